import json

from tidemark.schemas import SCHEMA_V1
from tidemark.sources import feed_stream
from tidemark.streaming import jobs


def page(folder, number, *articles, body=None):
    folder.mkdir(exist_ok=True)
    told = {"feed": [{"title": t, "overall_sentiment_label": s} for t, s in articles]}
    (folder / f"page-{number:04d}.json").write_text(json.dumps(told) if body is None else body)


def test_pages_are_read_in_their_order_once_and_without_gaps(spark, tmp_path, rows):
    folder, root = tmp_path / "pages", f"{tmp_path}/lake"

    def run():
        jobs.land_feed(feed_stream.read_feed_stream(spark, str(folder)), SCHEMA_V1, root, "feed").awaitTermination()
        return spark.read.parquet(f"{root}/validated/feed"), spark.read.parquet(f"{root}/quarantine/feed")

    page(folder, 2, ("b", "Bearish"))
    page(folder, 1, ("a", "Bullish"), ("no label", "Odd"))
    page(folder, 4, ("d", "Neutral"))
    (folder / "notes.txt").write_text("not a page")
    good, bad = run()
    assert rows(good.select("page", "text", "label")) == [(1, "a", "bullish"), (2, "b", "bearish")]
    assert rows(bad.select("page", "text")) == [(1, "no label")]
    # The gap closes: the stream goes on from its offset.
    page(folder, 3, body='{"Note": "rate limit"}')
    page(folder, 5, body="<html>")
    page(folder, 6, ("f", "Somewhat-Bullish"))
    good, bad = run()
    assert rows(good.select("page", "text")) == [(1, "a"), (2, "b"), (4, "d"), (6, "f")]
    assert {(r["page"], r["breaches"][0]) for r in bad.where("page > 1").collect()} == {(3, "page has no feed"), (5, "page is no JSON")}
    assert sorted(r[0] for r in good.select("batch_id").distinct().collect()) == [0, 1]
    run()
    assert good.count() == spark.read.parquet(f"{root}/validated/feed").count() == 4


def test_a_replayed_batch_reads_the_same_pages(tmp_path):
    for n in range(1, 4):
        page(tmp_path / "p", n, (f"t{n}", "Neutral"))
    reader = feed_stream.FeedReader(str(tmp_path / "p"))
    end = reader.latestOffset()
    read = lambda: [row for part in reader.partitions({"page": 1}, end) for row in reader.read(part)]
    first = read()
    page(tmp_path / "p", 4, ("late", "Neutral"))
    assert read() == first == [(2, 0, "t2", "Neutral", None), (3, 0, "t3", "Neutral", None)]
    assert reader.latestOffset() == {"page": 4}


def test_odd_pages():
    got = list(feed_stream.parse_page(7, b'{"feed": [null, {"title": 5}, {"title": "x", "overall_sentiment_label": null}]}'))
    assert got == [(7, 0, None, None, None), (7, 1, "5", None, None), (7, 2, "x", None, None)]
    assert [r[4] for r in feed_stream.parse_page(1, b"[1]")] == ["page has no feed"]
