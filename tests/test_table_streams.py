import pytest
from pyspark.sql import functions as F

from tidemark.plans import streams


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """The same documents as one file and as a folder of part files."""
    root = tmp_path_factory.mktemp("tables")
    texts = ["word " * 20, "another text " * 9, "short", "word " * 20, None, "wort " * 30]
    rows = [(i, t, "en" if i % 2 else "xx", "s", 0 if t is None else len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    (root / "file").mkdir()
    docs.coalesce(1).write.parquet(f"{root}/one")
    next((root / "one").glob("part-*.parquet")).rename(root / "file" / "documents.parquet")
    docs.repartition(3).write.parquet(f"{root}/folder/documents.parquet")
    events = spark.range(200).selectExpr(
        "id as event_id", "timestamp_seconds(1700000000 + id) as ts", "id as user_id", "'view' as event_type", "1.0D as value",
        "'{}' as props",
    )
    for kind in ("file", "folder"):
        events.write.parquet(f"{root}/{kind}/events.parquet")
    return root


@pytest.mark.parametrize("job", [streams.stream_land, streams.stream_dedup, streams.stream_route])
def test_a_stream_reads_a_table_of_part_files(spark, folders, rows, job):
    one, many = (rows(job(spark, f"{folders}/{kind}")) for kind in ("file", "folder"))
    assert one and one == many


def test_streams_of_tables_read_every_row_once(spark, folders):
    for kind in ("file", "folder"):
        stream = streams.stream(spark, f"{folders}/{kind}/", "documents")
        query = stream.agg(F.count("*").alias("n")).writeStream.format("memory").queryName(f"seen_{kind}").outputMode("complete")
        query.trigger(availableNow=True).start().awaitTermination()
        assert spark.table(f"seen_{kind}").first()["n"] == 6
