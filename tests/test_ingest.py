import json

import pytest
from pyspark.sql import functions as F

from tidemark import __version__
from tidemark.operators import corrupt, pool, validate
from tidemark.schemas import SCHEMA_V1, SCHEMAS
from tidemark.sources import readers, sinks
from tidemark.sources.adapters import Adapter, CsvAdapter, FeedAdapter, HubAdapter


def batch(spark, *pairs):
    return spark.createDataFrame(list(pairs), "text string, label string")


CLEAN = [("profits rose", "bullish"), ("shares fell", "bearish")]


def test_schema_v1_accepts_a_clean_batch(spark):
    assert SCHEMAS["v1"].name == "v1"
    assert validate.require_valid(batch(spark, *CLEAN), SCHEMA_V1) == 2


@pytest.mark.parametrize(
    "bad", [("profits rose", "positive"), (None, "bullish"), ("profits rose", None), ("profits rose", "Bullish")]
)
def test_schema_v1_rejects_a_broken_row(spark, bad):
    with pytest.raises(validate.SchemaError):
        validate.require_valid(batch(spark, CLEAN[0], bad), SCHEMA_V1)


def test_schema_v1_rejects_missing_and_mistyped_columns(spark):
    with pytest.raises(validate.SchemaError, match="label is missing"):
        validate.require_valid(batch(spark, *CLEAN).drop("label"), SCHEMA_V1)
    with pytest.raises(validate.SchemaError, match="label is int"):
        validate.require_valid(spark.createDataFrame([("a", 1)], "text string, label int"), SCHEMA_V1)


def test_fault_injection_breaks_a_copy_only(spark):
    keyed = batch(spark, *CLEAN).withColumn("k", F.when(F.col("label") == "bullish", 1).otherwise(2))
    first = corrupt.first_row(keyed, "k")
    faults = [corrupt.corrupt_label(keyed, first), corrupt.corrupt_null_text(keyed, first), corrupt.corrupt_drop_column(keyed)]
    for broken in faults:
        with pytest.raises(validate.SchemaError):
            validate.require_valid(broken, SCHEMA_V1)
    assert [r["label"] for r in faults[0].orderBy("k").collect()] == ["garbage", "bearish"]
    assert validate.require_valid(keyed, SCHEMA_V1) == 2


def test_life_cycle_order(spark, tmp_path):
    seen = []

    class Recorder(Adapter):
        def read(self):
            seen.append("read")
            return batch(spark, *CLEAN)

        def stage_raw(self, df):
            seen.append("stage_raw")
            return df

        def validate(self, df):
            seen.append("validate")

        def version(self, df):
            seen.append("version")

        def land(self, df):
            seen.append("land")

    Recorder(spark, str(tmp_path)).run()
    assert seen == ["read", "stage_raw", "validate", "version", "land"]
    with pytest.raises(TypeError):
        Adapter(spark, str(tmp_path))


CSV = (
    'text,label\n"A, quoted ""text""",0\nUp again,1\nFlat day,2\nDown,0\nRally,1\nNo news,2\n'
)


def test_csv_adapter_reads_maps_and_lands(spark, tmp_path, rows):
    path = tmp_path / "in.csv"
    path.write_text(CSV)
    adapter = CsvAdapter(spark, str(tmp_path / "lake"), str(path))
    got = dict(adapter.read().collect())
    assert got['A, quoted "text"'] == "bearish" and got["Up again"] == "bullish" and got["Flat day"] == "neutral"
    adapter.run()
    for zone in ("raw", "validated"):
        assert spark.read.parquet(f"{tmp_path}/lake/{zone}/coded_csv").count() == 6
        meta = spark.read.json(f"{tmp_path}/lake/{zone}/coded_csv.meta").first().asDict()
        assert meta == {"schema_version": "v1", "sdk_version": __version__, "rows": 6}
    adapter.run()
    assert spark.read.parquet(f"{tmp_path}/lake/validated/coded_csv").count() == 6


def test_broken_batch_lands_raw_only_and_lenient_mode_quarantines(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("text,label\nUp,1\nOdd,7\n")
    with pytest.raises(validate.SchemaError):
        CsvAdapter(spark, str(tmp_path / "strict"), str(path)).run()
    assert (tmp_path / "strict/raw/coded_csv").exists() and not (tmp_path / "strict/validated").exists()
    CsvAdapter(spark, str(tmp_path / "lenient"), str(path), strict=False).run()
    assert spark.read.parquet(f"{tmp_path}/lenient/validated/coded_csv").count() == 1
    bad = spark.read.parquet(f"{tmp_path}/lenient/quarantine/coded_csv").first()
    assert bad["text"] == "Odd" and bad["breaches"] == ["label_null"]


def test_feed_adapter(spark, tmp_path, rows):
    words = ["Bullish", "Somewhat-Bullish", "Neutral", "Somewhat-Bearish", "Bearish"]
    feed = [{"title": f"t{i}", "overall_sentiment_label": w, "extra": 1} for i, w in enumerate(words)]
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "a.json").write_text(json.dumps({"items": "5", "feed": feed}, indent=1))
    (pages / "b.json").write_text(json.dumps({"Note": "limit reached"}))
    adapter = FeedAdapter(spark, str(tmp_path), str(pages), topics="earnings")
    assert rows(adapter.read()) == [
        ("t0", "bullish"), ("t1", "bullish"), ("t2", "neutral"), ("t3", "bearish"), ("t4", "bearish"),
    ]
    assert readers.bad_feed_pages(spark, str(pages)).first()["page"].endswith("b.json")
    with pytest.raises(ValueError):
        FeedAdapter(spark, str(tmp_path), str(pages)).read()


def test_hub_adapter(spark, tmp_path, rows):
    data = [("a", "positive", 1), ("b", "negative", 2), ("c", "neutral", 3), ("d", "mixed", 4)]
    spark.createDataFrame(data, "text string, answer string, gold int").write.parquet(f"{tmp_path}/hub")
    got = rows(HubAdapter(spark, str(tmp_path), f"{tmp_path}/hub").read())
    assert got == [("a", "bullish"), ("b", "bearish"), ("c", "neutral"), ("d", None)]


def test_text_pairs_and_orphans(spark, tmp_path, rows):
    for split, name, kind in [("train", "x", "ects"), ("train", "x", "gt_summaries"), ("test", "y", "ects"),
                              ("test", "z", "gt_summaries")]:
        folder = tmp_path / split / kind
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.txt").write_text(f"  {kind} {name}\nline é \n", encoding="utf-8")
    pairs, orphans = readers.read_text_pairs(spark, str(tmp_path))
    assert rows(pairs) == [("train", "x", "ects x\nline é", "gt_summaries x\nline é")]
    assert rows(orphans) == [("test", "y", "right"), ("test", "z", "left")]
    with pytest.raises(ValueError):
        readers.require_paired(orphans)


def test_jsonl_headlines_metrics_and_logs(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", [0.1, 0.2, 0.7])], readers.SOFT_LABEL_SCHEMA)
    sinks.write_jsonl(df, f"{tmp_path}/soft")
    (tmp_path / "soft" / "more.json").write_text('\n{"text": "b", "probs": [1, 0, 0]}\n\n')
    assert rows(readers.read_jsonl(spark, f"{tmp_path}/soft", readers.SOFT_LABEL_SCHEMA)) == [
        ("a", [0.1, 0.2, 0.7]), ("b", [1.0, 0.0, 0.0]),
    ]
    (tmp_path / "h.csv").write_text('text\n"The central bank, again"\n"Say ""hi"""\n')
    assert rows(readers.read_headlines_csv(spark, f"{tmp_path}/h.csv")) == [('Say "hi"',), ("The central bank, again",)]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "v1.json").write_text(json.dumps({"test_f1": 0.5, "n_test": 4}, indent=2))
    got = readers.read_metrics(spark, f"{tmp_path}/m").first()
    assert (got["test_f1"], got["n_test"], got["metric"]) == (0.5, 4, None) and got["path"].endswith("v1.json")
    event = spark.createDataFrame([("m", "promoted")], "model string, decision string")
    for _ in range(2):
        sinks.append_log(event, f"{tmp_path}/audit")
    assert spark.read.json(f"{tmp_path}/audit").where("ts is not null and date is not null").count() == 2
    sinks.append_run(spark, f"{tmp_path}/runs", "r1", {"C": 10, "val_f1": 0.5})
    assert rows(spark.read.parquet(f"{tmp_path}/runs")) == [("r1", "C", "10"), ("r1", "val_f1", "0.5")]


def test_manifest_counts_every_file_and_sees_changes(spark, tmp_path):
    (tmp_path / "d" / "sub").mkdir(parents=True)
    (tmp_path / "d" / "a.bin").write_bytes(b"123")
    (tmp_path / "d" / "sub" / "b.bin").write_bytes(b"4567")
    one = readers.dataset_manifest(spark, f"{tmp_path}/d").first()
    assert (one["nfiles"], one["size"]) == (2, 7)
    (tmp_path / "d" / "a.bin").write_bytes(b"124")
    assert readers.dataset_manifest(spark, f"{tmp_path}/d").first()["digest"] != one["digest"]


def test_pool_skips_nulls_and_copies_and_merges(spark, rows):
    first = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "text string")
    second = spark.createDataFrame([("b",), ("c",)], "text string")
    stored = pool.pool_texts([first], spark)
    fresh = pool.new_texts(pool.pool_texts([second], spark), stored)
    assert rows(stored.select("text")) == [("a",), ("b",)] and rows(fresh.select("text")) == [("c",)]
    assert pool.pool_texts([], spark).count() == 0


def test_windows_are_disjoint_and_newest_first(spark):
    end = F.lit("2026-07-01 12:30:00").cast("timestamp")
    got = pool.time_windows(spark, end).orderBy("idx").collect()
    assert len(got) == 25 and got[0]["time_to"] == "20260701T1230" and got[0]["time_from"] == "20260617T1230"
    assert all(a["time_from"] == b["time_to"] for a, b in zip(got, got[1:]))
    ts = spark.createDataFrame([("2026-07-01 12:30:00",), ("2026-06-17 12:30:00",), ("2026-07-02 00:00:00",)], "s string")
    idx = ts.select(pool.window_index(F.col("s").cast("timestamp"), end).alias("i")).collect()
    assert [r["i"] for r in idx] == [0, 1, None]


def test_encoding_report(spark):
    df = spark.sql("select cast(x'C328' as string) as text union all select 'fine' union all select 'odd �'")
    got = validate.encoding_report(df, "text").first()
    assert (got["n_rows"], got["n_invalid"], got["n_replaced"]) == (3, 1, 1)
