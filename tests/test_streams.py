import pytest
from pyspark.sql import functions as F

from fixtures import promotion_files
from tidemark.operators import gate
from tidemark.streaming import jobs

KEYS = ["model", "version", "decision", "status", "reason", "previous_production"]


def clock(spark, tmp_path):
    """A stream of ticks, none yet, and a function that adds one."""
    spark.createDataFrame([], "ts timestamp").write.parquet(f"{tmp_path}/clock")

    def tick(at):
        spark.sql(f"select timestamp '{at}' as ts").coalesce(1).write.mode("append").parquet(f"{tmp_path}/clock")

    return jobs.read_files(spark, f"{tmp_path}/clock", "ts timestamp"), tick


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (2, 0, 3, 1), (3, 2, 1, 0)])
def test_gate_stream_in_any_order_of_files_equals_the_batch_gate(spark, tmp_path, rows, order):
    folder, requests, config, tags = promotion_files(spark, tmp_path, order)
    ticks, tick = clock(spark, tmp_path)

    def run():
        stream = jobs.read_files(spark, folder, requests.schema, per_batch=1)
        jobs.decide_promotions(stream, config, tags, f"{tmp_path}/out", delay="3 days", clock=ticks).awaitTermination()

    run()
    audit = spark.read.parquet(f"{tmp_path}/out/audit")
    waiting = requests.count() - audit.count()
    assert waiting > 100
    # A restart from the checkpoint changes nothing by itself; a tick settles what waits.
    run()
    assert requests.count() - spark.read.parquet(f"{tmp_path}/out/audit").count() == waiting
    tick("2030-01-01 00:00:00")
    run()
    audit = spark.read.parquet(f"{tmp_path}/out/audit")
    assert rows(audit.select(*KEYS)) == rows(gate.gate_sequence(requests, config, tags).select(*KEYS))
    assert spark.read.parquet(f"{tmp_path}/out/quarantine").count() == 0


def test_late_promotion_requests_go_to_quarantine(spark, tmp_path, rows):
    folder, requests, config, tags = promotion_files(spark, tmp_path, (3, 0, 1, 2))
    ticks, tick = clock(spark, tmp_path)
    for _ in range(2):
        stream = jobs.read_files(spark, folder, requests.schema, per_batch=1)
        jobs.decide_promotions(stream, config, tags, f"{tmp_path}/out", delay="0 seconds", clock=ticks).awaitTermination()
        tick("2030-01-01 00:00:00")
    audit, late = (spark.read.parquet(f"{tmp_path}/out/{x}") for x in ("audit", "quarantine"))
    # The file of the last hundred requests came first, so all others were behind the watermark.
    assert {r["seq"] for r in late.collect()} == set(range(300)) and late.count() == 300
    want = gate.gate_sequence(requests.where("seq >= 300"), config, tags)
    assert rows(audit.select(*KEYS)) == rows(want.select(*KEYS))


def test_gate_stream_of_hard_requests_from_given_incumbents(spark, tmp_path, rows):
    """Null models, versions and times, equal times and seq, repeated requests, and a model in production."""
    _, _, config, tags = promotion_files(spark, tmp_path)
    asked = [("m0", str(2 * (i % 9)), "a", 1_700_000_000_000_000 + i // 3, i % 2) for i in range(60)]
    asked += [(None, "1", "a", 1_700_000_000_000_000, 1), ("m1", None, "a", 1_700_000_000_000_001, None), ("m1", "3", "a", None, 3),
              ("m1", "3", "a", 1_700_000_000_000_001, None), ("m1", "3", "a", 1_700_000_000_000_001, 4), ("none", "1", "", 5, 5)]
    df = spark.createDataFrame(asked, "model string, version string, approved_by string, us long, seq long")
    df = df.withColumn("ts", F.timestamp_micros("us")).drop("us")
    df.write.parquet(f"{tmp_path}/asked")
    incumbents = spark.createDataFrame(
        [("m0", "p", 0.3), ("other", "q", 0.9)], "model string, incumbent_version string, incumbent_score double"
    )
    ticks, tick = clock(spark, tmp_path)
    for _ in range(2):
        stream = jobs.read_files(spark, f"{tmp_path}/asked", df.schema)
        jobs.decide_promotions(
            stream, config, tags, f"{tmp_path}/out", delay="1 day", clock=ticks, incumbents=incumbents
        ).awaitTermination()
        tick("2030-01-01 00:00:00")
    want = gate.gate_sequence(df, config, tags, incumbents)
    assert want.where("decision = 'promoted'").count() > 2
    assert rows(spark.read.parquet(f"{tmp_path}/out/audit").select(*KEYS)) == rows(want.select(*KEYS))


def test_land_and_dedup_over_many_batches(spark, tmp_path, rows):
    from tidemark.schemas import SCHEMA_V1

    df = spark.createDataFrame(
        [("a", "bullish", "2026-01-01 00:00:00"), ("b", "odd", "2026-01-01 00:01:00"),
         ("a", "bearish", "2026-01-01 00:02:00"), (None, "neutral", "2026-01-01 00:03:00")],
        "text string, label string, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    df.repartitionByRange(2, "ts").write.parquet(f"{tmp_path}/in")
    stream = jobs.read_files(spark, f"{tmp_path}/in", df.schema, per_batch=1)
    jobs.land(stream, SCHEMA_V1, f"{tmp_path}/lake", "t").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/lake/validated/t").count() == 2
    broken = spark.read.parquet(f"{tmp_path}/lake/quarantine/t")
    assert rows(broken.select(F.array_join("breaches", ","))) == [("label_vocabulary",), ("text_null",)]
    stream = jobs.read_files(spark, f"{tmp_path}/in", df.schema, per_batch=1)
    jobs.collect_pool(stream, "ts", "1 hour", f"{tmp_path}/pool").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/pool").select("text")) == [("a",), ("b",)]
