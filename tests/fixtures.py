import os
import random

from pyspark.sql import functions as F

CONFIG_ROWS = [("m0", "h", "v1", 0.01, 0.40, "F1"), ("m1", "h", "v1", 0.02, 0.0, "ROUGE-L")]


def promotion_files(spark, tmp_path, order=(0, 1, 2, 3)):
    """400 requests for two models in four files by time, with configuration and tags.

    ``order`` names the files in the order in which a stream of files meets them, which is that of their time stamps.
    """
    rng = random.Random(11)
    rows = [(f"m{i % 2}", str(i), "a" if i % 7 else "", i, round(rng.random(), 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "model string, version string, approved_by string, seq bigint, score double")
    df = df.withColumn("ts", F.timestamp_seconds(F.col("seq") * 600 + 1_700_000_000))
    requests = df.select("model", "version", "approved_by", "ts", "seq")
    for part in range(4):
        requests.where(f"seq div 100 = {part}").coalesce(1).write.parquet(f"{tmp_path}/p{part}")
    folder = tmp_path / "requests"
    folder.mkdir()
    for part in range(4):
        source = next((tmp_path / f"p{part}").glob("part-*.parquet"))
        (folder / f"{part}.parquet").write_bytes(source.read_bytes())
        stamp = 1_700_000_000 + 10 * order.index(part)
        os.utime(folder / f"{part}.parquet", (stamp, stamp))
    pairs = F.array(*[
        F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
        for k, v in (("test_f1", F.col("score")), ("eval_set_hash", F.lit("h")), ("schema_version", F.lit("v1")))
    ])
    tags = df.select("model", "version", "ts", "seq", F.inline(pairs))
    config = spark.createDataFrame(
        CONFIG_ROWS,
        "model string, expected_hash string, expected_schema string, margin double, floor double, metric_label string",
    )
    return str(folder), requests, config, tags
