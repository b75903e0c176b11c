"""Publishing a table in stages: data are written aside and become visible by one row of a manifest.

A table's folder holds ``data/<run>-<unique>`` for every run that wrote and ``manifest``, an append-only table with one
row for each run that finished. Spark's commit puts the file with that row in place at once. So a run that is killed
leaves data nobody reads and the old table as it was, and a run that is started again under the same name finds its row
and adds nothing.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST = "run_id string, path string, n_rows bigint, mode string, seq bigint, ts timestamp"


def manifest(spark: SparkSession, table: str) -> DataFrame:
    """The runs that finished, the first row of each where two wrote under one name at the same time."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{table}/manifest")
        rows.isEmpty()
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST)
    first = Window.partitionBy("run_id").orderBy("seq", "ts", "path")
    return rows.withColumn("_at", F.row_number().over(first)).where("_at = 1").drop("_at")


def publish(df: DataFrame, table: str, run_id: str, mode: str = "overwrite") -> int:
    """Makes ``df`` the table (``overwrite``) or a part of it (``append``) and gives its number of rows.

    ``run_id`` names the run: publishing again under the same name changes nothing and gives the number found.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append; got {mode!r}")
    spark = df.sparkSession
    known = manifest(spark, table)
    done = known.where(F.col("run_id") == run_id).first()
    if done is not None:
        return done["n_rows"]
    path, seen = f"{table}/data/{run_id}-{uuid.uuid4().hex}", Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    n = seen.get["n"]
    seq = (known.agg(F.max("seq")).first()[0] or 0) + 1
    row = spark.createDataFrame([(run_id, path, n, mode, seq)], "run_id string, path string, n_rows bigint, mode string, seq bigint")
    row.withColumn("ts", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{table}/manifest")
    return n


def read_published(spark: SparkSession, table: str, schema) -> DataFrame:
    """The table as the last finished run left it; without any, no rows."""
    known = manifest(spark, table)
    base = known.where("mode = 'overwrite'").agg(F.max("seq")).first()[0] or 0
    paths = [r["path"] for r in known.where(F.col("seq") >= base).select("path").collect()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
