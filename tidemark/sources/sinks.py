"""Sinks: lake zones with provenance, JSON lines, append-only logs, metric and run tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark import __version__


def write_zone(df: DataFrame, root: str, zone: str, name: str) -> int:
    """Overwrites one batch in a zone; the row count is observed during the write, not by a rescan."""
    seen = Observation(f"{zone}_{name}")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{root}/{zone}/{name}")
    return seen.get["rows"]


def write_sidecar(spark, root: str, zone: str, name: str, schema_version: str, rows: int) -> dict:
    """Provenance beside a batch: schema version, library version, number of rows."""
    meta = {"schema_version": schema_version, "sdk_version": __version__, "rows": rows}
    row = spark.createDataFrame([meta], "schema_version string, sdk_version string, rows bigint")
    row.write.mode("overwrite").json(f"{root}/{zone}/{name}.meta")
    return meta


def write_jsonl(df: DataFrame, path: str, *partition: str, mode: str = "overwrite") -> None:
    """One JSON object per line, in as many part files as there are partitions."""
    df.write.mode(mode).partitionBy(*partition).json(path)


def append_log(df: DataFrame, path: str, ts: str = "ts") -> None:
    """Append-only log of JSON lines, partitioned by UTC date; rows without a time get the present."""
    if ts not in df.columns:
        df = df.withColumn(ts, F.current_timestamp())
    df.withColumn("date", F.to_date(ts)).write.mode("append").partitionBy("date").json(path)


def append_metrics(df: DataFrame, path: str) -> None:
    """Adds evaluation results to the metrics table."""
    df.withColumn("ts", F.current_timestamp()).write.mode("append").parquet(path)


def write_report(df: DataFrame, path: str, about: dict[str, str]) -> None:
    """Result table of a benchmark run as one JSON document: the fields of ``about``, and the rows in ``rows``.

    For summaries, one row per level or setting: the rows meet in one document, in the order of their columns.
    """
    rows = df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias("rows"))
    rows.select(*[F.lit(v).alias(k) for k, v in about.items()], "rows").write.mode("overwrite").json(path)


def append_run(spark, path: str, run_id: str, values: dict) -> None:
    """Parameters and metrics of one run as ``(run_id, key, value)`` rows; values are strings."""
    rows = [(run_id, k, str(v)) for k, v in values.items()]
    spark.createDataFrame(rows, "run_id string, key string, value string").write.mode("append").parquet(path)
