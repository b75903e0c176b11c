"""The model registry as append-only tables: tag events, dossiers, production pointers.

Tag events are ``(model, version, key, value, ts, seq)`` with string values; the latest event of a
key is in force, so setting a tag twice or backfilling it is a plain append.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.fingerprint import table_fingerprint

# The tags of a dossier and the kinds of model that may be registered.
DOSSIER = ["test_f1", "eval_set_hash", "schema_version", "code_commit", "model_kind"]
MODEL_KINDS = ["distilbert", "lora_adapter", "sklearn"]


def latest_tags(tags: DataFrame) -> DataFrame:
    """Tag values in force: one row per (model, version, key)."""
    return tags.groupBy("model", "version", "key").agg(
        F.max_by("value", F.struct("ts", "seq")).alias("value")
    )


def dossiers(tags: DataFrame, keys: list[str] = DOSSIER) -> DataFrame:
    """One row per (model, version) with a column per tag; one grouping reads them all."""
    def newest(key: str) -> Column:
        return F.max_by("value", F.when(F.col("key") == key, F.struct("ts", "seq"))).alias(key)

    return tags.groupBy("model", "version").agg(*[newest(k) for k in keys])


def latest_versions(tags: DataFrame) -> DataFrame:
    """Highest version per model, compared as numbers."""
    return tags.groupBy("model").agg(F.max(F.col("version").cast("bigint")).alias("version"))


def production_pointer(audit: DataFrame) -> DataFrame:
    """Version in production per model: that of the last accepted promotion."""
    won = audit.where("decision = 'promoted'")
    return won.groupBy("model").agg(F.max_by("version", F.struct("ts", "seq")).alias("version"))


def production_view(audit: DataFrame, tags: DataFrame) -> DataFrame:
    """Models in production with their dossiers."""
    return production_pointer(audit).join(dossiers(tags), ["model", "version"], "left")


def provenance(tags: DataFrame) -> DataFrame:
    """Which code, schema and test set produced each version."""
    return dossiers(tags, ["code_commit", "schema_version", "eval_set_hash"])


def register_version(
    tags: DataFrame,
    model: str,
    test_set: DataFrame,
    test_f1: float,
    model_kind: str,
    code_commit: str,
    schema_version: str = "v1",
    n_test: int | None = None,
) -> tuple[str, DataFrame]:
    """The next version and its tag events, to be appended to ``tags``.

    The kind must be known. A score computed elsewhere must name as many test rows as there are. The
    fingerprint of the test set is computed here, never taken from the caller.
    """
    if model_kind not in MODEL_KINDS:
        raise ValueError(f"model_kind must be one of {MODEL_KINDS}; got {model_kind!r}")
    print_row = table_fingerprint(test_set).first()
    if n_test is not None and n_test != print_row["n_rows"]:
        raise ValueError(f"the score names {n_test} test rows, the test set has {print_row['n_rows']}")
    last = latest_versions(tags.where(F.col("model") == model)).first()
    version = str((last["version"] if last else 0) + 1)
    values = {
        "test_f1": str(test_f1),
        "eval_set_hash": print_row["digest"],
        "schema_version": schema_version,
        "code_commit": code_commit,
        "model_kind": model_kind,
    }
    return version, tag_events(tags.sparkSession, model, version, values)


def tag_events(spark, model: str, version: str, values: dict[str, str]) -> DataFrame:
    rows = spark.createDataFrame(
        [(model, version, k, v, i) for i, (k, v) in enumerate(values.items())],
        "model string, version string, key string, value string, seq bigint",
    )
    return rows.select("model", "version", "key", "value", F.current_timestamp().alias("ts"), "seq")


def backfill(tags: DataFrame, key: str, value: Column) -> DataFrame:
    """Events that set ``key`` on every version that lacks it or holds another value.

    Running it again on the result adds nothing.
    """
    versions = tags.groupBy("model", "version").agg(
        F.max_by("value", F.when(F.col("key") == key, F.struct("ts", "seq"))).alias("_old"),
        F.max("ts").alias("_ts"),
        F.max("seq").alias("_seq"),
    )
    return versions.withColumn("value", value).where("value is not null and not (value <=> _old)").select(
        "model", "version", F.lit(key).alias("key"), "value",
        F.col("_ts").alias("ts"), (F.col("_seq") + 1).alias("seq"),
    )
