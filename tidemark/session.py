"""Session defaults and the places where intermediate tables are written."""

from __future__ import annotations

import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Spark's setting by which shuffle files are removed at the end of a query, not when the driver happens to collect garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; extra keywords are Spark settings."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it then gets a fresh temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        path = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once and read it back.

    Cuts lineage, survives the loss of executors, and gives Catalyst the real size of the table, so
    that a later join is broadcast or shuffled by its measured size. Its shuffle files go as soon as it is written.
    """
    spark = df.sparkSession
    path, before = new_path(spark, name), spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when the scan has fewer splits than cores (one small file, say).

    A table of ordinary size has more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = pathlib.Path(__file__).resolve().parent
        target = f"{tempfile.mkdtemp(prefix='tidemark-')}/{package.name}"
        context.addPyFile(shutil.make_archive(target, "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
