"""Structured Streaming jobs. Each equals its batch operator on the same data.

Sinks written in ``foreachBatch`` go to one ``batch_id=`` folder per micro-batch in overwrite mode, so
a batch that is replayed after a failure replaces its own output. A job reads all that is there and
stops (``availableNow``) or, given another trigger, goes on. A job that is given no checkpoint keeps it beside its
output, so starting it again on that output goes on where it stopped.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.scores import psi_from_counts, unit_bin
from tidemark.functions.text import tokens
from tidemark.operators import drift, gate, routing, validate
from tidemark.operators.pool import text_hash
from tidemark.operators.scorers import Scorer
from tidemark.schemas import TextSchema
from tidemark.sources.feed_stream import labelled
from tidemark.sources.readers import FEED_LABELS
from tidemark.streaming import promotions

NOW = {"availableNow": True}


def read_files(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", per_batch: int | None = None):
    """Stream over the parquet files of a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(folder)


def _batches(stream: DataFrame, write, checkpoint: str, trigger: dict) -> StreamingQuery:
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _append(stream: DataFrame, path: str, checkpoint: str | None, trigger: dict) -> StreamingQuery:
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint or f"{path}/_checkpoint").option("path", path).trigger(**trigger).start()
    )


@contextmanager
def _rocks(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which keyed state with timers needs."""
    prefix = "spark.sql.streaming.stateStore."
    wanted = {
        f"{prefix}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # Of all stores of an executor together; without it each has caches and buffers of its own.
        f"{prefix}rocksdb.boundedMemoryUsage": "true",
        f"{prefix}rocksdb.maxMemoryUsageMB": "256",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def land(stream: DataFrame, schema: TextSchema, root: str, name: str, checkpoint=None, trigger=NOW) -> StreamingQuery:
    """Validates every micro-batch; good rows to the validated zone, broken ones to quarantine."""
    def write(batch: DataFrame, batch_id: int) -> None:
        good, broken = validate.split_batch(batch, schema)
        _write_batch(good, f"{root}/validated/{name}", batch_id)
        _write_batch(broken, f"{root}/quarantine/{name}", batch_id)

    return _batches(stream, write, checkpoint or f"{root}/_checkpoints/{name}", trigger)


def land_feed(articles: DataFrame, schema: TextSchema, root: str, name: str, checkpoint=None, trigger=NOW) -> StreamingQuery:
    """Articles of ``feed_stream.read_feed_stream`` to the validated zone, broken ones and broken pages to quarantine."""
    def write(batch: DataFrame, batch_id: int) -> None:
        good, broken = validate.split_batch(labelled(batch, FEED_LABELS), schema)
        _write_batch(good, f"{root}/validated/{name}", batch_id)
        pages = batch.where("problem is not null").select("page", F.array("problem").alias("breaches"))
        _write_batch(broken.unionByName(pages, allowMissingColumns=True), f"{root}/quarantine/{name}", batch_id)

    return _batches(articles, write, checkpoint or f"{root}/_checkpoints/{name}", trigger)


def unique_texts(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Drops repeated texts; a text is remembered for ``delay`` of event time."""
    return (
        stream.where("text is not null").withColumn("text_hash", text_hash())
        .withWatermark(ts, delay).dropDuplicatesWithinWatermark(["text_hash"])
    )


def collect_pool(stream: DataFrame, ts: str, delay: str, path: str, checkpoint=None, trigger=NOW) -> StreamingQuery:
    return _append(unique_texts(stream, ts, delay), path, checkpoint, trigger)


def drift_windows(
    stream: DataFrame, vocab: DataFrame, reference: list[int], key: str, text: str, ts: str, width: str, delay: str
) -> DataFrame:
    """Stability index per closed time window against the frozen histogram of the reference.

    Tokens meet the vocabulary in a stream-static join, are summed per text and window, and the texts
    are counted per bin. Rows later than the watermark are dropped.
    """
    known = vocab.select("token", F.lit(True).alias("known"))
    words = (
        stream.withWatermark(ts, delay)
        .select(F.window(ts, width).alias("window"), key, F.explode_outer(tokens(F.col(text))).alias("token"))
        .join(known, "token", "left")
    )
    has_token = F.col("token").isNotNull()
    per_text = words.groupBy("window", key).agg(
        F.count_if(has_token & F.col("known").isNull()).alias("u"), F.count_if(has_token).alias("n")
    )
    rate = F.when(F.col("n") > 0, F.col("u") / F.col("n")).otherwise(F.lit(0.0))
    binned = per_text.select("window", unit_bin(rate).alias("bin"))
    counts = F.array(*[F.count_if(F.col("bin") == k) for k in range(10)])
    frozen = F.array(*[F.lit(int(x)) for x in reference])
    return (
        binned.groupBy("window").agg(F.count("*").alias("n"), counts.alias("h"))
        .select(F.col("window.start").alias("start"), "n", psi_from_counts(frozen, F.col("h")).alias("psi"))
        .withColumn("alert", F.col("psi") > drift.PSI_THRESHOLD)
    )


def watch_drift(windows: DataFrame, path: str, checkpoint=None, trigger=NOW) -> StreamingQuery:
    return _append(windows, path, checkpoint, trigger)


def answer(
    stream: DataFrame, backends: dict[str, Scorer], path: str, models: DataFrame, checkpoint=None, trigger=NOW,
    threshold: float = routing.THRESHOLD,
) -> StreamingQuery:
    """Routes and scores requests; answers go to the prediction log, the rest to quarantine.

    ``models`` says which version and kind serves each backend, see ``routing.prediction_log``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        answers, broken = routing.route(batch, backends, threshold, strict=False)
        _write_batch(routing.prediction_log(answers, models), f"{path}/answers", batch_id)
        _write_batch(broken, f"{path}/quarantine", batch_id)

    return _batches(stream, write, checkpoint or f"{path}/_checkpoint", trigger)


def decide_promotions(
    stream: DataFrame, config: DataFrame, tags: DataFrame, path: str, checkpoint=None, trigger=NOW, delay: str = "0 seconds",
    clock: DataFrame | None = None, incumbents: DataFrame | None = None,
) -> StreamingQuery:
    """Promotion requests in order of their time, whatever the order in which they come.

    Decisions go to ``audit`` once the watermark, the latest time seen less ``delay``, has reached the request; until then
    the request waits in the state of its model. Requests whose millisecond the watermark had reached when they came are
    late and go to ``quarantine``. ``clock`` is a stream with a column ``ts`` that moves the watermark when no request
    does, at the end of a feed for instance. ``incumbents`` are those of the batch gate, for the first start only.
    Configuration and tags are those at the start of the job.
    """
    none = {"model": "string", "version": "string", "approved_by": "string", "seq": "bigint"}
    asked = stream.select(*[F.col(c).cast(t) for c, t in none.items()], F.col("ts").cast("timestamp").alias("ts"), F.lit(False).alias("_tick"))
    if clock is not None:
        ticks = clock.select(*[F.lit(None).cast(t).alias(c) for c, t in none.items()], F.col("ts").cast("timestamp").alias("ts"), F.lit(True).alias("_tick"))
        asked = asked.unionByName(ticks)
    rows = gate.with_dossiers(asked.withWatermark("ts", delay), config, tags)
    rows = rows.withColumn("_static", F.coalesce(gate.static_refusal(), gate.undated()))

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_batch(gate.decided(batch.where("not late")), f"{path}/audit", batch_id)
        _write_batch(batch.where("late").select("model", "version", "approved_by", "ts", "seq"), f"{path}/quarantine", batch_id)

    spark = stream.sparkSession
    with _rocks(spark):
        return _batches(promotions.in_order(rows, incumbents), write, checkpoint or f"{path}/_checkpoint", trigger)


def delayed_pairs(
    predictions: DataFrame, truths: DataFrame, key: str, horizon: str, delay: str
) -> DataFrame:
    """Predictions with the labels that arrive within the horizon: a stream-stream interval join.

    ``predictions``: key, label, ts; ``truths``: key, true_label, label_ts.
    """
    left = predictions.withWatermark("ts", delay)
    right = truths.withColumnRenamed(key, "_key").withWatermark("label_ts", delay)
    matched = left.join(
        right,
        (F.col(key) == F.col("_key"))
        & (F.col("label_ts") >= F.col("ts"))
        & (F.col("label_ts") <= F.col("ts") + F.expr(f"interval {horizon}")),
    )
    return matched.drop("_key").withColumn("correct", F.col("label") == F.col("true_label"))


def log_delayed_pairs(pairs: DataFrame, path: str, checkpoint=None, trigger=NOW) -> StreamingQuery:
    return _append(pairs, path, checkpoint, trigger)
