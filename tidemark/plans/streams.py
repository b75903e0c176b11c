"""The streaming jobs run over the test tables until all rows are read; each has its batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import hash_bucket, hash_int
from tidemark.operators import drift
from tidemark.plans import drift as drift_plans
from tidemark.plans import governance
from tidemark.plans.drift import RATES, train_vocabulary, written_rates
from tidemark.plans.ingest import BATCH, LANGS3
from tidemark.plans.registry import ORACLES, query, table
from tidemark.session import new_path
from tidemark.streaming import jobs


def stream(spark, sf_dir, name):
    """A test table, one file or a folder of part files, as a stream."""
    # The braces make the path a pattern, which Spark follows to files and into folders alike.
    return jobs.read_files(spark, f"{sf_dir.rstrip('/')}/{{{name}}}.parquet", table(spark, sf_dir, name).schema)


def documents_in_time(df):
    """One document per minute of 2024."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return df.withColumn("ts", start + F.make_dt_interval(mins=F.col("doc_id").cast("int")))


@query(
    "stream_land",
    BATCH
    + """
SELECT doc_id, CASE WHEN text IS NULL OR label NOT IN ('en', 'de', 'fr') THEN 'quarantine' ELSE 'validated' END AS zone
FROM d
""",
)
def stream_land(spark, sf_dir):
    docs = stream(spark, sf_dir, "documents")
    batch = docs.select(
        "doc_id", F.when(F.col("n_chars") >= 50, F.col("text")).alias("text"), F.col("lang").alias("label")
    )
    root = new_path(spark, "zones")
    jobs.land(batch, LANGS3, root, "documents").awaitTermination()
    parts = [
        spark.read.parquet(f"{root}/{zone}/documents").select("doc_id", F.lit(zone).alias("zone"))
        for zone in ("validated", "quarantine")
    ]
    return parts[0].unionByName(parts[1])


@query("stream_dedup", "SELECT DISTINCT sha256(text) AS text_hash FROM documents")
def stream_dedup(spark, sf_dir):
    path = new_path(spark, "pool")
    docs = documents_in_time(stream(spark, sf_dir, "documents").select("doc_id", "text"))
    jobs.collect_pool(docs, "ts", "3650 days", path).awaitTermination()
    return spark.read.parquet(path).select("text_hash")


@query(
    "stream_drift",
    RATES
    + f""",
w AS (SELECT time_bucket(INTERVAL 4 HOUR, TIMESTAMP '2024-01-01' + to_minutes(doc_id)) AS w,
             {drift_plans.BIN} AS bin FROM rates WHERE NOT is_ref),
last AS (SELECT max(TIMESTAMP '2024-01-01' + to_minutes(doc_id)) - INTERVAL 10 MINUTE AS mark FROM rates WHERE NOT is_ref),
grid AS (SELECT w, bin FROM (SELECT DISTINCT w FROM w, last WHERE w + INTERVAL 4 HOUR <= mark), range(10) t(bin)),
ref AS (SELECT {drift_plans.BIN} AS bin, count(*) AS n FROM rates WHERE is_ref GROUP BY 1),
cur AS (SELECT w, bin, count(*) AS n FROM w GROUP BY ALL),
s AS (SELECT g.w, coalesce(cur.n, 0) AS n,
             greatest(coalesce(ref.n, 0) / (SELECT sum(n) FROM ref), 1e-6) AS r,
             greatest(coalesce(cur.n, 0) / sum(coalesce(cur.n, 0)) OVER (PARTITION BY g.w), 1e-6) AS c
      FROM grid g LEFT JOIN ref ON g.bin = ref.bin LEFT JOIN cur ON cur.w = g.w AND cur.bin = g.bin)
SELECT strftime(w, '%Y-%m-%dT%H:%M') AS start, cast(sum(n) AS bigint) AS n, round(sum((c - r) * ln(c / r)), 6) AS psi,
       sum((c - r) * ln(c / r)) > 0.2 AS alert
FROM s GROUP BY w
""",
)
def stream_drift(spark, sf_dir):
    reference = written_rates(spark, sf_dir).where("is_ref")
    frozen = reference.agg(drift.bin_counts("oov_rate").alias("h")).first()["h"]
    docs = stream(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    live = documents_in_time(docs.withColumn("b", hash_bucket(F.col("doc_id"), 1000)).where(
        "not (lang = 'en' and (b < 700 or b >= 850))"
    ))
    windows = jobs.drift_windows(
        live, train_vocabulary(spark, sf_dir), frozen, "doc_id", "text", "ts", "4 hours", "10 minutes"
    )
    path = new_path(spark, "drift_windows")
    jobs.watch_drift(windows, path).awaitTermination()
    out = spark.read.schema("start timestamp, n bigint, psi double, alert boolean").parquet(path)
    return out.withColumn("start", F.date_format("start", "yyyy-MM-dd'T'HH:mm")).withColumn("psi", F.round("psi", 6))


@query(
    "stream_route",
    f"""
WITH c AS ({ORACLES["cascade"]}), m AS ({governance.SERVING_SQL})
SELECT c.*, CASE WHEN c.served_by <> 'summarizer' THEN c.output END AS label, m.model_version, m.model_kind,
       strftime(TIMESTAMP '2024-01-01' + to_minutes(c.doc_id), '%Y-%m-%dT%H:%M') AS ts
FROM c LEFT JOIN m USING (served_by)
""",
)
def stream_route(spark, sf_dir):
    def pick(salt, names):
        return F.get(F.array(*[F.lit(v) for v in names.values()]), (hash_int(F.col("doc_id"), salt) % 5).cast("int"))

    requests = documents_in_time(stream(spark, sf_dir, "documents")).select(
        "doc_id", pick("task", governance.TASKS).alias("task"), pick("tier", governance.TIERS).alias("tier"), "lang", "source", "ts"
    )
    path = new_path(spark, "predictions")
    jobs.answer(requests, governance.backends(), path, governance.serving_models(spark, sf_dir)).awaitTermination()
    return spark.read.parquet(f"{path}/answers").select(
        "doc_id", "output", "served_by", "escalated", "label", "model_version", "model_kind",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("ts"),
    )


@query("stream_gate", ORACLES["gate_sequence"])
def stream_gate(spark, sf_dir):
    requests = stream(spark, sf_dir, "events").select(
        F.concat(F.lit("m"), F.col("user_id") % 20).alias("model"), F.col("event_id").cast("string").alias("version"),
        F.when(F.col("event_type") == "signup", "").otherwise("ops").alias("approved_by"), "ts",
        F.col("event_id").alias("seq"),
    )
    path, ticks = new_path(spark, "promotions"), new_path(spark, "clock")
    spark.createDataFrame([], "ts timestamp").write.parquet(ticks)
    for _ in range(2):
        # The second run goes on from the first one's state; the tick settles what waits for its time.
        jobs.decide_promotions(
            requests, governance.config(spark, sf_dir), governance.tag_events(spark, sf_dir), path, delay="1 hour",
            clock=jobs.read_files(spark, ticks, "ts timestamp"),
        ).awaitTermination()
        spark.sql("select timestamp '9999-01-01 00:00:00' as ts").coalesce(1).write.mode("append").parquet(ticks)
    return spark.read.parquet(f"{path}/audit").select("model", "version", "decision", "status", "reason", "previous_production")


@query("stream_delayed_accuracy", ORACLES["delayed_label_accuracy"])
def stream_delayed_accuracy(spark, sf_dir):
    events = stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    preds = events.select("event_id", F.col("event_type").alias("label"), "ts", (F.col("user_id") % 10).alias("model"))
    truths = stream(spark, sf_dir, "events").select(
        (F.col("event_id") - 7).alias("event_id"), F.col("event_type").alias("true_label"),
        F.col("ts").cast("timestamp").alias("label_ts"),
    )
    path = new_path(spark, "pairs")
    jobs.log_delayed_pairs(jobs.delayed_pairs(preds, truths, "event_id", "30 minutes", "1 hour"), path).awaitTermination()
    out = spark.read.parquet(path).groupBy("model").agg(
        F.count("*").alias("n"), F.avg(F.col("correct").cast("int")).alias("accuracy")
    )
    return out.withColumn("retrain", F.col("accuracy") < F.lit(0.22 - 0.02)).withColumn("accuracy", F.round("accuracy", 6))
