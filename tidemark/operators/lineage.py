"""Lineage events: run durations, dataset closure, classification of failures.

Events are ``(event_type, run_id, job, inputs, outputs, ts)`` with event types START and COMPLETE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise


def lineage_events(spark, job: str, run_id: str, inputs: list[str], outputs: list[str]) -> DataFrame:
    """START and COMPLETE of one job run, to be appended to the event table."""
    rows = [(e, run_id, job, inputs, outputs) for e in ("START", "COMPLETE")]
    schema = "event_type string, run_id string, job string, inputs array<string>, outputs array<string>"
    return spark.createDataFrame(rows, schema).withColumn("ts", F.current_timestamp())


def run_durations(events: DataFrame) -> DataFrame:
    """Start, end and seconds per run; a run without COMPLETE has failed."""
    def at(kind: str) -> Column:
        return F.min(F.when(F.col("event_type") == kind, F.col("ts")))

    runs = events.groupBy("job", "run_id").agg(at("START").alias("started"), at("COMPLETE").alias("ended"))
    micros = F.unix_micros(F.col("ended").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))
    return runs.withColumn("seconds", micros / 1e6).withColumn(
        "state", F.when(F.col("ended").isNull(), "failed").otherwise("complete")
    )


def edges(events: DataFrame) -> DataFrame:
    """Dataset pairs (src, dst) of completed runs."""
    done = events.where("event_type = 'COMPLETE'")
    return (
        done.select("job", F.explode("inputs").alias("src"), "outputs")
        .select("job", "src", F.explode("outputs").alias("dst"))
    )


def _climb(single: DataFrame) -> DataFrame:
    """``dataset, up, steps``: the first ancestor with another number of sources than one, and how far it is.

    ``single`` holds the datasets with one source as ``dataset, up`` with ``steps`` 1. Each round doubles the reach of
    all of them, so rounds grow with the logarithm of the longest chain. What still climbs after as many rounds as
    there are chains to cover goes round a circle that nothing enters, and is left out.
    """
    state, reach, n = materialise(single, "lineage-climb"), 1, None
    while True:
        above = state.select(F.col("dataset").alias("up"), F.col("up").alias("_up"), F.col("steps").alias("_steps"))
        met = state.join(above, "up", "left")
        moved = materialise(
            met.select(
                "dataset", F.coalesce("_up", "up").alias("up"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
                F.col("_up").isNotNull().alias("_climbs"),
            ), "lineage-climb",
        )
        if moved.where("_climbs").isEmpty():
            return moved.drop("_climbs")
        n = n if n is not None else moved.count()
        reach *= 2
        state = moved.drop("_climbs")
        if reach > 2 * n:
            return state.join(state.select(F.col("dataset").alias("up")), "up", "left_anti").select("dataset", "up", "steps")


def closure(edge_table: DataFrame, seeds: DataFrame, downstream: bool = True) -> DataFrame:
    """Datasets that can be reached from the seeds, with their least number of steps.

    A dataset with one source is as deep as that source and one step more. So all of these are hung on the first
    ancestor that has several sources (or is a seed) by pointer jumping, whatever the length of the chain, and only
    those ancestors are walked step by step, over edges that carry the length of the chain between them. Each frontier
    is written, so a lost executor costs one round. Only datasets are kept, never paths.
    """
    a, b = ("src", "dst") if downstream else ("dst", "src")
    hops = materialise(edge_table.select(F.col(a).alias("source"), F.col(b).alias("dataset")).distinct(), "edges")
    start = materialise(seeds.select("dataset").distinct().withColumn("depth", F.lit(0)), "frontier")
    single = hops.groupBy("dataset").agg(F.min("source").alias("up"), F.count("*").alias("_n")).where("_n = 1")
    single = single.join(start, "dataset", "left_anti").select("dataset", "up", F.lit(1).alias("steps"))
    hung = _climb(single)
    joints = hops.join(hung.select("dataset"), "dataset", "left_anti").join(
        hung.select(F.col("dataset").alias("source"), "up", "steps"), "source", "left"
    )
    joints = materialise(
        joints.select(F.coalesce("up", "source").alias("source"), "dataset", (F.coalesce("steps", F.lit(0)) + 1).alias("steps"))
        .groupBy("source", "dataset").agg(F.min("steps").alias("steps")), "lineage-joints",
    )
    known, frontier = start, start
    while True:
        ahead = frontier.select(F.col("dataset").alias("source"), F.col("depth").alias("_depth")).join(joints, "source")
        ahead = ahead.groupBy("dataset").agg(F.min(F.col("_depth") + F.col("steps")).alias("depth"))
        # Chains differ in length, so a later round may still find a shorter way.
        old = known.select("dataset", F.col("depth").alias("_old"))
        better = ahead.join(old, "dataset", "left").where("_old is null or depth < _old").select("dataset", "depth")
        frontier = materialise(better, "frontier")
        if frontier.isEmpty():
            break
        known = materialise(known.join(frontier, "dataset", "left_anti").unionByName(frontier), "lineage-known")
    below = hung.join(known.select(F.col("dataset").alias("up"), "depth"), "up")
    return known.unionByName(below.select("dataset", (F.col("depth") + F.col("steps")).alias("depth")))


# Failure causes and the log signatures that tell them, in order.
SIGNATURES = {
    "oom": r"OOMKilled|exit code 137|out of memory",
    "data_validation": r"SchemaError|validation failed",
    "nccl_timeout": r"NCCL.*(timeout|Watchdog)",
    "node_pressure": r"MemoryPressure|NodeNotReady|Evicted",
}


def failure_cause(message: Column) -> Column:
    """The first cause whose signature the message shows, else ``unknown``."""
    hits = [F.when(message.rlike(pattern), cause) for cause, pattern in SIGNATURES.items()]
    return F.coalesce(*hits, F.lit("unknown"))


def time_to_cause(log: DataFrame, run: str, ts: str, failed: Column, message: str, limit_s: int = 600) -> DataFrame:
    """Per failed run: seconds from its first failure to the first message with a known cause."""
    cause = failure_cause(F.col(message))
    known = cause != "unknown"
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    out = log.groupBy(run).agg(
        F.min(F.when(failed, micros)).alias("_f"),
        F.min(F.when(failed & known, F.struct(micros.alias("t"), cause.alias("cause")))).alias("_c"),
    )
    seconds = (F.col("_c.t") - F.col("_f")) / 1e6
    return out.where("_f is not null").select(
        run, F.coalesce("_c.cause", F.lit("unknown")).alias("cause"), seconds.alias("seconds")
    ).withColumn("in_time", F.coalesce(F.col("seconds") < limit_s, F.lit(False)))
