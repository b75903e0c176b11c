"""Request-log and step-log analytics: latency, throughput, service levels, step time, run time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.blocked import join_with_nulls, range_blocks, running
from tidemark.operators.ranks import exact_median, exact_ranks, floor_rank
from tidemark.session import materialise

WARMUP_STEPS = 10  # fixed value
PERCENTILES = {"p50_ms": 0.50, "p95_ms": 0.95, "p99_ms": 0.99}


def latency_summary(log: DataFrame, level: str, latency_ms: str, ts: str) -> DataFrame:
    """Percentiles ``sorted[int(p (n - 1))]`` per level, and requests per second of its wall time."""
    ranks = exact_ranks(log, [level], latency_ms, {n: floor_rank(p) for n, p in PERCENTILES.items()})
    micros = F.unix_micros(F.max(F.col(ts).cast("timestamp"))) - F.unix_micros(F.min(F.col(ts).cast("timestamp")))
    wall = log.groupBy(level).agg((micros / 1e6).alias("wall_s"))
    return join_with_nulls(ranks, wall, [level]).withColumn("req_s", F.when(F.col("wall_s") > 0, F.col("n") / F.col("wall_s")))


def approx_latency_summary(log: DataFrame, level: str, latency_ms: str) -> DataFrame:
    """The same percentiles from one sketch per level, within one part in ten thousand of the rank."""
    q = F.percentile_approx(latency_ms, list(PERCENTILES.values()), 10_000)
    return log.groupBy(level).agg(F.count("*").alias("n"), q.alias("q")).select(
        level, "n", *[F.col("q")[i].alias(name) for i, name in enumerate(PERCENTILES)]
    )


def slo_windows(
    log: DataFrame, ts: str, latency_ms: str, failed: Column, timed_out: Column, sla_ms: float,
    width: str = "5 minutes",
) -> DataFrame:
    """Per window: requests, error and timeout rate, p95, throughput, and the alerts they raise.

    A p95 above the limit is the same as more than 5% of requests above it by the floor index, so
    the breach needs counts only. Throughput is compared with the window before.
    """
    start = F.window(F.col(ts), width)["start"]
    over = F.col(latency_ms) > sla_ms
    rows = log.select(start.alias("w"), failed.alias("f"), timed_out.alias("t"), over.alias("o"))
    out = rows.groupBy("w").agg(
        F.count("*").alias("n"), F.avg(F.col("f").cast("int")).alias("error_rate"),
        F.avg(F.col("t").cast("int")).alias("timeout_rate"), F.count_if("o").alias("n_over"),
    )
    at_least = F.col("n") - F.floor(F.lit(0.95) * (F.col("n") - 1))
    out = (
        out.withColumn("error_alert", F.col("error_rate") > 0.01)
        .withColumn("p95_breach", F.col("n_over") >= at_least)
    )
    previous = out.select(
        (F.col("w") + F.expr(f"interval {width}")).alias("w"), F.col("n").alias("previous_n")
    )
    return out.join(previous, "w", "left").withColumn(
        "throughput_drop", F.coalesce(F.col("n") < F.lit(0.8) * F.col("previous_n"), F.lit(False))
    )


def step_times(steps: DataFrame, run: str, ts: str, order: list[str], batch_size: int) -> DataFrame:
    """Median seconds per step of each run after the warm-up, and samples per second.

    The step number and the clock reading before each step come from blocked running aggregates over
    ranges of the order, so a run of any length, or a busy hour of it, is spread over many tasks.
    """
    clock = steps.select(run, *order, F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"))
    rows = range_blocks(clock, [run, *order, "_us"], "steps")
    ordered = F.struct(*order, "_us")
    rows = running(rows, [run], order, "_block", sums={"step": F.lit(1)}, maxima={"_prev": ordered})
    deltas = rows.where(F.col("step") > WARMUP_STEPS).select(
        run, ((F.col("_us") - F.col("_prev._us")) / 1e6).alias("step_s")
    )
    # Written once: the exact median reads the gaps twice.
    out = exact_median(materialise(deltas, "step_gaps"), [run], "step_s", "median_step_s")
    return out.withColumn("samples_per_s", F.lit(float(batch_size)) / F.col("median_step_s"))


def percent_faster(runs: DataFrame, label: str, value: str, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Gain (a - b) / a * 100 of the second run of each named pair over the first."""
    wanted = sorted({x for pair in pairs.values() for x in pair})
    row = runs.where(F.col(label).isin(wanted)).agg(
        *[F.max(F.when(F.col(label) == x, F.col(value))).alias(f"v{i}") for i, x in enumerate(wanted)]
    )
    at = {x: F.col(f"v{i}") for i, x in enumerate(wanted)}
    gains = F.array(
        *[F.struct(F.lit(name).alias("pair"), ((at[a] - at[b]) / at[a] * 100).alias("percent_faster"))
          for name, (a, b) in pairs.items()]
    )
    return row.select(F.inline(gains))


def success_rate(runs: DataFrame, succeeded: Column, *groups: str, floor: float = 0.98) -> DataFrame:
    """Share of runs that succeed; more than 98% are needed."""
    return runs.groupBy(*groups).agg(
        F.count("*").alias("n_runs"), F.avg(succeeded.cast("int")).alias("success_rate")
    ).withColumn("ok", F.col("success_rate") > floor)


def duration_regressions(
    runs: DataFrame, job: str, ts: str, seconds: str, days: int = 7, limit: float = 0.20
) -> DataFrame:
    """Mean run time per job and day against the mean of the runs on the days before it."""
    daily = runs.groupBy(job, F.to_date(ts).alias("day")).agg(
        F.count(seconds).alias("n_runs"), F.sum(seconds).alias("total_s")
    )
    before = Window.partitionBy(job).orderBy("day").rowsBetween(-days, -1)
    trailing = F.sum("total_s").over(before) / F.sum("n_runs").over(before)
    mean = F.col("total_s") / F.col("n_runs")
    return daily.select(
        job, "day", "n_runs", mean.alias("mean_s"), trailing.alias("trailing_s"),
    ).withColumn(
        "regressed", F.coalesce(F.col("mean_s") > F.lit(1 + limit) * F.col("trailing_s"), F.lit(False))
    )


def best_run(runs: DataFrame, run: str, metric: str, *groups: str, largest: bool = True) -> DataFrame:
    """Run with the best metric; the lowest run name wins a tie."""
    score = -F.col(metric) if largest else F.col(metric)
    first = F.min(F.struct(score.alias("s"), F.col(run), F.col(metric)))
    return runs.groupBy(*groups).agg(first.alias("_b")).select(*groups, f"_b.{run}", f"_b.{metric}")
