"""Request-log and run-log queries over ``events``: value is a latency, a run time or a metric."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import ranks, serving
from tidemark.plans.registry import query, table


@query(
    "latency_percentiles",
    """
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i,
                  count(*) OVER (PARTITION BY event_type) AS n FROM events),
w AS (SELECT event_type, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS wall_s FROM events GROUP BY event_type)
SELECT event_type, n, max(CASE WHEN i = floor(0.5::double * (n - 1)) THEN value END) AS p50_ms,
       max(CASE WHEN i = floor(0.95::double * (n - 1)) THEN value END) AS p95_ms,
       max(CASE WHEN i = floor(0.99::double * (n - 1)) THEN value END) AS p99_ms,
       round(any_value(wall_s), 6) AS wall_s, round(n / any_value(wall_s), 6) AS req_s
FROM r JOIN w USING (event_type) GROUP BY event_type, n
""",
)
def latency_percentiles(spark, sf_dir):
    out = serving.latency_summary(table(spark, sf_dir, "events"), "event_type", "value", "ts")
    return out.withColumns({c: F.round(c, 6) for c in ("wall_s", "req_s")})


@query(
    "slo_window",
    """
WITH w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS w, value, event_type = 'error' AS f, value > 300 AS t FROM events),
r AS (SELECT w, value, row_number() OVER (PARTITION BY w ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY w) AS n FROM w),
p AS (SELECT w, max(value) > 120 AS p95_breach FROM r WHERE i = floor(0.95::double * (n - 1)) GROUP BY w),
a AS (SELECT w, count(*) AS n, avg(f::int) AS error_rate, avg(t::int) AS timeout_rate,
             count(*) FILTER (WHERE value > 120) AS n_over FROM w GROUP BY w)
SELECT strftime(a.w, '%Y-%m-%dT%H:%M') AS w, a.n, round(a.error_rate, 6) AS error_rate,
       round(a.timeout_rate, 6) AS timeout_rate, a.n_over, a.error_rate > 0.01 AS error_alert, p.p95_breach,
       b.n AS previous_n, coalesce(a.n < 0.8 * b.n, false) AS throughput_drop
FROM a JOIN p USING (w) LEFT JOIN a b ON b.w + INTERVAL 5 MINUTE = a.w
""",
)
def slo_window(spark, sf_dir):
    out = serving.slo_windows(
        table(spark, sf_dir, "events"), "ts", "value", F.col("event_type") == "error", F.col("value") > 300, 120.0
    )
    return out.withColumn("w", F.date_format("w", "yyyy-MM-dd'T'HH:mm")).withColumns(
        {c: F.round(c, 6) for c in ("error_rate", "timeout_rate")}
    )


@query(
    "step_time",
    """
WITH s AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step,
                  (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1e6 AS d
           FROM events)
SELECT user_id, count(*) AS n, round(median(d), 6) AS median_step_s, round(8.0 / median(d), 6) AS samples_per_s
FROM s WHERE step > 10 GROUP BY user_id
""",
)
def step_time(spark, sf_dir):
    out = serving.step_times(table(spark, sf_dir, "events"), "user_id", "ts", ["ts", "event_id"], 8)
    return out.withColumns({c: F.round(c, 6) for c in ("median_step_s", "samples_per_s")})


PAIRS = {"A": ("error", "view"), "B": ("click", "signup"), "C": ("view", "purchase")}


@query(
    "pct_faster",
    """
WITH m AS (SELECT event_type, median(value) AS v FROM events GROUP BY event_type),
p AS (SELECT unnest(['A', 'B', 'C']) AS pair, unnest(['error', 'click', 'view']) AS a,
             unnest(['view', 'signup', 'purchase']) AS b)
SELECT pair, round((x.v - y.v) / x.v * 100, 6) AS percent_faster
FROM p JOIN m x ON x.event_type = a JOIN m y ON y.event_type = b
""",
)
def pct_faster(spark, sf_dir):
    medians = ranks.exact_median(table(spark, sf_dir, "events"), ["event_type"], "value")
    out = serving.percent_faster(medians, "event_type", "median", PAIRS)
    return out.withColumn("percent_faster", F.round("percent_faster", 6))


@query(
    "success_rate",
    """
SELECT user_id, count(*) AS n_runs, round(avg((event_type <> 'error')::int), 6) AS success_rate,
       avg((event_type <> 'error')::int) > 0.98 AS ok
FROM events GROUP BY user_id
""",
)
def success_rate(spark, sf_dir):
    out = serving.success_rate(table(spark, sf_dir, "events"), F.col("event_type") != "error", "user_id")
    return out.withColumn("success_rate", F.round("success_rate", 6))


@query(
    "duration_regression",
    """
WITH d AS (SELECT event_type, ts::date AS day, count(value) AS n_runs, sum(value) AS s FROM events GROUP BY ALL),
t AS (SELECT *, sum(s) OVER w / sum(n_runs) OVER w AS before FROM d
      WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT event_type, strftime(day, '%Y-%m-%d') AS day, n_runs, round(s / n_runs, 6) AS mean_s,
       round(before, 6) AS trailing_s, coalesce(s / n_runs > 1.2 * before, false) AS regressed
FROM t
""",
)
def duration_regression(spark, sf_dir):
    out = serving.duration_regressions(table(spark, sf_dir, "events"), "event_type", "ts", "value")
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd")).withColumns(
        {c: F.round(c, 6) for c in ("mean_s", "trailing_s")}
    )


@query(
    "best_run",
    """
SELECT event_type, min(event_id) AS event_id, value FROM events e
WHERE value = (SELECT max(value) FROM events x WHERE x.event_type = e.event_type) GROUP BY event_type, value
""",
)
def best_run(spark, sf_dir):
    return serving.best_run(table(spark, sf_dir, "events"), "event_id", "value", "event_type")
