"""Request routing: a backend by task and tier, and the confidence cascade."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scorers import Scorer
from tidemark.session import materialise

# The threshold and the names of tasks, tiers and backends.
THRESHOLD = 0.70
STUDENT, BIG, SUMMARIZER = "student", "llm_sentiment", "summarizer"


def effective_tier(tier: Column) -> Column:
    """An empty tier means the cascade."""
    return F.when(F.coalesce(tier, F.lit("")) == "", "escalate").otherwise(tier)


def first_backend(task: Column, tier: Column) -> Column:
    """Backend that sees the request first; null for an unknown task or tier."""
    classify = (
        F.when(effective_tier(tier) == "accurate", BIG)
        .when(effective_tier(tier).isin("cheap", "escalate"), STUDENT)
    )
    return F.when(task == "summarize", SUMMARIZER).when(task == "classify", classify)


def route_problem(task: Column, tier: Column) -> Column:
    """Why a request cannot be routed; null if it can."""
    return (
        F.when(~F.coalesce(task.isin("summarize", "classify"), F.lit(False)),
               F.concat(F.lit("Unknown task: "), F.coalesce(task, F.lit("null"))))
        .when(first_backend(task, tier).isNull(), F.concat(F.lit("Unknown tier: "), tier))
    )


def escalates(tier: Column, confidence: Column, threshold: float = THRESHOLD) -> Column:
    """True where the student is unsure on the cascade; without a confidence its answer stays."""
    return (effective_tier(tier) == "escalate") & F.coalesce(confidence < threshold, F.lit(False))


def route(
    requests: DataFrame,
    backends: dict[str, Scorer],
    threshold: float = THRESHOLD,
    strict: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Requests ``(task, tier, text, ...)`` answered: adds output, confidence, served_by, escalated.

    Each backend sees only its own rows: the unsure ones are filtered out and scored by the big
    model, because a conditional expression would not keep Python models from running on all rows.
    The student's scores are written once and read twice. The second table holds requests that
    cannot be routed; in strict mode the first such request raises.
    """
    task, tier = F.col("task"), F.col("tier")
    marked = requests.withColumn("problem", route_problem(task, tier)).withColumn(
        "_first", first_backend(task, tier)
    )
    broken = marked.where("problem is not null").drop("_first")
    if strict:
        bad = broken.first()
        if bad is not None:
            raise ValueError(bad["problem"])
    good = marked.where("problem is null").drop("problem")

    def answered(rows: DataFrame, name: str, escalated: bool) -> DataFrame:
        return rows.withColumn("served_by", F.lit(name)).withColumn("escalated", F.lit(escalated))

    parts = [
        answered(backends[name].score(good.where(F.col("_first") == name).drop("_first")), name, False)
        for name in (SUMMARIZER, BIG)
        if name in backends
    ]
    if STUDENT in backends:
        tried = materialise(
            backends[STUDENT].score(good.where(F.col("_first") == STUDENT).drop("_first")), "student_scores"
        )
        unsure = escalates(tier, F.col("confidence"), threshold)
        parts.append(answered(tried.where(~unsure), STUDENT, False))
        again = backends[BIG].score(tried.where(unsure).drop("output", "confidence"))
        parts.append(answered(again, BIG, True))
    return reduce(DataFrame.unionByName, parts), broken


def prediction_log(answers: DataFrame, models: DataFrame, ts: str = "ts") -> DataFrame:
    """Answers as the log keeps them: adds ``label`` (of classifications), ``model_version``, ``model_kind`` and ``ts``.

    ``models``: ``(served_by, model_version, model_kind)``, one row per backend in production. A backend that is not
    there leaves nulls; a request that has no time gets the present.
    """
    served = models.select(F.col("served_by"), "model_version", "model_kind")
    when = F.coalesce(F.col(ts).cast("timestamp"), F.current_timestamp()) if ts in answers.columns else F.current_timestamp()
    return answers.join(served, "served_by", "left").withColumns(
        {"label": F.when(F.col("served_by") != SUMMARIZER, F.col("output")), ts: when}
    )


def served_shares(answers: DataFrame) -> DataFrame:
    """Requests and escalations per backend, with the backend's share of all requests."""
    counts = answers.groupBy("served_by").agg(F.count("*").alias("n"), F.count_if("escalated").alias("n_escalated"))
    total = counts.agg(F.sum("n"))
    return counts.withColumn("share", F.col("n") / total.scalar())
