"""Prediction metrics. All start from the small matrix of (gold, predicted) counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scores import kl_terms, log_loss_term


def confusion_matrix(df: DataFrame, gold: str, pred: str, *groups: str) -> DataFrame:
    return df.groupBy(*groups, F.col(gold).alias("gold"), F.col(pred).alias("pred")).agg(
        F.count("*").alias("n")
    )


def class_report(matrix: DataFrame, *groups: str, labels: list[str] | None = None) -> DataFrame:
    """Per class: support, precision, recall and F1, each 0 where it is undefined.

    Classes are those seen as gold or predicted, or the given labels: then other predictions cost
    recall but add no class.
    """
    same = F.col("gold") == F.col("pred")
    sides = F.array(
        F.struct(F.col("gold").alias("label"), F.when(same, F.col("n")).otherwise(0).alias("tp"),
                 F.when(same, 0).otherwise(F.col("n")).alias("fn"), F.lit(0).cast("bigint").alias("fp")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("bigint").alias("tp"),
                 F.lit(0).cast("bigint").alias("fn"), F.when(same, 0).otherwise(F.col("n")).alias("fp")),
    )
    cells = matrix.select(*groups, F.explode(sides).alias("s")).select(*groups, "s.*")
    if labels is not None:
        grid = F.array(
            *[F.struct(F.lit(x).alias("label"), *[F.lit(0).cast("bigint").alias(c) for c in ("tp", "fn", "fp")])
              for x in labels]
        )
        cells = cells.where(F.col("label").isin(labels)).unionByName(
            matrix.select(*groups).distinct().select(*groups, F.explode(grid).alias("s")).select(*groups, "s.*")
        )
    sums = cells.groupBy(*groups, "label").agg(*[F.sum(c).alias(c) for c in ("tp", "fn", "fp")])

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    tp, fn, fp = F.col("tp"), F.col("fn"), F.col("fp")
    return sums.select(
        *groups, "label", (tp + fn).alias("support"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def macro_f1(matrix: DataFrame, *groups: str, labels: list[str] | None = None) -> DataFrame:
    """F1 averaged over the classes, every class counting the same."""
    return class_report(matrix, *groups, labels=labels).groupBy(*groups).agg(
        F.sum("support").alias("n_test"), F.avg("f1").alias("macro_f1")
    )


def regressions(candidate: DataFrame, production: DataFrame, limit: float = 0.02) -> DataFrame:
    """Class reports side by side; a class regresses when its F1 falls by more than the limit."""
    old = production.select("label", F.col("f1").alias("production_f1"))
    both = candidate.join(old, "label", "left")
    drop = F.coalesce(F.col("production_f1"), F.lit(0.0)) - F.col("f1")
    return both.withColumn("regressed", drop > limit)


def invalid_rate(df: DataFrame, pred: str, *groups: str, limit: float = 0.01) -> DataFrame:
    """Share of answers outside the label vocabulary; healthy below 1%."""
    rate = F.avg((F.col(pred) == "unknown").cast("int"))
    return df.groupBy(*groups).agg(F.count("*").alias("n"), rate.alias("invalid_rate")).withColumn(
        "ok", F.col("invalid_rate") < limit
    )


def agreement(left: DataFrame, right: DataFrame, key: str, pred: str, floor: float = 0.90) -> DataFrame:
    """Share of keys on which two models agree; at least 90% are needed."""
    pairs = left.select(key, F.col(pred).alias("a")).join(right.select(key, F.col(pred).alias("b")), key)
    return pairs.agg(
        F.count("*").alias("n"), F.avg((F.col("a") == F.col("b")).cast("int")).alias("agreement")
    ).withColumn("ok", F.col("agreement") >= floor)


def accuracy_with_delay(
    predictions: DataFrame, truths: DataFrame, key: str, horizon_seconds: int, promoted_accuracy: float,
    *groups: str, margin: float = 0.02,
) -> DataFrame:
    """Accuracy over the labels that arrive within a horizon after their prediction.

    ``predictions``: key, label, ts and the groups; ``truths``: key, true_label, label_ts.
    """
    late = F.col("label_ts") - F.col("ts")
    hits = predictions.join(truths, key).where(
        (F.col("label_ts") >= F.col("ts")) & (late <= F.make_dt_interval(secs=F.lit(horizon_seconds)))
    )
    return hits.groupBy(*groups).agg(
        F.count("*").alias("n"), F.avg((F.col("label") == F.col("true_label")).cast("int")).alias("accuracy")
    ).withColumn("retrain", F.col("accuracy") < F.lit(promoted_accuracy - margin))


def mean_log_loss(df: DataFrame, prob_of_truth: Column, *groups: str) -> DataFrame:
    return df.groupBy(*groups).agg(F.count("*").alias("n"), F.avg(log_loss_term(prob_of_truth)).alias("log_loss"))


def distillation_loss(
    df: DataFrame, teacher: str, student: str, *groups: str, temperature: float = 2.0
) -> DataFrame:
    """Mean KL divergence from teacher to student, times the squared temperature."""
    mean = F.avg(kl_terms(F.col(teacher), F.col(student)))
    return df.groupBy(*groups).agg(
        F.count("*").alias("n"), (F.lit(temperature**2) * mean).alias("kl_loss")
    )


def threshold_sweep(
    df: DataFrame, confidence: Column, correct_cheap: Column, correct_big: Column, steps: int = 20
) -> DataFrame:
    """Escalation rate and cascade accuracy at thresholds k / steps, from one pass.

    Rows are counted per threshold interval; the thresholds then need a running sum over at most
    ``steps`` rows. A row escalates where its confidence is below the threshold.
    """
    interval = F.size(
        F.filter(F.sequence(F.lit(1), F.lit(steps)), lambda k: confidence >= k / F.lit(float(steps)))
    )
    counts = (
        df.select(interval.alias("k"), correct_cheap.cast("int").alias("a"), correct_big.cast("int").alias("b"))
        .groupBy("k").agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    )
    grid = df.sparkSession.range(steps + 1).select(F.col("id").cast("int").alias("k"))
    full = grid.join(counts, "k", "left").fillna(0)
    below = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("k").rowsBetween(0, Window.unboundedFollowing)
    total = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n_all = F.sum("n").over(total)
    escalated = F.coalesce(F.sum("n").over(below), F.lit(0))
    right = F.coalesce(F.sum("b").over(below), F.lit(0)) + F.coalesce(F.sum("a").over(rest), F.lit(0))
    return full.select(
        (F.col("k") / F.lit(float(steps))).alias("threshold"),
        escalated.alias("n_escalated"),
        (escalated / n_all).alias("escalation_rate"),
        (right / n_all).alias("accuracy"),
    )


def check_counts(reported: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Reported test-set sizes against the rows that are there; a mismatch must be rejected."""
    actual = rows.groupBy(key).agg(F.count("*").alias("expected"))
    out = reported.join(actual, key, "left").fillna(0, ["expected"])
    return out.withColumn("ok", F.col("n_test") == F.col("expected"))
