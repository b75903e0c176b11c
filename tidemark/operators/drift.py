"""Drift measures: histograms, stability index, two-sample KS, class mix, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scores import BINS, drift_band, entropy, psi_from_counts, unit_bin
from tidemark.operators.blocked import join_with_nulls, range_blocks, running

PSI_THRESHOLD = 0.2
KS_ALPHA = 0.05


def bin_counts(value: str, bins: int = BINS, where: Column | None = None) -> Column:
    """Aggregate: the counts of all bins as one array, empty bins included."""
    where = F.lit(True) if where is None else where
    return F.array(
        *[F.count_if((unit_bin(F.col(value), bins) == k) & where) for k in range(bins)]
    )


def histogram(df: DataFrame, value: str, *groups: str, bins: int = BINS) -> DataFrame:
    """Rows per (group, bin); values outside [0, 1] are left out."""
    return (
        df.select(*groups, unit_bin(F.col(value), bins).alias("bin"))
        .where("bin is not null")
        .groupBy(*groups, "bin")
        .agg(F.count("*").alias("n"))
    )


def psi_by_group(
    reference: DataFrame, current: DataFrame, value: str, *groups: str, bins: int = BINS
) -> DataFrame:
    """Stability index of each group of ``current`` against the one reference sample."""
    base = reference.agg(bin_counts(value, bins).alias("h"))
    return (
        current.groupBy(*groups)
        .agg(F.count("*").alias("n"), F.avg(value).alias("mean_current"), bin_counts(value, bins).alias("h"))
        .withColumn("_ref", base.scalar())
        .withColumn("psi", psi_from_counts(F.col("_ref"), F.col("h")))
        .drop("h", "_ref")
    )


def ks_p_value(d: Column, n_ref: Column, n_cur: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value: the alternating Kolmogorov series."""
    lam = d * F.sqrt(F.try_divide(n_ref * n_cur, n_ref + n_cur))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda a, k: a + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(k * k * (lam * lam) * -2.0),
    )
    # Below 0.2 the series converges slowly and the p-value is 1 to twelve digits.
    return F.when(lam < 0.2, 1.0).when(lam.isNotNull(), F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def ks_two_sample(samples: DataFrame, value: str, side: str, *groups: str) -> DataFrame:
    """Largest gap between the two empirical distributions, per group, with its p-value.

    ``side`` is a boolean column, true for the reference sample. Values are counted first, so ties
    cost one row; the running shares are taken in value blocks, ranges of (group, value) whose number
    grows with the data. A group whose values are all on one side has neither gap nor p-value, and a
    group without any value is not there.
    """
    keys = list(groups)
    counted = samples.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count_if(F.col(side)).alias("r"), F.count_if(~F.col(side)).alias("c")
    )
    keyed = keys or ["_all"]
    if not keys:
        counted = counted.withColumn("_all", F.lit(0))
    counted = range_blocks(counted, [*keyed, value], "ks_counts")
    pair = running(
        counted, keyed, [value], "_block", sums={"cum_r": F.col("r"), "cum_c": F.col("c")}
    )
    totals = counted.groupBy(*keyed).agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))
    gap = F.max(F.abs(F.try_divide("cum_r", "n_ref") - F.try_divide("cum_c", "n_cur")))
    out = (
        join_with_nulls(pair, totals, keyed)
        .groupBy(*keyed, "n_ref", "n_cur")
        .agg(gap.alias("ks"))
        .withColumn("ks_p", ks_p_value(F.col("ks"), F.col("n_ref"), F.col("n_cur")))
    )
    return out.select(*keys, "n_ref", "n_cur", "ks", "ks_p")


def drift_report(samples: DataFrame, value: str, side: str, *groups: str) -> DataFrame:
    """One verdict per group: mean of both sides, stability index, KS, yes or no, watch band.

    A group with rows on one side only stays, with null for what needs both: index, gap, verdict and band.
    """
    ref, cur = F.col(side), ~F.col(side)
    shape = samples.groupBy(*groups).agg(
        F.avg(F.when(ref, F.col(value))).alias("mean_ref"),
        F.avg(F.when(cur, F.col(value))).alias("mean_current"),
        bin_counts(value, where=ref).alias("h_ref"),
        bin_counts(value, where=cur).alias("h_cur"),
    )
    psi = psi_from_counts(F.col("h_ref"), F.col("h_cur"))
    shape = shape.withColumn("psi", psi).drop("h_ref", "h_cur")
    return (
        join_with_nulls(shape, ks_two_sample(samples, value, side, *groups), list(groups), "left")
        .withColumn("drift", F.when(F.col("psi") > PSI_THRESHOLD, "yes").when(F.col("psi").isNotNull(), "no"))
        .withColumn("band", F.when(F.col("psi").isNotNull(), drift_band(F.col("psi"))))
    )


def drift_preset(samples: DataFrame, columns: list[str], side: str) -> DataFrame:
    """KS per numeric column and the share of columns whose p-value is below 0.05."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    long = samples.select(side, F.expr(f"stack({len(columns)}, {pairs}) as (column_name, value)"))
    tests = ks_two_sample(long, "value", side, "column_name")
    drifted = F.col("ks_p") < KS_ALPHA
    share = tests.agg(F.avg(drifted.cast("int")))
    return tests.withColumn("drifted", drifted).withColumn("drifted_share", share.scalar())


def class_mix_shift(
    train: DataFrame, predicted: DataFrame, label: str, limit: float = 0.10
) -> DataFrame:
    """Share of each class in training and in predictions; a shift beyond the limit is a breach."""
    both = train.select(label, F.lit(1).alias("t"), F.lit(0).alias("p")).unionByName(
        predicted.select(label, F.lit(0).alias("t"), F.lit(1).alias("p"))
    )
    counts = both.groupBy(label).agg(F.sum("t").alias("n_train"), F.sum("p").alias("n_pred"))
    totals = counts.agg(F.struct(F.sum("n_train").alias("t"), F.sum("n_pred").alias("p")).alias("s"))
    return (
        counts.withColumn("_tot", totals.scalar())
        .withColumn("train_share", F.col("n_train") / F.col("_tot.t"))
        .withColumn("pred_share", F.col("n_pred") / F.col("_tot.p"))
        .drop("_tot")
        .withColumn("shift", F.abs(F.col("pred_share") - F.col("train_share")))
        .withColumn("breach", F.col("shift") > limit)
    )


def confidence_summary(df: DataFrame, probs: str, *groups: str) -> DataFrame:
    """Mean confidence and mean entropy of predictions."""
    return df.groupBy(*groups).agg(
        F.count("*").alias("n"),
        F.avg(F.array_max(probs)).alias("mean_confidence"),
        F.avg(entropy(F.col(probs))).alias("mean_entropy"),
    )
