"""Column expressions over probability arrays and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BINS = 10
CLIP = 1e-6  # fixed value: smallest share used in a stability index


def unit_bin(value: Column, bins: int = BINS) -> Column:
    """Bin of a value in [0, 1]: the number of inner edges ``k * (1 / bins)`` it reaches.

    Edges are double products, so 3/10 lies below the edge 0.30000000000000004. Values outside
    [0, 1] give null.
    """
    inner = F.size(F.filter(F.sequence(F.lit(1), F.lit(bins - 1)), lambda k: value >= k * F.lit(1.0 / bins)))
    return F.when((value >= 0) & (value <= 1), inner)


def psi_from_counts(reference: Column, current: Column) -> Column:
    """Population stability index of two arrays of bin counts; null when a side is empty.

    Shares are clipped from below and not normalised again.
    """
    def total(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0.0).cast("double"), lambda a, x: a + x)

    def share(count: Column, n: Column) -> Column:
        return F.greatest(count / n, F.lit(CLIP))

    terms = F.zip_with(
        reference,
        current,
        lambda r, c: (share(c, total(current)) - share(r, total(reference)))
        * F.ln(share(c, total(current)) / share(r, total(reference))),
    )
    value = F.aggregate(terms, F.lit(0.0).cast("double"), lambda a, x: a + x)
    return F.when((total(reference) > 0) & (total(current) > 0), value)


def drift_band(psi: Column) -> Column:
    """Watch bands: below 0.1 ok, to 0.2 watch, above retrain."""
    return (
        F.when(psi > 0.2, "retrain").when(psi >= 0.1, "watch").when(psi.isNotNull(), "ok")
    )


def argmax_label(probs: Column, labels: list[str]) -> Column:
    """Label of the largest score; the first one wins a tie."""
    names = F.array(*[F.lit(x) for x in labels])
    return F.get(names, (F.array_position(probs, F.array_max(probs)) - 1).cast("int"))


def softmax(logits: Column, temperature: float = 1.0) -> Column:
    scaled = F.transform(logits, lambda z: F.exp((z - F.array_max(logits)) / F.lit(float(temperature))))
    total = F.aggregate(scaled, F.lit(0.0), lambda a, x: a + x)
    return F.transform(scaled, lambda e: e / total)


def entropy(probs: Column) -> Column:
    return F.aggregate(
        probs, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.ln(p)).otherwise(F.lit(0.0))
    )


def kl_terms(teacher: Column, student: Column) -> Column:
    """Sum of p (ln p - ln q) over the classes; a teacher share of 0 adds nothing."""
    parts = F.zip_with(
        teacher,
        student,
        lambda p, q: F.when(p > 0, p * (F.ln(p) - F.ln(q))).otherwise(F.lit(0.0)),
    )
    return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)


def log_loss_term(prob_of_truth: Column, eps: float = 1e-15) -> Column:
    return -F.ln(F.least(F.greatest(prob_of_truth, F.lit(eps)), F.lit(1 - eps)))
