"""Summary scores over (candidate, reference) pairs: ROUGE-L, ROUGE-N, length compliance."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.stem import stem
from tidemark.functions.text import ngrams, sentence_count, summary_tokens

MIN_STEMMED = 4  # fixed value: shorter tokens are not stemmed


def lcs_length(a, b) -> int:
    """Length of the longest common subsequence, one row of bits per step (Hyyrö, 2004)."""
    where: dict = {}
    for i, token in enumerate(b):
        where[token] = where.get(token, 0) | (1 << i)
    full = (1 << len(b)) - 1
    row = full
    for token in a:
        hit = row & where.get(token, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(b) - bin(row).count("1")


@F.arrow_udf(T.IntegerType())
def common_length(a: pa.Array, b: pa.Array) -> pa.Array:
    """Pairs leave Arrow one at a time, so that a worker holds the words of one pair as Python strings."""
    return pa.array((lcs_length(x.as_py(), y.as_py()) for x, y in zip(a, b)), pa.int32())


@F.arrow_udf(T.ArrayType(T.StringType()))
def stemmed(words: pa.Array) -> pa.Array:
    """Each different word of a batch is stemmed once; the lists stay Arrow arrays."""
    coded = words.values.dictionary_encode()
    stems = pa.array([stem(w) if len(w) >= MIN_STEMMED else w for w in coded.dictionary.to_pylist()], pa.string())
    return pa.ListArray.from_arrays(words.offsets, stems.take(coded.indices), mask=words.is_null() if words.null_count else None)


def f_measure(overlap: Column, n_candidate: Column, n_reference: Column) -> Column:
    """Harmonic mean of precision and recall; 0 without overlap."""
    return F.when(overlap > 0, 2 * overlap / (n_candidate + n_reference)).otherwise(F.lit(0.0))


def rouge_l(pairs: DataFrame, candidate: str, reference: str, name: str, use_stemmer: bool = True) -> DataFrame:
    """Adds the ROUGE-L F-measure of each pair. Tokens are made in the JVM, only the LCS is Python."""
    a, b = summary_tokens(F.col(candidate)), summary_tokens(F.col(reference))
    if use_stemmer:
        a, b = stemmed(a), stemmed(b)
    rows = pairs.withColumn("_a", a).withColumn("_b", b)
    return rows.withColumn(
        name, f_measure(common_length("_a", "_b"), F.size("_a"), F.size("_b"))
    ).drop("_a", "_b")


def beat_bar(scored: DataFrame, adapter: str, base: str) -> DataFrame:
    """Mean score of both systems; the adapter must beat the base."""
    return scored.agg(
        F.count("*").alias("n_test"), F.avg(adapter).alias("adapter"), F.avg(base).alias("base")
    ).withColumn("beat_bar", F.col("adapter") > F.col("base"))


def rouge_n(pairs: DataFrame, keys: list[str], candidate: str, reference: str, n: int) -> DataFrame:
    """ROUGE-N per pair: n-grams of both sides are counted in one grouping, no join."""
    def side(column: str, mark: int) -> DataFrame:
        words = pairs.select(*keys, summary_tokens(F.col(column)).alias("w"))
        return words.select(
            *keys, F.explode_outer(ngrams(F.col("w"), n)).alias("gram"), F.lit(mark).alias("side")
        )

    present = F.col("gram").isNotNull()
    counts = (
        side(candidate, 1).unionByName(side(reference, 2))
        .groupBy(*keys, "gram")
        .agg(F.count_if(present & (F.col("side") == 1)).alias("c"), F.count_if(present & (F.col("side") == 2)).alias("r"))
    )
    sums = counts.groupBy(*keys).agg(
        F.sum(F.least("c", "r")).alias("overlap"), F.sum("c").alias("n_candidate"), F.sum("r").alias("n_reference")
    )
    return sums.withColumn("f", f_measure(F.col("overlap"), F.col("n_candidate"), F.col("n_reference")))


def length_compliance(df: DataFrame, text: str, *groups: str, low: int = 2, high: int = 3) -> DataFrame:
    """Share of summaries of two or three sentences; at least 95% are needed."""
    inside = sentence_count(F.col(text)).between(low, high)
    return df.groupBy(*groups).agg(
        F.count("*").alias("n"), F.avg(inside.cast("int")).alias("compliance")
    ).withColumn("ok", F.col("compliance") >= 0.95)
