"""Fits of more rows than one task takes: blocks of rows, columns that are equal, gradients summed in tasks."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import logistic, models

LABELS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    """60 rows; column 5 repeats column 2, columns 6 and 7 are in one row alone, column 8 is in none."""
    rng, rows = np.random.RandomState(3), []
    for i in range(60):
        x = {int(j): float(rng.rand()) for j in rng.choice(5, 3, replace=False)}
        if 2 in x:
            x[5] = x[2]
        if i == 7:
            x[6] = x[7] = 0.5
        vector = Vectors.sparse(9, x) if i % 4 else Vectors.dense([x.get(j, 0.0) for j in range(9)])
        rows.append((i, LABELS[int(rng.choice(3, p=[0.6, 0.3, 0.1]) if i > 2 else i)], vector))
    return spark.createDataFrame(rows, ["id", "label", "features"]).repartition(3).cache()


def gradient(table, model, target, penalty):
    """Of the mean weighted loss and half the penalty times the squared weights."""
    rows = table.select(vector_to_array("features").alias("f"), target.alias("t")).collect()
    x, t = np.array([r["f"] for r in rows]), np.array([r["t"] for r in rows])
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    z = x @ w.T + b
    e = np.exp(z - z.max(axis=1, keepdims=True))
    slope = (e / e.sum(axis=1, keepdims=True) * t.sum(axis=1, keepdims=True) - t) / t.sum()
    return abs(slope.T @ x + penalty * w).max(), abs(slope.sum(axis=0)).max()


@pytest.mark.parametrize("collected", [1 << 20, 0])
def test_many_rows_are_fitted_to_the_optimum(spark, table, monkeypatch, collected):
    monkeypatch.setattr(models, "ROWS_PER_TASK", 20)
    monkeypatch.setattr(logistic, "COLLECTED", collected)
    monkeypatch.setattr(logistic, "ENTRIES", 30)
    ready = models.prepared(table, "label", LABELS)
    # 0 to 4, with 5 in 2, and 6 with 7
    assert ready.n == 60 and sorted(ready.scale.round(6)) == [1.0] * 4 + [round(2**0.5, 6)] * 2
    model = models.fit_classifier(ready, "label", LABELS, 5.0, tol=1e-10)
    ready.free()
    counts = {r["label"]: r["count"] for r in table.groupBy("label").count().collect()}
    target = F.array(*[F.when(F.col("label") == x, F.lit(20 / counts[x])).otherwise(F.lit(0.0)) for x in LABELS])
    assert max(gradient(table, model, target, 1 / 300)) < 1e-7
    w = model.coefficientMatrix.toArray()
    assert np.allclose(w[:, 2], w[:, 5]) and np.allclose(w[:, 6], w[:, 7]) and not w[:, 8].any()
    again = models.fit_classifier(table, "label", LABELS, 5.0, tol=1e-10)
    assert np.allclose(again.coefficientMatrix.toArray(), w, atol=1e-6)


def test_small_and_large_tables_come_to_the_same_model(table, monkeypatch):
    small = models.fit_classifier(table, "label", LABELS, 5.0, tol=1e-12)
    monkeypatch.setattr(models, "ROWS_PER_TASK", 20)
    large = models.fit_classifier(table, "label", LABELS, 5.0, tol=1e-10)
    assert np.allclose(small.coefficientMatrix.toArray(), large.coefficientMatrix.toArray(), atol=1e-4)
    assert np.allclose(small.interceptVector.toArray(), large.interceptVector.toArray(), atol=1e-4)


def test_many_rows_are_distilled_to_the_optimum(table, monkeypatch):
    monkeypatch.setattr(models, "ROWS_PER_TASK", 20)
    monkeypatch.setattr(models, "TOLERANCE", 1e-10)
    probs = F.transform(F.array(*map(F.lit, range(3))), lambda i: (F.col("id") + i) % 7 / F.lit(10.0))
    soft = table.withColumn("probs", probs)
    model = models.distill(soft, "probs", LABELS, 2.0, penalty=0.01)
    assert max(gradient(soft, model, F.col("probs"), 0.0025)) < 1e-7


def test_many_rows_with_an_unknown_label_are_an_error(table, monkeypatch):
    monkeypatch.setattr(models, "ROWS_PER_TASK", 20)
    for odd in (F.lit(None).cast("string"), F.lit("x")):
        with pytest.raises(Exception, match="label that is none"):
            models.fit_classifier(table.withColumn("label", F.when(F.col("id") == 9, odd).otherwise(F.col("label"))), "label", LABELS)


def test_no_tokens_are_kept_in_memory(spark, monkeypatch):
    texts = spark.createDataFrame([("bb bb aa",), ("aa cc",), (None,)], "text string")
    monkeypatch.setattr(type(texts), "persist", lambda *_: pytest.fail("tokens are kept"))
    features = models.fit_features(texts)
    rows = models.featurize(features, texts).select("text", vector_to_array("features").alias("f")).collect()
    got = {r["text"]: sorted(x for x in r["f"] if x) for r in rows}
    a, b, c = (np.log(4 / (df + 1)) + 1 for df in (2, 1, 1))
    assert got[None] == [] and got["aa cc"] == pytest.approx(sorted([a, c] / np.hypot(a, c)))
    assert got["bb bb aa"] == pytest.approx(sorted([a, 2 * b] / np.hypot(a, 2 * b)))
