import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import models
from tidemark.operators.scorers import ModelScorer, RuleScorer

LABELS = ["bullish", "bearish", "neutral"]
TEXTS = [
    ("profits rose sharply", "bullish"), ("record profits and growth", "bullish"), ("shares fell on losses", "bearish"),
    ("heavy losses reported", "bearish"), ("the company kept guidance", "neutral"), ("guidance unchanged by company", "neutral"),
    ("growth of profits", "bullish"), ("losses and falling shares", "bearish"), ("company guidance unchanged", "neutral"),
    ("profits growth record", "bullish"),
]


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(TEXTS)], "id int, text string, label string")


def test_features_are_smoothed_unit_tfidf(spark, train):
    features = models.featurize(models.fit_features(train), train)
    rows = features.select(vector_to_array("features").alias("f")).collect()
    assert all(abs(math.sqrt(sum(x * x for x in r["f"])) - 1) < 1e-9 for r in rows)
    vocab = {w for t, _ in TEXTS for w in t.split()}
    assert len(rows[0]["f"]) == len(vocab)
    hashed = models.featurize(models.fit_features(train, max_features=8), train)
    assert len(hashed.select(vector_to_array("features").alias("f")).first()["f"]) == 8


def test_classifier_learns_scores_and_softens(spark, train):
    model = models.train(train, "text", "label", LABELS, c=10.0)
    scored = models.predict(model, train, LABELS)
    assert scored.where("pred = label").count() == len(TEXTS)
    assert models.evaluate(model, train, "label", LABELS).first()["macro_f1"] == 1.0
    out = ModelScorer(model, LABELS).score(train.select("id", "text"))
    assert out.columns == ["id", "text", "output", "confidence"]
    soft, hard = (models.soft_labels(model, train, t).agg(F.avg(F.array_max("probs"))).first()[0] for t in (4.0, 1.0))
    assert 1 / 3 < soft < hard


def test_optimum_has_no_gradient(spark, train):
    """The objective is C * sum(weight * loss) + |W|^2 / 2 with free intercepts."""
    c = 10.0
    rows = models.featurize(models.fit_features(train), train)
    model = models.fit_classifier(rows, "label", LABELS, c, tol=1e-12)
    counts = {x: sum(label == x for _, label in TEXTS) for x in LABELS}
    data = rows.select(vector_to_array("features").alias("f"), "label").collect()
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    grad = w.copy()
    for r in data:
        z = [sum(wi * x for wi, x in zip(w[k], r["f"])) + b[k] for k in range(3)]
        e = [math.exp(v - max(z)) for v in z]
        for k in range(3):
            weight = len(TEXTS) / (3 * counts[r["label"]])
            diff = e[k] / sum(e) - (LABELS[k] == r["label"])
            grad[k] += [c * weight * diff * x for x in r["f"]]
    assert abs(grad).max() < 1e-3


def test_distilled_student_agrees_with_its_teacher(spark, train):
    rows = models.featurize(models.fit_features(train), train)
    teacher = models.fit_classifier(rows, "label", LABELS)
    soft = models.soft_labels(teacher, rows, 2.0)
    student = models.distill(soft, "probs", LABELS)
    a = {r["id"]: r["pred"] for r in models.predict(teacher, rows, LABELS).collect()}
    b = {r["id"]: r["pred"] for r in models.predict(student, rows, LABELS).collect()}
    assert a == b


def test_dispatch_by_kind(spark, rows):
    assert models.by_kind({"a": 1}, "a") == 1
    with pytest.raises(KeyError):
        models.by_kind({"a": 1}, "b")
    scorers = {"a": RuleScorer(F.lit("x")), "b": RuleScorer(F.lit("y"))}
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, kind string")
    assert rows(models.score_by_kind(df, "kind", scorers).select("id", "output")) == [(1, "x"), (2, "y"), (3, "x")]
    for odd in ("c", None):
        with pytest.raises(KeyError):
            models.score_by_kind(df.union(spark.createDataFrame([(4, odd)], df.schema)), "kind", scorers)
