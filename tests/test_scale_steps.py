"""Steps whose cost must not grow with what they need not hold."""

import pytest
from pyspark.ml.linalg import Vectors

from tidemark.operators import models, summaries
from tidemark.plans import models as model_plans
from tidemark.streaming import promotions

LABELS = ["a", "b"]


def features(spark, rows, size=50):
    return spark.createDataFrame([(x, Vectors.sparse(size, v)) for x, v in rows], ["label", "features"])


def test_learning_curve_fits_only_features_that_occur(spark, monkeypatch):
    train = features(spark, [("a", {3: 1.0}), ("b", {7: 1.0}), ("a", {3: 0.6, 9: 0.8}), ("b", {7: 0.8, 9: 0.6})])
    val = features(spark, [("a", {3: 0.6, 40: 0.8}), ("b", {7: 0.5, 0: 0.5}), ("b", {49: 1.0})])
    sizes, fit = [], models.fit_classifier

    def spy(*args, **kw):
        model = fit(*args, **kw)
        sizes.append(model.numFeatures)
        return model

    monkeypatch.setattr(models, "fit_classifier", spy)
    cut = models.learning_curve(train, val, "label", LABELS, [1, 4]).collect()
    assert sizes == [3, 3]
    monkeypatch.setattr(models, "occurring", lambda *x: list(x))
    whole = models.learning_curve(train, val, "label", LABELS, [1, 4]).collect()
    assert sizes[2:] == [50, 50]
    for a, b in zip(cut, whole, strict=True):
        assert a["epoch"] == b["epoch"] and a["train_loss"] == pytest.approx(b["train_loss"], abs=1e-9)
        assert a["val_loss"] == pytest.approx(b["val_loss"], abs=1e-9)


def test_a_fit_has_no_more_gradients_than_cores(spark, monkeypatch):
    monkeypatch.setattr(models, "ROWS_PER_TASK", 1)
    seen = []

    class Regression:
        def fit(self, data):
            seen.append(data.rdd.getNumPartitions())

    cores = spark.sparkContext.defaultParallelism
    models._fit(Regression(), spark.range(200).repartition(4 * cores), 200)
    assert seen == [cores]


def test_the_best_of_a_sweep_is_not_fitted_again(spark, monkeypatch):
    rows = features(spark, [("en", {1: 1.0}), ("de", {2: 1.0})] * 4).withColumnRenamed("label", "lang")
    rows = rows.crossJoin(spark.createDataFrame([("train",), ("val",), ("test",)], "split string"))
    fits, fit = [], models.fit_classifier
    monkeypatch.setattr(model_plans, "split_features", lambda *_: rows)
    monkeypatch.setattr(models, "fit_classifier", lambda *a, **k: (fits.append(a[3]), fit(*a, **k))[1])
    out = model_plans.c_sweep(spark, "").collect()
    assert fits == [0.01, 0.1, 1.0, 10.0]
    assert [r["test_f1"] for r in out if r["is_best"]] == [1.0] and sum(r["is_best"] for r in out) == 1


def test_stemmed_words_and_common_lengths_in_columns(spark):
    words = [(["cats", "ran", "running"], ["cat", "run", "running"]), ([], ["x"]), (["hopping"] * 3, ["hop", "hopping"])]
    df = spark.createDataFrame(words, "a array<string>, b array<string>").coalesce(1)
    got = df.select(summaries.stemmed("a").alias("a"), summaries.stemmed("b").alias("b")).select(
        "a", summaries.common_length("a", "b").alias("n")
    ).collect()
    assert [(r["a"], r["n"]) for r in got] == [(["cat", "ran", "run"], 2), ([], 0), (["hop"] * 3, 2)]


class Handle:
    """A state of one key, with a count of the calls to it."""

    def __init__(self):
        self.calls, self.values, self.timers, self.value = 0, {}, set(), None

    def __getattr__(self, name):
        def call(*args):
            self.calls += 1
            return {
                "containsKey": lambda k: k in self.values, "getValue": lambda k: self.values[k],
                "updateValue": lambda k, v: self.values.__setitem__(k, v), "removeKey": lambda k: self.values.pop(k),
                "registerTimer": lambda t: self.timers.add(t), "deleteTimer": lambda t: self.timers.discard(t),
                "exists": lambda: self.value is not None, "get": lambda: self.value, "update": lambda v: setattr(self, "value", v),
                "getValueState": lambda *_: self, "getMapState": lambda *_: self,
            }[name](*args)

        return call


class Times:
    def __init__(self, mark):
        self.mark = mark
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: self.mark


def test_gate_state_is_called_per_slice_and_not_per_request():
    handle, gate = Handle(), promotions.PromotionProcessor()
    gate.init(handle)
    rows = [{"_tick": False, "_static": None, "version": str(i), "approved_by": "a", "seq": i, "micros": 1_700_000_000_000_000 + i * 1000,
             "metric_label": "F1", "score": i / 1000, "margin": 0.01, "floor": 0.4} for i in range(1000)]
    assert list(gate.handleInputRows(("m",), rows[::-1], Times(0))) == []
    mark = 1_700_000_000_000 + 499
    out = []
    for end in (mark, mark + 10_000_000):
        while handle.timers and min(handle.timers) <= end:
            at = min(handle.timers)
            handle.timers.discard(at)
            times = Times(end)
            times.getExpiryTimeInMs = None
            out += gate.handleExpiredTimer(("m",), times, Times(at))
        if end == mark:
            assert len(out) == 500
    assert [r["version"] for r in out] == [str(i) for i in range(1000)] and not handle.values
    assert handle.calls < 60
