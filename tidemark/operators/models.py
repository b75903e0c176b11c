"""Text classifiers on Spark ML: TF-IDF with balanced logistic regression, sweeps, distillation."""

from __future__ import annotations

from collections.abc import Callable
from time import perf_counter

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    ElementwiseProduct,
    HashingTF,
    Normalizer,
    SQLTransformer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scores import argmax_label, log_loss_term, softmax
from tidemark.functions.text import TOKEN_PATTERN
from tidemark.operators.logistic import Examples, Regression
from tidemark.operators.metrics import confusion_matrix, macro_f1
from tidemark.operators.split import class_weights
from tidemark.session import materialise, spread

MAX_FEATURES = 1 << 20  # the model itself lives on the driver; larger vocabularies are hashed
MAX_ITER = 1000  # fixed value
TOLERANCE = 1e-2  # the search stops when ten iterations gain less than this share of the first loss
ROWS_PER_TASK = 5_000


def fit_features(train: DataFrame, text: str = "text", max_features: int = MAX_FEATURES) -> PipelineModel:
    """Tokens, term counts, smoothed inverse frequency and unit length, fitted on the training texts.

    The coefficients of a linear model are held by the driver, so the number of features is checked:
    up to the limit every token of the training texts is a feature of its own; beyond it tokens are
    hashed into that many features, and none is dropped.
    """
    pattern = TOKEN_PATTERN.replace("\\", "\\\\")
    tokenizer = SQLTransformer(
        statement=f"SELECT *, coalesce(regexp_extract_all(lower({text}), '{pattern}', 0), array()) AS tokens FROM __THIS__"
    )
    rows = tokenizer.transform(spread(train.select(text))).select("tokens")
    # Tokens are cut anew in each pass over the texts; kept, they are several times as large as the texts.
    tokens = rows.select(F.explode(F.array_distinct("tokens")).alias("token"))
    counts = materialise(tokens.groupBy("token").agg(F.count("*").alias("df")), "token_texts")
    n_tokens = counts.count()
    if n_tokens <= max_features:
        alone = counts.select(F.array("token").alias("tokens"), "df")
        counter = CountVectorizer(inputCol="tokens", outputCol="tf", vocabSize=max(n_tokens, 1), minDF=1).fit(alone)
        places = counter.transform(alone).select(F.unwrap_udt("tf")["indices"][0].alias("i"), "df").toArrow()
        df = np.zeros(n_tokens)
        df[places["i"].to_numpy()] = places["df"].to_numpy()
        idf = np.log((train.count() + 1.0) / (df + 1.0))
    else:
        counter = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=max_features)
        idf = IDF(inputCol="tf", outputCol="_idf").fit(counter.transform(rows)).idf.toArray()
    # Spark's idf is ln((1 + n) / (1 + df)); the usual smoothed form adds 1.
    scale = ElementwiseProduct(scalingVec=DenseVector(idf + 1.0), inputCol="tf", outputCol="_weighted")
    unit = Normalizer(p=2.0, inputCol="_weighted", outputCol="features")
    return PipelineModel([tokenizer, counter, scale, unit])


def featurize(features: PipelineModel, df: DataFrame) -> DataFrame:
    return features.transform(spread(df)).drop("tokens", "tf", "_weighted")


def label_index(label: Column, labels: list[str]) -> Column:
    """Position of a label in the fixed order, as the model sees it."""
    return (F.array_position(F.array(*[F.lit(x) for x in labels]), label) - 1).cast("double")


def fit_classifier(
    rows: DataFrame | Examples, label: str, labels: list[str], c: float = 10.0, max_iter: int = MAX_ITER,
    tol: float = TOLERANCE,
):
    """Multinomial logistic regression on ``features`` with balanced class weights.

    With weights that sum to n, a penalty of 1 / (C n) is the optimum of C * loss + |W|^2 / 2. A large table that is
    fitted more than once is better given as ``prepared``.
    """
    if isinstance(rows, Examples):
        return Regression(1.0 / (c * rows.n), max_iter, tol).fit(rows)
    n = rows.count()
    weight = _balanced(rows, label)
    y = label_index(F.col(label), labels)
    if n <= ROWS_PER_TASK:
        data = rows.select("features", y.alias("y"), weight.alias("w"))
        return _fit(_regression(1.0 / (c * n), max_iter, tol), data, n)
    return _fit(Regression(1.0 / (c * n), max_iter, tol), _weighed(rows, label, labels, weight), n)


def prepared(rows: DataFrame, label: str, labels: list[str]) -> DataFrame | Examples:
    """Rows to be given to ``fit_classifier`` several times; those of a small table as they are."""
    n = rows.count()
    return rows if n <= ROWS_PER_TASK else Examples(_gathered(_weighed(rows, label, labels, _balanced(rows, label)), n))


def _balanced(rows: DataFrame, label: str) -> Column:
    weights = {r[label]: r["weight"] for r in class_weights(rows, label).collect()}
    return F.coalesce(*[F.when(F.col(label) == k, F.lit(w)) for k, w in weights.items()])


def _weighed(rows: DataFrame, label: str, labels: list[str], weight: Column) -> DataFrame:
    """``features`` with the weight of each class, which is that of the row for its own class and 0 for others."""
    held = F.array(*[F.when(F.col(label) == x, weight).otherwise(F.lit(0.0)) for x in labels])
    unknown = F.raise_error(F.lit("a row has a label that is none of those to be learned")).cast("array<double>")
    return rows.select("features", F.when(label_index(F.col(label), labels) >= 0, held).otherwise(unknown).alias("t"))


def _gathered(data: DataFrame, n: int) -> DataFrame:
    """Every partition returns a gradient as large as the model, so small data use few, and large no more than the cores.

    Each iteration reads all partitions, so more of them than cores only add gradients to move and sum.
    """
    wanted = min(max(1, n // ROWS_PER_TASK), data.sparkSession.sparkContext.defaultParallelism)
    return data.coalesce(wanted) if wanted < data.rdd.getNumPartitions() else data


def _fit(regression, data: DataFrame, n: int):
    """Few rows are fitted by Spark's estimator, from a cache; ``Regression`` keeps its own."""
    data = _gathered(data, n)
    if isinstance(regression, Regression):
        return regression.fit(data)
    data = data.persist()
    model = regression.fit(data)
    data.unpersist()
    return model


def _regression(penalty: float, max_iter: int, tol: float = TOLERANCE) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features", labelCol="y", weightCol="w", family="multinomial", regParam=penalty,
        elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=tol,
    )


def train(df: DataFrame, text: str, label: str, labels: list[str], c: float = 10.0) -> PipelineModel:
    """Text to label, end to end."""
    features = fit_features(df, text)
    rows = materialise(featurize(features, df.select(text, label)).drop(text), "features")
    model = fit_classifier(rows, label, labels, c)
    return PipelineModel([*features.stages, model])


def predict(model, df: DataFrame, labels: list[str]) -> DataFrame:
    """Adds ``pred`` and ``confidence``, the largest class probability."""
    scored = model.transform(df).withColumn("_p", vector_to_array("probability"))
    out = scored.withColumn("pred", argmax_label(F.col("_p"), labels)).withColumn("confidence", F.array_max("_p"))
    return out.select(*df.columns, "pred", "confidence")


def soft_labels(model, df: DataFrame, temperature: float = 2.0) -> DataFrame:
    """Adds ``probs``: softmax of the class scores over the temperature, in label order."""
    scored = model.transform(df).withColumn("_z", vector_to_array("rawPrediction"))
    return scored.withColumn("probs", softmax(F.col("_z"), temperature)).select(*df.columns, "probs")


def evaluate(model, df: DataFrame, label: str, labels: list[str]) -> DataFrame:
    """One row: number of rows and macro-F1 over the classes seen."""
    return macro_f1(confusion_matrix(predict(model, df, labels), label, "pred"))


def c_sweep(
    train_rows: DataFrame, val_rows: DataFrame, label: str, labels: list[str], grid: list[float]
) -> list[dict]:
    """One fit per value of C on rows with ``features``: validation macro-F1, fit time and speed, and the model."""
    n = train_rows.count()
    ready = prepared(train_rows, label, labels)
    out = []
    for c in grid:
        start = perf_counter()
        model = fit_classifier(ready, label, labels, c)
        seconds = perf_counter() - start
        score = evaluate(model, val_rows, label, labels).first()["macro_f1"]
        out.append({"c": float(c), "val_f1": score, "step_time_sec": seconds, "samples_per_sec": n / seconds, "model": model})
    if isinstance(ready, Examples):
        ready.free()
    return out


def occurring(rows: DataFrame, *others: DataFrame) -> list[DataFrame]:
    """The tables with ``features`` cut to those that are not zero in all of ``rows``.

    A model that is fitted on ``rows`` gives the features cut off no weight, so its scores are the same.
    """
    held = F.udf(lambda v: [int(i) for i in v.toArray().nonzero()[0]] if isinstance(v, DenseVector) else v.indices.tolist(), "array<int>")
    found = rows.select(F.explode(held("features")).alias("i")).distinct().orderBy("i").collect()
    places = np.array([r["i"] for r in found], np.int64)

    def cut(v):
        if isinstance(v, DenseVector):
            return DenseVector(v.toArray()[places])
        at = np.searchsorted(places, v.indices)
        here = at < len(places)
        here[here] = places[at[here]] == v.indices[here]
        return SparseVector(len(places), at[here], v.values[here])

    if not len(places):
        return [rows, *others]
    return [x.withColumn("features", F.udf(cut, VectorUDT())("features")) for x in (rows, *others)]


def learning_curve(
    train_rows: DataFrame, val_rows: DataFrame, label: str, labels: list[str], epochs: list[int], c: float = 1e4
) -> DataFrame:
    """Log loss on both sides after each number of iterations, almost without penalty.

    Every iteration sends a gradient as large as the model to the driver, so the model has the features of the training
    rows alone.
    """
    spark = train_rows.sparkSession
    train_rows, val_rows = (
        materialise(x.select("features", label), "curve") for x in occurring(train_rows, val_rows)
    )
    curve = None
    for e in epochs:
        model = fit_classifier(train_rows, label, labels, c, max_iter=e)
        sides = train_rows.select("features", label, F.lit("train").alias("side")).unionByName(
            val_rows.select("features", label, F.lit("val").alias("side"))
        )
        probs = vector_to_array("probability")
        truth = F.get(probs, label_index(F.col(label), labels).cast("int"))
        losses = model.transform(sides).groupBy().agg(
            F.avg(F.when(F.col("side") == "train", log_loss_term(truth))).alias("train_loss"),
            F.avg(F.when(F.col("side") == "val", log_loss_term(truth))).alias("val_loss"),
        ).first()
        row = spark.createDataFrame(
            [(e, losses["train_loss"], losses["val_loss"])], "epoch int, train_loss double, val_loss double"
        )
        curve = row if curve is None else curve.unionByName(row)
    return curve


def distill(
    rows: DataFrame, probs: str, labels: list[str], temperature: float = 2.0, penalty: float = 1e-4
):
    """Student fitted on soft labels: each row weighs for every class by its probability.

    The weighted loss is the cross-entropy to the teacher, hence its KL divergence up to a constant.
    Labels softened at temperature T ask for scores divided by T, so the fitted student's scores are
    to be multiplied by T before they are read as class scores; its argmax is the same either way.
    """
    n = rows.count()
    if n <= ROWS_PER_TASK:
        classes = F.sequence(F.lit(0), F.lit(len(labels) - 1))
        soft = rows.select(
            "features",
            F.explode(F.transform(classes, lambda i: F.struct(i.cast("double").alias("y"), F.get(probs, i).alias("w")))).alias("t"),
        ).where("t.w > 0")
        return _fit(_regression(penalty / temperature**2, MAX_ITER), soft.select("features", "t.y", "t.w"), n)
    shares = [F.get(F.col(probs), F.lit(i)) for i in range(len(labels))]
    data = rows.select("features", F.array(*[F.when(p > 0, p).otherwise(F.lit(0.0)) for p in shares]).alias("t"))
    return _fit(Regression(penalty / temperature**2, MAX_ITER, TOLERANCE), data, n)


def by_kind(table: dict[str, Callable], kind: str) -> Callable:
    """The job registered for a kind of model; an unknown kind is an error."""
    if kind not in table:
        raise KeyError(f"unsupported model_kind {kind!r}; expected one of {sorted(table)}")
    return table[kind]


def score_by_kind(requests: DataFrame, kind: str, scorers: dict[str, object]) -> DataFrame:
    """Rows scored by the scorer of their kind, which sees only its own rows.

    A row of another kind, or of none, is an error, found before anything is scored.
    """
    known = F.coalesce(F.col(kind).isin(list(scorers)), F.lit(False))
    for row in requests.where(~known).select(kind).take(1):
        by_kind(scorers, row[0])
    parts = [s.score(requests.where(F.col(kind) == k)) for k, s in scorers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
