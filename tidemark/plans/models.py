"""Model jobs over ``documents``: the language of a text is its label. Fitted models have no SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import models, registry
from tidemark.operators.fingerprint import table_fingerprint
from tidemark.operators.metrics import distillation_loss
from tidemark.plans.drift import written_rates
from tidemark.plans.heal_loop import heal
from tidemark.plans.prepare import split_documents
from tidemark.plans.registry import query
from tidemark.session import materialise

LANGS = ["en", "de", "es", "fr"]
SPLITS = ["train", "val", "test"]


def split_features(spark, sf_dir):
    """All documents with their split and the features fitted on the training split; written once."""
    docs = split_documents(spark, sf_dir).select("doc_id", "text", "lang", "split")
    features = models.fit_features(docs.where("split = 'train'"))
    return materialise(models.featurize(features, docs).drop("text"), "features")


@query("train_eval")
def train_eval(spark, sf_dir):
    """Fit on the training split, macro-F1 on the other two."""
    rows = split_features(spark, sf_dir)
    model = models.fit_classifier(rows.where("split = 'train'"), "lang", LANGS, 10.0)
    parts = [
        models.evaluate(model, rows.where(F.col("split") == s), "lang", LANGS).select(F.lit(s).alias("split"), "*")
        for s in ("val", "test")
    ]
    return parts[0].unionByName(parts[1]).withColumn("macro_f1", F.round("macro_f1", 6))


@query("c_sweep")
def c_sweep(spark, sf_dir):
    """Four fits scored on validation; the best one is confirmed once on test."""
    rows = split_features(spark, sf_dir)
    train, val, test = [rows.where(F.col("split") == s) for s in SPLITS]
    runs = models.c_sweep(train, val, "lang", LANGS, [0.01, 0.1, 1.0, 10.0])
    chosen = max(runs, key=lambda r: (r["val_f1"], -r["c"]))
    best = chosen["c"]
    test_f1 = models.evaluate(chosen["model"], test, "lang", LANGS).first()["macro_f1"]
    table_rows = [(r["c"], r["val_f1"], r["c"] == best, test_f1 if r["c"] == best else None) for r in runs]
    return spark.createDataFrame(table_rows, "c double, val_f1 double, is_best boolean, test_f1 double")


@query("learning_curve")
def learning_curve(spark, sf_dir):
    """Train and validation loss by iteration on a starved training set of 500 rows."""
    rows = split_features(spark, sf_dir)
    starved = rows.where("split = 'train'").orderBy(F.md5(F.col("doc_id").cast("string"))).limit(500)
    starved = materialise(starved, "starved")
    curve = models.learning_curve(starved, rows.where("split = 'val'"), "lang", LANGS, [1, 2, 4, 8, 16])
    best = curve.agg(F.min_by("epoch", "val_loss"))
    return curve.withColumn("is_best", F.col("epoch") == best.scalar())


def teacher_and_labels(spark, sf_dir):
    rows = split_features(spark, sf_dir)
    teacher = models.fit_classifier(rows.where("split = 'train'"), "lang", LANGS, 10.0)
    return rows, models.soft_labels(teacher, rows, 2.0)


@query("soft_labels_model")
def soft_labels_model(spark, sf_dir):
    """Teacher probabilities of every document, softened at T = 2."""
    _, soft = teacher_and_labels(spark, sf_dir)
    return soft.select("doc_id", *[F.round(F.col("probs")[i], 6).alias(f"p_{x}") for i, x in enumerate(LANGS)])


@query("distill_student")
def distill_student(spark, sf_dir):
    """Student fitted on the soft labels of the training split: loss to the teacher, and macro-F1."""
    _, soft = teacher_and_labels(spark, sf_dir)
    soft = materialise(soft, "soft_labels")
    student = models.distill(soft.where("split = 'train'"), "probs", LANGS, 2.0)
    # The student was fitted at temperature T: its scores are already those over T.
    scored = models.soft_labels(student, soft.withColumnRenamed("probs", "teacher"), 1.0)
    loss = distillation_loss(scored.where("split = 'test'"), "teacher", "probs", temperature=2.0)
    score = models.evaluate(student, soft.where("split = 'test'"), "lang", LANGS)
    return loss.select("n", F.round("kl_loss", 6).alias("kl_loss")).withColumn(
        "macro_f1", F.round(score.select("macro_f1").scalar(), 6)
    )


@query("batch_score")
def batch_score(spark, sf_dir):
    """Label and confidence of every document from an end-to-end text model."""
    docs = split_documents(spark, sf_dir)
    model = models.train(docs.where("split = 'train'"), "text", "lang", LANGS)
    out = models.predict(model, docs.select("doc_id", "text", "lang", "split"), LANGS)
    return out.select("doc_id", "lang", "split", "pred", F.round("confidence", 6).alias("confidence"))


@query("heal_loop")
def heal_loop(spark, sf_dir):
    """Foreign-language batches drift from English; the retrained model must beat the incumbent."""
    docs = split_documents(spark, sf_dir)
    train, test = docs.where("split = 'train'"), docs.where("split = 'test'")
    test_set = test.select("text", F.col("lang").alias("label"))
    digest = table_fingerprint(test_set).first()["digest"]
    name = "text-labels"
    tags = materialise(
        registry.tag_events(spark, name, "1", {
            "test_f1": "0.5", "eval_set_hash": digest, "schema_version": "v1", "code_commit": "c0",
            "model_kind": "sklearn",
        }),
        "tags",
    )
    config = spark.createDataFrame(
        [(name, digest, "v1", 0.01, 0.40, "F1")],
        "model string, expected_hash string, expected_schema string, margin double, floor double, metric_label string",
    )
    incumbents = spark.createDataFrame([(name, "1", 0.5)], "model string, incumbent_version string, incumbent_score double")

    def retrain() -> float:
        model = models.train(train, "text", "lang", LANGS)
        return models.evaluate(model, test, "lang", LANGS).first()["macro_f1"]

    outcome, _ = heal(
        written_rates(spark, sf_dir), name, tags, config, incumbents, test_set, {"sklearn": retrain}, "c1"
    )
    return outcome.withColumns({c: F.round(c, 6) for c in ("psi", "test_f1")})
