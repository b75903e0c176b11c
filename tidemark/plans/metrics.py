"""Metric queries: two text rules play the models, hashed scores play their probabilities."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scores import argmax_label, softmax
from tidemark.functions.text import hash_int
from tidemark.operators import drift, metrics
from tidemark.plans.registry import query, table

LANGS = ["en", "de", "es", "fr"]
RULES = {"en": " the ", "fr": " les ", "de": " und ", "es": " que "}
OTHER_RULES = {"es": " el ", "de": " die ", "fr": " la ", "en": " of "}


def rule(markers: dict[str, str]):
    """The first language whose marker word occurs in the text, else ``unknown``."""
    text = F.lower("text")
    return F.coalesce(*[F.when(F.contains(text, F.lit(m)), lang) for lang, m in markers.items()], F.lit("unknown"))


def rule_sql(markers: dict[str, str]) -> str:
    whens = " ".join(f"WHEN contains(lower(text), '{m}') THEN '{lang}'" for lang, m in markers.items())
    return f"CASE {whens} ELSE 'unknown' END"


PREDICTED = f"""
WITH d AS (SELECT doc_id, source, lang AS gold, {rule_sql(RULES)} AS pred, {rule_sql(OTHER_RULES)} AS other FROM documents)
"""


def report_sql(name: str, pred: str, classes: str) -> str:
    """CTE ``name`` with the class report of ``pred``; ``classes`` yields the classes."""
    return f"""
{name} AS (
  SELECT c.label, count(*) FILTER (WHERE gold = label) AS support,
         CASE WHEN count(*) FILTER (WHERE {pred} = label) > 0
              THEN count(*) FILTER (WHERE gold = label AND {pred} = label) / count(*) FILTER (WHERE {pred} = label)
              ELSE 0.0 END AS precision,
         CASE WHEN count(*) FILTER (WHERE gold = label) > 0
              THEN count(*) FILTER (WHERE gold = label AND {pred} = label) / count(*) FILTER (WHERE gold = label)
              ELSE 0.0 END AS recall,
         CASE WHEN count(*) FILTER (WHERE gold = label OR {pred} = label) > 0
              THEN 2 * count(*) FILTER (WHERE gold = label AND {pred} = label)
                   / (count(*) FILTER (WHERE gold = label) + count(*) FILTER (WHERE {pred} = label))
              ELSE 0.0 END AS f1
  FROM d, ({classes}) c GROUP BY c.label)
"""


SEEN = "SELECT gold AS label FROM d UNION SELECT pred FROM d"
LISTED = "SELECT unnest(['en', 'de', 'es', 'fr']) AS label"


def predictions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", "source", F.col("lang").alias("gold"), rule(RULES).alias("pred"), rule(OTHER_RULES).alias("other")
    )


@query("confusion_matrix", PREDICTED + "SELECT gold, pred, count(*) AS n FROM d GROUP BY ALL")
def confusion_matrix(spark, sf_dir):
    """Gold labels and predictions arrive as two tables and meet on the document key."""
    docs = table(spark, sf_dir, "documents")
    gold = docs.select("doc_id", F.col("lang").alias("gold"))
    pred = docs.select("doc_id", rule(RULES).alias("pred"))
    return metrics.confusion_matrix(gold.join(pred, "doc_id"), "gold", "pred")


@query(
    "macro_f1",
    PREDICTED + "," + report_sql("r", "pred", SEEN)
    + "SELECT cast(sum(support) AS bigint) AS n_test, round(avg(f1), 6) AS macro_f1 FROM r",
)
def macro_f1(spark, sf_dir):
    matrix = metrics.confusion_matrix(predictions(spark, sf_dir), "gold", "pred")
    return metrics.macro_f1(matrix).withColumn("macro_f1", F.round("macro_f1", 6))


@query(
    "macro_f1_fixed",
    PREDICTED + "," + report_sql("r", "pred", LISTED)
    + "SELECT cast(sum(support) AS bigint) AS n_test, round(avg(f1), 6) AS macro_f1 FROM r",
)
def macro_f1_fixed(spark, sf_dir):
    matrix = metrics.confusion_matrix(predictions(spark, sf_dir), "gold", "pred")
    return metrics.macro_f1(matrix, labels=LANGS).withColumn("macro_f1", F.round("macro_f1", 6))


@query(
    "per_class_report",
    PREDICTED + "," + report_sql("r", "pred", LISTED) + "," + report_sql("p", "other", LISTED)
    + """
SELECT r.label, r.support, round(r.precision, 6) AS precision, round(r.recall, 6) AS recall, round(r.f1, 6) AS f1,
       round(p.f1, 6) AS production_f1, p.f1 - r.f1 > 0.02 AS regressed
FROM r JOIN p ON r.label = p.label
""",
)
def per_class_report(spark, sf_dir):
    rows = predictions(spark, sf_dir)
    candidate = metrics.class_report(metrics.confusion_matrix(rows, "gold", "pred"), labels=LANGS)
    production = metrics.class_report(metrics.confusion_matrix(rows, "gold", "other"), labels=LANGS)
    out = metrics.regressions(candidate, production)
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1", "production_f1")})


@query(
    "invalid_rate",
    PREDICTED
    + """
SELECT source, count(*) AS n, round(avg((pred = 'unknown')::int), 6) AS invalid_rate,
       avg((pred = 'unknown')::int) < 0.01 AS ok
FROM d GROUP BY source
""",
)
def invalid_rate(spark, sf_dir):
    out = metrics.invalid_rate(predictions(spark, sf_dir), "pred", "source")
    return out.withColumn("invalid_rate", F.round("invalid_rate", 6))


@query(
    "agreement",
    PREDICTED
    + "SELECT count(*) AS n, round(avg((pred = other)::int), 6) AS agreement, avg((pred = other)::int) >= 0.9 AS ok FROM d",
)
def agreement(spark, sf_dir):
    rows = predictions(spark, sf_dir)
    teacher, student = rows.select("doc_id", "pred"), rows.select("doc_id", F.col("other").alias("pred"))
    out = metrics.agreement(teacher, student, "doc_id", "pred")
    return out.withColumn("agreement", F.round("agreement", 6))


@query(
    "n_test_check",
    """
WITH e AS (SELECT lang, count(*) AS expected FROM documents GROUP BY lang),
r AS (SELECT d.lang, count(*) AS n_test FROM documents d
      WHERE d.lang <> 'es' OR d.doc_id IN (SELECT doc_id FROM labels) GROUP BY d.lang)
SELECT lang, n_test, expected, n_test = expected AS ok FROM r JOIN e USING (lang)
""",
)
def n_test_check(spark, sf_dir):
    """The Spanish result was computed on the labelled documents only, so its size is off."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("labelled"))
    scored = docs.join(labels, "doc_id", "left").where("lang <> 'es' or labelled")
    return metrics.check_counts(scored.groupBy("lang").agg(F.count("*").alias("n_test")), docs, "lang")


def weights(seed: str):
    """Four positive integer weights per document, one per language."""
    return F.array(*[(hash_int(F.col("doc_id"), f"{seed}{i}") % 100 + 1).cast("double") for i in range(4)])


def weights_sql(seed: str) -> str:
    parts = [
        f"(cast(concat('0x', substr(md5(concat('{seed}{i}:', doc_id)), 1, 8)) AS bigint) % 100 + 1)::double"
        for i in range(4)
    ]
    return f"[{', '.join(parts)}]"


def shares(seed: str):
    w = weights(seed)
    return F.transform(w, lambda x: x / F.aggregate(w, F.lit(0.0), lambda a, y: a + y))


SCORED = f"""
WITH w AS (SELECT doc_id, lang, {weights_sql('t')} AS tw, {weights_sql('s')} AS sw FROM documents),
d AS (SELECT doc_id, lang, tw, list_transform(tw, lambda x: x / list_sum(tw)) AS teacher,
             list_transform(sw, lambda x: x / list_sum(sw)) AS student FROM w)
"""


def scored(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return docs.select("*", weights("t").alias("tw"), shares("t").alias("teacher"), shares("s").alias("student"))


@query(
    "log_loss",
    SCORED
    + """
SELECT lang, count(*) AS n,
       round(-avg(ln(list_extract(student, list_position(['en', 'de', 'es', 'fr'], lang)))), 6) AS log_loss
FROM d GROUP BY lang
""",
)
def log_loss(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in LANGS])
    truth = F.get(F.col("student"), (F.array_position(names, F.col("lang")) - 1).cast("int"))
    out = metrics.mean_log_loss(scored(spark, sf_dir), truth, "lang")
    return out.withColumn("log_loss", F.round("log_loss", 6))


@query(
    "kl_divergence",
    SCORED
    + """
SELECT lang, count(*) AS n, round(4.0 * avg(list_sum(list_transform(range(1, 5),
         lambda i: teacher[i] * (ln(teacher[i]) - ln(student[i]))))), 6) AS kl_loss
FROM d GROUP BY lang
""",
)
def kl_divergence(spark, sf_dir):
    out = metrics.distillation_loss(scored(spark, sf_dir), "teacher", "student", "lang")
    return out.withColumn("kl_loss", F.round("kl_loss", 6))


@query(
    "argmax_label",
    SCORED
    + """
SELECT doc_id, list_extract(['en', 'de', 'es', 'fr'], list_position(student, list_max(student))) AS label,
       round(list_max(student), 6) AS confidence
FROM d
""",
)
def argmax(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "doc_id", argmax_label(F.col("student"), LANGS).alias("label"),
        F.round(F.array_max("student"), 6).alias("confidence"),
    )


@query(
    "confidence_entropy",
    SCORED
    + """
SELECT lang, count(*) AS n, round(avg(list_max(student)), 6) AS mean_confidence,
       round(avg(-list_sum(list_transform(student, lambda p: p * ln(p)))), 6) AS mean_entropy
FROM d GROUP BY lang
""",
)
def confidence_entropy(spark, sf_dir):
    out = drift.confidence_summary(scored(spark, sf_dir), "student", "lang")
    return out.withColumns({c: F.round(c, 6) for c in ("mean_confidence", "mean_entropy")})


@query(
    "soft_labels",
    SCORED
    + """,
e AS (SELECT doc_id, list_transform(tw, lambda z: exp((z / 10 - list_max(tw) / 10) / 2.0)) AS e FROM d)
SELECT doc_id, round(e[1] / list_sum(e), 6) AS p_en, round(e[2] / list_sum(e), 6) AS p_de,
       round(e[3] / list_sum(e), 6) AS p_es, round(e[4] / list_sum(e), 6) AS p_fr
FROM e
""",
)
def soft_labels(spark, sf_dir):
    logits = F.transform("tw", lambda x: x / 10)
    out = scored(spark, sf_dir).select("doc_id", softmax(logits, 2.0).alias("p"))
    return out.select("doc_id", *[F.round(F.col("p")[i], 6).alias(f"p_{x}") for i, x in enumerate(LANGS)])


CASCADE_SCORES = """
WITH d AS (
  SELECT doc_id, lang, (cast(concat('0x', substr(md5(concat('conf:', doc_id)), 1, 8)) AS bigint) % 1000) / 1000 AS conf,
         cast(concat('0x', substr(md5(concat('cheap:', doc_id)), 1, 8)) AS bigint) % 100 < 75 AS cheap_ok,
         cast(concat('0x', substr(md5(concat('big:', doc_id)), 1, 8)) AS bigint) % 100 < 85 AS big_ok
  FROM documents)
"""


@query(
    "threshold_sweep",
    CASCADE_SCORES
    + """
SELECT k / 20.0::double AS threshold, count(*) FILTER (WHERE conf < k / 20.0::double) AS n_escalated,
       round(avg((conf < k / 20.0::double)::int), 6) AS escalation_rate,
       round(avg((CASE WHEN conf < k / 20.0::double THEN big_ok ELSE cheap_ok END)::int), 6) AS accuracy
FROM d, range(21) t(k) GROUP BY k
""",
)
def threshold_sweep(spark, sf_dir):
    key = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").select("doc_id")
    out = metrics.threshold_sweep(
        docs, (hash_int(key, "conf") % 1000) / 1000, hash_int(key, "cheap") % 100 < 75, hash_int(key, "big") % 100 < 85
    )
    return out.withColumns({c: F.round(c, 6) for c in ("escalation_rate", "accuracy")})


@query(
    "delayed_label_accuracy",
    """
WITH p AS (SELECT event_id, event_type AS label, ts, user_id % 10 AS model FROM events),
t AS (SELECT event_id - 7 AS event_id, event_type AS true_label, ts AS label_ts FROM events)
SELECT model, count(*) AS n, round(avg((label = true_label)::int), 6) AS accuracy,
       avg((label = true_label)::int) < 0.22 - 0.02 AS retrain
FROM p JOIN t USING (event_id) WHERE label_ts >= ts AND label_ts - ts <= INTERVAL 30 MINUTE GROUP BY model
""",
)
def delayed_label_accuracy(spark, sf_dir):
    """The truth about an event arrives with the event seven places later."""
    events = table(spark, sf_dir, "events")
    preds = events.select("event_id", F.col("event_type").alias("label"), "ts", (F.col("user_id") % 10).alias("model"))
    truths = events.select(
        (F.col("event_id") - 7).alias("event_id"), F.col("event_type").alias("true_label"), F.col("ts").alias("label_ts")
    )
    out = metrics.accuracy_with_delay(preds, truths, "event_id", 1800, 0.22, "model")
    return out.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "class_mix_shift",
    PREDICTED
    + """,
t AS (SELECT gold AS label, count(*) AS n FROM d GROUP BY gold),
p AS (SELECT other AS label, count(*) AS n FROM d GROUP BY other),
s AS (SELECT label, coalesce(t.n, 0) AS n_train, coalesce(p.n, 0) AS n_pred,
             coalesce(t.n, 0) / (SELECT sum(n) FROM t) AS train_share,
             coalesce(p.n, 0) / (SELECT sum(n) FROM p) AS pred_share
      FROM t FULL JOIN p USING (label))
SELECT label, n_train, n_pred, round(train_share, 6) AS train_share, round(pred_share, 6) AS pred_share,
       round(abs(pred_share - train_share), 6) AS shift, abs(pred_share - train_share) > 0.1 AS breach
FROM s
""",
)
def class_mix_shift(spark, sf_dir):
    """The mix of predicted classes against the mix of labels."""
    rows = predictions(spark, sf_dir)
    labels, predicted = rows.select(F.col("gold").alias("label")), rows.select(F.col("other").alias("label"))
    out = drift.class_mix_shift(labels, predicted, "label")
    return out.withColumns({c: F.round(c, 6) for c in ("train_share", "pred_share", "shift")})
