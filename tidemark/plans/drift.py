"""Token and drift queries over ``documents``.

English documents with hash bucket below 700 are the training split, from 850 on they are the
reference sample; the rest, and every other language, arrive as current batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import hash_bucket
from tidemark.operators import drift, tokens
from tidemark.plans.registry import query, table
from tidemark.session import materialise

TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"

RATES = f"""
WITH d AS (
  SELECT doc_id, lang, source, text, n_chars,
         cast(concat('0x', substr(md5(concat('42:', doc_id)), 1, 8)) AS bigint) % 1000 AS b
  FROM documents),
vocab AS (SELECT DISTINCT unnest({TOKENS}) AS token FROM d WHERE lang = 'en' AND b < 700),
scored AS (SELECT * FROM d WHERE NOT (lang = 'en' AND b < 700)),
words AS (SELECT doc_id, unnest({TOKENS}) AS token FROM scored),
hits AS (
  SELECT w.doc_id, count(*) AS n, count(*) FILTER (WHERE v.token IS NULL) AS unseen
  FROM words w LEFT JOIN vocab v ON w.token = v.token GROUP BY w.doc_id),
rates AS (
  SELECT s.doc_id, s.lang, s.source, s.n_chars, (s.lang = 'en' AND s.b >= 850) AS is_ref,
         coalesce(h.unseen, 0) AS oov_tokens, coalesce(h.n, 0) AS n_tokens,
         CASE WHEN h.n > 0 THEN h.unseen / h.n ELSE 0.0 END AS oov_rate
  FROM scored s LEFT JOIN hits h ON s.doc_id = h.doc_id)
"""

BIN = "len(list_filter(range(1, 10), lambda k: oov_rate >= k * 0.1::double))"


def psi_sql(group: str) -> str:
    """Stability index per value of ``group`` on a full grid of bins."""
    return RATES + f""",
binned AS (SELECT *, {BIN} AS bin FROM rates),
grid AS (SELECT g, bin FROM (SELECT DISTINCT {group} AS g FROM binned WHERE NOT is_ref), range(10) t(bin)),
ref AS (SELECT bin, count(*) AS n FROM binned WHERE is_ref GROUP BY bin),
cur AS (SELECT {group} AS g, bin, count(*) AS n FROM binned WHERE NOT is_ref GROUP BY ALL),
shares AS (
  SELECT grid.g,
         greatest(coalesce(ref.n, 0) / (SELECT sum(n) FROM ref), 1e-6) AS r,
         greatest(coalesce(cur.n, 0) / (SELECT sum(n) FROM cur c WHERE c.g = grid.g), 1e-6) AS c
  FROM grid LEFT JOIN ref ON grid.bin = ref.bin LEFT JOIN cur ON grid.g = cur.g AND grid.bin = cur.bin),
p AS (SELECT g, sum((c - r) * ln(c / r)) AS psi FROM shares GROUP BY g)
SELECT p.g AS {group}, m.n, round(m.mean_current, 6) AS mean_current, round(p.psi, 6) AS psi,
       CASE WHEN p.psi > 0.2 THEN 'yes' ELSE 'no' END AS drift,
       CASE WHEN p.psi > 0.2 THEN 'retrain' WHEN p.psi >= 0.1 THEN 'watch' ELSE 'ok' END AS band
FROM p JOIN (SELECT {group} AS g, count(*) AS n, avg(oov_rate) AS mean_current
             FROM rates WHERE NOT is_ref GROUP BY 1) m ON m.g = p.g
"""


def bucketed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumn("b", hash_bucket(F.col("doc_id"), 1000))


def train_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bucketed_documents(spark, sf_dir)
    return materialise(tokens.vocabulary(docs.where("lang = 'en' and b < 700"), "text"), "vocabulary")


def scored_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OOV rate of every document outside the training split, with the reference flagged."""
    scored = bucketed_documents(spark, sf_dir).where("not (lang = 'en' and b < 700)").withColumn(
        "is_ref", F.expr("lang = 'en' and b >= 850")
    )
    return tokens.oov_rates(
        scored, train_vocabulary(spark, sf_dir), "doc_id", "text", "lang", "source", "n_chars", "is_ref"
    )


def written_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(scored_rates(spark, sf_dir), "oov_rates")


def verdict(psi: DataFrame) -> DataFrame:
    return psi.select(
        psi.columns[0],
        "n",
        F.round("mean_current", 6).alias("mean_current"),
        F.round("psi", 6).alias("psi"),
        F.when(F.col("psi") > drift.PSI_THRESHOLD, "yes").otherwise("no").alias("drift"),
        drift.drift_band(F.col("psi")).alias("band"),
    )


@query("psi_by_lang", psi_sql("lang"))
def psi_by_lang(spark, sf_dir):
    rates = written_rates(spark, sf_dir)
    return verdict(drift.psi_by_group(rates.where("is_ref"), rates.where("not is_ref"), "oov_rate", "lang"))


@query("psi_by_source", psi_sql("source"))
def psi_by_source(spark, sf_dir):
    rates = written_rates(spark, sf_dir)
    return verdict(
        drift.psi_by_group(rates.where("is_ref"), rates.where("not is_ref"), "oov_rate", "source")
    )


@query(
    "psi",
    RATES
    + f""",
binned AS (SELECT is_ref, {BIN} AS bin FROM rates),
counts AS (SELECT bin, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS c
           FROM binned GROUP BY bin),
grid AS (SELECT coalesce(r, 0) AS r, coalesce(c, 0) AS c FROM range(10) t(bin) LEFT JOIN counts USING (bin)),
shares AS (SELECT greatest(r / sum(r) OVER (), 1e-6) AS r, greatest(c / sum(c) OVER (), 1e-6) AS c FROM grid)
SELECT (SELECT count(*) FROM rates WHERE NOT is_ref) AS n, round(sum((c - r) * ln(c / r)), 6) AS psi FROM shares
""",
)
def psi(spark, sf_dir):
    rates = written_rates(spark, sf_dir)
    out = drift.psi_by_group(rates.where("is_ref"), rates.where("not is_ref"), "oov_rate")
    return out.select("n", F.round("psi", 6).alias("psi"))


@query(
    "oov_rate",
    RATES
    + "SELECT doc_id, lang, is_ref, oov_tokens, n_tokens, round(oov_rate, 6) AS oov_rate FROM rates",
)
def oov_rate(spark, sf_dir):
    return scored_rates(spark, sf_dir).select(
        "doc_id", "lang", "is_ref", "oov_tokens", "n_tokens", F.round("oov_rate", 6).alias("oov_rate")
    )


@query(
    "oov_histogram",
    RATES + f"SELECT lang, is_ref, {BIN} AS bin, count(*) AS n FROM rates GROUP BY ALL",
)
def oov_histogram(spark, sf_dir):
    out = drift.histogram(scored_rates(spark, sf_dir), "oov_rate", "lang", "is_ref")
    return out.withColumn("bin", F.col("bin").cast("bigint"))


P_VALUE = """
CASE WHEN {lam} < 0.2 THEN 1.0 ELSE least(greatest(list_sum(list_transform(range(1, 101),
  lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * ({lam}) * ({lam})))), 0.0), 1.0) END
"""


def ks_sql(samples: str, keys: str) -> str:
    """KS per ``keys`` from a table expression with columns keys, value, is_ref."""
    comma = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    lam = "ks * sqrt(n_ref * n_cur / (n_ref + n_cur))"
    return f"""
steps AS (
  SELECT {comma}value,
         sum(count(*) FILTER (WHERE is_ref)) OVER ({part} ORDER BY value) AS cum_r,
         sum(count(*) FILTER (WHERE NOT is_ref)) OVER ({part} ORDER BY value) AS cum_c,
         sum(count(*) FILTER (WHERE is_ref)) OVER ({part}) AS n_ref,
         sum(count(*) FILTER (WHERE NOT is_ref)) OVER ({part}) AS n_cur
  FROM {samples} GROUP BY {comma}value),
gaps AS (
  SELECT {comma}cast(any_value(n_ref) AS bigint) AS n_ref, cast(any_value(n_cur) AS bigint) AS n_cur,
         max(abs(cum_r / n_ref - cum_c / n_cur)) AS ks
  FROM steps {f'GROUP BY {keys}' if keys else ''}),
ks AS (SELECT {comma}n_ref, n_cur, ks, {P_VALUE.format(lam=lam)} AS ks_p FROM gaps)
"""


@query(
    "ks_stat",
    RATES
    + ",samples AS (SELECT oov_rate AS value, is_ref FROM rates),"
    + ks_sql("samples", "")
    + "SELECT n_ref, n_cur, round(ks, 6) AS ks, round(ks_p, 6) AS ks_p FROM ks",
)
def ks_stat(spark, sf_dir):
    rates = written_rates(spark, sf_dir)
    out = drift.ks_two_sample(rates, "oov_rate", "is_ref")
    return out.select("n_ref", "n_cur", F.round("ks", 6).alias("ks"), F.round("ks_p", 6).alias("ks_p"))


@query(
    "drift_report",
    RATES
    + f""",
samples AS (
  SELECT lang, oov_rate AS value, is_ref FROM rates WHERE NOT is_ref
  UNION ALL
  SELECT l.lang, r.oov_rate, true FROM rates r, (SELECT unnest(['de', 'en', 'es', 'fr']) AS lang) l WHERE r.is_ref),
binned AS (SELECT lang, is_ref, {BIN.replace('oov_rate', 'value')} AS bin FROM samples),
grid AS (SELECT lang, bin FROM (SELECT DISTINCT lang FROM samples), range(10) t(bin)),
shares AS (
  SELECT g.lang,
         greatest(count(b.bin) FILTER (WHERE b.is_ref)
                  / sum(count(b.bin) FILTER (WHERE b.is_ref)) OVER (PARTITION BY g.lang), 1e-6) AS r,
         greatest(count(b.bin) FILTER (WHERE NOT b.is_ref)
                  / sum(count(b.bin) FILTER (WHERE NOT b.is_ref)) OVER (PARTITION BY g.lang), 1e-6) AS c
  FROM grid g LEFT JOIN binned b ON b.lang = g.lang AND b.bin = g.bin GROUP BY g.lang, g.bin),
p AS (SELECT lang, sum((c - r) * ln(c / r)) AS psi FROM shares GROUP BY lang),
m AS (SELECT lang, avg(value) FILTER (WHERE is_ref) AS mean_ref, avg(value) FILTER (WHERE NOT is_ref) AS mean_current
      FROM samples GROUP BY lang),
"""
    + ks_sql("samples", "lang")
    + """
SELECT lang, round(mean_ref, 6) AS mean_ref, round(mean_current, 6) AS mean_current, round(psi, 6) AS psi,
       n_ref, n_cur, round(ks, 6) AS ks, round(ks_p, 6) AS ks_p,
       CASE WHEN psi > 0.2 THEN 'yes' ELSE 'no' END AS drift,
       CASE WHEN psi > 0.2 THEN 'retrain' WHEN psi >= 0.1 THEN 'watch' ELSE 'ok' END AS band
FROM m JOIN p USING (lang) JOIN ks USING (lang)
""",
)
def drift_report(spark, sf_dir):
    """Each language batch against the English reference, which is repeated per batch."""
    rates = written_rates(spark, sf_dir).select("lang", "oov_rate", "is_ref")
    # Structs, so that a null language is a batch of its own.
    batches = rates.where("not is_ref").agg(F.collect_set(F.struct("lang"))).scalar()
    reference = rates.where("is_ref").select(F.explode(batches).alias("batch"), "oov_rate", "is_ref")
    reference = reference.select("batch.lang", "oov_rate", "is_ref")
    samples = reference.unionByName(rates.where("not is_ref"))
    out = drift.drift_report(samples, "oov_rate", "is_ref", "lang")
    rounded = ["mean_ref", "mean_current", "psi", "ks", "ks_p"]
    return out.withColumns({c: F.round(c, 6) for c in rounded})


@query(
    "drift_preset",
    RATES
    + """,
samples AS (
  SELECT 'oov_rate' AS column_name, cast(oov_rate AS double) AS value, is_ref FROM rates
  UNION ALL SELECT 'n_tokens', cast(n_tokens AS double), is_ref FROM rates
  UNION ALL SELECT 'n_chars', cast(n_chars AS double), is_ref FROM rates),
"""
    + ks_sql("samples", "column_name")
    + """
SELECT column_name, n_ref, n_cur, round(ks, 6) AS ks, ks_p < 0.05 AS drifted,
       round((SELECT avg((ks_p < 0.05)::int) FROM ks), 6) AS drifted_share FROM ks
""",
)
def drift_preset(spark, sf_dir):
    rates = written_rates(spark, sf_dir)
    out = drift.drift_preset(rates, ["oov_rate", "n_tokens", "n_chars"], "is_ref")
    return out.select(
        "column_name", "n_ref", "n_cur", F.round("ks", 6).alias("ks"), "drifted",
        F.round("drifted_share", 6).alias("drifted_share"),
    )


COUNTS = f"""
WITH words AS (SELECT doc_id, unnest({TOKENS}) AS token FROM documents),
counts AS (SELECT doc_id, token, count(*) AS cnt FROM words GROUP BY ALL),
freq AS (
  SELECT token, count(*) AS df, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
  FROM counts GROUP BY token)
"""


@query("vocab_df", COUNTS + "SELECT token, df, round(idf, 6) AS idf FROM freq")
def vocab_df(spark, sf_dir):
    out = tokens.document_frequency(table(spark, sf_dir, "documents"), "text")
    return out.withColumn("idf", F.round("idf", 6))


@query(
    "tfidf",
    COUNTS
    + """
SELECT doc_id, token, cnt, df,
       round(cnt * idf / sqrt(sum(cnt * idf * cnt * idf) OVER (PARTITION BY doc_id)), 6) AS weight
FROM counts JOIN freq USING (token)
""",
)
def tfidf(spark, sf_dir):
    out = tokens.tfidf(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select("doc_id", "token", "cnt", "df", F.round("weight", 6).alias("weight"))
