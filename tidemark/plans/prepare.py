"""Splits, weights and fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import fingerprint, split
from tidemark.plans.registry import query, table

SPLIT = """
WITH r AS (
  SELECT doc_id, lang, text, n_chars,
         row_number() OVER (PARTITION BY lang ORDER BY md5(concat('42:', doc_id)), doc_id) AS rn,
         (count(*) OVER (PARTITION BY lang) * 30 + 99) // 100 AS holdout
  FROM documents),
s AS (SELECT doc_id, lang, text, n_chars,
             CASE WHEN rn <= (holdout + 1) // 2 THEN 'test' WHEN rn <= holdout THEN 'val' ELSE 'train' END AS split
      FROM r)
"""


def split_documents(spark, sf_dir):
    return split.stratified_split(table(spark, sf_dir, "documents"), "doc_id", "lang")


@query("stratified_split", SPLIT + "SELECT doc_id, lang, split FROM s")
def stratified_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return split.stratified_split(docs, "doc_id", "lang")


@query(
    "random_split",
    """
SELECT doc_id, CASE WHEN cast(concat('0x', substr(md5(concat('42:', doc_id)), 1, 8)) AS bigint) % 1000 < 100
                    THEN 'val' ELSE 'train' END AS split
FROM documents
""",
)
def random_split(spark, sf_dir):
    return split.random_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query(
    "class_weights",
    """
SELECT lang, count(*) AS n_class,
       round((SELECT count(*) FROM documents) / ((SELECT count(DISTINCT lang) FROM documents) * count(*)), 6) AS weight
FROM documents GROUP BY lang
""",
)
def class_weights(spark, sf_dir):
    out = split.class_weights(table(spark, sf_dir, "documents"), "lang")
    return out.withColumn("weight", F.round("weight", 6))


@query(
    "eval_set_hash",
    SPLIT
    + """,
h AS (SELECT sha256(concat(length(lang), ':', lang, '|', length(text), ':', text)) AS h FROM s WHERE split = 'test'),
c AS (SELECT h, count(*) AS n FROM h GROUP BY h),
l1 AS (SELECT substr(h, 1, 6) AS h, sum(n) AS n,
              sha256(string_agg(concat(h, ':', n), ',' ORDER BY concat(h, ':', n))) AS d FROM c GROUP BY 1),
l2 AS (SELECT substr(h, 1, 3) AS h, sum(n) AS n, sha256(string_agg(concat(h, ':', d), ',' ORDER BY h)) AS d
       FROM l1 GROUP BY 1)
SELECT cast(sum(n) AS bigint) AS n_rows, sha256(string_agg(concat(h, ':', d), ',' ORDER BY h)) AS digest FROM l2
""",
)
def eval_set_hash(spark, sf_dir):
    test = split_documents(spark, sf_dir).where("split = 'test'")
    return fingerprint.table_fingerprint(test, ["lang", "text"])
