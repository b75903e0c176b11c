"""Chat-format and summary-score queries; conversation turns stand in for summary pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import chat, summaries
from tidemark.plans.registry import query, table
from tidemark.session import ship_package

INSTRUCTION_SQL = "'" + chat.PROMPTS["classify"]["instruction"].replace("\n", "' || chr(10) || '") + "'"
SYSTEM_SQL = "'" + chat.PROMPTS["classify"]["system"] + "'"


@query(
    "chat_format",
    f"""
SELECT doc_id, 3 AS n_messages, {SYSTEM_SQL} AS system, md5({INSTRUCTION_SQL} || text) AS user_md5, lang AS assistant
FROM documents
""",
)
def chat_format(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", chat.messages(F.col("text"), "classify", F.col("lang")).alias("m"))
    return rows.select(
        "doc_id", F.size("m").alias("n_messages"), F.col("m")[0]["content"].alias("system"),
        F.md5(F.col("m")[1]["content"]).alias("user_md5"), F.col("m")[2]["content"].alias("assistant"),
    )


@query("chat_unformat", "SELECT doc_id, md5(text) AS text_md5, lang AS gold FROM documents")
def chat_unformat(spark, sf_dir):
    """Examples of half the documents lack the instruction, which must then stay untouched."""
    docs = table(spark, sf_dir, "documents")
    plain = F.array(chat.turn("user", F.col("text")), chat.turn("assistant", F.col("lang")))
    formatted = chat.messages(F.col("text"), "classify", F.col("lang"))
    rows = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, formatted).otherwise(plain).alias("m"))
    return rows.select(
        "doc_id", F.md5(chat.prompt_text(F.col("m"), "classify")).alias("text_md5"), chat.gold_answer(F.col("m")).alias("gold")
    )


PAIRS = """
WITH p AS (SELECT a.conv_id, a.turn, b.role, b.text AS candidate, a.text AS reference
           FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1
           WHERE a.role = 'assistant')
"""


@query(
    "conversation_messages",
    PAIRS + "SELECT conv_id, turn, role, md5(candidate) AS prompt_md5, md5(reference) AS reply_md5 FROM p",
)
def conversation_messages(spark, sf_dir):
    rows = chat.reply_examples(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    m = F.col("messages")
    return rows.select(
        "conv_id", "turn", m[0]["role"].alias("role"), F.md5(m[0]["content"]).alias("prompt_md5"),
        F.md5(m[1]["content"]).alias("reply_md5"),
    )


@query(
    "conversation_array",
    """
SELECT conv_id, cast(count(*) AS bigint) AS n_turns,
       md5(string_agg(concat(role, chr(10), text), chr(10) ORDER BY turn)) AS messages_md5,
       arg_min(role, turn) AS first_role, arg_max(role, turn) AS last_role
FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
""",
)
def conversation_array(spark, sf_dir):
    """Every conversation as one array of messages."""
    rows = chat.conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["content"]))
    return rows.select(
        "conv_id", "n_turns", F.md5(F.array_join(lines, "\n")).alias("messages_md5"),
        F.col("messages")[0]["role"].alias("first_role"), F.element_at("messages", -1)["role"].alias("last_role"),
    )


def summary_pairs(spark, sf_dir):
    """Reference: a reply. Adapter candidate: the turn before it. Base candidate: its first sentence."""
    ship_package(spark)
    rows = chat.reply_examples(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    m = F.col("messages")
    return rows.select(
        "conv_id", "turn", m[1]["content"].alias("reference"), m[0]["content"].alias("candidate"),
        F.substring_index(m[0]["content"], ".", 1).alias("base"),
    )


@query(
    "rouge_l",
    PAIRS.replace("WITH p", "WITH RECURSIVE p")
    + """,
t AS (SELECT conv_id, turn, regexp_extract_all(lower(candidate), '[a-z0-9]+') AS a,
             regexp_extract_all(lower(reference), '[a-z0-9]+') AS b FROM p),
l AS (
  SELECT conv_id, turn, a, b, 0 AS i, list_transform(b, lambda x: 0) AS r FROM t
  UNION ALL
  SELECT conv_id, turn, a, b, i + 1,
         list_transform(range(1, len(b) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda q:
           CASE WHEN a[i + 1] = b[q] THEN coalesce(CASE WHEN q > 1 THEN r[q - 1] END, 0) + 1 ELSE r[q] END)))
  FROM l WHERE i < len(a))
SELECT conv_id, turn, len(a) AS n_candidate, len(b) AS n_reference,
       round(coalesce(2 * list_max(r) / (len(a) + len(b)), 0.0), 6) AS rouge_l
FROM l WHERE i = len(a)
""",
)
def rouge_l(spark, sf_dir):
    pairs = summary_pairs(spark, sf_dir)
    out = summaries.rouge_l(pairs, "candidate", "reference", "rouge_l", use_stemmer=False)
    counts = {"n_candidate": "candidate", "n_reference": "reference"}
    return out.select(
        "conv_id", "turn",
        *[F.size(summaries.summary_tokens(F.col(c))).cast("bigint").alias(n) for n, c in counts.items()],
        F.round("rouge_l", 6).alias("rouge_l"),
    )


@query("rouge_l_stemmed")
def rouge_l_stemmed(spark, sf_dir):
    """Mean stemmed ROUGE-L of both systems and the verdict."""
    pairs = summary_pairs(spark, sf_dir)
    scored = summaries.rouge_l(pairs, "candidate", "reference", "adapter")
    scored = summaries.rouge_l(scored, "base", "reference", "base_score")
    out = summaries.beat_bar(scored, "adapter", "base_score")
    return out.withColumns({c: F.round(c, 6) for c in ("adapter", "base")})


def rouge_n_sql(n: int) -> str:
    gram = " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
    return PAIRS + f""",
w AS (SELECT conv_id, turn, 1 AS side, regexp_extract_all(lower(candidate), '[a-z0-9]+') AS w FROM p
      UNION ALL SELECT conv_id, turn, 2, regexp_extract_all(lower(reference), '[a-z0-9]+') FROM p),
g AS (SELECT conv_id, turn, side, unnest(list_transform(range(1, len(w) - {n - 1} + 1), lambda i: {gram})) AS gram FROM w),
c AS (SELECT conv_id, turn, gram, count(*) FILTER (WHERE side = 1) AS c, count(*) FILTER (WHERE side = 2) AS r
      FROM g GROUP BY ALL),
s AS (SELECT conv_id, turn, sum(least(c, r)) AS o, sum(c) AS c, sum(r) AS r FROM c GROUP BY ALL)
SELECT p.conv_id, p.turn, cast(coalesce(o, 0) AS bigint) AS overlap, cast(coalesce(c, 0) AS bigint) AS n_candidate,
       cast(coalesce(r, 0) AS bigint) AS n_reference,
       round(CASE WHEN o > 0 THEN 2 * o / (c + r) ELSE 0.0 END, 6) AS f
FROM p LEFT JOIN s ON p.conv_id = s.conv_id AND p.turn = s.turn
"""


@query("rouge_1", rouge_n_sql(1))
def rouge_1(spark, sf_dir):
    out = summaries.rouge_n(summary_pairs(spark, sf_dir), ["conv_id", "turn"], "candidate", "reference", 1)
    return out.withColumn("f", F.round("f", 6))


@query("rouge_2", rouge_n_sql(2))
def rouge_2(spark, sf_dir):
    out = summaries.rouge_n(summary_pairs(spark, sf_dir), ["conv_id", "turn"], "candidate", "reference", 2)
    return out.withColumn("f", F.round("f", 6))


@query(
    "length_compliance",
    r"""
WITH s AS (SELECT role, len(list_filter(regexp_split_to_array(text, '[.!?]+'),
             lambda p: length(regexp_replace(p, '^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$', '', 'g')) > 0)) AS n
           FROM conversations)
SELECT role, count(*) AS n, round(avg((n BETWEEN 2 AND 3)::int), 6) AS compliance,
       avg((n BETWEEN 2 AND 3)::int) >= 0.95 AS ok
FROM s GROUP BY role
""",
)
def length_compliance(spark, sf_dir):
    out = summaries.length_compliance(table(spark, sf_dir, "conversations"), "text", "role")
    return out.withColumn("compliance", F.round("compliance", 6))
