"""Ingest, validation and batch-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import map_values, parse_label
from tidemark.operators import corrupt, pool, validate
from tidemark.plans.drift import bucketed_documents
from tidemark.plans.registry import query, table
from tidemark.schemas import labelled_text
from tidemark.sources import readers

BUCKET = "cast(concat('0x', substr(md5(concat('{seed}:', doc_id)), 1, 8)) AS bigint) % 1000"
B42 = BUCKET.format(seed=42)
B13 = BUCKET.format(seed=13)

LANGS3 = labelled_text("langs3", ["en", "de", "fr"])
LANGS4 = labelled_text("langs4", ["en", "de", "fr", "es"])

EVENT_LABELS = {"purchase": "bullish", "error": "bearish", "view": "neutral", "click": "neutral"}


@query(
    "label_map",
    """
SELECT event_id, event_type,
       CASE event_type WHEN 'purchase' THEN 'bullish' WHEN 'error' THEN 'bearish'
                       WHEN 'view' THEN 'neutral' WHEN 'click' THEN 'neutral' END AS label
FROM events
""",
)
def label_map(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return events.withColumn("label", map_values(F.col("event_type"), EVENT_LABELS))


@query(
    "ingest_feed",
    """
WITH k AS (SELECT event_id, event_type, cast(json_extract(props, '$.k') AS integer) AS k FROM events),
w AS (SELECT *, list_extract(['Bullish', 'Somewhat-Bullish', 'Neutral', 'Somewhat-Bearish', 'Bearish', 'Unknown'],
                             k % 6 + 1) AS word FROM k WHERE k % 7 <> 0)
SELECT concat(event_type, ' ', event_id) AS text,
       CASE WHEN word IN ('Bullish', 'Somewhat-Bullish') THEN 'bullish' WHEN word = 'Neutral' THEN 'neutral'
            WHEN word IN ('Bearish', 'Somewhat-Bearish') THEN 'bearish' END AS label
FROM w
""",
)
def ingest_feed(spark, sf_dir):
    """Every event becomes a JSON page; pages without a feed give no rows."""
    words = F.array(*[F.lit(w) for w in [*readers.FEED_LABELS, "Unknown"]])
    k = F.get_json_object("props", "$.k").cast("int")
    article = F.struct(
        F.concat_ws(" ", "event_type", "event_id").alias("title"),
        F.get(words, k % 6).alias("overall_sentiment_label"),
    )
    page = F.when(k % 7 != 0, F.to_json(F.struct(F.array(article).alias("feed")))).otherwise(
        F.lit('{"note": "limit reached"}')
    )
    pages = table(spark, sf_dir, "events").select(F.from_json(page, readers.FEED_SCHEMA).alias("p"))
    return readers.articles(pages.select("p.feed"))


def lang_batch(spark, sf_dir):
    """Documents as a labelled batch in which very short texts count as missing."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.when(F.col("n_chars") >= 50, F.col("text")).alias("text"),
                       F.col("lang").alias("label"))


BATCH = "WITH d AS (SELECT doc_id, CASE WHEN n_chars >= 50 THEN text END AS text, lang AS label FROM documents)\n"


@query(
    "validate_v1",
    BATCH
    + """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE text IS NULL) AS text_null,
       count(*) FILTER (WHERE label IS NULL) AS label_null,
       count(*) FILTER (WHERE label NOT IN ('en', 'de', 'fr')) AS label_vocabulary
FROM d
""",
)
def validate_v1(spark, sf_dir):
    return validate.breach_counts(lang_batch(spark, sf_dir), LANGS3)


@query(
    "quarantine_rows",
    BATCH
    + """
SELECT doc_id, concat_ws(',', CASE WHEN text IS NULL THEN 'text_null' END,
                         CASE WHEN label NOT IN ('en', 'de', 'fr') THEN 'label_vocabulary' END) AS breaches
FROM d WHERE text IS NULL OR label NOT IN ('en', 'de', 'fr')
""",
)
def quarantine_rows(spark, sf_dir):
    _, broken = validate.split_batch(lang_batch(spark, sf_dir), LANGS3)
    return broken.select("doc_id", F.array_join("breaches", ",").alias("breaches"))


@query(
    "null_fractions",
    """
WITH d AS (SELECT text, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'text' AS column_name, round(avg((text IS NULL)::int), 6) AS null_fraction, avg((text IS NULL)::int) = 0 AS ok FROM d
UNION ALL SELECT 'quality', round(avg((quality IS NULL)::int), 6), avg((quality IS NULL)::int) < 0.01 FROM d
UNION ALL SELECT 'toxic', round(avg((toxic IS NULL)::int), 6), avg((toxic IS NULL)::int) < 0.01 FROM d
""",
)
def null_fractions(spark, sf_dir):
    both = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    out = validate.null_fractions(both, ["text", "quality", "toxic"])
    return out.withColumn("null_fraction", F.round("null_fraction", 6))


@query(
    "duplicate_rate",
    """
SELECT count(*) AS n_rows, count(DISTINCT text) AS n_distinct,
       round((count(*) - count(DISTINCT text)) / count(*), 6) AS duplicate_rate,
       (count(*) - count(DISTINCT text)) / count(*) >= 0.005 AS dedupe
FROM documents
""",
)
def duplicate_rate(spark, sf_dir):
    out = validate.duplicate_rate(table(spark, sf_dir, "documents"), ["text"])
    return out.withColumn("duplicate_rate", F.round("duplicate_rate", 6))


@query(
    "length_filter",
    """
SELECT lang, count(*) FILTER (WHERE length(text) BETWEEN 10 AND 2000) AS n_kept,
       count(*) FILTER (WHERE NOT length(text) BETWEEN 10 AND 2000) AS n_dropped,
       round(avg((NOT length(text) BETWEEN 10 AND 2000)::int), 6) AS drop_rate,
       avg((NOT length(text) BETWEEN 10 AND 2000)::int) > 0.02 AS warn
FROM documents GROUP BY lang
""",
)
def length_filter(spark, sf_dir):
    out = validate.length_report(table(spark, sf_dir, "documents"), "text", "lang")
    return out.withColumn("drop_rate", F.round("drop_rate", 6))


@query(
    "volume_band",
    """
WITH d AS (SELECT event_type, ts::date AS day, count(*) AS n_rows FROM events GROUP BY ALL),
m AS (SELECT *, avg(n_rows) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS t
      FROM d)
SELECT event_type, strftime(day, '%Y-%m-%d') AS day, n_rows, round(t, 6) AS trailing_mean,
       coalesce(abs(n_rows - t) > 0.5 * t, false) AS alert
FROM m
""",
)
def volume_band(spark, sf_dir):
    out = validate.volume_band(table(spark, sf_dir, "events"), "event_type", "ts")
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd")).withColumn(
        "trailing_mean", F.round("trailing_mean", 6)
    )


@query(
    "class_balance",
    """
SELECT lang, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share,
       count(*) / sum(count(*)) OVER () < 0.1 AS warn
FROM documents GROUP BY lang
""",
)
def class_balance(spark, sf_dir):
    out = validate.class_balance(table(spark, sf_dir, "documents"), "lang")
    return out.withColumn("share", F.round("share", 6))


@query(
    "freshness",
    """
SELECT user_id, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS newest,
       cast(floor(epoch((SELECT max(ts) FROM events))) - floor(epoch(max(ts))) AS bigint) AS age_seconds,
       floor(epoch((SELECT max(ts) FROM events))) - floor(epoch(max(ts))) > 21600 AS stale
FROM events GROUP BY user_id
""",
)
def freshness(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    now = events.agg(F.max("ts")).scalar()
    out = validate.freshness(events, "user_id", "ts", now, 6 * 3600)
    return out.withColumn("newest", F.date_format("newest", "yyyy-MM-dd'T'HH:mm:ss"))


@query(
    "encoding_check",
    """
SELECT lang, count(*) AS n_rows, cast(0 AS bigint) AS n_invalid,
       count(*) FILTER (WHERE contains(text, chr(65533))) AS n_replaced
FROM documents GROUP BY lang
""",
)
def encoding_check(spark, sf_dir):
    return validate.encoding_report(table(spark, sf_dir, "documents"), "text", "lang")


@query(
    "encoding_quarantine",
    """
WITH d AS (SELECT doc_id, text, doc_id % 7 = 3 AS cut FROM documents),
m AS (SELECT doc_id, text IS NULL AS missing, cut OR coalesce(contains(text, chr(65533)), false) AS broken FROM d)
SELECT doc_id, CASE WHEN missing THEN 'text_null' ELSE 'text_encoding' END AS breaches FROM m WHERE missing OR broken
""",
)
def encoding_quarantine(spark, sf_dir):
    """Every seventh text ends in the middle of a character; what is no UTF-8 goes to quarantine."""
    whole = F.col("text").cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 7 == 3, F.concat(whole, F.lit(b"\xe2\x82")).cast("string")).otherwise(F.col("text")).alias("text"),
        F.col("lang").alias("label"),
    )
    _, broken = validate.split_batch(docs, labelled_text("langs4_utf8", ["en", "de", "fr", "es"], ("text",)))
    return broken.select("doc_id", F.array_join("breaches", ",").alias("breaches"))


@query(
    "corrupt_then_validate",
    f"""
WITH d AS (SELECT doc_id, text, lang AS label, {B13} AS b, doc_id = (SELECT min(doc_id) FROM documents) AS first
           FROM documents),
f AS (
  SELECT 'label_first' AS fault, text, CASE WHEN first THEN 'garbage' ELSE label END AS label FROM d
  UNION ALL SELECT 'label_some', text, CASE WHEN b < 20 THEN 'garbage' ELSE label END FROM d
  UNION ALL SELECT 'text_first', CASE WHEN NOT first THEN text END, label FROM d
  UNION ALL SELECT 'text_some', CASE WHEN NOT b < 20 THEN text END, label FROM d)
SELECT fault, count(*) AS n_rows, count(*) FILTER (WHERE text IS NULL) AS text_null,
       count(*) FILTER (WHERE label IS NULL) AS label_null,
       count(*) FILTER (WHERE label NOT IN ('en', 'de', 'fr', 'es')) AS label_vocabulary
FROM f GROUP BY fault
""",
)
def corrupt_then_validate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("label"))
    first, some = corrupt.first_row(docs, "doc_id"), corrupt.some_rows("doc_id", 20)
    faults = {
        "label_first": corrupt.corrupt_label(docs, first),
        "label_some": corrupt.corrupt_label(docs, some),
        "text_first": corrupt.corrupt_null_text(docs, first),
        "text_some": corrupt.corrupt_null_text(docs, some),
    }
    counts = [
        validate.breach_counts(df, LANGS4).select(F.lit(name).alias("fault"), "*") for name, df in faults.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


WORDS = ["the", "is", "ein", "la", "que"]


@query(
    "parse_label",
    r"""
WITH c AS (SELECT conv_id, turn,
                  lower(regexp_replace(text, '^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$', '', 'g')) AS t FROM conversations)
SELECT conv_id, turn, CASE WHEN starts_with(t, 'the') THEN 'the' WHEN starts_with(t, 'is') THEN 'is'
                           WHEN starts_with(t, 'ein') THEN 'ein' WHEN starts_with(t, 'la') THEN 'la'
                           WHEN starts_with(t, 'que') THEN 'que' ELSE 'unknown' END AS label
FROM c
""",
)
def parse_labels(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", parse_label(F.col("text"), WORDS).alias("label"))


@query(
    "pair_orphans",
    """
SELECT doc_id, 'right' AS missing FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'left' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
""",
)
def pair_orphans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return readers.pair_by_key(docs, table(spark, sf_dir, "labels").select("doc_id"), ["doc_id"])[1]


@query("headline_pool", "SELECT sha256(text) AS text_hash, min(doc_id) AS doc_id FROM documents GROUP BY text")
def headline_pool(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    pulls = [docs.where("lang = 'en'"), docs.where("lang <> 'en'")]
    return pool.pool_texts(pulls, spark, "doc_id").select("text_hash", "doc_id")


@query(
    "incremental_pool",
    f"""
WITH d AS (SELECT doc_id, text, {B42} AS b FROM documents)
SELECT sha256(text) AS text_hash, min(doc_id) AS doc_id FROM d
WHERE b >= 500 AND text NOT IN (SELECT text FROM d WHERE b < 500) GROUP BY text
""",
)
def incremental_pool(spark, sf_dir):
    docs = bucketed_documents(spark, sf_dir)
    stored = pool.pool_texts([docs.where("b < 500")], spark, "doc_id")
    fresh = pool.pool_texts([docs.where("b >= 500")], spark, "doc_id")
    return pool.new_texts(fresh, stored).select("text_hash", "doc_id")


@query(
    "time_windows",
    """
WITH e AS (SELECT max(ts) AS now FROM events),
w AS (SELECT i AS idx, now - to_days(cast(i + 1 AS integer)) AS a, now - to_days(cast(i AS integer)) AS b
      FROM e, range(25) t(i))
SELECT idx, strftime(a, '%Y%m%dT%H%M') AS time_from, strftime(b, '%Y%m%dT%H%M') AS time_to,
       (SELECT count(*) FROM events WHERE ts > a AND ts <= b) AS n_events
FROM w
""",
)
def time_windows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    end = events.agg(F.max("ts")).scalar()
    counts = (
        events.select(pool.window_index(F.col("ts"), end, 25, 1).alias("idx"))
        .groupBy("idx").agg(F.count("*").alias("n_events"))
    )
    windows = pool.time_windows(spark, end, 25, 1)
    return windows.join(counts, "idx", "left").withColumn("n_events", F.coalesce("n_events", F.lit(0)))


@query("dataset_manifest")
def dataset_manifest(spark, sf_dir):
    return readers.dataset_manifest(spark, sf_dir)
