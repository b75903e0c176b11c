"""Token tables: counts per text, vocabularies, TF-IDF weights and out-of-vocabulary rates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import tokens
from tidemark.session import materialise, spread

# A vocabulary up to this many tokens (some tens of MB) is broadcast; a larger one is shuffled.
BROADCAST_TOKENS = 1_000_000

# Bytes of text whose (text, token) rows one task holds at a time; they take some ten times as much memory.
TASK_TEXT = 8_000_000


def text_tasks(df: DataFrame, text: str) -> int:
    """How many tasks the texts are cut into tokens by: by their bytes, so that a task's memory does not grow with them."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TASK_TEXT))


def token_counts(df: DataFrame, key: str, text: str, *keep: str, tasks: int | None = None) -> DataFrame:
    """One row per (text, token) with its count; the text itself is not carried along.

    Texts are partitioned by their key before they are cut into tokens, so the counts, and anything
    else per text, need no further shuffle. There are ``tasks`` partitions, if given (see ``text_tasks``).
    """
    texts = df.select(key, *keep, text)
    texts = texts.repartition(tasks, key) if tasks else texts.repartition(key)
    words = texts.select(key, *keep, F.explode(tokens(F.col(text))).alias("token"))
    return words.groupBy(key, *keep, "token").agg(F.count("*").alias("cnt"))


def vocabulary(df: DataFrame, text: str) -> DataFrame:
    """Distinct tokens of the training texts."""
    return spread(df.select(text)).select(F.explode(tokens(F.col(text))).alias("token")).distinct()


def frequent(counts: DataFrame, limit: int = BROADCAST_TOKENS, n: str = "n") -> DataFrame:
    """The rows of ``counts`` whose ``n`` is at least a power of two, the smallest that leaves ``limit`` rows or fewer.

    ``counts`` should be a written table. No row of the rest then occurs very often, so the rest can be shuffled.
    """
    sizes = counts.groupBy(F.floor(F.log2(n)).cast("int").alias("power")).count().collect()
    power, held = max((r["power"] for r in sizes), default=0) + 1, 0
    for r in sorted(sizes, key=lambda r: -r["power"]):
        held += r["count"]
        if held > limit:
            break
        power = r["power"]
    return counts.where(F.col(n) >= F.lit(2**power))


def _word(words: int) -> Column:
    """Where a token's bit is: its word of 64 slots, among ``words`` (a power of two); null without a token."""
    return F.when(F.col("token").isNotNull(), F.expr(f"xxhash64(token) & {words - 1}L"))


# The bit of a token within its word. It comes from other bits of the hash than the word.
SLOT = "shiftleft(1L, cast(shiftrightunsigned(xxhash64(token), 58) as int))"


def known_slots(counts: DataFrame, limit: int = BROADCAST_TOKENS, words: int | None = None) -> tuple[DataFrame, int]:
    """``_word, _yes, _no``: bits of the slots that known and that unknown tokens of ``counts`` hash to; and how many words.

    There are at least eight slots to a token while ``limit`` words hold them, unless ``words`` says how many words of 64
    there are. A token of ``counts`` in a slot of one kind is of that kind; only where both bits are set does the token
    itself have to be looked up.
    """
    if words is None:
        words = 2 ** min(math.ceil(math.log2(max(counts.count() / 8, 1))), int(math.log2(max(limit, 1))))
    bits = [F.bit_or(F.when(kind, F.expr(SLOT)).otherwise(F.lit(0).cast("bigint"))) for kind in (F.col("known"), F.col("known").isNull())]
    return counts.groupBy(_word(words).alias("_word")).agg(bits[0].alias("_yes"), bits[1].alias("_no")), words


def oov_rates(
    df: DataFrame, vocab: DataFrame, key: str, text: str, *keep: str, broadcast_limit: int = BROADCAST_TOKENS
) -> DataFrame:
    """Share of each text's tokens, with multiplicity, that the vocabulary lacks; 0 without tokens.

    ``vocab`` should be a written table (see ``materialise``), since its size is checked first. A
    small one is broadcast and the tokens are never shuffled, only the per-text sums are. Of a larger
    one hashed slots are broadcast (``known_slots``): a token whose slot has no known one is unknown and
    goes nowhere. Among the others the tokens that the vocabulary has are broadcast, if these are within
    the limit. If they are not, slots of both kinds are. They settle every token but those whose slot also
    has one of the other kind; of these the most frequent are broadcast, and the rare ones, if any are
    left, are shuffled. Every token is told by its slot or looked up, never guessed.
    """
    known = vocab.select("token", F.lit(True).alias("known"))
    words = spread(df.select(key, *keep, text)).select(key, *keep, F.explode_outer(tokens(F.col(text))).alias("token"))
    has_token = F.col("token").isNotNull()
    found = F.count_if("known")
    small = vocab.count() <= broadcast_limit
    if not small:
        slots, n_words = known_slots(known, broadcast_limit)
        slots = materialise(slots, "vocabulary_slots")
        placed = words.where(has_token).withColumn("_word", _word(n_words)).join(F.broadcast(slots), "_word")
        counts = placed.where(f"_yes & {SLOT} != 0").groupBy("token").agg(F.count("*").alias("n"))
        counts = materialise(counts.join(known, "token", "left"), "token_counts")
        known = counts.where("known").select("token", "known")
        small = known.count() <= broadcast_limit
    if small:
        sums = words.join(F.broadcast(known), "token", "left").groupBy(key, *keep).agg(
            found.alias("_known"), F.count_if(has_token).alias("n_tokens")
        )
    else:
        # As many words as before, so that a token without a known one in its slot has no bit of ``_yes`` here either.
        slots = materialise(known_slots(counts, words=n_words)[0], "known_slots")
        held = counts.withColumn("_word", _word(n_words)).join(F.broadcast(slots), "_word")
        unsure = materialise(held.where(f"_yes & _no & {SLOT} != 0").select("token", "n", "known"), "unsure_tokens")
        often = unsure if unsure.count() <= broadcast_limit else frequent(unsure, broadcast_limit)
        told = words.withColumn("_word", _word(n_words)).join(F.broadcast(slots), "_word", "left").select(
            key, *keep, "token", F.expr(f"_yes & ~_no & {SLOT} != 0").alias("_sure"),
            F.expr(f"if(_yes & _no & {SLOT} != 0, token, null)").alias("_unsure"),
        )
        looked = F.broadcast(often.select(F.col("token").alias("_unsure"), "known", F.lit(True).alias("_often")))
        marked = told.join(looked, "_unsure", "left")
        sums = marked.groupBy(key, *keep).agg(
            F.count_if(F.col("_sure") | F.col("known")).alias("_known"), F.count_if(has_token).alias("n_tokens")
        )
        if often is not unsure:
            # Rare tokens that the vocabulary lacks count as tokens already; the known ones are looked up.
            rare = marked.where(F.col("_unsure").isNotNull() & F.col("_often").isNull()).select(key, *keep, "token").join(
                unsure.where("known").join(often.select("token"), "token", "left_anti").select("token"), "token"
            )
            sides = sums.unionByName(
                rare.groupBy(key, *keep).agg(F.count("*").alias("_known")).withColumn("n_tokens", F.lit(0))
            )
            sums = sides.groupBy(key, *keep).agg(F.sum("_known").alias("_known"), F.sum("n_tokens").alias("n_tokens"))
    return (
        sums.withColumn("oov_tokens", F.col("n_tokens") - F.col("_known"))
        .select(key, *keep, "oov_tokens", "n_tokens")
        .withColumn(
            "oov_rate",
            F.when(F.col("n_tokens") > 0, F.col("oov_tokens") / F.col("n_tokens")).otherwise(F.lit(0.0)),
        )
    )


def document_frequency(df: DataFrame, text: str) -> DataFrame:
    """Per token: number of texts that hold it and the smoothed inverse frequency.

    A text's tokens are made distinct within its row, so only partial counts per token are shuffled.
    """
    n_texts = df.agg(F.count("*"))
    held = spread(df.select(text)).select(F.explode(F.array_distinct(tokens(F.col(text)))).alias("token"))
    counts = held.groupBy("token").agg(F.count("*").alias("df")).withColumn("_n", n_texts.scalar())
    return counts.withColumn("idf", F.ln((F.col("_n") + 1) / (F.col("df") + 1)) + 1).drop("_n")


def weighted_tokens(
    df: DataFrame, key: str, text: str, frequency: DataFrame, broadcast_limit: int = BROADCAST_TOKENS
) -> DataFrame:
    """``key, token, cnt, df, idf, weight``: tf * idf scaled to unit length per text, over the tokens in ``frequency``.

    ``frequency`` should be a written table, since its size is checked first. A small one is broadcast: the texts are
    shuffled once, by key, and counts, weights and the norm keep that partitioning. Of a larger one the tokens of most
    texts are broadcast, up to the limit, and only the rows of rare tokens go to their token and back to their text.
    """
    tasks = text_tasks(df, text)
    counts = token_counts(df, key, text, tasks=tasks)
    if frequency.count() <= broadcast_limit:
        held = counts.join(F.broadcast(frequency), "token")
    else:
        often = frequent(frequency, broadcast_limit, "df")
        names = often.select("token")
        rare = counts.join(F.broadcast(names), "token", "left_anti").join(frequency.join(names, "token", "left_anti"), "token")
        held = counts.join(F.broadcast(often), "token").unionByName(rare.repartition(tasks, key))
    weighted = held.withColumn("raw", F.col("cnt") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return weighted.withColumn("weight", F.col("raw") / norm).drop("raw")


def tfidf(df: DataFrame, key: str, text: str) -> DataFrame:
    """Weights tf * idf scaled to unit length per text, with the frequencies of the same texts."""
    return weighted_tokens(df, key, text, materialise(document_frequency(df, text), "document_frequency"))
