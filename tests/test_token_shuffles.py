import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import tokens

LIMITS = (0, 20, 10_000)


@pytest.fixture(scope="module")
def texts(spark):
    """Frequent and rare words, a null and a blank text, a null key, and a key that comes twice."""
    rng = random.Random(3)
    rows = [(i // 2 if i < 4 else i, " ".join(f"w{int(rng.paretovariate(0.6)) % 900}" for _ in range(60))) for i in range(80)]
    return spark.createDataFrame([*rows, (900, None), (901, "! ?"), (None, "w1 w2 w1")], "k long, text string").repartition(5).persist()


def test_rates_are_the_same_whatever_is_broadcast(spark, texts, rows):
    vocab = spark.createDataFrame([(f"w{i}",) for i in range(1, 400, 2)], "token string")
    got = [rows(tokens.oov_rates(texts, vocab, "k", "text", broadcast_limit=limit)) for limit in LIMITS]
    assert len(got[0]) == 81 and got[0] == got[1] == got[2]
    assert sum(r[1] for r in got[0]) == sum(
        int(w[1:]) % 2 == 0 or int(w[1:]) >= 400
        for r in texts.where("text is not null").collect() for w in r["text"].split() if len(w) > 1 and w[0] == "w"
    )


def test_weights_are_the_same_whatever_is_broadcast(texts, rows):
    frequency = tokens.document_frequency(texts, "text")
    parts = [
        tokens.weighted_tokens(texts, "k", "text", frequency, limit).withColumn("weight", F.round("weight", 9)).select(
            "k", "token", "cnt", "df", "weight"
        )
        for limit in LIMITS
    ]
    got = [rows(p) for p in parts]
    assert got[0] and got[0] == got[1] == got[2]


def test_frequent_rows_fit_the_limit_and_leave_no_larger_one(spark):
    counts = spark.range(1, 1001).selectExpr("id as token", "cast(1000 / id as bigint) as n")
    for limit in (0, 1, 7, 100, 1000):
        often = tokens.frequent(counts, limit)
        assert often.count() <= limit
        least = often.agg(F.min("n")).first()[0]
        assert least is None or counts.join(often, "token", "left_anti").where(F.col("n") >= least).count() == 0
    assert tokens.frequent(counts, 1000).count() == 1000


def test_only_rare_tokens_are_shuffled_for_rates(spark, texts):
    """The tokens of the texts meet a broadcast table first; a shuffle of them all would leave no such join."""
    vocab = spark.createDataFrame([(f"w{i}",) for i in range(1, 400)], "token string")
    plan = tokens.oov_rates(texts, vocab, "k", "text", broadcast_limit=20)._jdf.queryExecution().toString()
    assert "rightHint=(strategy=broadcast)" in plan or "BroadcastHashJoin" in plan


def test_a_vocabulary_beyond_the_limit_moves_no_text_tokens_if_the_part_the_texts_hold_is_within_it(spark, texts, rows):
    """The rows of the texts go to no token: they meet a broadcast table, and only their sums are shuffled."""
    held = [f"w{i}" for i in range(1, 400)]
    vocab = spark.createDataFrame([(t,) for t in [*held, *(f"x{i}" for i in range(2000))]], "token string")
    got = tokens.oov_rates(texts, vocab, "k", "text", broadcast_limit=1000)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "rightHint=(strategy=broadcast)" in plan
    assert rows(got) == rows(tokens.oov_rates(texts, vocab, "k", "text", broadcast_limit=10_000))
    assert rows(got) == rows(tokens.oov_rates(texts, vocab, "k", "text", broadcast_limit=0))


def test_slots_settle_most_tokens_and_the_others_are_looked_up(spark, rows):
    """Known and unknown tokens beyond the limit: no row of the texts goes to its token, whichever are unsure."""
    texts = spark.range(300).selectExpr(
        "id as k", "concat_ws(' ', transform(sequence(0, 39), i -> concat('w', cast((id * 17 + i * i) % 3000 as string)))) as text"
    )
    vocab = spark.range(0, 3000, 2).selectExpr("concat('w', id) as token")
    got = tokens.oov_rates(texts, vocab, "k", "text", broadcast_limit=1000)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == plan.count("rightHint=(strategy=broadcast)") == 2
    want = [(k, sum((k * 17 + i * i) % 3000 % 2 for i in range(40)), 40) for k in range(300)]
    assert [r[:3] for r in rows(got)] == sorted(want, key=repr)
    # Fewer slots than tokens leave unsure ones beyond the limit, which are shuffled.
    assert rows(tokens.oov_rates(texts, vocab, "k", "text", broadcast_limit=40)) == rows(got)
    counts = vocab.selectExpr("token", "true as known").unionByName(spark.range(5000).selectExpr("concat('x', id) as token", "cast(null as boolean) as known"))
    slots, n_words = tokens.known_slots(counts, 1_000_000)
    told = counts.withColumn("_word", tokens._word(n_words)).join(slots, "_word")
    assert told.where(f"(_yes & {tokens.SLOT} != 0) != coalesce(known, false) and _yes & _no & {tokens.SLOT} = 0").count() == 0
    assert 0 < told.where(f"_yes & _no & {tokens.SLOT} != 0").count() < 2000


def test_a_task_holds_the_tokens_of_so_many_bytes_of_text(texts, monkeypatch):
    """Partitions follow the bytes of the texts, and a union of frequent and rare tokens keeps them without a further shuffle."""
    monkeypatch.setattr(tokens, "TASK_TEXT", 500)
    size = sum(len(r["text"] or "") for r in texts.collect())
    frequency = tokens.document_frequency(texts, "text").persist()
    for limit in LIMITS:
        got = tokens.weighted_tokens(texts, "k", "text", frequency, limit)
        assert got.rdd.getNumPartitions() == -(-size // 500) > 8
        assert got.count() > 0


def test_tokens_without_a_known_one_in_their_slot_are_not_shuffled(spark, rows, monkeypatch):
    """Of many unknown tokens only those that share a slot with the vocabulary are grouped at all."""
    written = {}

    def kept(df, name):
        df = df.persist()
        written[name] = df.count()
        return df

    monkeypatch.setattr(tokens, "materialise", kept)
    texts = spark.range(200).selectExpr(
        "id as k", "concat_ws(' ', concat('w', id * 3), concat_ws(' ', transform(sequence(1, 50), i -> concat('x', id * 50 + i)))) as text"
    )
    vocab = spark.range(3000).selectExpr("concat('w', id) as token")
    want = [(k, 50, 51) for k in range(200)]
    for limit in (2000, 1000, 150):
        written.clear()
        assert [r[:3] for r in rows(tokens.oov_rates(texts, vocab, "k", "text", broadcast_limit=limit))] == sorted(want, key=repr)
        assert 200 <= written["token_counts"] < (200 + 10_000) / (2 if limit > 150 else 1)
