import hashlib
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scores import psi_from_counts, unit_bin
from tidemark.functions.stem import stem
from tidemark.functions.text import parse_label, tokens
from tidemark.operators import blocked, chat, drift, metrics, ranks, serving, summaries
from tidemark.operators import tokens as token_ops
from tidemark.operators.fingerprint import table_fingerprint
from tidemark.operators.split import class_weights, stratified_split


def numbers(spark, values, name="v"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


def test_bins_follow_double_edges(spark):
    got = {r["v"]: r["b"] for r in numbers(spark, [0, 0.1, 0.3, 0.6, 0.7, 0.95, 1.0, 1.2, -0.1])
           .select("v", unit_bin(F.col("v")).alias("b")).collect()}
    assert got == {0.0: 0, 0.1: 1, 0.3: 2, 0.6: 5, 0.7: 6, 0.95: 9, 1.0: 9, 1.2: None, -0.1: None}


def test_psi_matches_a_hand_computation_and_empty_side_is_null(spark):
    r, c = [5, 5, 0], [1, 8, 1]
    want = sum(
        (max(y / 10, 1e-6) - max(x / 10, 1e-6)) * math.log(max(y / 10, 1e-6) / max(x / 10, 1e-6)) for x, y in zip(r, c)
    )
    lit = lambda xs: F.array(*[F.lit(x) for x in xs])
    got = spark.range(1).select(psi_from_counts(lit(r), lit(c)).alias("p"), psi_from_counts(lit([0, 0, 0]), lit(c)).alias("e"))
    row = got.first()
    assert row["p"] == pytest.approx(want) and row["e"] is None


def test_tokens_and_oov_on_both_paths(spark):
    df = spark.createDataFrame(
        [(1, "The Fed, the Fed: QT x 10y"), (2, "! ? x"), (3, None), (4, "naïve café_9")], "k int, text string"
    )
    got = {r["k"]: r["t"] for r in df.select("k", tokens(F.col("text")).alias("t")).collect()}
    assert got == {1: ["the", "fed", "the", "fed", "qt", "10y"], 2: [], 3: [], 4: ["naïve", "café_9"]}
    vocab = spark.createDataFrame([("the",), ("fed",)], "token string")
    for limit in (0, 10):
        rates = {r["k"]: r["oov_rate"] for r in token_ops.oov_rates(df, vocab, "k", "text", broadcast_limit=limit).collect()}
        assert rates == {1: pytest.approx(2 / 6), 2: 0.0, 3: 0.0, 4: 1.0}


def test_tfidf_matches_the_definition(spark):
    texts = ["up up down", "down flat", "flat flat flat rise"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {(r["k"], r["token"]): r["weight"] for r in token_ops.tfidf(df, "k", "text").collect()}
    bags = [t.split() for t in texts]
    for k, bag in enumerate(bags):
        raw = {w: bag.count(w) * (math.log(4 / (1 + sum(w in b for b in bags))) + 1) for w in set(bag)}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        for w, x in raw.items():
            assert got.pop((k, w)) == pytest.approx(x / norm)
    assert not got


def test_ks_against_brute_force(spark):
    rng = random.Random(1)
    a = [round(rng.random(), 2) for _ in range(300)]
    b = [round(rng.random() ** 1.3, 2) for _ in range(200)]
    df = spark.createDataFrame([(x, True) for x in a] + [(x, False) for x in b], "v double, is_ref boolean")
    got = drift.ks_two_sample(df.repartition(5), "v", "is_ref").first()
    want = max(abs(sum(x <= t for x in a) / 300 - sum(x <= t for x in b) / 200) for t in a + b)
    lam = want * math.sqrt(300 * 200 / 500)
    p = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert got["ks"] == pytest.approx(want) and got["ks_p"] == pytest.approx(p)
    assert (got["n_ref"], got["n_cur"]) == (300, 200)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 200, 3000])
@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_percentiles_and_median_are_exact(spark, n, accuracy):
    rng = random.Random(n)
    values = [round(rng.expovariate(1), 2) for _ in range(n)]
    df = numbers(spark, values).withColumn("g", F.lit("x")).repartition(4)
    targets = {k: ranks.floor_rank(p) for k, p in serving.PERCENTILES.items()}
    got = ranks.exact_ranks(df, ["g"], "v", targets, accuracy).first()
    ordered = sorted(values)
    for k, p in serving.PERCENTILES.items():
        assert got[k] == ordered[int(p * (n - 1))]
    assert ranks.exact_median(df, ["g"], "v").first()["median"] == pytest.approx(statistics.median(values))


def test_blocked_windows_equal_plain_ones(spark):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.8 else "cold", i, rng.randrange(100)) for i in range(500)]
    df = spark.createDataFrame(data, "k string, t int, v int").withColumn("b", F.expr("t div 37"))
    got = blocked.running(
        df, ["k"], ["t"], "b", sums={"s": F.col("v"), "i": F.lit(1)}, maxima={"m": F.col("v")}
    )
    seen: dict = {}
    want = {}
    for k, t, v in sorted(data, key=lambda r: r[1]):
        old = seen.setdefault(k, [])
        want[k, t] = (max(old) if old else None, sum(old) + v, len(old) + 1)
        old.append(v)
    assert {(r["k"], r["t"]): (r["m"], r["s"], r["i"]) for r in got.collect()} == want


def test_split_quotas_and_independence_from_partitions(spark, rows):
    data = [(i, "abc"[(i % 10 > 5) + (i % 10 > 8)]) for i in range(1000)] + [(5000, "lonely")]
    df = spark.createDataFrame(data, "k int, label string")
    first = rows(stratified_split(df, "k", "label"))
    for parts in (1, 17):
        shuffled = df.orderBy(F.md5(F.col("k").cast("string"))).repartition(parts)
        assert rows(stratified_split(shuffled, "k", "label")) == first
    by_class: dict = {}
    for k, label in data:
        by_class.setdefault(label, []).append(k)
    want = {}
    for label, keys in by_class.items():
        keys.sort(key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())
        holdout = -(-3 * len(keys) // 10)
        test = -(-holdout // 2)
        for i, k in enumerate(keys):
            want[k] = "test" if i < test else "val" if i < holdout else "train"
    assert {k: s for k, _, s in first} == want


def test_fingerprint_ignores_order_but_not_content(spark):
    data = [("a", "x"), ("a", "x"), ("b", None), ("", "y")]
    df = spark.createDataFrame(data, "text string, label string")
    base = table_fingerprint(df).first()
    assert base["n_rows"] == 4
    assert table_fingerprint(df.repartition(7).orderBy("label")).first() == base
    for other in ([("a", "x"), ("b", None), ("", "y")], [("a", "x"), ("a", "x"), ("b", ""), ("", "y")],
                  [("ax", ""), ("a", "x"), ("b", None), ("", "y")]):
        assert table_fingerprint(spark.createDataFrame(other, df.schema)).first()["digest"] != base["digest"]


def test_f1_with_unknown_and_absent_classes(spark):
    data = [("bullish", "bullish"), ("bullish", "unknown"), ("bearish", "bearish"), ("neutral", "bearish")]
    matrix = metrics.confusion_matrix(spark.createDataFrame(data, "g string, p string"), "g", "p")
    f1 = {"bullish": 2 / 3, "bearish": 2 / 3, "neutral": 0.0, "unknown": 0.0}
    assert metrics.macro_f1(matrix).first()["macro_f1"] == pytest.approx(sum(f1.values()) / 4)
    labels = ["bullish", "bearish", "neutral"]
    assert metrics.macro_f1(matrix, labels=labels).first()["macro_f1"] == pytest.approx(4 / 9)
    only = metrics.class_report(matrix, labels=["bullish", "absent"])
    assert {r["label"]: r["support"] for r in only.collect()} == {"bullish": 2, "absent": 0}


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "label string")
    assert {r["label"]: r["weight"] for r in class_weights(df, "label").collect()} == {"a": 4 / 6, "b": 2.0}


def test_parse_label(spark):
    answers = {" Bullish\n": "bullish", "bearish outlook": "bearish", "NEUTRAL": "neutral", "very bullish": "unknown", "": "unknown"}
    df = spark.createDataFrame([(a,) for a in answers], "a string")
    got = dict(df.select("a", parse_label(F.col("a"), ["bullish", "bearish", "neutral"])).collect())
    assert got == answers


def brute_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_lcs_against_brute_force():
    rng = random.Random(7)
    for _ in range(200):
        a = [rng.choice("abcd") for _ in range(rng.randrange(90))]
        b = [rng.choice("abcde") for _ in range(rng.randrange(90))]
        assert summaries.lcs_length(a, b) == brute_lcs(a, b)


def test_rouge_on_pairs(spark):
    pairs = spark.createDataFrame(
        [(1, "the cat sat", "the cat was sitting"), (2, "", "words"), (3, "caresses ponies", "caress pony")],
        "k int, c string, r string",
    )
    plain = {r["k"]: r["f"] for r in summaries.rouge_l(pairs, "c", "r", "f", use_stemmer=False).collect()}
    assert plain == {1: pytest.approx(4 / 7), 2: 0.0, 3: 0.0}
    stems = {r["k"]: r["f"] for r in summaries.rouge_l(pairs, "c", "r", "f").collect()}
    assert stems[3] == pytest.approx(1.0)
    two = {r["k"]: (r["overlap"], r["f"]) for r in summaries.rouge_n(pairs, ["k"], "c", "r", 2).collect()}
    assert two == {1: (1, pytest.approx(0.4)), 2: (0, 0.0), 3: (0, 0.0)}


# Examples from the published description of the algorithm.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
    "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc",
    "digitizer": "digit", "radicalli": "radic", "vietnamization": "vietnam", "predication": "predic",
    "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "formaliti": "formal",
    "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "formalize": "formal",
    "electrical": "electr", "hopeful": "hope", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "inference": "infer", "airliner": "airlin", "adjustable": "adjust", "replacement": "replac",
    "adoption": "adopt", "communism": "commun", "activate": "activ", "effective": "effect", "probate": "probat",
    "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
}


def test_stems():
    assert {w: stem(w) for w in STEMS} == STEMS


def test_chat_round_trip(spark):
    df = spark.createDataFrame([("Profits rose", "bullish")], "text string, label string")
    m = chat.messages(F.col("text"), "classify", F.col("label"))
    row = df.select(m.alias("m"), chat.messages(F.col("text"), "classify").alias("q")).first()
    assert [t["role"] for t in row["m"]] == ["system", "user", "assistant"] and len(row["q"]) == 2
    assert row["m"][1]["content"].endswith("\n\nStatement: Profits rose")
    back = df.select(chat.prompt_text(m, "classify").alias("t"), chat.gold_answer(m).alias("g")).first()
    assert tuple(back) == ("Profits rose", "bullish")


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.65, True, False), (0.70, False, True)], "c double, a boolean, b boolean")
    got = {round(r["threshold"], 2): (r["n_escalated"], r["accuracy"])
           for r in metrics.threshold_sweep(df, F.col("c"), F.col("a"), F.col("b")).collect()}
    assert got[0.65] == (0, 0.5) and got[0.7] == (1, 0.0) and got[0.75] == (2, 0.5)


def test_null_groups_are_groups(spark):
    rows = [(None if i % 4 == 0 else "g", float(i % 37) / 37, i % 3 == 0, i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, v double, ref boolean, id int")
    own = [r[1] for r in rows if r[0] is None]
    low = {r.g: r for r in ranks.exact_ranks(df, ["g"], "v", {"p": ranks.floor_rank(0.5)}).collect()}
    assert low[None].n == len(own) and low[None].p == sorted(own)[(len(own) - 1) // 2]
    report = {r.g: r for r in drift.drift_report(df, "v", "ref", "g").collect()}
    assert report[None].n_ref + report[None].n_cur == len(own) and set(report) == {None, "g"}
    split_rows = stratified_split(df, "id", "g").collect()
    assert len(split_rows) == len(rows)
    assert sum(r.split != "train" for r in split_rows if r.g is None) == -(-30 * len(own) // 100)
