import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gate, lineage, registry, routing
from tidemark.operators.scorers import BatchScorer, RuleScorer
from tidemark.plans.heal_loop import heal

CONFIG = "model string, expected_hash string, expected_schema string, margin double, floor double, metric_label string"
NOW = "cast('2026-01-01' as timestamp)"


def config(spark, margin=0.01):
    return spark.createDataFrame(
        [("m", "h", "v1", margin, 0.40, "F1"), ("nohash", None, "v1", 0.01, 0.40, "F1")], CONFIG
    )


def tags(spark, versions):
    """``versions``: (model, version, score, hash, schema)."""
    rows = []
    for i, (m, v, score, digest, schema) in enumerate(versions):
        for k, x in (("test_f1", score), ("eval_set_hash", digest), ("schema_version", schema)):
            if x is not None:
                rows.append((m, v, k, str(x), i))
    df = spark.createDataFrame(rows, "model string, version string, key string, value string, seq bigint")
    return df.select("model", "version", "key", "value", F.expr(NOW).alias("ts"), "seq")


def requests(spark, items):
    rows = [(m, v, who, i) for i, (m, v, who) in enumerate(items)]
    df = spark.createDataFrame(rows, "model string, version string, approved_by string, seq bigint")
    ts = F.expr(NOW) + F.make_dt_interval(mins=F.col("seq").cast("int") * 25)
    return df.select("model", "version", "approved_by", ts.alias("ts"), "seq")


def decide(spark, versions, items, incumbents=None, **kw):
    out = gate.gate_sequence(requests(spark, items), config(spark), tags(spark, versions), incumbents, **kw)
    return [(r["decision"], r["status"], r["reason"], r["previous_production"]) for r in out.orderBy("seq").collect()]


def test_gate_order_and_reasons(spark):
    versions = [
        ("m", "1", 0.9, "other", "v1"), ("m", "2", 0.9, "h", "v2"), ("m", "3", 0.39, "h", "v1"),
        ("m", "4", 0.40, "h", "v1"), ("m", "5", None, "h", "v1"), ("nohash", "1", 0.9, "h", "v1"),
    ]
    items = [("other", "1", "a"), ("nohash", "1", ""), ("m", "4", ""), ("m", "1", "a"), ("m", "2", "a"), ("m", "5", "a"),
             ("m", "3", "a"), ("m", "4", "a")]
    got = decide(spark, versions, items)
    assert [(d, s) for d, s, _, _ in got] == [
        ("rejected", 404), ("rejected", 409), ("rejected", 400), ("rejected", 409), ("rejected", 409),
        ("rejected", 409), ("rejected", 409), ("promoted", 200),
    ]
    assert got[6][2] == "candidate F1 0.3900 below minimum floor 0.4000"
    assert got[4][2] == "schema v2 incompatible with v1" and got[5][2] == "dossier incomplete"


def test_exact_margin_passes_and_same_version_again_fails(spark):
    versions = [("m", "7", 0.6885, "h", "v1"), ("m", "8", 0.6885 + 0.01, "h", "v1"), ("m", "9", 0.70, "h", "v1")]
    incumbents = spark.createDataFrame([("m", "7", 0.6885)], "model string, incumbent_version string, incumbent_score double")
    got = decide(spark, versions, [("m", "8", "a"), ("m", "8", "a"), ("m", "9", "a")], incumbents)
    assert [d for d, *_ in got] == ["promoted", "rejected", "rejected"]
    assert got[0][3] == "7"
    assert got[1][2] == "candidate F1 0.6985 must be at least 0.7085 (production v8 F1 0.6985 + margin 0.0100)"


def walk(items, scores, margin, floor=0.40):
    """Decisions on (order..., version) items, one after the other: won, and the version it replaces."""
    best, holder, out = None, None, []
    for item in items:
        v = item[-1]
        won = scores[v] >= floor if best is None else scores[v] >= best + margin
        out.append((*item, won, holder if won else None))
        if won:
            best, holder = scores[v], v
    return out


@pytest.mark.parametrize("rising", [False, True])
@pytest.mark.parametrize("margin", [0.0, 0.01, -0.05, None])
def test_sequence_equals_a_plain_walk(spark, rising, margin):
    rng = random.Random(5)
    scores = {str(i): round(0.3 + (0.0011 * i if rising else rng.random() * 0.6), 4) for i in range(400)}
    versions = [("m", v, s, "h", "v1") for v, s in scores.items()]
    policy = config(spark, 0.01).withColumn("margin", F.lit(margin).cast("double"))
    out = gate.gate_sequence(requests(spark, [("m", v, "a") for v in scores]), policy, tags(spark, versions))
    got = [(r["version"], r["decision"] == "promoted", r["previous_production"]) for r in out.orderBy("seq").collect()]
    assert got == walk([(v,) for v in scores], scores, gate.MARGIN if margin is None else margin)


def test_every_request_is_decided_once(spark):
    """Equal seq at different times, many requests in one second, repeated requests, and requests without a time."""
    rng = random.Random(11)
    scores = {str(i): round(0.4 + rng.random() * 0.5, 3) for i in range(150)}
    t = tags(spark, [("m", v, s, "h", "v1") for v, s in scores.items()])
    items = [(rng.randint(0, 2), rng.randint(0, 3), v) for v in scores] + [(1, 1, "7")] * 5
    asked = spark.createDataFrame(
        [("m", v, "a", ts, seq) for ts, seq, v in items] + [("m", "3", "a", None, 0), ("m", "3", "a", None, 0)],
        "model string, version string, approved_by string, ts long, seq long",
    ).withColumn("ts", F.timestamp_seconds("ts"))
    for margin in (0.02, -0.02):
        out = gate.gate_sequence(asked, config(spark, margin), t).collect()
        assert [r.status for r in out if r.ts is None] == [400, 400]
        got = [(int(r.ts.timestamp()), r.seq, r.version, r.decision == "promoted", r.previous_production) for r in out if r.ts]
        assert sorted(got, key=repr) == sorted(walk(sorted(items), scores, margin), key=repr)


def test_a_negative_margin_starts_from_the_incumbent(spark):
    scores = {"1": 0.5, "2": 0.47, "3": 0.43, "4": 0.9}
    incumbents = spark.createDataFrame([("m", "0", 0.5)], "model string, incumbent_version string, incumbent_score double")
    out = gate.gate_sequence(
        requests(spark, [("m", v, "a") for v in scores]), config(spark, -0.04),
        tags(spark, [("m", v, s, "h", "v1") for v, s in scores.items()]), incumbents,
    ).orderBy("seq").collect()
    assert [(r.decision, r.previous_production) for r in out] == [
        ("promoted", "0"), ("promoted", "1"), ("promoted", "2"), ("promoted", "3")
    ]


def test_registry_latest_tag_wins_and_backfill_is_idempotent(spark, rows):
    t = tags(spark, [("m", "2", 0.5, "h", "v1"), ("m", "10", 0.6, "h", "v1"), ("m", "10", 0.7, "h", "v1")])
    assert rows(registry.latest_versions(t)) == [("m", 10)]
    assert {r["version"]: r["test_f1"] for r in registry.dossiers(t).collect()} == {"2": "0.5", "10": "0.7"}
    kind = F.when(F.col("version") == "10", "lora_adapter")
    once = registry.backfill(t, "model_kind", kind)
    assert rows(once.select("version", "value")) == [("10", "lora_adapter")]
    assert registry.backfill(t.unionByName(once), "model_kind", kind).count() == 0


def test_register_checks_kind_and_rows(spark):
    t = tags(spark, [("m", "9", 0.5, "h", "v1")])
    test_set = spark.createDataFrame([("a", "x"), ("b", "y")], "text string, label string")
    version, events = registry.register_version(t, "m", test_set, 0.61, "sklearn", "abc", n_test=2)
    assert version == "10"
    tag = {r["key"]: r["value"] for r in events.collect()}
    assert tag["test_f1"] == "0.61" and len(tag["eval_set_hash"]) == 64 and tag["model_kind"] == "sklearn"
    assert registry.register_version(t, "new", test_set, 0.1, "distilbert", "abc")[0] == "1"
    with pytest.raises(ValueError):
        registry.register_version(t, "m", test_set, 0.61, "magic", "abc")
    with pytest.raises(ValueError):
        registry.register_version(t, "m", test_set, 0.61, "sklearn", "abc", n_test=3)


def test_lineage_chain_durations_and_failures(spark, rows):
    events = (
        lineage.lineage_events(spark, "ingest", "r1", ["hub.table"], ["silver.table"])
        .unionByName(lineage.lineage_events(spark, "train", "r2", ["silver.table"], ["model.base"]))
        .unionByName(lineage.lineage_events(spark, "register", "r3", ["model.base"], ["model.final"]))
        .unionByName(lineage.lineage_events(spark, "register", "r4", ["x"], ["hub.table"]).where("event_type = 'START'"))
    )
    e = lineage.edges(events)
    seed = spark.createDataFrame([("silver.table",)], "dataset string")
    assert rows(lineage.closure(e, seed)) == [("model.base", 1), ("model.final", 2), ("silver.table", 0)]
    assert rows(lineage.closure(e, seed, downstream=False)) == [("hub.table", 1), ("silver.table", 0)]
    states = {r["run_id"]: r["state"] for r in lineage.run_durations(events).collect()}
    assert states == {"r1": "complete", "r2": "complete", "r3": "complete", "r4": "failed"}


def test_closure_ends_on_a_cycle(spark, rows):
    e = spark.createDataFrame([("j", "a", "b"), ("j", "b", "a")], "job string, src string, dst string")
    assert rows(lineage.closure(e, spark.createDataFrame([("a",)], "dataset string"))) == [("a", 0), ("b", 1)]


def depths(pairs, seeds):
    known, todo = dict.fromkeys(seeds, 0), list(seeds)
    for node in todo:
        for a, b in pairs:
            if a == node and b not in known:
                known[b] = known[node] + 1
                todo.append(b)
    return sorted(known.items(), key=repr)


def test_closure_follows_a_long_chain_in_few_rounds(spark, monkeypatch):
    written = []
    real = lineage.materialise
    monkeypatch.setattr(lineage, "materialise", lambda df, name: written.append(name) or real(df, name))
    n = 10_000
    chain = spark.range(n).select(F.lit("j").alias("job"), F.col("id").cast("string").alias("src"), (F.col("id") + 1).cast("string").alias("dst"))
    out = lineage.closure(chain, spark.createDataFrame([("0",)], "dataset string"))
    assert out.count() == n + 1 and out.where("depth != cast(dataset as int)").count() == 0
    assert len(written) < 25


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_has_the_least_depths(spark, rows, seed):
    """Trees, chains of different length between the same datasets, circles with and without a way in, several seeds."""
    rng = random.Random(seed)
    pairs = [(f"c{i}", f"c{i + 1}") for i in range(20)] + [("c0", "x"), ("x", "c20"), ("c20", "c5"), ("c20", "c21")]
    pairs += [("r1", "r2"), ("r2", "r3"), ("r3", "r1"), ("r3", "out"), ("s", "s"), ("s", "t")]
    pairs += [(f"n{rng.randrange(40)}", f"n{rng.randrange(40)}") for _ in range(45)] + [("c21", "n0"), ("c7", "n1")]
    e = spark.createDataFrame([("j", *p) for p in pairs], "job string, src string, dst string")
    for start in (["c0"], ["n3", "r2", "c5", "absent", "s"]):
        got = lineage.closure(e, spark.createDataFrame([(x,) for x in start], "dataset string"))
        assert rows(got) == depths(sorted(set(pairs)), start)


CASES = [
    ("summarize", "", 0.1, "summarizer", False), ("classify", "accurate", 0.1, "llm_sentiment", False),
    ("classify", "cheap", 0.10, "student", False), ("classify", "escalate", 0.99, "student", False),
    ("classify", "escalate", 0.48, "llm_sentiment", True), ("classify", "escalate", 0.70, "student", False),
    ("classify", "", 0.10, "llm_sentiment", True), ("classify", "escalate", None, "student", False),
    ("classify", None, 0.10, "llm_sentiment", True),
]


def route_rows(spark):
    rows = [(i, t, tier, c, f"text {i}") for i, (t, tier, c, *_) in enumerate(CASES)]
    return spark.createDataFrame(rows, "id int, task string, tier string, conf double, text string")


def backends():
    return {
        "student": RuleScorer(F.lit("s"), F.col("conf")), "llm_sentiment": RuleScorer(F.lit("b")),
        "summarizer": RuleScorer(F.concat(F.lit("sum of "), "text")),
    }


def test_routing_truth_table(spark):
    answers, broken = routing.route(route_rows(spark), backends())
    got = {r["id"]: (r["served_by"], r["escalated"], r["output"]) for r in answers.collect()}
    for i, (task, _, _, served, escalated) in enumerate(CASES):
        output = {"student": "s", "llm_sentiment": "b", "summarizer": f"sum of text {i}"}[served]
        assert got[i] == (served, escalated, output)
    assert broken.count() == 0


def test_unknown_task_or_tier(spark):
    bad = spark.createDataFrame(
        [(1, "translate", "escalate", 0.5, "t"), (2, "classify", "fancy", 0.5, "t")], route_rows(spark).schema
    )
    with pytest.raises(ValueError, match="Unknown"):
        routing.route(bad, backends())
    answers, broken = routing.route(bad, backends(), strict=False)
    assert answers.count() == 0
    assert sorted(r["problem"] for r in broken.collect()) == ["Unknown task: translate", "Unknown tier: fancy"]


def test_big_model_sees_only_the_unsure_rows(spark):
    seen = spark.sparkContext.accumulator(0)

    def load():
        def score(texts):
            seen.add(len(texts))
            return ["big"] * len(texts), [None] * len(texts)

        return score

    answers, _ = routing.route(route_rows(spark), {**backends(), "llm_sentiment": BatchScorer(load)})
    assert answers.where("output = 'big'").count() == 4
    assert seen.value == 4


def test_heal_loop_without_and_with_drift(spark):
    rates = spark.createDataFrame([(0.1, True)] * 20 + [(0.15, False)] * 20, "oov_rate double, is_ref boolean")
    t = tags(spark, [("m", "1", 0.5, "h", "v1")]).unionByName(registry.tag_events(spark, "m", "1", {"model_kind": "sklearn"}))
    test_set = spark.createDataFrame([("a", "x")], "text string, label string")
    digest = __import__("tidemark.operators.fingerprint", fromlist=["x"]).table_fingerprint(test_set).first()["digest"]
    conf = spark.createDataFrame([("m", digest, "v1", 0.01, 0.4, "F1")], CONFIG)
    inc = spark.createDataFrame([("m", "1", 0.5)], "model string, incumbent_version string, incumbent_score double")
    run = lambda r, score: heal(r, "m", t, conf, inc, test_set, {"sklearn": lambda: score}, "c")
    calm, events = run(rates, 0.9)
    assert calm.first()["drift"] == "no" and events.count() == 0
    drifted = rates.withColumn("oov_rate", F.when(F.col("is_ref"), 0.1).otherwise(0.9))
    good = run(drifted, 0.9)[0].first()
    assert (good["decision"], good["version"], good["previous_production"]) == ("promoted", "2", "1")
    assert run(drifted, 0.505)[0].first()["status"] == 409
    with pytest.raises(KeyError):
        heal(drifted, "m", t, conf, inc, test_set, {}, "c")
