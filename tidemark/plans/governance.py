"""Registry, gate, lineage and routing queries; every event plays a registered candidate version."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import hash_int
from tidemark.operators import gate, lineage, registry, routing
from tidemark.operators.scorers import RuleScorer
from tidemark.plans.registry import query, table
from tidemark.session import materialise


def h(salt: str) -> str:
    return f"cast(concat('0x', substr(md5(concat('{salt}:', event_id)), 1, 8)) AS bigint)"


TAGS = f"""
e AS (SELECT event_id AS seq, ts, concat('m', user_id % 20) AS model, cast(event_id AS varchar) AS version,
             event_type, {h('score')} % 10000 / 10000.0::double AS score, {h('gap')} % 50 AS gap,
             {h('hash')} % 10 AS hh, {h('schema')} % 12 AS hs FROM events),
dossier AS (SELECT model, version, CASE WHEN gap <> 0 THEN score END AS score,
                   CASE WHEN hh = 0 THEN 'other' ELSE 'frozen' END AS eval_set_hash,
                   CASE WHEN hs = 0 THEN 'v2' ELSE 'v1' END AS schema_version FROM e),
config AS (SELECT model, CASE WHEN model <> 'm18' THEN 'frozen' END AS expected_hash, 'v1' AS expected_schema,
                  0.01::double AS margin, CASE WHEN model = 'm17' THEN 0.0::double ELSE 0.4::double END AS floor,
                  CASE WHEN model = 'm17' THEN 'ROUGE-L' ELSE 'F1' END AS metric_label
           FROM (SELECT DISTINCT model FROM e) WHERE model <> 'm19'),
requests AS (SELECT model, version, CASE WHEN event_type = 'signup' THEN '' ELSE 'ops' END AS approved_by, ts, seq FROM e),
checked AS (
  SELECT r.*, d.score, c.margin, c.floor, c.metric_label,
         CASE WHEN c.model IS NULL THEN 404 WHEN c.expected_hash IS NULL THEN 409 WHEN r.approved_by = '' THEN 400
              WHEN d.score IS NULL OR d.eval_set_hash <> c.expected_hash OR d.schema_version <> c.expected_schema
              THEN 409 END AS static_status,
         CASE WHEN c.model IS NULL THEN 'no gate config for model'
              WHEN c.expected_hash IS NULL THEN concat('expected eval-set hash not configured for ', r.model)
              WHEN r.approved_by = '' THEN 'approved_by required' WHEN d.score IS NULL THEN 'dossier incomplete'
              WHEN d.eval_set_hash <> c.expected_hash THEN 'eval-set hash mismatch — not the canonical frozen test set'
              WHEN d.schema_version <> c.expected_schema
              THEN concat('schema ', d.schema_version, ' incompatible with ', c.expected_schema) END AS static_reason
  FROM requests r LEFT JOIN config c USING (model) JOIN dossier d ON d.model = r.model AND d.version = r.version)
"""

FLOOR_REASON = "printf('candidate %s %.4f below minimum floor %.4f', metric_label, score, floor)"


def margin_reason(version: str, score: str) -> str:
    return (
        "printf('candidate %s %.4f must be at least %.4f (production v%s %s %.4f + margin %.4f)', metric_label, "
        f"score, {score} + margin, {version}, metric_label, {score}, margin)"
    )


SEQUENCE = TAGS + """,
eligible AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY ts, seq) AS rn FROM checked WHERE static_status IS NULL),
walk AS (
  SELECT model, cast(0 AS bigint) AS rn, cast(NULL AS varchar) AS before, cast(NULL AS double) AS bs,
         cast(NULL AS varchar) AS inc, cast(NULL AS double) AS s FROM (SELECT DISTINCT model FROM eligible)
  UNION ALL
  SELECT w.model, e.rn, w.inc, w.s,
         CASE WHEN e.score >= coalesce(w.s + e.margin, e.floor) THEN e.version ELSE w.inc END,
         CASE WHEN e.score >= coalesce(w.s + e.margin, e.floor) THEN e.score ELSE w.s END
  FROM walk w JOIN eligible e ON e.model = w.model AND e.rn = w.rn + 1),
audit AS (
  SELECT e.model, e.version, e.approved_by, e.ts, e.seq,
         CASE WHEN w.inc IS NOT DISTINCT FROM e.version THEN 'promoted' ELSE 'rejected' END AS decision,
         CASE WHEN w.inc IS NOT DISTINCT FROM e.version THEN 200 ELSE 409 END AS status,
         CASE WHEN w.inc IS NOT DISTINCT FROM e.version THEN NULL WHEN w.bs IS NULL THEN """ + FLOOR_REASON + """
              ELSE """ + margin_reason("w.before", "w.bs") + """ END AS reason,
         CASE WHEN w.inc IS NOT DISTINCT FROM e.version THEN w.before END AS previous_production
  FROM eligible e JOIN walk w ON w.model = e.model AND w.rn = e.rn
  UNION ALL
  SELECT model, version, approved_by, ts, seq, 'rejected', static_status, static_reason, NULL
  FROM checked WHERE static_status IS NOT NULL)
"""


def candidates(spark, sf_dir):
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), "ts", F.concat(F.lit("m"), F.col("user_id") % 20).alias("model"),
        key.cast("string").alias("version"), "event_type",
        (hash_int(key, "score") % 10000 / 10000.0).alias("score"), (hash_int(key, "gap") % 50).alias("gap"),
        (hash_int(key, "hash") % 10).alias("hh"), (hash_int(key, "schema") % 12).alias("hs"),
    )


def tag_events(spark, sf_dir):
    """Three tags per version; some versions lack the score, and some scores are set twice."""
    def tag(key, value):
        return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))

    score = F.when(F.col("gap") != 0, F.format_string("%.4f", F.col("score")))
    tags = F.array(
        tag("eval_set_hash", F.when(F.col("hh") == 0, "other").otherwise("frozen")),
        tag("schema_version", F.when(F.col("hs") == 0, "v2").otherwise("v1")),
        tag("test_f1", score),
    )
    rows = candidates(spark, sf_dir)
    first = rows.select("model", "version", "ts", "seq", F.inline(tags)).where("value is not null")
    stale = rows.where("gap between 1 and 5").select(
        "model", "version", "ts", (F.col("seq") - 1).alias("seq"),
        F.lit("test_f1").alias("key"), F.lit("0.9999").alias("value"),
    )
    return first.unionByName(stale)


def requests(spark, sf_dir):
    approver = F.when(F.col("event_type") == "signup", "").otherwise("ops")
    return candidates(spark, sf_dir).select("model", "version", approver.alias("approved_by"), "ts", "seq")


def config(spark, sf_dir):
    models = candidates(spark, sf_dir).select("model").distinct().where("model <> 'm19'")
    m = F.col("model")
    return materialise(models.select(
        "model", F.when(m != "m18", "frozen").alias("expected_hash"), F.lit("v1").alias("expected_schema"),
        F.lit(gate.MARGIN).alias("margin"), F.when(m == "m17", 0.0).otherwise(gate.FLOOR).alias("floor"),
        F.when(m == "m17", "ROUGE-L").otherwise("F1").alias("metric_label"),
    ), "gate_config")


def incumbents(spark, sf_dir):
    """In production: the last version per model that scores between 0.5 and 0.7; model m3 has none."""
    fit = candidates(spark, sf_dir).where("gap <> 0 and score between 0.5 and 0.7 and model <> 'm3'")
    return fit.groupBy("model").agg(
        F.max_by("version", "seq").alias("incumbent_version"), F.max_by("score", "seq").alias("incumbent_score")
    )


@query(
    "registry_state",
    "WITH " + TAGS + """
SELECT model, version, 'test_f1' AS key, printf('%.4f', score) AS value FROM dossier WHERE score IS NOT NULL
UNION ALL SELECT model, version, 'eval_set_hash', eval_set_hash FROM dossier
UNION ALL SELECT model, version, 'schema_version', schema_version FROM dossier
""",
)
def registry_state(spark, sf_dir):
    return registry.latest_tags(tag_events(spark, sf_dir))


@query("latest_versions", "WITH " + TAGS + "SELECT model, max(cast(version AS bigint)) AS version FROM e GROUP BY model")
def latest_versions(spark, sf_dir):
    return registry.latest_versions(tag_events(spark, sf_dir))


@query(
    "gate_snapshot",
    "WITH " + TAGS + """,
inc AS (SELECT model, arg_max(version, seq) AS iv, arg_max(score, seq) AS s FROM dossier JOIN e USING (model, version, score)
        WHERE score BETWEEN 0.5 AND 0.7 AND model <> 'm3' GROUP BY model),
r AS (SELECT c.*, iv, s, CASE WHEN s IS NULL THEN CASE WHEN score < floor THEN """ + FLOOR_REASON + """ END
             WHEN score < s + margin THEN """ + margin_reason("iv", "s") + """ END AS why
      FROM checked c LEFT JOIN inc USING (model))
SELECT model, version, CASE WHEN coalesce(static_reason, why) IS NULL THEN 'promoted' ELSE 'rejected' END AS decision,
       coalesce(static_status, CASE WHEN why IS NULL THEN 200 ELSE 409 END) AS status,
       coalesce(static_reason, why) AS reason,
       CASE WHEN coalesce(static_reason, why) IS NULL THEN iv END AS previous_production
FROM r
""",
)
def gate_snapshot(spark, sf_dir):
    out = gate.gate_snapshot(
        requests(spark, sf_dir), config(spark, sf_dir), tag_events(spark, sf_dir), incumbents(spark, sf_dir)
    )
    return out.select("model", "version", "decision", "status", "reason", "previous_production")


def audit(spark, sf_dir):
    return gate.gate_sequence(requests(spark, sf_dir), config(spark, sf_dir), tag_events(spark, sf_dir))


@query(
    "gate_sequence",
    "WITH RECURSIVE " + SEQUENCE
    + "SELECT model, version, decision, status, reason, previous_production FROM audit",
)
def gate_sequence(spark, sf_dir):
    return audit(spark, sf_dir).select("model", "version", "decision", "status", "reason", "previous_production")


@query(
    "audit_summary",
    "WITH RECURSIVE " + SEQUENCE + """
SELECT model, decision, status, CASE WHEN decision = 'promoted' THEN 'promoted' WHEN starts_with(reason, 'candidate') THEN 'score'
       WHEN starts_with(reason, 'schema') THEN 'schema' WHEN starts_with(reason, 'eval-set') THEN 'hash' ELSE reason END AS kind,
       count(*) AS n
FROM audit GROUP BY ALL
""",
)
def audit_summary(spark, sf_dir):
    return gate.audit_summary(audit(spark, sf_dir))


@query(
    "production_view",
    "WITH RECURSIVE " + SEQUENCE + """
SELECT p.model, p.version, printf('%.4f', d.score) AS test_f1, d.eval_set_hash, d.schema_version
FROM (SELECT model, arg_max(version, seq) AS version FROM audit WHERE decision = 'promoted' GROUP BY model) p
JOIN dossier d ON d.model = p.model AND d.version = p.version
""",
)
def production_view(spark, sf_dir):
    out = registry.production_view(audit(spark, sf_dir), tag_events(spark, sf_dir))
    return out.select("model", "version", "test_f1", "eval_set_hash", "schema_version")


@query(
    "gate_extended",
    "WITH " + TAGS + f""",
x AS (SELECT model, version, {h('reg').replace('event_id', 'seq')} % 4 - 1 AS n_regressed,
             (80 + {h('agree').replace('event_id', 'seq')} % 20) / 100 AS agreement,
             CASE WHEN seq % 9 <> 0 THEN 'd1' END AS data_version, CASE WHEN seq % 11 <> 0 THEN 'c1' END AS code_commit
      FROM e)
SELECT model, version, CASE WHEN n_regressed > 0 THEN 'a class regresses by more than 2 points'
       WHEN agreement < 0.9 THEN 'teacher agreement below 90%'
       WHEN data_version IS NULL OR code_commit IS NULL THEN 'lineage incomplete' END AS reason
FROM x
""",
)
def gate_extended(spark, sf_dir):
    seq = F.col("seq")
    rows = candidates(spark, sf_dir).select(
        "model", "version", (hash_int(seq, "reg") % 4 - 1).alias("n_regressed"),
        ((hash_int(seq, "agree") % 20 + 80) / 100).alias("agreement"),
        F.when(seq % 9 != 0, "d1").alias("data_version"), F.when(seq % 11 != 0, "c1").alias("code_commit"),
        F.lit("v1").alias("schema_version"),
    )
    return rows.select("model", "version", gate.extended_refusal().alias("reason"))


INCUMBENTS = """,
inc AS (SELECT model, arg_max(version, seq) AS iv, arg_max(score, seq) AS s FROM dossier JOIN e USING (model, version, score)
        WHERE score BETWEEN 0.5 AND 0.7 AND model <> 'm3' GROUP BY model),
"""


@query(
    "gate_with_evidence",
    "WITH " + TAGS + INCUMBENTS + f"""
x AS (SELECT model, version, {h('reg').replace('event_id', 'seq')} % 4 - 1 AS n_regressed,
             (80 + {h('agree').replace('event_id', 'seq')} % 20) / 100 AS agreement, seq FROM e),
r AS (SELECT c.*, iv, s,
             coalesce(static_reason, CASE WHEN x.n_regressed > 0 THEN 'a class regresses by more than 2 points'
                      WHEN x.agreement < 0.9 THEN 'teacher agreement below 90%'
                      WHEN x.seq % 9 = 0 OR x.seq % 11 = 0 THEN 'lineage incomplete' END) AS rule,
             CASE WHEN s IS NULL THEN CASE WHEN score < floor THEN """ + FLOOR_REASON + """ END
             WHEN score < s + margin THEN """ + margin_reason("iv", "s") + """ END AS why
      FROM checked c LEFT JOIN inc USING (model) JOIN x ON x.model = c.model AND x.version = c.version)
SELECT model, version, CASE WHEN coalesce(rule, why) IS NULL THEN 'promoted' ELSE 'rejected' END AS decision,
       coalesce(static_status, CASE WHEN coalesce(rule, why) IS NULL THEN 200 ELSE 409 END) AS status,
       coalesce(rule, why) AS reason, CASE WHEN coalesce(rule, why) IS NULL THEN iv END AS previous_production
FROM r
""",
)
def gate_with_evidence(spark, sf_dir):
    """The snapshot gate with the further rules: per-class regression, teacher agreement, lineage."""
    rows, seq = candidates(spark, sf_dir), F.col("seq")
    evidence = rows.select(
        "model", "version", (hash_int(seq, "reg") % 4 - 1).alias("n_regressed"),
        ((hash_int(seq, "agree") % 20 + 80) / 100).alias("agreement"),
    )
    lineage = F.array(
        F.struct(F.lit("data_version").alias("key"), F.when(seq % 9 != 0, "d1").alias("value")),
        F.struct(F.lit("code_commit").alias("key"), F.when(seq % 11 != 0, "c1").alias("value")),
    )
    tags = tag_events(spark, sf_dir).unionByName(
        rows.select("model", "version", "ts", "seq", F.inline(lineage)).where("value is not null")
    )
    out = gate.gate_snapshot(requests(spark, sf_dir), config(spark, sf_dir), tags, incumbents(spark, sf_dir), evidence)
    return out.select("model", "version", "decision", "status", "reason", "previous_production")


LINEAGE = """
l AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'START' WHEN event_type <> 'error' THEN 'COMPLETE' ELSE 'FAIL' END AS event_type,
             event_id // 2 AS run, ts FROM events)
"""


def lineage_events(spark, sf_dir):
    """Two events per run; run i makes dataset i from dataset i div 3 and fails on an error event."""
    run = F.expr("event_id div 2")
    kind = F.when(F.col("event_id") % 2 == 0, "START").when(F.col("event_type") != "error", "COMPLETE").otherwise("FAIL")

    def ds(number):
        return F.concat(F.lit("d"), number)

    return table(spark, sf_dir, "events").select(
        kind.alias("event_type"), run.cast("string").alias("run_id"), F.concat(F.lit("job"), run % 20).alias("job"),
        F.array(ds(F.expr("event_id div 2 div 3"))).alias("inputs"), F.array(ds(run)).alias("outputs"), "ts",
    )


@query(
    "run_durations",
    "WITH " + LINEAGE + """
SELECT concat('job', run % 20) AS job, cast(run AS varchar) AS run_id,
       round((epoch_us(min(ts) FILTER (WHERE event_type = 'COMPLETE')) - epoch_us(min(ts) FILTER (WHERE event_type = 'START')))
             / 1e6, 6) AS seconds,
       CASE WHEN count(*) FILTER (WHERE event_type = 'COMPLETE') = 0 THEN 'failed' ELSE 'complete' END AS state
FROM l GROUP BY run
""",
)
def run_durations(spark, sf_dir):
    out = lineage.run_durations(lineage_events(spark, sf_dir))
    return out.select("job", "run_id", F.round("seconds", 6).alias("seconds"), "state")


@query(
    "lineage_closure",
    "WITH RECURSIVE " + LINEAGE + """,
edge AS (SELECT DISTINCT run // 3 AS src, run AS dst FROM l WHERE event_type = 'COMPLETE'),
reach AS (SELECT 1 AS d, 0 AS depth UNION ALL SELECT edge.dst, depth + 1 FROM reach JOIN edge ON edge.src = reach.d)
SELECT concat('d', d) AS dataset, min(depth) AS depth FROM reach GROUP BY d
""",
)
def lineage_closure(spark, sf_dir):
    edge_table = lineage.edges(lineage_events(spark, sf_dir))
    seeds = edge_table.select(F.lit("d1").alias("dataset")).distinct()
    return lineage.closure(edge_table, seeds)


LOGS = {
    0: "container killed: OOMKilled, exit code 137",
    1: "SchemaError: label outside vocabulary",
    2: "NCCL watchdog: collective timeout after 600 s",
    3: "pod Evicted from node",
    4: "segmentation fault",
}
LOG_SQL = "CASE CAST(json_extract(props, '$.k') AS integer) % 5 " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in LOGS.items()
) + " END"


@query(
    "failure_class",
    f"""
WITH m AS (SELECT user_id, event_id, epoch_us(ts) AS t, {LOG_SQL} AS msg FROM events WHERE event_type = 'error'),
c AS (SELECT *, CASE WHEN regexp_matches(msg, 'OOMKilled|exit code 137|out of memory') THEN 'oom'
                     WHEN regexp_matches(msg, 'SchemaError|validation failed') THEN 'data_validation'
                     WHEN regexp_matches(msg, 'NCCL.*(timeout|Watchdog)') THEN 'nccl_timeout'
                     WHEN regexp_matches(msg, 'MemoryPressure|NodeNotReady|Evicted') THEN 'node_pressure'
                     ELSE 'unknown' END AS cause FROM m)
SELECT user_id, coalesce(arg_min(cause, t) FILTER (WHERE cause <> 'unknown'), 'unknown') AS cause,
       round((min(t) FILTER (WHERE cause <> 'unknown') - min(t)) / 1e6, 6) AS seconds,
       coalesce((min(t) FILTER (WHERE cause <> 'unknown') - min(t)) / 1e6 < 600, false) AS in_time
FROM c GROUP BY user_id
""",
)
def failure_class(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("int") % 5
    message = F.get(F.array(*[F.lit(v) for v in LOGS.values()]), k)
    log = table(spark, sf_dir, "events").withColumn("message", message)
    out = lineage.time_to_cause(log, "user_id", "ts", F.col("event_type") == "error", "message")
    return out.withColumn("seconds", F.round("seconds", 6))


TASKS = {0: "summarize", 1: "classify", 2: "classify", 3: "classify", 4: "translate"}
TIERS = {0: "accurate", 1: "cheap", 2: "escalate", 3: "", 4: "fancy"}


def switch_sql(salt: str, names: dict[int, str]) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in names.items())
    return f"CASE cast(concat('0x', substr(md5(concat('{salt}:', doc_id)), 1, 8)) AS bigint) % 5 {whens} END"


ROUTED = f"""
WITH r AS (SELECT doc_id, {switch_sql('task', TASKS)} AS task, {switch_sql('tier', TIERS)} AS tier,
                  (cast(concat('0x', substr(md5(concat('conf:', doc_id)), 1, 8)) AS bigint) % 100) / 100 AS conf,
                  doc_id % 13 = 0 AS silent, lang, source FROM documents),
p AS (SELECT *, CASE WHEN task NOT IN ('summarize', 'classify') THEN concat('Unknown task: ', task)
                     WHEN task = 'classify' AND tier = 'fancy' THEN concat('Unknown tier: ', tier) END AS problem,
             CASE WHEN task = 'summarize' THEN 'summarizer'
                  WHEN task = 'classify' AND tier = 'accurate' THEN 'llm_sentiment'
                  WHEN task = 'classify' AND tier IN ('cheap', 'escalate', '') THEN 'student' END AS first
      FROM r),
c AS (SELECT *, first = 'student' AND tier IN ('escalate', '') AND NOT silent AND conf < 0.7 AS escalated FROM p)
"""


def route_requests(spark, sf_dir):
    def pick(salt, names):
        return F.get(F.array(*[F.lit(v) for v in names.values()]), (hash_int(F.col("doc_id"), salt) % 5).cast("int"))

    return table(spark, sf_dir, "documents").select(
        "doc_id", pick("task", TASKS).alias("task"), pick("tier", TIERS).alias("tier"), "lang", "source"
    )


def backends():
    """The student knows the language with a hashed confidence, or none; the big model knows the source."""
    conf = F.when(F.col("doc_id") % 13 != 0, hash_int(F.col("doc_id"), "conf") % 100 / 100)
    return {
        routing.STUDENT: RuleScorer(F.col("lang"), conf),
        routing.BIG: RuleScorer(F.col("source")),
        routing.SUMMARIZER: RuleScorer(F.concat_ws("/", "source", "lang")),
    }


SERVING = [
    (routing.STUDENT, "m1", "distilbert"), (routing.BIG, "m2", "lora_adapter"), (routing.SUMMARIZER, "m17", "lora_adapter")
]
SERVING_SQL = f"""
SELECT s.served_by, cast(max(event_id) AS varchar) AS model_version, s.model_kind
FROM (VALUES {", ".join(map(str, SERVING))}) s(served_by, model, model_kind)
JOIN events ON concat('m', user_id % 20) = s.model GROUP BY s.served_by, s.model_kind
"""


def serving_models(spark, sf_dir):
    """The newest version of the model behind each backend, with its kind."""
    behind = spark.createDataFrame(SERVING, "served_by string, model string, model_kind string")
    newest = registry.latest_versions(tag_events(spark, sf_dir))
    return materialise(
        behind.join(newest, "model").select("served_by", F.col("version").cast("string").alias("model_version"), "model_kind"),
        "serving_models",
    )


@query("route_plan", ROUTED + "SELECT doc_id, task, tier, first AS backend, problem FROM p")
def route_plan(spark, sf_dir):
    task, tier = F.col("task"), F.col("tier")
    return route_requests(spark, sf_dir).select(
        "doc_id", "task", "tier", routing.first_backend(task, tier).alias("backend"),
        routing.route_problem(task, tier).alias("problem"),
    )


@query(
    "cascade",
    ROUTED + """
SELECT doc_id, CASE WHEN escalated OR first = 'llm_sentiment' THEN source WHEN first = 'student' THEN lang
                    ELSE concat(source, '/', lang) END AS output,
       CASE WHEN escalated THEN 'llm_sentiment' ELSE first END AS served_by, escalated
FROM c WHERE problem IS NULL
""",
)
def cascade(spark, sf_dir):
    answers, _ = routing.route(route_requests(spark, sf_dir), backends(), strict=False)
    return answers.select("doc_id", "output", "served_by", "escalated")


@query(
    "served_shares",
    ROUTED + """
SELECT CASE WHEN escalated THEN 'llm_sentiment' ELSE first END AS served_by, count(*) AS n,
       count(*) FILTER (WHERE escalated) AS n_escalated, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM c WHERE problem IS NULL GROUP BY 1
""",
)
def served_shares(spark, sf_dir):
    answers, _ = routing.route(route_requests(spark, sf_dir), backends(), strict=False)
    return routing.served_shares(answers).withColumn("share", F.round("share", 6))
