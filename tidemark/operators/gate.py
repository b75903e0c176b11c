"""The promotion gate: ordered checks of one request, and requests in sequence per model.

Requests are ``(model, version, approved_by, ts, seq)``; the configuration is
``(model, expected_hash, expected_schema, margin, floor, metric_label)`` with one row per model. A margin may be
negative; a missing margin or floor is that of the default policy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.blocked import range_blocks, running
from tidemark.operators.registry import DOSSIER, dossiers
from tidemark.operators.search import next_at_least, reached
from tidemark.session import materialise

# Default policy, for models whose configuration lacks a margin or a floor.
MARGIN = 0.01
FLOOR = 0.40

ORDER = ["ts", "seq", "version", "approved_by"]


def with_dossiers(
    requests: DataFrame, config: DataFrame, tags: DataFrame, evidence: DataFrame | None = None
) -> DataFrame:
    """Requests with their model's configuration and their candidate's dossier, where there are any.

    ``evidence``, ``(model, version, n_regressed, agreement)``, brings the further rules into the gate; ``_extra`` then
    has the one that the candidate breaks, else null.
    """
    known = config.withColumns({
        "margin": F.coalesce("margin", F.lit(MARGIN)), "floor": F.coalesce("floor", F.lit(FLOOR)), "_configured": F.lit(True)
    })
    keys = DOSSIER if evidence is None else [*DOSSIER, "data_version"]
    rows = requests.join(known, "model", "left").join(dossiers(tags, keys), ["model", "version"], "left").withColumn(
        "score", F.col("test_f1").cast("double")
    )
    if evidence is None:
        return rows.withColumn("_extra", F.lit(None).cast("string"))
    found = evidence.select("model", "version", "n_regressed", "agreement")
    return rows.join(found, ["model", "version"], "left").withColumn("_extra", extended_refusal())


# The reasons, which audits and their readers compare word for word.
def static_refusal() -> Column:
    """Status and reason of the first check that fails before scores are compared; null if none."""
    def refuse(status: int, reason: Column) -> Column:
        return F.struct(F.lit(status).alias("status"), reason.alias("reason"))

    missing = F.col("eval_set_hash").isNull() | F.col("schema_version").isNull() | F.col("score").isNull()
    return F.coalesce(
        F.when(F.col("_configured").isNull(), refuse(404, F.lit("no gate config for model"))),
        F.when(
            F.coalesce("expected_hash", F.lit("")) == "",
            refuse(409, F.concat(F.lit("expected eval-set hash not configured for "), F.col("model"))),
        ),
        F.when(F.coalesce("approved_by", F.lit("")) == "", refuse(400, F.lit("approved_by required"))),
        F.when(missing, refuse(409, F.lit("dossier incomplete"))),
        F.when(
            F.col("eval_set_hash") != F.col("expected_hash"),
            refuse(409, F.lit("eval-set hash mismatch — not the canonical frozen test set")),
        ),
        F.when(
            F.col("schema_version") != F.col("expected_schema"),
            refuse(
                409,
                F.format_string("schema %s incompatible with %s", F.col("schema_version"), F.col("expected_schema")),
            ),
        ),
        F.when(F.col("_extra").isNotNull(), refuse(409, F.col("_extra"))),
    )


def undated() -> Column:
    """Refusal of a request without a time, which has no place in a sequence; null for others."""
    return F.when(
        F.col("ts").isNull(), F.struct(F.lit(400).alias("status"), F.lit("request has no timestamp").alias("reason"))
    )


def score_refusal(incumbent_version: Column, incumbent_score: Column) -> Column:
    """Reason for which the score fails against the incumbent, or the floor without one; else null."""
    required = incumbent_score + F.col("margin")
    below_floor = F.format_string(
        "candidate %s %.4f below minimum floor %.4f", F.col("metric_label"), F.col("score"), F.col("floor")
    )
    below_margin = F.format_string(
        "candidate %s %.4f must be at least %.4f (production v%s %s %.4f + margin %.4f)",
        F.col("metric_label"), F.col("score"), required, incumbent_version, F.col("metric_label"),
        incumbent_score, F.col("margin"),
    )
    return F.when(incumbent_score.isNull(), F.when(F.col("score") < F.col("floor"), below_floor)).otherwise(
        F.when(F.col("score") < required, below_margin)
    )


def _decide(rows: DataFrame, static: Column, version: Column, score: Column) -> DataFrame:
    compared = score_refusal(version, score)
    status = F.coalesce(static["status"], F.when(compared.isNotNull(), 409), F.lit(200))
    decided = rows.withColumn("_reason", F.coalesce(static["reason"], compared)).withColumn("status", status)
    return decided.select(
        "model", "version", "approved_by", "ts", "seq",
        F.when(F.col("_reason").isNull(), "promoted").otherwise("rejected").alias("decision"),
        "status", F.col("_reason").alias("reason"),
        F.when(F.col("_reason").isNull(), version).alias("previous_production"),
    )


def decided(rows: DataFrame) -> DataFrame:
    """Decisions on rows that carry ``_static`` and the ``incumbent_version`` and ``incumbent_score`` they met."""
    return _decide(rows, F.col("_static"), F.col("incumbent_version"), F.col("incumbent_score"))


def gate_snapshot(
    requests: DataFrame, config: DataFrame, tags: DataFrame, incumbents: DataFrame, evidence: DataFrame | None = None
) -> DataFrame:
    """Every request decided on its own against the models now in production.

    ``incumbents``: ``(model, incumbent_version, incumbent_score)``.
    """
    rows = with_dossiers(requests, config, tags, evidence).join(incumbents, "model", "left")
    return decided(rows.withColumn("_static", static_refusal()))


def gate_sequence(
    requests: DataFrame, config: DataFrame, tags: DataFrame, incumbents: DataFrame | None = None,
    evidence: DataFrame | None = None,
) -> DataFrame:
    """Requests decided in order of (ts, seq, version, approver); an accepted one is the incumbent of the next.

    One row per request, repeated ones included; a request without a time has no place in the order and is refused.
    An acceptance leads to the next request whose score clears its bar: these links are found for all requests at once,
    and the chain of acceptances is followed over them by pointer jumping. Each request then meets the last acceptance
    before it. Where the margin is not negative only running maxima can be accepted, so no others are searched.
    """
    rows = with_dossiers(requests, config, tags, evidence)
    if incumbents is None:
        rows = rows.withColumn("incumbent_version", F.lit(None).cast("string")).withColumn(
            "incumbent_score", F.lit(None).cast("double")
        )
    else:
        rows = rows.join(incumbents, "model", "left")
    rows = range_blocks(rows.withColumn("_static", F.coalesce(static_refusal(), undated())), ["model", *ORDER], "gate_requests")
    order = [*ORDER, "_id"]
    eligible = rows.where("_static is null")
    best = running(eligible, ["model"], order, "_block", maxima={"_best": F.col("score")})
    records = best.where(F.col("_best").isNull() | (F.col("score") >= F.col("_best")) | (F.col("margin") < 0))
    placed = running(records, ["model"], order, "_block", sums={"pos": F.lit(1)}).select(
        "model", "pos", "_id", "score", (F.col("score") + F.col("margin")).alias("bar")
    )
    bar = F.coalesce(F.col("incumbent_score") + F.col("margin"), F.col("floor"))
    start = eligible.select("model", F.lit(0).cast("bigint").alias("pos"), bar.alias("bar")).distinct()
    placed = materialise(placed.unionByName(start, allowMissingColumns=True), "gate_records")
    chain = reached(next_at_least(placed, "model", "pos", "score", "bar"), "model", "pos")
    accepted = placed.where("pos > 0").join(chain, ["model", "pos"], "left_semi").select("_id")
    marked = eligible.join(accepted.withColumn("_accepted", F.lit(True)), "_id", "left")
    known = running(
        marked, ["model"], order, "_block", maxima={"_last": F.when(F.col("_accepted"), F.struct(*order, "score"))}
    )
    decided = _decide(
        known, F.col("_static"),
        F.coalesce("_last.version", "incumbent_version"), F.coalesce("_last.score", "incumbent_score"),
    )
    nothing = F.lit(None)
    refused = _decide(rows.where("_static is not null"), F.col("_static"), nothing.cast("string"), nothing.cast("double"))
    return decided.unionByName(refused)


def audit_summary(audit: DataFrame) -> DataFrame:
    """Decisions per model and status, the reason reduced to its kind."""
    kind = (
        F.when(F.col("decision") == "promoted", "promoted")
        .when(F.col("reason").startswith("candidate"), "score")
        .when(F.col("reason").startswith("schema"), "schema")
        .when(F.col("reason").startswith("eval-set"), "hash")
        .otherwise(F.col("reason"))
    )
    return audit.groupBy("model", "decision", "status", kind.alias("kind")).agg(F.count("*").alias("n"))


def extended_refusal() -> Column:
    """Optional further rules, first failure wins; null if none. A gate that is given evidence applies them.

    Reads ``n_regressed`` (classes that lost over 2 points), ``agreement`` with the teacher, and the
    lineage tags ``data_version``, ``code_commit`` and ``schema_version``.
    """
    return F.coalesce(
        F.when(F.col("n_regressed") > 0, F.lit("a class regresses by more than 2 points")),
        F.when(F.col("agreement") < 0.90, F.lit("teacher agreement below 90%")),
        F.when(
            F.col("data_version").isNull() | F.col("code_commit").isNull() | F.col("schema_version").isNull(),
            F.lit("lineage incomplete"),
        ),
    )
