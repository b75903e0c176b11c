"""The heal loop: drift check, retraining of the kind in production, registration, promotion gate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import drift, gate, models, registry

RESULT = (
    "drift string, psi double, model_kind string, version string, test_f1 double, decision string, "
    "status int, reason string, previous_production string"
)


def heal(
    rates: DataFrame,
    model: str,
    tags: DataFrame,
    config: DataFrame,
    incumbents: DataFrame,
    test_set: DataFrame,
    retrain: dict[str, Callable[[], float]],
    code_commit: str,
    approver: str = "auto-retrain-bot",
) -> tuple[DataFrame, DataFrame]:
    """Runs the loop once and gives its one-row outcome and the tag events to append.

    ``rates`` holds ``oov_rate`` with the flag ``is_ref``; ``retrain`` maps a kind of model to a job
    that trains a candidate and returns its score on the test set. Without drift nothing happens.
    """
    spark = rates.sparkSession
    psi = drift.psi_by_group(rates.where("is_ref"), rates.where("not is_ref"), "oov_rate").first()["psi"]
    if psi is None or psi <= drift.PSI_THRESHOLD:
        outcome = spark.createDataFrame([("no", psi, *[None] * 7)], RESULT)
        return outcome, tags.limit(0)
    kind = (
        registry.dossiers(tags).join(
            incumbents.select("model", F.col("incumbent_version").alias("version")), ["model", "version"]
        ).where(F.col("model") == model).first()["model_kind"]
    )
    score = models.by_kind(retrain, kind)()
    version, events = registry.register_version(tags, model, test_set, score, kind, code_commit)
    request = spark.createDataFrame([(model, version, approver, 0)], "model string, version string, approved_by string, seq bigint")
    decision = gate.gate_sequence(
        request.withColumn("ts", F.current_timestamp()), config, tags.unionByName(events), incumbents
    ).first()
    outcome = spark.createDataFrame(
        [("yes", psi, kind, version, score, decision["decision"], decision["status"], decision["reason"],
          decision["previous_production"])],
        RESULT,
    )
    return outcome, events
