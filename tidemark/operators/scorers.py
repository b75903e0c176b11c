"""Scorers: anything that adds ``output`` and ``confidence`` (null when it has none) to a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Scorer(Protocol):
    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with the columns ``output string`` and ``confidence double``."""


class RuleScorer:
    """Two SQL expressions."""

    def __init__(self, output: Column, confidence: Column | None = None) -> None:
        self.output = output
        self.confidence = F.lit(None) if confidence is None else confidence

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn("output", self.output).withColumn("confidence", self.confidence.cast("double"))


class ModelScorer:
    """A fitted Spark ML text classifier."""

    def __init__(self, model: PipelineModel, labels: list[str]) -> None:
        self.model, self.labels = model, labels

    def score(self, df: DataFrame) -> DataFrame:
        from tidemark.operators.models import predict

        return predict(self.model, df, self.labels).withColumnRenamed("pred", "output")


class BatchScorer:
    """A model outside Spark: ``load()`` runs once per Python worker task and gives a function from a
    batch of texts to (outputs, confidences). Batches reach it through Arrow."""

    def __init__(self, load: Callable[[], Callable[[list[str]], tuple[list, list]]], text: str = "text") -> None:
        self.load, self.text = load, text

    def score(self, df: DataFrame) -> DataFrame:
        load, text = self.load, self.text
        fields = [*df.schema.fields, T.StructField("output", T.StringType()),
                  T.StructField("confidence", T.DoubleType())]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = load()
            for batch in batches:
                outputs, confidences = model(batch[text].tolist())
                yield batch.assign(output=outputs, confidence=confidences)

        return df.mapInPandas(run, T.StructType(fields))
