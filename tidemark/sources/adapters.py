"""Ingest adapters: one fixed life cycle, one reader per kind of source."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.validate import require_valid, split_batch
from tidemark.schemas import SCHEMA_V1, TextSchema
from tidemark.sources import readers
from tidemark.sources.sinks import write_sidecar, write_zone


class Adapter(ABC):
    """read, stage raw, validate, version, land: always in this order.

    A source fills in ``read``. Raw data lands before validation, so a rejected batch can be
    inspected. In strict mode one broken row rejects the batch; otherwise broken rows go to the
    quarantine zone with the names of the rules they break.
    """

    schema: TextSchema = SCHEMA_V1
    name: str = ""

    def __init__(self, spark: SparkSession, root: str, strict: bool = True) -> None:
        self.spark = spark
        self.root = root
        self.strict = strict
        self.metadata: dict = {}

    @abstractmethod
    def read(self) -> DataFrame:
        """The batch as a ``(text, label)`` table."""

    def run(self) -> None:
        df = self.read()
        df = self.stage_raw(df)
        self.validate(df)
        self.version(df)
        self.land(df)

    def stage_raw(self, df: DataFrame) -> DataFrame:
        """Lands the raw zone and goes on from the landed copy, so the source is read once."""
        rows = write_zone(df, self.root, "raw", self.name)
        write_sidecar(self.spark, self.root, "raw", self.name, self.schema.name, rows)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/raw/{self.name}")

    def validate(self, df: DataFrame) -> None:
        if self.strict:
            require_valid(df, self.schema)
        else:
            split_batch(df, self.schema)

    def version(self, df: DataFrame) -> None:
        self.metadata = {"schema_version": self.schema.name}

    def land(self, df: DataFrame) -> None:
        good, broken = split_batch(df, self.schema)
        rows = write_zone(good, self.root, "validated", self.name)
        if not self.strict:
            write_zone(broken, self.root, "quarantine", self.name)
        self.metadata = write_sidecar(
            self.spark, self.root, "validated", self.name, self.metadata["schema_version"], rows
        )


class CsvAdapter(Adapter):
    """CSV with text and an integer label."""

    name = "coded_csv"

    def __init__(self, spark, root, path: str, columns: str = "text string, label int", **kw) -> None:
        super().__init__(spark, root, **kw)
        self.path, self.columns = path, columns

    def read(self) -> DataFrame:
        return readers.read_coded_csv(self.spark, self.path, self.columns)


class FeedAdapter(Adapter):
    """Landed JSON pages of a news feed; topics or tickers say what was asked for."""

    name = "news_feed"

    def __init__(
        self, spark, root, path: str, topics: str | None = None, tickers: str | None = None, **kw
    ) -> None:
        super().__init__(spark, root, **kw)
        self.path, self.topics, self.tickers = path, topics, tickers

    def read(self) -> DataFrame:
        if not self.topics and not self.tickers:
            raise ValueError("a feed needs topics or tickers")
        return readers.read_feed(self.spark, self.path)


class HubAdapter(Adapter):
    """Parquet table with text and an answer word."""

    name = "hub_table"

    def __init__(self, spark, root, path: str, **kw) -> None:
        super().__init__(spark, root, **kw)
        self.path = path

    def read(self) -> DataFrame:
        return readers.read_answers(self.spark, self.path)
