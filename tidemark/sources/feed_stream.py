"""Landed pages of a news feed as a stream with numbered offsets.

Pages are files ``page-<number>.json`` in one folder, numbered from 1 in the order of the feed. The offset is the number of
the last page read. It moves on only as far as pages have landed without a gap, so a page that lands late is waited
for, batches follow the order of the feed, and a batch that is replayed from its offsets reads the same pages.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.functions.text import map_values
from tidemark.session import ship_package

FORMAT = "feed_pages"
SCHEMA = "page bigint, position int, title string, sentiment string, problem string"
NAME = re.compile(r"page-0*(\d+)\.json$")
PER_TASK = 64  # pages that one task reads


class Pages(InputPartition):
    def __init__(self, files: list[tuple[int, str]]):
        self.files = files


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    """A local path or a URI that Arrow's file systems know."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def parse_page(number: int, body: bytes) -> Iterator[tuple]:
    """A row per article; a page that is no JSON or has no feed is one row with the problem."""
    try:
        page = json.loads(body)
    except ValueError:
        yield number, None, None, None, "page is no JSON"
        return
    feed = page.get("feed") if isinstance(page, dict) else None
    if not isinstance(feed, list):
        yield number, None, None, None, "page has no feed"
        return
    for i, article in enumerate(feed):
        told = article if isinstance(article, dict) else {}
        title, mood = told.get("title"), told.get("overall_sentiment_label")
        yield number, i, None if title is None else str(title), None if mood is None else str(mood), None


class FeedReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path, self.last = path, 0

    def _landed(self) -> dict[int, str]:
        system, root = _folder(self.path)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        hits = [(NAME.search(f.base_name), f.path) for f in found if f.type == fs.FileType.File]
        return {int(m[1]): path for m, path in hits if m}

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        landed = self._landed()
        while self.last + 1 in landed:
            self.last += 1
        return {"page": self.last}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        self.last = max(self.last, end["page"])
        landed = self._landed()
        files = [(n, landed[n]) for n in range(start["page"] + 1, end["page"] + 1)]
        return [Pages(files[i: i + PER_TASK]) for i in range(0, len(files), PER_TASK)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        system, _ = _folder(self.path)
        for number, path in partition.files:
            with system.open_input_stream(path) as f:
                yield from parse_page(number, f.read())

    def commit(self, end: dict) -> None:
        """Pages stay where they are; the query's own checkpoint keeps the offset."""


class FeedPages(DataSource):
    """``spark.readStream.format("feed_pages").option("path", folder)``; a batch takes all pages that have landed."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> FeedReader:
        return FeedReader(self.options["path"])


def read_feed_stream(spark: SparkSession, path: str) -> DataFrame:
    """Stream of the articles in the order of their pages, with the problem of a page that has none."""
    ship_package(spark)
    spark.dataSource.register(FeedPages)
    return spark.readStream.format(FORMAT).option("path", path).load()


def labelled(articles: DataFrame, labels: dict[str, str]) -> DataFrame:
    """``page, position, text, label`` of the articles; an unknown sentiment has no label."""
    good = articles.where("problem is null")
    return good.select("page", "position", F.col("title").alias("text"), map_values(F.col("sentiment"), labels).alias("label"))
