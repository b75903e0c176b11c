"""Files cut into lines by byte ranges: quoted CSV whose values hold line breaks, and digests of whole files.

Spark's line reader splits a file into ranges; its order within a range and the start of the range place every line.
What depends on all earlier lines of a file (inside quotes or not, the line's number) is taken over the ranges first and
then within each, so a file of any size is read by as many tasks as it has ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.blocked import running
from tidemark.operators.fingerprint import table_fingerprint
from tidemark.session import materialise

# A line as the CSV grammar sees it; possessive, so long lines neither backtrack nor recurse.
_QUOTED = r'(?:[^"]++|"")*+'
_FIELD = rf'(?:"{_QUOTED}"[^,]*+|[^",][^,]*+|)'
_OPENS = rf'(?:{_FIELD},)*+"{_QUOTED}\z'
#: The line ends inside quotes, if it began outside, or inside.
ENDS_INSIDE_FROM_OUTSIDE = rf"\A{_OPENS}"
ENDS_INSIDE_FROM_INSIDE = rf'\A{_QUOTED}(?:\z|"[^,]*+,{_OPENS})'


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, length, block, at, value``: every line, the byte its range starts at, and its order within the range.

    Lines end at the byte 0x0A alone; a carriage return before it stays.
    """
    raw = spark.read.options(lineSep="\n", recursiveFileLookup=True).text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
    )


def _inside(rows: DataFrame) -> DataFrame:
    """Adds ``inside``: whether the line begins within quotes.

    A line leaves the state as it was, turns it, or sets it whatever it was. So the state is that of the last line that
    set it, turned as often as lines have turned it since.
    """
    out, inn = F.rlike("value", F.lit(ENDS_INSIDE_FROM_OUTSIDE)), F.rlike("value", F.lit(ENDS_INSIDE_FROM_INSIDE))
    rows = rows.withColumns({"_turns": (out & ~inn).cast("int"), "_sets": F.when(out == inn, out)})
    rows = materialise(rows, "lines")
    rows = running(rows, ["file"], ["at"], "block", sums={"_turned": F.col("_turns")})
    mark = F.when(F.col("_sets").isNotNull(), F.struct("block", "at", "_sets", "_turned"))
    rows = running(rows, ["file"], ["at"], "block", maxima={"_last": mark})
    since = F.col("_turned") - F.col("_turns") - F.coalesce("_last._turned", F.lit(0))
    state = F.coalesce("_last._sets", F.lit(False)) != (since % 2 == 1)
    return rows.withColumn("inside", state).drop("_turns", "_sets", "_turned", "_last")


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, number, record``: the CSV records of each file, numbered from 1; breaks within quotes are kept."""
    rows = running(_inside(lines(spark, path)), ["file"], ["at"], "block", sums={"number": (~F.col("inside")).cast("int")})
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    joined = F.array_join(F.transform(parts, lambda p: p["value"]), "\n")
    grouped = rows.groupBy("file", "number").agg(joined.alias("record"))
    return grouped.withColumn("record", F.regexp_replace("record", r"\r\z", ""))


def read_quoted_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """Quoted CSV (quotes doubled inside quotes) as the multi-line reader gives it, but read range by range.

    Blank records are skipped. With a header the first record of each file is left out. A carriage return within quotes
    stays, where the multi-line reader of a file whose lines end in CRLF makes such pairs a line feed.
    """
    found = records(spark, path)
    if header:
        found = found.where("number > 1")
    parsed: Column = F.from_csv("record", schema, {"quote": '"', "escape": '"'})
    return found.where(F.trim("record") != "").select(parsed.alias("_row")).select("_row.*")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, n_lines, digest`` for every file below ``path`` that is not empty (Spark lists no others).

    The digest is that of the file's numbered lines, by a tree of bounded fan-in, and its length: together they determine
    every byte. It does not depend on how the file was cut into ranges. A task holds one line at a time: the lines of a
    range are neighbours in ``at``, so a line's number follows from the first line of its range and the lines before the
    range, and no lines are sorted. The table of ranges is one that the driver lists anyway; it is broadcast.
    """
    hashed = lines(spark, path).withColumn("line", F.sha2(F.col("value").cast("binary"), 256)).drop("value")
    hashed = materialise(hashed, "line_digests")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1
    ranges = hashed.groupBy("file", "block").agg(F.min("at").alias("_first"), F.count("*").alias("_n"))
    ranges = ranges.select("file", "block", shift.alias("_shift"))
    numbered = hashed.join(F.broadcast(ranges), ["file", "block"]).withColumn("number", F.col("at") + F.col("_shift"))
    named = numbered.select(F.struct("file", "length").alias("_file"), "number", "line")
    whole = table_fingerprint(named, ["number", "line"], "_file")
    return whole.select(
        F.col("_file.file").alias("path"), "_file.length", F.col("n_rows").alias("n_lines"),
        F.sha2(F.concat_ws(":", "digest", "_file.length"), 256).alias("digest"),
    )
