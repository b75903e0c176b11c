"""Divergence of the sources of a corpus: how far apart their term frequencies are, language by language.

The counts of kept terms are a sparse matrix for each language, a row for each source and a column for each term, with the
terms in most sources first and those of like sources side by side. It is cut into stripes of rows and of columns; each
pair of row stripes meets at each column stripe in one task, which holds both as K-squared trees (``quadtree``) and walks
them together. Quadrants that are empty in both are priced by their number of columns. Sums over column stripes are added
by a shuffle. A task's memory is bounded by the two blocks, whatever the number of terms or sources.

A term is kept in a language if it occurs in at least ``least`` of its documents. With V kept terms, and N occurrences of
them in a group, a term of count c there has the price ``p = 1 + floor(10^9 (c + 2) / (N + 2 V))``, and two prices are
``floor((p - q)^2 / (p + q))`` apart. All of it is integer arithmetic, so results do not depend on the layout.

Defined results. Null text, language and source are read as ''. A row is a document, repeated ones too. A group without
terms has the prices of an empty count; a language without kept terms gives pairs of value 0 and no terms. A language of
one source gives no pairs. Equal values rank by the UTF-8 bytes of the item. An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import text_or_empty
from tidemark.llm.quadtree import Quadtree, height, joint_sums
from tidemark.operators.blocked import range_blocks, running
from tidemark.session import materialise, ship_package

#: In UTF-8 a term is a run of ASCII letters and of bytes above 0x7F: what is neither becomes a blank, A-Z become a-z.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_BLANKED = bytes(b if b > 0x7F or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
#: Terms that a task counts before it sends its counts on.
HELD = 1 << 19
#: Rows and columns of a block: at most 2^19 cells a side in a task.
ROWS, COLS = 1 << 7, 1 << 12


def _flush(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, df) in held.items():
        # A null term says that the group is there.
        terms = pa.array([*n, None], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), terms,
             pa.array([*n.values(), 0], pa.int64()), pa.array([*(df[t] for t in n), 0], pa.int64())],
            ["lang", "source", "term", "n", "df"],
        )
    held.clear()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's rows by group, sent on whenever enough different terms are held."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for text, lang, source in zip(batch.column(0), langs, sources, strict=True):
            n, df = held.setdefault((lang, source), (Counter(), Counter()))
            terms, before = text.as_py().translate(_BLANKED).split(), len(n)
            n.update(terms)
            df.update(set(terms))
            size += len(n) - before
            if size > HELD:
                yield from _flush(held)
                size = 0
    yield from _flush(held)


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """``lang, source, term, n, df``: occurrences and documents; one row of null term keeps groups without any."""
    ship_package(docs.sparkSession)
    rows = docs.select(
        text_or_empty(text).cast("binary").alias("text"), text_or_empty(lang).alias("lang"), text_or_empty(source).alias("source")
    )
    parts = rows.mapInArrow(_count, "lang string, source string, term string, n bigint, df bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _numbered(df: DataFrame, order: list[str], name: str, number: str) -> DataFrame:
    """Adds a number from 0 within each language, without gaps, in the order of the columns."""
    ranged = range_blocks(df, ["lang", *order], name)
    out = running(ranged, ["lang"], [*order, "_id"], "_block", sums={number: F.lit(1)})
    return out.withColumn(number, (F.col(number) - 1).cast("bigint")).drop("_block", "_id")


def _price(count: Column, n: Column, v: Column) -> Column:
    """Exact for counts up to 10^19; null where there is nothing to price."""
    above = (F.lit(10**9).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")).cast("decimal(38,0)")
    total = (n + 2 * v).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", above, F.nullif(total, F.lit(0).cast("decimal(20,0)")))


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, i, j, value`` for the rows ``i < j`` of each language.

    ``cells``: ``lang, row, col, p, n_rows``; ``groups``: ``lang, row, empty, n_rows, v``. Each block also receives the
    empty price of its rows, so blocks without any cell are there as well.
    """
    stripe = F.floor(F.col("row") / ROWS)
    stripes = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n_rows") - 1) / ROWS))
    chunks = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), F.ceil(F.col("v") / COLS) - 1))
    # Two dealt columns: the other stripe of the pair, and the column stripe. A price of a row has the column -1.
    held = cells.select("lang", "row", "col", "p", F.lit(None).cast("bigint").alias("v"), stripe.alias("own"),
                        F.floor(F.col("col") / COLS).alias("chunk"), F.explode(stripes).alias("other"))
    empty = groups.select("lang", "row", F.lit(-1).cast("bigint").alias("col"), F.col("empty").alias("p"), "v",
                          stripe.alias("own"), F.explode(stripes).alias("other"), "n_rows")
    empty = empty.select("lang", "row", "col", "p", "v", "own", F.explode(chunks).alias("chunk"), "other")
    every = held.select(empty.columns).unionByName(empty).select(
        "lang", "row", "col", "p", "v", "own", "chunk",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
    )

    def compare(table: pa.Table) -> pa.Table:
        get = {c: table.column(c).to_numpy() for c in ("row", "col", "p", "own")}
        low, high, chunk = (table.column(c)[0].as_py() for c in ("low", "high", "chunk"))
        lead = get["col"] < 0
        v = table.column("v").drop_null()[0].as_py()
        cols = min(COLS, v - chunk * COLS)
        tall = height(ROWS, cols)

        def side(own: int) -> Quadtree:
            mine = get["own"] == own
            heads, body = mine & lead, mine & ~lead
            empty = np.zeros(int(heads.sum()), np.int64)
            empty[get["row"][heads] - own * ROWS] = get["p"][heads]
            return Quadtree(get["row"][body] - own * ROWS, get["col"][body] - chunk * COLS, get["p"][body], empty, tall)

        left = side(low)
        right = left if low == high else side(high)
        found = joint_sums(left, right, cols)
        i, j = np.triu_indices(len(found), 1) if low == high else (x.ravel() for x in np.indices(found.shape))
        return pa.table({
            "lang": pa.array([table.column("lang")[0].as_py()] * len(i), pa.string()),
            "i": pa.array(i + low * ROWS), "j": pa.array(j + high * ROWS), "value": pa.array(found[i, j]),
        })

    ship_package(cells.sparkSession)
    parts = every.groupBy("lang", "low", "high", "chunk").applyInArrow(compare, "lang string, i bigint, j bigint, value bigint")
    return parts.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 10, top: int = 10
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for each group, a language with a source.

    Part ``pair``: every other source of the language and the sum over all kept terms of how far the prices are apart.
    Part ``term``: up to ``top`` kept terms that the group has and that cost more there than in the whole language.
    """
    counts = materialise(term_counts(docs, text, lang, source), "term-counts")
    terms = counts.where("term is not null").groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("df").alias("df"), (-F.count("*")).alias("_spread"), F.min("source").alias("_first")
    ).where(F.col("df") >= least)
    terms = materialise(_numbered(terms, ["_spread", "_first", "term"], "divergence-terms", "col"), "divergence-columns")
    kept = counts.join(terms.select("lang", "term", "col", "total"), ["lang", "term"])
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    named = counts.select("lang", "source").distinct()
    per_lang = named.groupBy("lang").agg(F.count("*").alias("n_rows")).join(langs, "lang", "left").select(
        "lang", "n_rows", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("n_lang", F.lit(0)).alias("n_lang")
    )
    groups = _numbered(named, ["source"], "divergence-groups", "row").join(sizes, ["lang", "source"], "left").join(
        materialise(per_lang, "divergence-langs"), "lang"
    )
    groups = groups.withColumn("n_group", F.coalesce("n_group", F.lit(0))).withColumn(
        "empty", F.coalesce(_price(F.lit(0).cast("bigint"), F.col("n_group"), F.col("v")), F.lit(1)).cast("bigint")
    )
    groups = materialise(groups, "divergence-rows")
    cells = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "row", "n_rows", "term", "col",
        _price(F.col("n"), F.col("n_group"), F.col("v")).cast("bigint").alias("p"),
        _price(F.col("total"), F.col("n_lang"), F.col("v")).cast("bigint").alias("q"),
    )
    cells = materialise(cells, "divergence-cells")

    sums = materialise(_pair_sums(cells.select("lang", "row", "col", "p", "n_rows"), groups), "divergence-pairs")
    both = sums.unionByName(sums.select("lang", F.col("j").alias("i"), F.col("i").alias("j"), "value"))
    name = lambda at, out: groups.select("lang", F.col("row").alias(at), F.col("source").alias(out))
    pairs = both.join(name("i", "source"), ["lang", "i"]).join(name("j", "item"), ["lang", "j"])
    over = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pairs.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(over))
    higher = cells.where("p > q").select("lang", "source", F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    first = higher.withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return pairs.select(columns).unionByName(first.select(columns))
