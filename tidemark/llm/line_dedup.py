"""Line de-duplication with a segment-partition edit join, in DataFrame expressions only.

Lines are cut at line feeds. Equal lines are one class by a 128-bit hash. Lines of at least ``least`` code points are
also near each other at an edit distance of at most ``edits``: a line of n code points is cut into edits + 1 segments,
so a line within reach holds one of them unchanged, at a place that the lengths and the number of segments before and
after it bound (multi-match-aware substring selection). Segments are indexed under (length, number, content) and every
line probes the index for its own length and those up to ``edits`` below it.

Most keys belong to one line and end there, counted but never paired. Lines under keys that meet are compared inside
the join condition: first a parity signature of their code points, then a banded bit-parallel edit distance; only true
neighbours become rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import free_name
from tidemark.session import materialise

BLANKS = " \t\r\x0b\x0c"
#: Numbers of lines, 8 bytes each, up to which they are broadcast; beyond it they are shuffled with the texts.
BROADCAST_IDS = 1 << 21
IDS = ["h1", "h2"]


def _let(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def parity(text: Column) -> Column:
    """64 bits: whether the code points of each residue are odd in number. One edit flips at most two."""
    one = F.lit(1).cast("bigint")
    return F.aggregate(
        F.split(text, ""), F.lit(0).cast("bigint"),
        lambda bits, c: bits.bitwiseXOR(F.call_function("shiftleft", one, F.pmod(F.ascii(c), F.lit(64)))),
    )


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether the edit distance of two texts is at most ``edits``: banded, bit-parallel, one step per code point.

    Bit k of the band in column j stands for row j - edits + k of the longer text. D0 marks diagonals without a cost;
    the distance is the difference of the lengths plus the costs on the diagonal that ends in the last cell.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1
    long = lambda x: F.lit(x).cast("bigint")
    longer, shorter = F.when(F.length(a) >= F.length(b), a).otherwise(b), F.when(F.length(a) >= F.length(b), b).otherwise(a)

    def distance(pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        gap = F.size(x) - F.size(y)

        def matches(c: Column, j: Column) -> Column:
            bits = [
                F.when(F.coalesce(F.get(x, j + (k - edits)) == c, F.lit(False)), long(1 << k)).otherwise(long(0))
                for k in range(width)
            ]
            total = bits[0]
            for bit in bits[1:]:
                total = total + bit
            return total

        def step(state: Column, pm: Column) -> Column:
            vp, vn = state["vp"], state["vn"]
            d0 = (pm.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(pm).bitwiseOR(vn).bitwiseAND(long(full))

            def with_d0(d0: Column) -> Column:
                hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp)).bitwiseAND(long(full)))
                hn = d0.bitwiseAND(vp)
                down = F.shiftright(d0, 1)
                cost = F.lit(1) - F.call_function("shiftright", d0, gap + edits).bitwiseAND(long(1)).cast("int")
                return F.struct(
                    hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)).bitwiseAND(long(full))).alias("vp"),
                    down.bitwiseAND(hp).alias("vn"), (state["score"] + cost).alias("score"),
                )

            return _let(d0, with_d0)

        start = F.struct(
            long(full & ~((1 << edits) - 1)).alias("vp"), long(0).alias("vn"), gap.alias("score")
        )
        return F.aggregate(F.transform(y, matches), start, step, lambda s: s["score"])

    pair = F.struct(F.split(longer, "").alias("x"), F.split(shorter, "").alias("y"))
    return F.when(F.length(longer) - F.length(shorter) > edits, False).otherwise(_let(pair, distance) <= edits)


def document(key: str, text: str) -> Column:
    """A row's document: its key, then a hash of its text, so that rows of one key (or none) stay apart by their texts."""
    return F.struct(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash"))


def split_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc, line_no, line, h1, h2`` of each line that is not blank; line numbers start at 0."""
    lines = docs.select(document(key, text).alias("doc"), F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))
    return lines.where(F.btrim("line", F.lit(BLANKS)) != "").select(
        "doc", "line_no", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")
    )


def segment_keys(lines: DataFrame, edits: int) -> DataFrame:
    """``key, tag`` of the substrings each line probes with; its own segments are also the index.

    ``lines`` has ``id, line, n``, ``n`` the code points of the line. The low bit of the tag says that the key is an index
    entry, the others are the id. One row is made for each kind of substring and cut by one short expression: all kinds in
    one array make generated code too long to be compiled.
    """
    kinds = [
        F.struct(F.lit(gap).alias("gap"), F.lit(i).alias("i"), F.lit(shift).alias("shift"))
        for gap in range(edits + 1)
        for i in range(edits + 1)
        for shift in range(max(-i, gap - (edits - i)), min(i, gap + (edits - i)) + 1)
    ]
    other, i = F.col("n") - F.col("k.gap"), F.col("k.i")
    cut = lines.select("id", "line", "n", F.explode(F.array(*kinds)).alias("k")).select(
        "id", "line", "n", other.alias("other"), i.alias("i"),
        F.floor(other * i / (edits + 1)).cast("int").alias("start"), F.col("k.shift").alias("shift"),
        F.floor(other * (i + 1) / (edits + 1)).cast("int").alias("end"),
        ((F.col("k.gap") == 0) & (F.col("k.shift") == 0)).cast("bigint").alias("index"),
    )
    at, size = F.col("start") + F.col("shift"), F.col("end") - F.col("start")
    inside = (at >= 0) & (at + size <= F.col("n")) & (size > 0)
    part = F.substring("line", at + 1, size)
    return cut.where(inside).select(F.xxhash64("other", "i", part).alias("key"), (F.col("id") * 2 + F.col("index")).alias("tag"))


def near_lines(distinct: DataFrame, edits: int, least: int) -> DataFrame:
    """Pairs of different lines within reach: ``h1, h2, o1, o2, earlier``, once in each direction.

    ``distinct`` has one row ``h1, h2, first, line`` per line; ``earlier`` says that the other line comes first.
    """
    # Written once with a number for each line, so that keys carry 8 bytes and texts are not shuffled again.
    own = materialise(
        distinct.withColumn("n", F.length("line")).where(F.col("n") >= least).withColumn("id", F.monotonically_increasing_id()),
        "line-distinct",
    )
    dealt = segment_keys(own, edits).repartition("key")
    # This and the join below read the same columns, so they share one shuffle. An inner join on keys that are unique:
    # a semi join would be pushed below the shuffle.
    met = dealt.groupBy("key").agg(F.min("tag").alias("low"), F.max("tag").alias("high"), F.max(F.col("tag") % 2).alias("indexed")).where(
        "indexed = 1 AND shiftright(low, 1) != shiftright(high, 1)"
    ).select("key")
    live = dealt.join(met.hint("shuffle_hash"), "key").select(
        "key", F.shiftright("tag", 1).alias("id"), (F.col("tag") % 2 == 1).alias("index")
    )
    live = materialise(live, "line-keys")
    wanted = materialise(live.select("id").distinct(), "line-ids")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = materialise(own.join(wanted, "id").withColumn("bits", parity(F.col("line"))), "line-texts")
    full = live.join(texts, "id")
    index = full.where("index").select("key", *[F.col(c).alias(f"i_{c}") for c in (*IDS, "first", "line", "bits")])
    near = (
        ((F.col("h1") != F.col("i_h1")) | (F.col("h2") != F.col("i_h2")))
        & (F.bit_count(F.col("bits").bitwiseXOR(F.col("i_bits"))) <= 2 * edits)
        & within(F.col("line"), F.col("i_line"), edits)
    )
    pairs = full.withColumnRenamed("key", "i_key").join(index, (F.col("i_key") == F.col("key")) & near)
    one = pairs.select(*IDS, F.col("i_h1").alias("o1"), F.col("i_h2").alias("o2"),
                       (F.col("i_first") < F.col("first")).alias("earlier"))
    other = pairs.select(F.col("i_h1").alias("h1"), F.col("i_h2").alias("h2"), F.col("h1").alias("o1"),
                         F.col("h2").alias("o2"), (F.col("first") < F.col("i_first")).alias("earlier"))
    return one.unionByName(other).distinct()


def repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = 2, least: int = 40
) -> DataFrame:
    """``doc, equal_lines, near_lines``: the numbers of the lines of a document that repeat an earlier line.

    ``doc`` is the key and a hash of the text. Lines are ordered by it, null keys first, and by line number. A line
    repeats if an equal line comes before it, or if its first occurrence follows that of a line within ``edits`` edits,
    both of ``least`` code points or more; the second kind is in ``near_lines``, each line in one array at most. Blank
    lines never repeat. Documents without repeated lines have no row. Repeated rows, equal in key and text, are one
    document. A null text has no lines. Other columns are ignored.
    """
    lines = split_lines(docs, key, text)
    distinct = lines.groupBy(*IDS).agg(
        F.min(F.struct("doc", "line_no")).alias("first"), F.first("line").alias("line")
    )
    near = near_lines(distinct, edits, least).where("earlier").select(*IDS).distinct().withColumn("near", F.lit(True))
    # Read twice below: written, so that texts are not cut and hashed again for each.
    slim = materialise(lines.drop("line"), "line-places")
    firsts = slim.groupBy(*IDS).agg(F.min(F.struct("doc", "line_no")).alias("first"), F.count("*").alias("n"))
    marked = firsts.join(near, IDS, "left").where("n > 1 OR near")
    here = F.struct("doc", "line_no")
    hits = slim.join(marked, IDS).select(
        "doc", "line_no", (~here.eqNullSafe(F.col("first"))).alias("equal"), F.coalesce("near", F.lit(False)).alias("near")
    ).where("equal OR near")
    numbers = lambda where: F.array_sort(F.array_distinct(F.collect_list(F.when(where, F.col("line_no")))))
    return hits.groupBy("doc").agg(
        numbers(F.col("equal")).alias("equal_lines"), numbers(~F.col("equal")).alias("near_lines")
    )


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = 2, least: int = 40) -> DataFrame:
    """``docs`` without repeated lines; documents of which only blank lines would be left are dropped.

    A null text stays as it is. Other columns stay as they are.
    """
    found = repeated_lines(docs, key, text, edits, least)
    name, own = free_name(docs, "_gone"), free_name(docs, "_document")
    gone = found.select(F.col("doc").alias(own), F.concat("equal_lines", "near_lines").alias(name))
    joined = docs.withColumn(own, document(key, text)).join(gone.hint("shuffle_hash"), own, "left")
    kept = F.filter(F.split(F.col(text), "\n"), lambda line, i: ~F.array_contains(F.col(name), i))
    rest = F.when(F.col(name).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    out = joined.withColumn(text, rest)
    return out.where(F.col(name).isNull() | (F.btrim(F.col(text), F.lit(BLANKS + "\n")) != "")).select(docs.columns)
