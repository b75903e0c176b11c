"""The next value at or above a bar in long ordered groups, and the chains that such links form.

Both take a logarithmic number of joins, whatever the length of a group, and no task reads a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

BITS = 6  # 64 children a node
FAN = 1 << BITS


def _up(node: Column, levels: int = 1) -> Column:
    return F.shiftright(node, BITS * levels)


def _levels(df: DataFrame, key: str, pos: str, value: str) -> list[DataFrame]:
    """Tables ``_key, _parent, _children`` from the positions up to one root a group; children are (slot, maximum)."""
    top = df.agg(F.max(pos)).first()[0] or 0
    nodes = df.select(F.col(key).alias("_key"), F.col(pos).cast("bigint").alias("_node"), F.col(value).alias("_top"))
    out = []
    while True:
        child = F.struct((F.col("_node") % FAN).cast("int").alias("slot"), F.col("_top").alias("top"))
        up = materialise(
            nodes.groupBy("_key", _up(F.col("_node")).alias("_parent")).agg(
                F.collect_list(child).alias("_children"), F.max("_top").alias("_top")
            ), "search-level",
        )
        out.append(up.drop("_top"))
        top >>= BITS
        if top == 0:
            return out
        nodes = up.select("_key", F.col("_parent").alias("_node"), "_top")


def next_at_least(df: DataFrame, key: str, pos: str, value: str, bar: str) -> DataFrame:
    """``key, pos, next``: the position of the first later row of the group whose value is at least the row's bar.

    ``pos`` are different integers from 0 in each group, better without gaps; ``next`` is null where no row is high enough
    or the bar is null. A tree of maxima with 64 children a node is climbed until a later sibling is high enough and
    then descended to the first such row: two joins for each level, each on the parent node.
    """
    levels = _levels(df, key, pos, value)
    own = F.col("_pos")
    rows = df.select(
        F.col(key).alias("_key"), F.col(pos).cast("bigint").alias("_pos"), F.col(bar).alias("_bar"),
        F.lit(-1).alias("_level"), F.lit(None).cast("bigint").alias("_at"),
    )

    def child(rows: DataFrame, level: int, parent: Column, after: Column) -> DataFrame:
        """Adds the first child after ``after`` that reaches the bar."""
        high = F.filter("_children", lambda c: (c["slot"] > after) & (c["top"] >= F.col("_bar")))
        found = F.array_min(F.transform(high, lambda c: c["slot"]))
        joined = rows.withColumn("_parent", parent).join(levels[level], ["_key", "_parent"], "left")
        return joined.withColumn("_found", F.shiftleft(parent, BITS) + found).drop("_children", "_parent")

    for level in range(len(levels)):
        rows = child(rows, level, _up(own, level + 1), (_up(own, level) % FAN).cast("int"))
        new = (F.col("_level") < 0) & F.col("_found").isNotNull()
        rows = rows.withColumns(
            {"_at": F.when(new, F.col("_found")).otherwise(F.col("_at")), "_level": F.when(new, level).otherwise(F.col("_level"))}
        ).drop("_found")
    for level in range(len(levels) - 1, 0, -1):
        # Rows that were settled lower down meet their own parent, which changes nothing and keeps the keys spread.
        below = F.col("_level") >= level
        rows = child(rows, level - 1, F.when(below, F.col("_at")).otherwise(_up(own, level)), F.lit(-1))
        rows = rows.withColumn("_at", F.when(below, F.col("_found")).otherwise(F.col("_at"))).drop("_found")
    return rows.select(F.col("_key").alias(key), F.col("_pos").alias(pos), F.col("_at").alias("next"))


def reached(links: DataFrame, key: str, pos: str, start: int = 0) -> DataFrame:
    """``key, pos`` of the rows on the chain that leads from position ``start`` over ``next``, the start included.

    Each round doubles both the reach of the links and the known part of the chains, so rounds grow with the logarithm
    of the longest chain. One table is written a round: rows without ``next`` are those known to be on the chain.
    """
    none = F.lit(None).cast("bigint")
    first = links.where(F.col(pos) == start).select(key, pos, none.alias("next"))
    state = materialise(first.unionByName(links.where("next is not null").select(key, pos, "next")), "search-chain")
    while True:
        chain, jumps = state.where("next is null"), state.where("next is not null")
        if jumps.isEmpty():
            return chain.select(key, pos)
        ahead = jumps.select(key, F.col(pos).alias("_via"), F.col("next").alias("_next"))
        found = chain.select(key, F.col(pos).alias("_via")).join(ahead, [key, "_via"])
        further = jumps.withColumnRenamed("next", "_via").join(ahead, [key, "_via"])
        state = materialise(
            chain.unionByName(found.select(key, F.col("_next").alias(pos), none.alias("next")))
            .unionByName(further.select(key, pos, F.col("_next").alias("next"))), "search-chain",
        )
