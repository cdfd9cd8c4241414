"""Ordered digests of keyed tables as hash trees, which tell where two tables differ.

Rows stand in key order and are cut into ranges at keys that the key's own digest picks, about one in 256; a range's
digest is that of its rows' digests in order, and ranges are gathered into nodes in the same way until one is left.
Since cuts depend on keys alone, an edit changes the ranges it touches and their ancestors and no other, and two tables
that were built apart can be compared from the top: only children of differing nodes are looked at, and only rows of
differing ranges are joined. Nothing but one range's rows comes together in a task: ranges hold a few hundred
rows, and the chance of one ten times as long is that of 2,560 keys in a row without a cut.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import canonical_line
from tidemark.session import scratch_path

#: A key whose digest at a level begins so opens a range or node.
CUT = "00"
#: The range before the first cut.
START = "start"


@dataclass(frozen=True)
class Tree:
    """``rows``: the keys, node (name of the range: its first key as text) and digest of every row. ``levels``: from
    the ranges up, (node, parent, rows, digest); the last level has one node, or none if the table is empty."""

    keys: list[str]
    rows: DataFrame
    levels: list[DataFrame]

    def root(self) -> DataFrame:
        """(row_count, sha256): the ordered digest of the whole table."""
        text = F.concat(F.lit("sha256:"), F.coalesce(F.max("digest"), F.sha2(F.lit("").cast("binary"), 256)))
        return self.levels[-1].agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"), text.alias("sha256"))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cut(name: Column, level: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{level}:"), name).cast("binary"), 256).startswith(CUT)


def _gathered(items: DataFrame, level: int) -> DataFrame:
    """Items (_key, name, rows, digest) with ``node``: the last cut at or before each, and their place in order."""
    parts = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["_key", "digest"]
    x = items.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    x = _written(x.withColumn("_open", F.when(_cut(F.col("name"), level), F.col("name"))), "digest-order").withColumn("_part", F.shiftright("_at", 33))
    # one row a partition carries the last cut of the partitions before
    last = x.groupBy("_part").agg(F.max_by("_open", F.when(F.col("_open").isNotNull(), F.col("_at"))).alias("_last"))
    carry = F.last("_last", ignorenulls=True).over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    here = F.last("_open", ignorenulls=True).over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    x = x.withColumn("_here", here).join(last.select("_part", carry.alias("_carry")), "_part")
    return x.withColumn("node", F.coalesce("_here", "_carry", F.lit(START))).drop("_here", "_carry", "_part", "_open")


def tree(df: DataFrame, keys: list[str]) -> Tree:
    """The tree of a table in the order of ``keys``, which should be unique: equal keys stand in order of their digests.

    Every column counts, in canonical text. NULL keys stand first. The order of rows and the partitions of the frame make
    no difference.
    """
    items = df.select(
        *keys, F.struct(*keys).alias("_key"), canonical_line(df.select(*keys)).alias("name"), F.lit(1).cast("long").alias("rows"), F.sha2(canonical_line(df).cast("binary"), 256).alias("digest")
    )
    level, below, levels, rows = 0, _written(_gathered(items, 0), "digest-rows"), [], None
    rows = below.select(*keys, "node", "digest")
    while True:
        kids = F.sort_array(F.collect_list(F.struct("_at", "digest")))["digest"]
        up = below.groupBy("node").agg(F.min("_key").alias("_key"), F.sum("rows").alias("rows"), F.sha2(F.array_join(kids, "").cast("binary"), 256).alias("digest"))
        up = _written(up.withColumnRenamed("node", "name"), "digest-nodes")
        if up.count() <= 1:
            return Tree(keys, rows, [*levels, up.select(F.col("name").alias("node"), F.lit(None).cast("string").alias("parent"), "rows", "digest")])
        level += 1
        below = _written(_gathered(up, level), "digest-level")
        levels.append(below.select(F.col("name").alias("node"), F.col("node").alias("parent"), "rows", "digest"))


def differing_ranges(before: Tree, after: Tree) -> DataFrame:
    """(range_from, rows_before, rows_after): ranges whose digests differ, or that only one table has (NULL rows on the other side).

    Works down from the highest level that both trees have.
    """
    inside_a = inside_b = None
    for level in range(min(len(before.levels), len(after.levels)) - 1, -1, -1):
        a, b = before.levels[level], after.levels[level]
        if inside_a is not None:
            a, b = a.join(inside_a, a["parent"] == inside_a["_up"], "left_semi"), b.join(inside_b, b["parent"] == inside_b["_up"], "left_semi")
        a = a.select(F.col("node").alias("node"), F.col("rows").alias("rows_before"), F.col("digest").alias("_a"))
        b = b.select(F.col("node").alias("node"), F.col("rows").alias("rows_after"), F.col("digest").alias("_b"))
        found = _written(a.join(b, "node", "full").where(~F.col("_a").eqNullSafe(F.col("_b"))), "digest-differences")
        inside_a = inside_b = found.select(F.col("node").alias("_up"))
    return found.select(F.col("node").alias("range_from"), "rows_before", "rows_after")


def differing_rows(before: Tree, after: Tree, ranges: DataFrame | None = None) -> DataFrame:
    """(keys, change): rows that were added, removed or changed, joined within the differing ranges only."""
    ranges = differing_ranges(before, after) if ranges is None else ranges
    within = ranges.select(F.col("range_from").alias("node"))
    a = before.rows.join(within, "node", "left_semi").select(*before.keys, F.col("digest").alias("_a"))
    b = after.rows.join(within, "node", "left_semi").select(*[F.col(k).alias(f"_{k}") for k in after.keys], F.col("digest").alias("_b"))
    same = F.lit(True)
    for k in before.keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("changed")
    x = a.join(b, same, "full").where(~F.col("_a").eqNullSafe(F.col("_b")))
    return x.select(*[F.when(F.col("_a").isNull(), F.col(f"_{k}")).otherwise(F.col(k)).alias(k) for k in before.keys], change.alias("change"))
