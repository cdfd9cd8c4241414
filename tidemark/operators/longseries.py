"""The panel's window operators for series of any length.

A daily panel has a bounded group per symbol.  A series of ticks does not: one
key may hold a third of all rows, and a window partitioned by that key would be
one task.  Here rows are put in range partitions of (key, order), which splits
a hot key over as many partitions as its rows need, and written once; each
partition is a block.  Everything then works on bounded groups of (key, block):
block summaries carry what earlier blocks contribute, and rows near a block's
edge are copied to the neighbour that needs them; expanding ranks climb a merge tree over the blocks.  Results are the same as one
window over the whole key.  (key, order) must be unique.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.rank import BITS, earlier_not_above
from tidemark.session import scratch_path


@dataclass(frozen=True)
class Series:
    """Written rows numbered from 0 within each key (column ``i``), the block length, and how many blocks that makes."""

    rows: DataFrame
    keys: list[str]
    block: int
    parts: int


def _ranged(df: DataFrame, by: list[str], parts: int, name: str, part: str) -> DataFrame:
    """The rows with the number of their range partition, written so that the numbering is fixed."""
    return _written(df.repartitionByRange(parts, *by).withColumn(part, F.spark_partition_id()), name)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, keys: list[str], order: str, parts: int | None = None) -> Series:
    """Number each key's rows in order: one range exchange into ``parts`` partitions (the session's number by default).

    The rows are sorted within the partitions as they are written, so a row's number
    is its place in its partition less that of the key's first row there, plus the
    key's rows in earlier partitions; no row is exchanged again for it.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*keys, order]
    x = _written(df.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("_at", 33)
    runs = x.groupBy(*keys, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select(*keys, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    # one row per key and partition that holds it
    rows = x.withColumn("_part", part).join(shifts, [*keys, "_part"]).select(*df.columns, (F.col("_at") + F.col("_shift")).alias("i"))
    n = x.count()  # of a written table: its footers
    return Series(_written(rows, "numbered"), keys, max(1, -(-n // parts)), parts)


def with_windows(s: Series, back: int, ahead: int, columns: Callable[[Window], dict[str, Column]]) -> DataFrame:
    """Add columns over frames reaching at most ``back`` rows before and ``ahead`` rows after each row.

    ``columns`` gets the ordered window of a block.  The last ``back`` rows of a
    block are copied to the next one and the first ``ahead`` to the one before;
    copies feed the frames and are dropped.
    """
    size = max(s.block, back, ahead, 1)
    b = F.expr(f"i div {size}")
    place = F.col("i") % size
    homes = F.array_compact(
        F.array(b, F.when(place >= size - back, b + 1), F.when((place < ahead) & (b > 0), b - 1))
    )
    x = s.rows.withColumn("_home", b).withColumn("_blk", F.explode(homes))
    w = Window.partitionBy(*s.keys, "_blk").orderBy("i")
    added = columns(w)
    x = x.select(*s.rows.columns, "_home", "_blk", *[c.alias(n) for n, c in added.items()])
    return x.where("_home = _blk").drop("_home", "_blk")


def running(s: Series, value: str, fold: str, out: str) -> DataFrame:
    """Add the running ``fold`` ('max' or 'last' known) of ``value``: within the block, after what earlier blocks carry."""
    x = s.rows.withColumn("_blk", F.expr(f"i div {s.block}"))
    here = Window.partitionBy(*s.keys, "_blk").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*s.keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    if fold == "max":
        total, inside, carry = F.max(value), F.max(value).over(here), F.max("_b").over(earlier)
        joined = F.greatest(F.col("_inside"), F.col("_carry"))
    elif fold == "last":
        known = F.when(F.col(value).isNotNull(), F.col("i"))
        total, inside = F.max_by(value, known), F.last(value, ignorenulls=True).over(here)
        carry = F.last("_b", ignorenulls=True).over(earlier)
        joined = F.coalesce("_inside", "_carry")
    else:
        raise ValueError(f"unknown fold {fold!r}")
    blocks = x.groupBy(*s.keys, "_blk").agg(total.alias("_b")).select(*s.keys, "_blk", carry.alias("_carry"))
    x = x.withColumn("_inside", inside).join(blocks, [*s.keys, "_blk"])
    return x.select(*s.rows.columns, joined.alias(out))


def expanding_rank(s: Series, value: str) -> DataFrame:
    """(keys, i, k, n): among the key's first n = i + 1 rows, how many values are <= the current one.

    A merge tree over the index blocks: blocks are the leaves, and every node has 16 children. Earlier rows not above
    the current one lie in its own block, where they are counted at once, or, on exactly one level, in an earlier child
    of a node that both are in. A level puts the rows of each node in order of value: one range exchange deals them out
    evenly however large the node is, every partition counts its rows by child, and what the node's earlier
    partitions hold is added from one row a node and partition. So n rows are moved for each of log16(blocks) levels.
    """
    keys = s.keys
    x = s.rows.select(*keys, "i", F.col(value).alias("_v"), F.expr(f"i div {s.block}").alias("_ib"), F.lit(0).cast("long").alias("_sum")).where("_v IS NOT NULL")
    blocks, shift = (s.rows.agg(F.max("i")).first()[0] or 0) // s.block + 1, 0
    while 1 << shift < blocks:
        x, shift = _merged(x, keys, shift, s.parts), shift + BITS
        if 1 << shift < blocks:
            x = _written(x, "rank-level")  # the next exchange reads it twice, to sample and to deal out
    x = earlier_not_above(x, [*keys, "_ib"], ["i"], "_v", out="_own")
    return x.select(*keys, "i", (F.col("_sum") + F.col("_own") + 1).alias("k"), (F.col("i") + 1).alias("n"))


def _merged(x: DataFrame, keys: list[str], shift: int, parts: int) -> DataFrame:
    """One level of the tree: ``_sum`` grows by the rows of the earlier children of the row's node whose value is not above."""
    children = 1 << BITS
    node = x.withColumn("_g", F.expr(f"shiftright(_ib, {shift + BITS})"))
    node = _ranged(node, [*keys, "_g", "_v", "i"], parts, "rank-ranges", "_p").withColumn("_d", F.expr(f"shiftright(_ib, {shift}) & {children - 1}"))
    at = [*keys, "_g", "_p"]
    # within a node, an earlier child's rows with the same value have smaller numbers, so they come first
    here = Window.partitionBy(*at).orderBy("_v", "i").rowsBetween(Window.unboundedPreceding, -1)
    inside = [F.coalesce(F.sum(F.when(F.col("_d") < d, 1)).over(here), F.lit(0)).alias(f"_c{d}") for d in range(1, children)]
    held = node.groupBy(*at).agg(*[F.count_if(F.col("_d") < d).alias(f"_h{d}") for d in range(1, children)])
    earlier = Window.partitionBy(*keys, "_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    carry = held.select(*at, F.array(*[F.coalesce(F.sum(f"_h{d}").over(earlier), F.lit(0)) for d in range(1, children)]).alias("_carry"))
    counted = node.select(*x.columns, "_g", "_p", "_d", F.array(*inside).alias("_inside")).join(carry, at)
    more = F.when(F.col("_d") > 0, F.col("_inside")[F.col("_d") - 1] + F.col("_carry")[F.col("_d") - 1]).otherwise(0)
    return counted.select(*[(F.col("_sum") + more).alias("_sum") if c == "_sum" else F.col(c) for c in x.columns])
