"""Pages at any depth, under any allowed sort and filter, from an order-statistics index of a table.

An index holds a table's rows in ranges of one sort order, each range a folder, and a summary with one row a range: how
many rows it has, and the least and greatest value of the sort column. The full sort key is unique, so ranges have
about the same size however often a value repeats. Exact ranks at the boundaries of the ranges follow from the counts:
a page reads the ranges its ranks fall in and no other, at page 10,000 as on page 1. A filter is counted range by range
without moving a row, and a page that follows a known row (seek) starts at the range this row belongs to.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import browse

RANGE = "_range"
#: Rows of a range, about: what a page reads at least.
ROWS_PER_RANGE = 100_000
#: Ranges of an index, at most: more rows make them longer, so the exchange, the folders and the summary stay few.
MAX_RANGES = 1000
#: Ranges a seek reads at first; as many again while filters leave a page short.
SEEK_RANGES = 2


@dataclass(frozen=True)
class Index:
    """A sort of a table: its rows by range, and the ranges (_range, rows, nulls, low, high)."""

    key: str
    column: str
    way: str
    rows: DataFrame
    ranges: DataFrame

    def order(self) -> list[tuple[str, bool]]:
        return browse.sort_columns(browse.spec_of(self.key), self.column, self.way)

    def read(self, ranges: Column) -> DataFrame:
        return self.rows.where(ranges)


def ranged(df: DataFrame, key: str, sort: str | None = None, direction: str = "asc", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The rows with their range under a sort; one exchange. To be written with ``_range`` as the partition column."""
    spec = browse.spec_of(key)
    keys = browse.sort_keys(spec, *browse.resolve_sort(spec, sort, direction))
    parts = min(MAX_RANGES, max(1, -(-df.count() // rows_per_range)))
    return df.repartitionByRange(parts, *keys).withColumn(RANGE, F.spark_partition_id())


def summary(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(RANGE).agg(F.count("*").alias("rows"), F.count_if(F.col(column).isNull()).alias("nulls"), F.min(column).alias("low"), F.max(column).alias("high"))


def write(df: DataFrame, path: str, key: str, sort: str | None = None, direction: str = "asc", rows_per_range: int = ROWS_PER_RANGE) -> Index:
    """Write an index below ``path``: the rows first, the summary last, so that a whole summary means a whole index."""
    column, _ = browse.resolve_sort(browse.spec_of(key), sort, direction)
    made = ranged(df, key, sort, direction, rows_per_range)
    made.write.partitionBy(RANGE).parquet(f"{path}/rows")
    rows = df.sparkSession.read.schema(made.schema).parquet(f"{path}/rows")
    summary(rows, column).coalesce(1).write.parquet(f"{path}/ranges")
    return read(df.sparkSession, path, key, sort, direction, made.schema)


def read(spark: SparkSession, path: str, key: str, sort: str | None = None, direction: str = "asc", schema: StructType | None = None) -> Index:
    """A written index; the ``schema`` is needed only where the table is empty."""
    column, way = browse.resolve_sort(browse.spec_of(key), sort, direction)
    rows = (spark.read.schema(schema) if schema else spark.read).parquet(f"{path}/rows")
    return Index(key, column, way, rows, spark.read.parquet(f"{path}/ranges"))


def _counted(index: Index, filters: browse.Filters | None) -> DataFrame:
    """(_range, rows, before, total) of the ranges that hold rows: one row a range, numbered in one small window."""
    if filters is None:
        counts = index.ranges.select(RANGE, "rows")
    else:
        counts = browse.filtered(index.rows, browse.spec_of(index.key), filters).groupBy(RANGE).agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1))
    return counts.select(RANGE, "rows", F.coalesce(before, F.lit(0)).alias("before"), F.sum("rows").over(Window.partitionBy()).alias("total"))


def page(index: Index, number: int = 1, size: int = browse.DEFAULT_PAGE_SIZE, filters: browse.Filters | None = None) -> DataFrame:
    """The rows of one page with the filtered set's ``total_count``, as a sort with offset and limit would give them.

    A page beyond the end is empty. At most one range for each row of the page is read.
    """
    size = browse.clamp_page_size(size)
    low = (max(1, number) - 1) * size
    held = _counted(index, filters).where((F.col("before") < low + size) & (F.col("before") + F.col("rows") > low)).orderBy(RANGE).collect()
    rows = index.read(F.col(RANGE).isin([r[RANGE] for r in held]))
    if filters is not None:
        rows = browse.filtered(rows, browse.spec_of(index.key), filters)
    skip, total = (low - held[0].before, held[0].total) if held else (0, 0)
    rows = rows.orderBy(*_keys(index)).offset(skip).limit(size)
    return rows.drop(RANGE).withColumn("total_count", F.lit(total).cast("long"))


def _keys(index: Index) -> list[Column]:
    return [F.asc_nulls_last(c) if up else F.desc_nulls_first(c) for c, up in index.order()]


def _value(v) -> Column:
    return F.lit(v).cast("date") if isinstance(v, dt.date) and not isinstance(v, dt.datetime) else F.lit(v)


def after(order: list[tuple[str, bool]], last: dict) -> Column:
    """Whether a row comes after the row ``last`` in an order of mixed directions; NULLs are greatest either way.

    Never NULL itself: a NULL key is a value with a place in the order.
    """
    out = F.lit(False)
    for c, up in reversed(order):
        key, v = F.col(c), last[c]
        if v is None:
            beyond, level = (F.lit(False) if up else key.isNotNull()), key.isNull()
        else:
            beyond = (key.isNull() | (key > _value(v))) if up else (key < _value(v))
            level = key == _value(v)
        out = F.coalesce(beyond, F.lit(False)) | (F.coalesce(level, F.lit(False)) & out)
    return out


def _first_range(index: Index, last: dict) -> int | None:
    """The first range that can hold a row after ``last``: its sort column isn't wholly before the known value."""
    (c, up), *_ = index.order()
    v = last[c]
    if v is None:
        reach = F.lit(True) if not up else F.col("nulls") > 0
    elif up:
        reach = (F.col("nulls") > 0) | (F.col("high") >= _value(v))
    else:
        reach = F.col("low") <= _value(v)
    return index.ranges.where(reach).agg(F.min(RANGE)).first()[0]


def page_after(index: Index, last: dict, size: int = browse.DEFAULT_PAGE_SIZE, filters: browse.Filters | None = None) -> DataFrame:
    """The page that follows the row ``last`` (its sort column and primary key), whether or not that row exists.

    Reading starts at the row's range and takes in twice as many ranges as long as the filters leave the page short.
    """
    size = browse.clamp_page_size(size)
    first, end = _first_range(index, last), index.ranges.agg(F.max(RANGE)).first()[0]
    spec, wide = browse.spec_of(index.key), SEEK_RANGES
    if first is None:
        return index.read(F.lit(False)).drop(RANGE)
    while True:
        rows = browse.filtered(index.read(F.col(RANGE).between(first, first + wide - 1)), spec, filters or browse.Filters())
        rows = rows.where(after(index.order(), last)).orderBy(*_keys(index)).limit(size)
        if first + wide > end or rows.count() == size:
            return rows.drop(RANGE)
        wide *= 2
