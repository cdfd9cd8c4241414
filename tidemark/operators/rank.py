"""Counting earlier rows with a value not above the current one.

Spark's rank functions refuse running frames, and a self-join is quadratic.
Number a group's rows 0..n-1 in order and write the numbers in base 16.  An
earlier row j and a later row i first differ, from the top, at one digit, where
j's is the smaller.  So for each digit position, rows sharing the higher digits
form a group in which one window ordered by value keeps a running count per
digit, and each row adds the counts of the smaller digits.  Every pair is counted
once: n log16 n rows, one shuffle for all positions, and none where the rows already
lie by key: the row itself travels with its first digit, so it's not joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 4


def earlier_not_above(
    df: DataFrame, keys: list[str], order: list[str], value: str, weight: Column | None = None, out: str = "k"
) -> DataFrame:
    """Add ``out``: total weight (1 by default) of rows strictly before each row, in
    ``order`` within ``keys``, whose ``value`` is <= the row's.  (keys, order) is unique."""
    w = Window.partitionBy(*keys)
    n = df.withColumn("_w", (weight if weight is not None else F.lit(1)).cast("bigint"))
    n = n.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    top = F.ceil(F.log2(F.greatest(F.col("_n"), F.lit(2))) / BITS).cast("int") - 1
    rest = {f"_r{j}": c for j, c in enumerate(df.columns) if c not in keys}  # carried by the rows of the first digit
    at = n.select(*keys, *[F.col(c).alias(r) for r, c in rest.items()], "_i", "_w", F.col(value).alias("_v"), F.explode(F.sequence(F.lit(0), top)).alias("_l"))
    at = at.withColumns({r: F.when(F.col("_l") == 0, F.col(r)) for r in rest})
    at = at.withColumn("_g", F.expr(f"shiftright(_i, {BITS} * (_l + 1))"))
    at = at.withColumn("_d", F.expr(f"shiftright(_i, {BITS} * _l) & {2**BITS - 1}"))
    below = Window.partitionBy(*keys, "_l", "_g").orderBy("_v").rangeBetween(Window.unboundedPreceding, 0)
    counts = [F.sum(F.when(F.col("_d") < d, F.col("_w"))).over(below).alias(f"_c{d}") for d in range(1, 2**BITS)]
    part = at.select(*keys, *rest, "_i", "_d", "_l", *counts).where("_d > 0 OR _l = 0")
    mine = F.when(F.col("_d") > 0, F.array(*[F.col(f"_c{d}") for d in range(1, 2**BITS)])[F.col("_d") - 1])
    whole = [F.first(r, ignorenulls=True).alias(c) for r, c in rest.items()]
    counted = part.groupBy(*keys, "_i").agg(*whole, F.sum(mine).alias("_k"))
    return counted.select(*df.columns, F.coalesce("_k", F.lit(0)).alias(out))


def tercile(k: Column, n: Column, least: int) -> Column:
    """low / normal / high for a share k/n of at most 1/3, at most 2/3, above; NULL under ``least``."""
    return (
        F.when(n < least, None)
        .when(3 * k <= n, "low")
        .when(3 * k <= 2 * n, "normal")
        .when(n.isNotNull(), "high")
    )


def expanding_tercile(df: DataFrame, keys: list[str], order: str, value: str, least: int, out: str) -> DataFrame:
    """(keys, order, out): label of each non-NULL value by its rank among those seen so far, itself included."""
    w = (Window.partitionBy(*keys) if keys else Window).orderBy(order)
    seen = df.where(F.col(value).isNotNull()).select(*keys, order, value, F.row_number().over(w).alias("_nth"))
    ranked = earlier_not_above(seen, keys, ["_nth"], value)  # the rank and the number of rows so far go by one numbering
    return ranked.select(*keys, order, tercile(F.col("k") + 1, F.col("_nth"), least).alias(out))
