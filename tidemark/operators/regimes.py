"""Trailing regime descriptions per symbol."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.scalar import change
from tidemark.operators.market import by_symbol, price
from tidemark.operators.rank import expanding_tercile


def last_n(n: int):
    return by_symbol().rowsBetween(-(n - 1), 0)


def trailing_return(p: Column, n: int) -> Column:
    return change(p, F.lag(p, n).over(by_symbol()))


def simple_average(p: Column, n: int) -> Column:
    """Mean of the last n rows, NULL until n non-NULL ones exist."""
    return F.when(F.count(p).over(last_n(n)) == n, F.avg(p).over(last_n(n)))


def annualised_volatility(r: Column, n: int = schemas.VOL_WINDOW) -> Column:
    """Sample deviation of n returns scaled to a year; NULL unless all n exist."""
    whole = F.count(r).over(last_n(n)) == n
    return F.when(whole, F.stddev_samp(r).over(last_n(n)) * math.sqrt(schemas.SESSIONS_PER_YEAR))


def trend_label(p: Column, s50: Column, s200: Column) -> Column:
    return (
        F.when(p.isNull() | s50.isNull() | s200.isNull(), None)
        .when((p > s200) & (s50 > s200), "uptrend")
        .when((p < s200) & (s50 < s200), "downtrend")
        .otherwise("neutral")
    )


def momentum_label(r20: Column, r60: Column) -> Column:
    return (
        F.when(r20.isNull() | r60.isNull(), None)
        .when((r20 > 0) & (r60 > 0), "positive")
        .when((r20 < 0) & (r60 < 0), "negative")
        .otherwise("mixed")
    )


def asset_types(df: DataFrame, universe: DataFrame) -> DataFrame:
    """Add asset_type; a symbol outside the universe is an error."""
    u = universe.select(F.col("symbol").alias("_u"), "asset_type")
    unknown = F.raise_error(F.concat(F.lit("unknown symbol "), F.col("symbol")))
    return df.join(u, F.col("symbol") == F.col("_u"), "left").withColumn(
        "asset_type", F.when(F.col("_u").isNull(), unknown.cast("string")).otherwise(F.col("asset_type"))
    ).drop("_u")


def volatility_regime(vols: DataFrame) -> DataFrame:
    """(symbol, date, volatility_regime): terciles of the symbol's own history up to each day."""
    return expanding_tercile(
        vols, ["symbol"], "date", "volatility_20d", schemas.VOL_MIN_OBSERVATIONS, "volatility_regime"
    )


def trailing_fields(daily: DataFrame, universe: DataFrame, close_only: list[str]) -> DataFrame:
    """Everything but the expanding volatility label, in one window pass."""
    p = F.col("p")
    x = asset_types(daily, universe).withColumn("p", price(close_only))
    x = x.select(
        "date", "symbol", "asset_type", "p",
        *[trailing_return(p, n).alias(f"return_{n}d") for n in schemas.TRAILING_HORIZONS],
        *[simple_average(p, n).alias(f"sma_{n}") for n in schemas.SMA_WINDOWS],
        annualised_volatility(F.col("return_1d")).alias("volatility_20d"),
        F.col("drawdown_from_high").alias("drawdown_pct"),
    )
    return x.select(
        "date", "symbol", "asset_type",
        *[f"return_{n}d" for n in schemas.TRAILING_HORIZONS],
        *[(p > F.col(f"sma_{n}")).alias(f"above_{n}dma") for n in schemas.SMA_WINDOWS],
        *[change(p, F.col(f"sma_{n}")).alias(f"distance_{n}dma_pct") for n in schemas.SMA_WINDOWS],
        "volatility_20d", "drawdown_pct",
        trend_label(p, F.col("sma_50"), F.col("sma_200")).alias("trend_regime"),
        momentum_label(F.col("return_20d"), F.col("return_60d")).alias("momentum_regime"),
    )


def asset_regimes(daily: DataFrame, universe: DataFrame, close_only: list[str]) -> DataFrame:
    """The asset_regimes table from daily bars with derived fields.

    The trailing fields are needed twice (once for the ranks): write them where the
    panel is large, and take ``labelled``.
    """
    return labelled(trailing_fields(daily, universe, close_only))


def labelled(trailing: DataFrame) -> DataFrame:
    """Trailing fields with the expanding volatility label.

    A symbol's labels, one for each known volatility, meet its rows as one array in date order (the calendar bounds it): a
    join by symbol alone, for which rows that lie by symbol stay in place. A row takes the labels of its day from the array,
    as a join by day would give them where days repeat.
    """
    labels = volatility_regime(trailing.select("symbol", "date", "volatility_20d"))
    known = labels.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("date", "volatility_regime"))).alias("_labels"))
    through = F.count("volatility_20d").over(by_symbol().rangeBetween(Window.unboundedPreceding, 0)).cast("int")
    today = F.count("volatility_20d").over(Window.partitionBy("symbol", "date")).cast("int")
    joined = trailing.withColumns({"_through": through, "_today": today}).join(known, "symbol", "left")
    found = F.when(F.col("date").isNotNull(), F.slice("_labels", F.col("_through") - F.col("_today") + 1, F.col("_today")))
    out = joined.select(*trailing.columns, F.explode_outer(found).alias("_label"))
    return out.select(*trailing.columns, F.col("_label.volatility_regime").alias("volatility_regime"))


def full_sample_tercile(df: DataFrame, value: str, out: str) -> DataFrame:
    """Label by rank in the symbol's whole history: the look-ahead form a point-in-time label must differ from."""
    share = F.cume_dist().over(Window.partitionBy("symbol").orderBy(value))
    return df.where(F.col(value).isNotNull()).select(
        "symbol", "date",
        F.when(share <= 1.0 / 3.0, "low").when(share <= 2.0 / 3.0, "normal").otherwise("high").alias(out),
    )
