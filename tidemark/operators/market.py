"""Price panel derivations per symbol: daily fields and forward outcomes.

The panel's key is (symbol, date), so one symbol never has more than 366 rows a
year and its window group is bounded by the calendar; work spreads over symbols
and over column-pruned scans.  Series with no such bound (ticks) go through
``operators.longseries``, which splits one series over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.scalar import change, ratio



def by_symbol():
    return Window.partitionBy("symbol").orderBy("date")


def is_close_only(close_only: list[str]) -> Column:
    return F.upper("symbol").isin([s.upper() for s in close_only])


def price(close_only: list[str]) -> Column:
    """The level returns are taken on: close for close-only symbols, adjusted close otherwise."""
    return F.when(is_close_only(close_only), F.col("close")).otherwise(F.col("adj_close"))


def full_only(c: Column, close_only: list[str]) -> Column:
    return F.when(~is_close_only(close_only), c)


def return_1d(close_only: list[str]) -> Column:
    p = price(close_only)
    return change(p, F.lag(p).over(by_symbol()))


def gap_pct(close_only: list[str]) -> Column:
    return full_only(change(F.col("adj_open"), F.lag("adj_close").over(by_symbol())), close_only)


def intraday_return(close_only: list[str]) -> Column:
    return full_only(change(F.col("close"), F.col("open")), close_only)


def range_pct(close_only: list[str]) -> Column:
    return full_only(ratio(F.col("high") - F.col("low"), F.col("open")), close_only)


def drawdown_from_high(close_only: list[str]) -> Column:
    p = price(close_only)
    return change(p, F.max(p).over(by_symbol().rowsBetween(Window.unboundedPreceding, 0)))


def daily_fields(observed: DataFrame, close_only: list[str]) -> DataFrame:
    """Observed bars plus the five derived columns, in one window pass."""
    return observed.select(
        "date", "symbol", *schemas.OBSERVED_COLUMNS,
        return_1d(close_only).alias("return_1d"),
        gap_pct(close_only).alias("gap_pct"),
        intraday_return(close_only).alias("intraday_return"),
        range_pct(close_only).alias("range_pct"),
        drawdown_from_high(close_only).alias("drawdown_from_high"),
    )


# ------------------------------------------------------- forward outcomes
def forward_return(p: Column, n: int) -> Column:
    return change(F.lead(p, n).over(by_symbol()), p)


def forward_extremes(n: int) -> tuple[Column, Column]:
    """(max up, max down) over the next n rows; NULL unless all n highs and all n lows exist."""
    nxt = by_symbol().rowsBetween(1, n)
    whole = (F.count("adj_high").over(nxt) == n) & (F.count("adj_low").over(nxt) == n)
    base = F.col("adj_close")
    return (
        F.when(whole, change(F.max("adj_high").over(nxt), base)),
        F.when(whole, change(F.min("adj_low").over(nxt), base)),
    )


def forward_outcomes(bars: DataFrame, close_only: list[str]) -> DataFrame:
    """Forward returns, extremes and positive flags; incomplete horizons stay NULL."""
    p = price(close_only)
    x = bars.select("date", "symbol", "close", "adj_close", "adj_high", "adj_low")
    cols = [forward_return(p, n).alias(f"return_{n}d") for n in schemas.RETURN_HORIZONS]
    for n in schemas.EXTREME_HORIZONS:
        up, down = forward_extremes(n)
        cols += [
            full_only(up, close_only).alias(f"max_up_{n}d"),
            full_only(down, close_only).alias(f"max_down_{n}d"),
        ]
    x = x.select("date", "symbol", *cols)
    return x.select("*", *[(F.col(f"return_{n}d") > 0).alias(f"positive_{n}d") for n in schemas.FLAG_HORIZONS])
