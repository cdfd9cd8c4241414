"""Queries over the price panel: daily fields, forward outcomes, regimes, table builders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import market, rank, regimes
from tidemark.plans import builders as b
from tidemark.plans import recipes as r
from tidemark.plans.registry import query

DMD = "return_1d gap_pct intraday_return range_pct drawdown_from_high"
OUT = " ".join(c for c, t in schemas.TABLE_COLUMNS["market_outcomes"] if t == "double")
REG = " ".join(c for c, t in schemas.TABLE_COLUMNS["asset_regimes"] if t == "double")


def _all(table: str) -> str:
    return f"SELECT {', '.join(schemas.columns(table))} FROM {table}"


def bars(spark, sf):
    return r.bars(spark, sf)


def daily(spark, sf):
    return b.table(spark, sf, "daily_market_data")


@query("w1_return_1d", "SELECT date, symbol, return_1d FROM daily_market_data", "return_1d")
def _(spark, sf):
    return bars(spark, sf).select("date", "symbol", market.return_1d(r.CLOSE_ONLY).alias("return_1d"))


@query("w2_gap_pct", "SELECT date, symbol, gap_pct FROM daily_market_data", "gap_pct")
def _(spark, sf):
    return bars(spark, sf).select("date", "symbol", market.gap_pct(r.CLOSE_ONLY).alias("gap_pct"))


@query("w3_intraday_and_range", "SELECT date, symbol, intraday_return, range_pct FROM daily_market_data", "intraday_return range_pct")
def _(spark, sf):
    return bars(spark, sf).select(
        "date", "symbol", market.intraday_return(r.CLOSE_ONLY).alias("intraday_return"), market.range_pct(r.CLOSE_ONLY).alias("range_pct")
    )


@query("w4_drawdown_from_high", "SELECT date, symbol, drawdown_from_high FROM daily_market_data", "drawdown_from_high")
def _(spark, sf):
    return bars(spark, sf).select("date", "symbol", market.drawdown_from_high(r.CLOSE_ONLY).alias("drawdown_from_high"))


RETURNS = [f"return_{n}d" for n in schemas.RETURN_HORIZONS]


@query("w5_forward_returns", f"SELECT date, symbol, {', '.join(RETURNS)} FROM market_outcomes", " ".join(RETURNS))
def _(spark, sf):
    p = market.price(r.CLOSE_ONLY)
    return bars(spark, sf).select(
        "date", "symbol", *[market.forward_return(p, n).alias(f"return_{n}d") for n in schemas.RETURN_HORIZONS]
    )


EXT = [f"max_{w}_{n}d" for n in schemas.EXTREME_HORIZONS for w in ("up", "down")]


@query("w6_forward_extremes", f"SELECT date, symbol, {', '.join(EXT)} FROM market_outcomes", " ".join(EXT))
def _(spark, sf):
    return market.forward_outcomes(bars(spark, sf), r.CLOSE_ONLY).select("date", "symbol", *EXT)


FLAGS = [f"positive_{n}d" for n in schemas.FLAG_HORIZONS]


@query("w7_forward_positive_flags", f"SELECT date, symbol, {', '.join(FLAGS)} FROM market_outcomes")
def _(spark, sf):
    return market.forward_outcomes(bars(spark, sf), r.CLOSE_ONLY).select("date", "symbol", *FLAGS)


def trailing(spark, sf):
    return regimes.trailing_fields(daily(spark, sf), r.universe(spark), r.CLOSE_ONLY)


TR = [f"return_{n}d" for n in schemas.TRAILING_HORIZONS]


@query("w14_trailing_returns", f"SELECT date, symbol, {', '.join(TR)} FROM trail_stats", " ".join(TR))
def _(spark, sf):
    return trailing(spark, sf).select("date", "symbol", *TR)


SMA = [c for n in schemas.SMA_WINDOWS for c in (f"above_{n}dma", f"distance_{n}dma_pct")]


@query("w15_moving_averages", f"SELECT date, symbol, {', '.join(SMA)} FROM asset_regimes", " ".join(c for c in SMA if "distance" in c))
def _(spark, sf):
    return trailing(spark, sf).select("date", "symbol", *SMA)


@query("w16_annualised_volatility", "SELECT date, symbol, volatility_20d FROM trail_stats", "volatility_20d")
def _(spark, sf):
    return trailing(spark, sf).select("date", "symbol", "volatility_20d")


@query("w17_trend_regime", "SELECT date, symbol, trend_regime FROM asset_regimes")
def _(spark, sf):
    return trailing(spark, sf).select("date", "symbol", "trend_regime")


@query("w18_momentum_regime", "SELECT date, symbol, momentum_regime FROM asset_regimes")
def _(spark, sf):
    return trailing(spark, sf).select("date", "symbol", "momentum_regime")


@query("w19_expanding_volatility_regime", "SELECT date, symbol, volatility_regime FROM asset_regimes WHERE volatility_20d IS NOT NULL")
def _(spark, sf):
    return regimes.volatility_regime(b.table(spark, sf, "asset_regimes").select("symbol", "date", "volatility_20d"))


@query("w19_expanding_rank_counts", "SELECT date, symbol, k, n FROM vol_rank")
def _(spark, sf):
    v = b.table(spark, sf, "asset_regimes").where("volatility_20d IS NOT NULL").select("symbol", "date", "volatility_20d")
    ranked = rank.earlier_not_above(v, ["symbol"], ["date"], "volatility_20d")
    return ranked.select(
        "date", "symbol", (F.col("k") + 1).cast("bigint").alias("k"), F.row_number().over(market.by_symbol()).cast("bigint").alias("n")
    )


@query("p8_asset_type", "SELECT date, symbol, CASE WHEN symbol = 'HOUSEHOLD' THEN 'commodity' ELSE 'etf' END AS asset_type, symbol = 'HOUSEHOLD' AS close_only FROM bars")
def _(spark, sf):
    x = regimes.asset_types(bars(spark, sf).select("date", "symbol"), r.universe(spark))
    return x.select("date", "symbol", "asset_type", market.is_close_only(r.CLOSE_ONLY).alias("close_only"))


@query("b1_trading_days", _all("trading_days"))
def _(spark, sf):
    return b.trading_days(spark, sf)


@query("b2_daily_market_data", _all("daily_market_data"), DMD)
def _(spark, sf):
    return b.daily_market_data(spark, sf)


@query("b3_market_outcomes", _all("market_outcomes"), OUT)
def _(spark, sf):
    return b.market_outcomes(spark, sf)


@query("b4_asset_regimes", _all("asset_regimes"), REG)
def _(spark, sf):
    return b.asset_regimes(spark, sf)


@query("b5_macro_conditions", _all("macro_conditions"), " ".join(c for c, t in schemas.TABLE_COLUMNS["macro_conditions"] if t == "double"))
def _(spark, sf):
    return b.macro_conditions(spark, sf)


@query("b6_scheduled_events", _all("scheduled_events"))
def _(spark, sf):
    return b.scheduled_events(spark, sf)


@query("b7_calendar_context", _all("calendar_context"))
def _(spark, sf):
    return b.calendar_context(spark, sf)
