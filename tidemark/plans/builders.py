"""The seven canonical tables, composed from operators over the input recipes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import calendar, events, macro, market, regimes
from tidemark.plans import recipes as r
from tidemark.plans.store import stored
from tidemark.sources import html
from tidemark.sources.calendar import election_days


def trading_days(spark: SparkSession, sf: str) -> DataFrame:
    return schemas.conform(calendar.trading_days(r.spine(spark, sf)), "trading_days")


def daily_market_data(spark: SparkSession, sf: str) -> DataFrame:
    return schemas.conform(market.daily_fields(r.bars(spark, sf), r.CLOSE_ONLY), "daily_market_data")


def market_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    daily = table(spark, sf, "daily_market_data")
    return schemas.conform(market.forward_outcomes(daily, r.CLOSE_ONLY), "market_outcomes")


def asset_regimes(spark: SparkSession, sf: str) -> DataFrame:
    trailing = stored(spark, sf, "trailing_fields", _trailing, together=PANEL_ORDER)  # the window pass is read twice
    return schemas.conform(regimes.labelled(trailing), "asset_regimes")


def _trailing(spark: SparkSession, sf: str) -> DataFrame:
    return regimes.trailing_fields(table(spark, sf, "daily_market_data"), r.universe(spark), r.CLOSE_ONLY)


def macro_levels(spark: SparkSession, sf: str) -> DataFrame:
    return macro.macro_levels(
        r.vintages(spark, sf), r.observations(spark, sf), r.weekly_level(spark, sf), r.spine(spark, sf)
    )


def macro_conditions(spark: SparkSession, sf: str) -> DataFrame:
    levels = stored(spark, sf, "macro_levels", macro_levels)
    releases = macro.release_yoy(r.vintages(spark, sf).where("series = 'cpi'"), r.spine(spark, sf))
    return schemas.conform(macro.macro_labels(levels, releases), "macro_conditions")


def event_families(spark: SparkSession, sf: str) -> list[DataFrame]:
    v = r.vintages(spark, sf)
    return [
        events.meeting_events(html.meeting_days(r.heading_pages(spark, sf), "page_id")),
        events.release_events(v.where("series = 'cpi'"), "cpi"),
        events.release_events(v.where("series = 'unrate'"), "employment_situation"),
        events.election_events(election_days(r.order_span(spark, sf))),
    ]


def scheduled_events(spark: SparkSession, sf: str) -> DataFrame:
    e = events.scheduled_events(event_families(spark, sf), r.spine(spark, sf))
    return schemas.conform(e, "scheduled_events")


def holiday_catalog(spark: SparkSession, sf: str) -> DataFrame:
    c = r.closures(spark, sf)
    rules = c.where("type = 'regular'").select("date", "name", F.lit(1).alias("position"))
    return calendar.holiday_catalog(rules, c.where("type = 'exceptional'"))


def calendar_context(spark: SparkSession, sf: str) -> DataFrame:
    c = calendar.calendar_context(
        table(spark, sf, "trading_days"), table(spark, sf, "scheduled_events"),
        holiday_catalog(spark, sf), r.early_closes(spark, sf),
    )
    return schemas.conform(c, "calendar_context")


PANEL_ORDER = ("symbol", "date")  # a symbol's rows of every panel table lie together, in date order
PANEL = ("daily_market_data", "market_outcomes", "asset_regimes")

BUILDERS = {
    "trading_days": trading_days,
    "daily_market_data": daily_market_data,
    "market_outcomes": market_outcomes,
    "asset_regimes": asset_regimes,
    "macro_conditions": macro_conditions,
    "scheduled_events": scheduled_events,
    "calendar_context": calendar_context,
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A canonical table as written parquet, built on first use."""
    return stored(spark, sf, name, BUILDERS[name], together=PANEL_ORDER if name in PANEL else None)


def tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {t: table(spark, sf, t) for t in schemas.TABLE_COLUMNS}
