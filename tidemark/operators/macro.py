"""Macro series on the spine: point-in-time readings, current series, regime labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import scalar
from tidemark.operators import asof
from tidemark.operators.rank import earlier_not_above, tercile

# series -> (field, point-in-time vintages, year-on-year, carried forward, timing)
# The stand-in series take the places of the landed ones.
FIELDS = {
    "cpi": "inflation_rate",
    "core": "core_inflation_rate",
    "unrate": "unemployment_rate",
    "icsa": "jobless_claims",
    "dff": "fed_funds_rate",
    "dgs2": "treasury_2y_yield",
    "dgs10": "treasury_10y_yield",
    "walcl": "fed_balance_sheet",
    "baa10y": "credit_spread",
}
YOY_SERIES = ("cpi", "core")


def parse_vintages(raw: DataFrame) -> DataFrame:
    """Text observations to typed vintages: missing values dropped, any other bad number an error."""
    return raw.select(
        *[c for c in raw.columns if c not in ("date", "value", "realtime_start", "realtime_end")],
        scalar.iso_day(F.col("date")).alias("ref_date"),
        scalar.strict_number(F.col("value")).alias("value"),
        scalar.iso_day(F.col("realtime_start")).alias("realtime_start"),
        scalar.iso_day(F.col("realtime_end")).alias("realtime_end"),
    ).where("value IS NOT NULL")


def first_prints(vintages: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The earliest print of each reference date; equal starts keep the earlier input row."""
    keys = keys or []
    first = F.min_by(F.struct("value", "realtime_start"), F.struct("realtime_start", "ordinal")).alias("f")
    return vintages.groupBy(*keys, "ref_date").agg(first).select(
        *keys, "ref_date", F.col("f.value").alias("value"), F.col("f.realtime_start").alias("realtime_start")
    )


def release_days(vintages: DataFrame) -> DataFrame:
    """(series, as_of): the only days a state can gain something, so the only ones worth evaluating."""
    return vintages.select("series", F.col("realtime_start").alias("as_of")).distinct()


def pit_readings(vintages: DataFrame, yoy_series: tuple[str, ...] = YOY_SERIES) -> DataFrame:
    """(series, as_of, reading): newest reference date's level, or its change on the year, on each release day."""
    latest = asof.latest_state(vintages, release_days(vintages), ["series"])
    latest = latest.withColumn("base_ref", asof.year_before(F.col("ref_date")))
    x = asof.value_at(latest, vintages, "base_ref", "base", ["series"])
    reading = F.when(F.col("series").isin(*yoy_series), asof.yoy(F.col("value"), F.col("base"))).otherwise(F.col("value"))
    return x.select("series", "as_of", reading.alias("reading"))


def sparse_pit(vintages: DataFrame, spine: DataFrame, timing: str = "pre_open") -> DataFrame:
    """(series, date, value): readings on their sessions; the later calendar day wins a shared session.

    A NULL reading emits nothing, so it never clears the carried value.
    """
    r = pit_readings(vintages).where("reading IS NOT NULL")
    on = asof.map_to_session(r, spine, "as_of", timing).where("session IS NOT NULL")
    return on.groupBy("series", F.col("session").alias("date")).agg(F.max_by("reading", "as_of").alias("value"))


def sparse_current(observations: DataFrame, spine: DataFrame, timing: str, shift_days: int = 0) -> DataFrame:
    """(series, date, value) of a current series; the later observation wins a shared session.

    Of equal observation dates the later row wins, by the input's ``ordinal``; without
    that column, the larger value.
    """
    tie = "ordinal" if "ordinal" in observations.columns else "value"
    x = observations.select(
        "series", F.col("date").alias("obs"), scalar.strict_number(F.col("value").cast("string")).alias("value"), F.col(tie).alias("_tie")
    ).where("value IS NOT NULL")
    x = x.withColumn("known", F.date_add("obs", shift_days))
    on = asof.map_to_session(x, spine, "known", timing).where("session IS NOT NULL")
    last = F.max_by("value", F.struct("obs", "_tie"))
    return on.groupBy("series", F.col("session").alias("date")).agg(last.alias("value"))


def carried(sparse: DataFrame, spine: DataFrame) -> DataFrame:
    """(series, date, value): every session of every series, last reading carried forward."""
    grid = asof.spine_by_series(spine, sparse.select("series").distinct())
    return asof.forward_fill(grid.join(sparse, ["series", "date"], "left"), "value", keys=["series"])


def macro_levels(vintages: DataFrame, daily: DataFrame, weekly: DataFrame, spine: DataFrame) -> DataFrame:
    """One row per session with the nine level fields.

    The wide columns are carried forward on the spine itself, one window for all.
    """
    sparse = (
        sparse_pit(vintages, spine)
        .unionByName(sparse_current(daily, spine, "observation_date"))
        .unionByName(sparse_current(weekly, spine, "after_close", shift_days=1))
    )
    wide = asof.reindex(sparse, spine, FIELDS)
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    keep = {FIELDS[s] for s in ("cpi", "core", "unrate", "icsa", "walcl")}
    return wide.select(
        "date", *[F.last(c, ignorenulls=True).over(so_far).alias(c) if c in keep else F.col(c) for c in FIELDS.values()]
    )


def release_yoy(vintages: DataFrame, spine: DataFrame, timing: str = "pre_open") -> DataFrame:
    """(date, yoy): one change on the year per first print, in the state of its own release day."""
    p = first_prints(vintages).select(F.col("realtime_start").alias("as_of"), "ref_date")
    p = p.withColumn("base_ref", asof.year_before(F.col("ref_date")))
    x = asof.value_at(p, vintages, "ref_date", "cur")
    x = asof.value_at(x, vintages, "base_ref", "base")
    x = x.withColumn("yoy", asof.yoy(F.col("cur"), F.col("base"))).where("yoy IS NOT NULL")
    on = asof.map_to_session(x, spine, "as_of", timing).where("session IS NOT NULL")
    return on.groupBy(F.col("session").alias("date")).agg(
        F.max_by("yoy", F.struct("as_of", "ref_date")).alias("yoy")
    )


def inflation_regime(levels: DataFrame, releases: DataFrame, least: int = schemas.MIN_RELEASES) -> DataFrame:
    """(date, inflation_regime): tercile of the carried rate among releases available by each session.

    Releases and sessions are put in one sequence (releases first on a shared
    day) and earlier releases not above the rate are counted.
    """
    points = releases.select("date", F.lit(0).alias("side"), F.col("yoy").alias("v"))
    asks = levels.where("inflation_rate IS NOT NULL").select("date", F.lit(1).alias("side"), F.col("inflation_rate").alias("v"))
    both = points.unionByName(asks)
    ranked = earlier_not_above(both, [], ["date", "side"], "v", 1 - F.col("side"))
    n = F.sum(1 - F.col("side")).over(Window.orderBy("date", "side"))
    return ranked.select("date", "side", tercile(F.col("k"), n, least).alias("inflation_regime")).where("side = 1").drop("side")


def rate_label(cur, prior):
    return (
        F.when(cur.isNull() | prior.isNull(), None)
        .when(cur - prior <= -schemas.RATE_THRESHOLD, "easing")
        .when(cur - prior >= schemas.RATE_THRESHOLD, "tightening")
        .otherwise("stable")
    )


def rate_regime(levels: DataFrame, rate: str = "fed_funds_rate") -> DataFrame:
    """(date, rate_regime): against the 63rd earlier known observation; NULL where the rate is."""
    known = levels.where(F.col(rate).isNotNull()).select("date", rate)
    prior = F.lag(rate, schemas.RATE_LOOKBACK).over(Window.orderBy("date"))
    return known.select("date", rate_label(F.col(rate), prior).alias("rate_regime"))


def macro_labels(levels: DataFrame, releases: DataFrame) -> DataFrame:
    """Levels with the spread and both regime labels: the macro_conditions table."""
    x = levels.join(inflation_regime(levels, releases), "date", "left").join(rate_regime(levels), "date", "left")
    return x.withColumn(
        "yield_curve_10y_2y", scalar.spread(F.col("treasury_10y_yield"), F.col("treasury_2y_yield"))
    )
