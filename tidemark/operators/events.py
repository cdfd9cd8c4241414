"""Scheduled event occurrences and their place on the spine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import scalar
from tidemark.operators.asof import map_to_session, session_index
from tidemark.operators.macro import first_prints

# Fixed values.
SOURCES = {
    "fomc": "federal_reserve_fomc_historical",
    "cpi": "alfred_cpiaucsl_first_print",
    "employment_situation": "alfred_unrate_first_print",
    "election": "us_statutory_election_day",
}
COVERAGE_START = "1957-01-01"


def _canonical(df: DataFrame, event_type: str, reference, timing) -> DataFrame:
    session, time = timing
    nothing = F.lit(None).cast("string")
    x = df.select(
        F.lit(event_type).alias("event_type"), "event_date", nothing.alias("symbol"),
        reference.alias("reference_period"), session.alias("release_session"),
        time.alias("event_time_et"), F.lit(SOURCES[event_type]).alias("source"),
    )
    ident = scalar.event_id(F.col("event_type"), F.col("event_date"), F.col("reference_period"), F.col("symbol"))
    return x.select(ident.alias("event_id"), *x.columns)


def meeting_events(days: DataFrame) -> DataFrame:
    """(event_date) of scheduled meetings to canonical rows, one per day."""
    d = days.select("event_date").distinct()
    return _canonical(d, "fomc", F.lit(None).cast("string"), scalar.meeting_timing(F.col("event_date")))


def release_events(vintages: DataFrame, event_type: str, start: str = COVERAGE_START) -> DataFrame:
    """First prints of a monthly series: one event per reference month, on the first release day."""
    p = first_prints(vintages).where(F.dayofmonth("ref_date") == 1)
    p = p.where(F.col("realtime_start") >= F.lit(start).cast("date"))
    p = p.select(F.col("realtime_start").alias("event_date"), "ref_date")
    out = _canonical_release(p, event_type)
    return out.dropDuplicates(["event_id"])


def _canonical_release(p: DataFrame, event_type: str) -> DataFrame:
    x = p.select("event_date", scalar.reference_month(F.col("ref_date")).alias("_ref"))
    return _canonical(x, event_type, F.col("_ref"), scalar.release_timing(F.col("event_date")))


def election_events(days: DataFrame) -> DataFrame:
    return _canonical(days, "election", F.col("kind"), scalar.election_timing(F.col("event_date")))


def scheduled_events(families: list[DataFrame], spine: DataFrame, start: str = COVERAGE_START) -> DataFrame:
    """Union of the event families, from ``start`` to the earlier of the last session and today."""
    end = spine.agg(F.least(F.max("date"), F.to_date(F.from_utc_timestamp(F.current_timestamp(), "America/New_York")))).scalar()
    every = reduce(lambda a, b: a.unionByName(b), families)
    return every.where((F.col("event_date") >= F.lit(start).cast("date")) & (F.col("event_date") <= end))


def by_type(events: DataFrame, types: list[str] = schemas.EVENT_TYPES) -> DataFrame:
    """(event_type, event_date) of the wanted families, in long form."""
    return events.where(F.col("event_type").isin(types)).select("event_type", "event_date")


def event_flags(trading: DataFrame, events: DataFrame) -> DataFrame:
    """(date, flags): true where the raw event date is the session itself."""
    e = by_type(events)
    flags = e.groupBy(F.col("event_date").alias("date")).agg(
        *[F.bool_or(F.col("event_type") == t).alias(flag) for t, (flag, _) in schemas.EVENT_FLAGS.items()]
    )
    x = trading.select("date").join(flags, "date", "left")
    return x.select("date", *[F.coalesce(f, F.lit(False)).alias(f) for f, _ in schemas.EVENT_FLAGS.values()])


def anchors(events: DataFrame, spine: DataFrame) -> DataFrame:
    """(event_type, session): each event's own or next session, each once; none past the last session."""
    return (
        map_to_session(by_type(events), spine, "event_date", "pre_open")
        .where("session IS NOT NULL").select("event_type", "session").distinct()
    )


def sessions_since(trading: DataFrame, events: DataFrame) -> DataFrame:
    """(date, days_since_last_*): sessions since the latest anchored event; NULL before the first."""
    idx = session_index(trading)
    hits = anchors(events, trading).groupBy(F.col("session").alias("date")).agg(
        *[F.bool_or(F.col("event_type") == t).alias(f"_{t}") for t in schemas.EVENT_FLAGS]
    )
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    x = idx.join(hits, "date", "left")
    return x.select(
        "date",
        *[
            (F.col("i") - F.last(F.when(F.col(f"_{t}"), F.col("i")), ignorenulls=True).over(so_far)).alias(since)
            for t, (_, since) in schemas.EVENT_FLAGS.items()
        ],
    )
