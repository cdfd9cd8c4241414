"""Point-in-time alignment: spine membership, availability mapping, intervals, carries.

The trading-day spine holds at most 366 rows a year whatever the data volume,
so it and the calendar map made from it are broadcast, and windows over it
alone may run as one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIMINGS = ("pre_open", "after_close", "observation_date")


def _spine():
    """One group: the spine is bounded by the calendar."""
    return Window.orderBy("date")


# ------------------------------------------------------------------- spine
def on_spine(df: DataFrame, spine: DataFrame, date: str = "date") -> DataFrame:
    """Rows whose date is a session."""
    s = F.broadcast(spine.select(F.col("date").alias("_s")))
    return df.join(s, F.col(date) == F.col("_s"), "left_semi")


def off_spine(df: DataFrame, spine: DataFrame, date: str = "date") -> DataFrame:
    """Rows whose date is no session (the rejects)."""
    s = F.broadcast(spine.select(F.col("date").alias("_s")))
    return df.join(s, F.col(date) == F.col("_s"), "left_anti")


def reindex(series: DataFrame, spine: DataFrame, fields: dict[str, str], date: str = "date") -> DataFrame:
    """Long (date, series, value) to one wide row per session, NULL where a series has none.

    ``fields`` maps each series to its column; naming them keeps the pivot one pass.
    """
    wide = series.groupBy(date).agg(
        *[F.max(F.when(F.col("series") == s, F.col("value"))).alias(c) for s, c in fields.items()]
    )
    return spine.select("date").join(wide, "date", "left")


def session_index(spine: DataFrame) -> DataFrame:
    """(date, i): position of each session, from 1."""
    return spine.select("date", F.row_number().over(_spine()).alias("i"))


# ------------------------------------------------------------ availability
def calendar_map(spine: DataFrame) -> DataFrame:
    """One row per calendar day from the day before the first session to the last session.

    on_or_next, strictly_after: sessions (NULL past the end); i: index of the
    last session on or before the day, so equal dates differ by their sessions.
    """
    s = spine.select(
        "date",
        F.lag("date").over(_spine()).alias("prev"),
        F.lead("date").over(_spine()).alias("next"),
        F.row_number().over(_spine()).alias("n"),
    )
    start = F.coalesce(F.date_add("prev", 1), F.date_sub("date", 1))
    return s.select(F.explode(F.sequence(start, F.col("date"))).alias("day"), "date", "next", "n").select(
        "day",
        F.col("date").alias("on_or_next"),
        F.when(F.col("day") < F.col("date"), F.col("date")).otherwise(F.col("next")).alias("strictly_after"),
        (F.col("day") == F.col("date")).alias("is_session"),
        F.when(F.col("day") == F.col("date"), F.col("n")).otherwise(F.col("n") - 1).alias("i"),
    )


def map_to_session(df: DataFrame, spine: DataFrame, day: str, timing: str, out: str = "session") -> DataFrame:
    """Add the session on which something known on calendar day ``day`` is usable.

    pre_open: same session or the next one; after_close: the first session
    strictly after; observation_date: that session or none.  NULL past the last
    session.  Days before the first session share the map's leading day, so the
    join stays an equi-join.
    """
    if timing not in TIMINGS:
        raise ValueError(f"unknown timing {timing!r}")
    m = calendar_map(spine)
    lead_day = spine.agg(F.date_sub(F.min("date"), 1)).scalar()
    key = F.greatest(F.col(day), lead_day)
    target = {
        "pre_open": F.col("on_or_next"),
        "after_close": F.col("strictly_after"),
        "observation_date": F.when(F.col("is_session"), F.col("on_or_next")),
    }[timing]
    m = m.select(F.col("day").alias("_day"), target.alias(out))
    return (
        df.withColumn("_key", F.when(F.col(day).isNotNull(), key))
        .join(F.broadcast(m), F.col("_key") == F.col("_day"), "left")
        .drop("_key", "_day")
    )


def neighbours(df: DataFrame, spine: DataFrame, day: str) -> DataFrame:
    """Add prev_session (strictly before) and next_session (strictly after) for any date."""
    s = spine.select("date", F.lag("date").over(_spine()).alias("p"))
    last = spine.agg(F.max("date")).scalar()
    m = calendar_map(spine).join(s, F.col("on_or_next") == F.col("date"))
    m = m.select(F.col("day").alias("_day"), F.col("p").alias("_p"), F.col("strictly_after").alias("_n"))
    lead_day = spine.agg(F.date_sub(F.min("date"), 1)).scalar()
    joined = df.withColumn("_key", F.greatest(F.col(day), lead_day)).join(
        F.broadcast(m), F.col("_key") == F.col("_day"), "left"
    )
    past = F.col(day) > last
    return joined.select(
        *df.columns,
        F.when(past, last).otherwise(F.col("_p")).alias("prev_session"),
        F.col("_n").alias("next_session"),
    )


def neighbour_rows(df: DataFrame, sessions: DataFrame, day: str) -> DataFrame:
    """Add the whole rows of the sessions before and after any date, as structs ``previous`` and ``next``.

    ``sessions`` is the session table: one row a session, so the calendar bounds what is broadcast.
    """
    out = neighbours(df, sessions.select("date"), day)
    for side, name in (("prev_session", "previous"), ("next_session", "next")):
        rows = sessions.select(F.col("date").alias("_at"), F.struct(*sessions.columns).alias(name))
        out = out.join(F.broadcast(rows), F.col(side) == F.col("_at"), "left").drop("_at")
    return out


def sessions_between(df: DataFrame, spine: DataFrame, after: str, through: str, out: str = "lag_sessions") -> DataFrame:
    """Sessions in (after, through]; 0 where after >= through, NULL where either is NULL."""
    m = calendar_map(spine).select("day", "i")
    lead_day = spine.agg(F.date_sub(F.min("date"), 1)).scalar()
    last = spine.agg(F.max("date")).scalar()
    clip = lambda c: F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), lead_day), last))
    a = F.broadcast(m.select(F.col("day").alias("_da"), F.col("i").alias("_ia")))
    b = F.broadcast(m.select(F.col("day").alias("_db"), F.col("i").alias("_ib")))
    x = (
        df.withColumn("_ka", clip(after)).withColumn("_kb", clip(through))
        .join(a, F.col("_ka") == F.col("_da"), "left")
        .join(b, F.col("_kb") == F.col("_db"), "left")
    )
    n = F.col("_ib") - F.col("_ia")
    return x.select(*df.columns, F.when(n >= 0, n).when(n < 0, 0).alias(out))


# ------------------------------------------------------- bitemporal state
def _years(start: Column, end: Column) -> Column:
    return F.sequence(F.year(start), F.year(end))


def as_of_state(vintages: DataFrame, as_of: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, as_of, ref_date, value) knowable on each as-of day.

    A vintage holds on start <= day < end; where several hold for one reference
    date, the last in input order (``ordinal``) wins.  The interval is cut into
    calendar years, clipped to the as-of range, so the join is an equi-join on
    (keys, year) and the conditions only filter within a year.
    """
    keys = keys or []
    held = _held(vintages, as_of, keys)
    return held.groupBy(*keys, "as_of", "ref_date").agg(F.max_by("value", "ordinal").alias("value"))


LEVELS = 17  # dyadic blocks of 1 to 65,536 days: the calendar's bound


def latest_state(vintages: DataFrame, as_of: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, as_of, ref_date, value): only the newest reference date of each as-of day's state.

    An interval of days is covered by at most two blocks of each power of two, and a
    day lies in one block of each. The newest vintage of a block is found first, so
    the join is an equi-join of as many rows as vintages and days, times the levels;
    days and vintages never meet pair by pair.
    """
    keys = keys or []
    ends = as_of.agg(F.min("as_of").alias("lo"), F.max("as_of").alias("hi"))
    span = ends.select(F.struct("lo", "hi")).scalar()
    top = F.struct("ref_date", "ordinal", "value")
    v = vintages.where("realtime_start < realtime_end").select(
        *keys, top.alias("_t"), F.unix_date(F.greatest("realtime_start", span["lo"])).alias("_a"),
        F.unix_date(F.least("realtime_end", F.date_add(span["hi"], 1))).alias("_b"),
    )
    v = v.withColumn("_l", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))))
    v = v.withColumns({"_a": F.expr("shiftright(_a + shiftleft(1, _l) - 1, _l)"), "_b": F.expr("shiftright(_b, _l)")}).where("_a < _b")
    cover = F.array_compact(F.array(F.expr("IF(_a & 1 = 1, _a, NULL)"), F.expr("IF(_b & 1 = 1, _b - 1, NULL)")))
    newest = v.select(*keys, "_l", "_t", F.explode(cover).alias("_k")).groupBy(*keys, "_l", "_k").agg(F.max("_t").alias("_t"))
    days = as_of.select(*keys, "as_of").distinct().withColumn("_l", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))))
    days = days.withColumn("_k", F.expr("shiftright(unix_date(as_of), _l)"))
    found = days.join(newest, [*keys, "_l", "_k"]).groupBy(*keys, "as_of").agg(F.max("_t").alias("t"))
    return found.select(*keys, "as_of", F.col("t.ref_date").alias("ref_date"), F.col("t.value").alias("value"))


def _held(vintages: DataFrame, as_of: DataFrame, keys: list[str]) -> DataFrame:
    last = as_of.agg(F.max("as_of")).scalar()
    v = vintages.select(*keys, "ref_date", "value", "realtime_start", "realtime_end", "ordinal", last.alias("_last"))
    v = v.where("realtime_start < realtime_end AND realtime_start <= _last")
    v = v.withColumn("_y", F.explode(_years(F.col("realtime_start"), F.least(F.date_sub("realtime_end", 1), F.col("_last")))))
    a = as_of.select(*keys, "as_of", F.year("as_of").alias("_y")).distinct()
    return v.join(a, [*keys, "_y"]).where("realtime_start <= as_of AND as_of < realtime_end")


def value_at(points: DataFrame, vintages: DataFrame, ref: str, out: str, keys: list[str] | None = None) -> DataFrame:
    """Left-add the value of reference date ``ref`` in the state of each point's ``as_of`` day.

    An equi-join on (keys, reference date): a reference date has only its own revisions.
    """
    keys = keys or []
    v = vintages.select(
        *keys, F.col("ref_date").alias(ref), F.col("value").alias("_v"), F.col("ordinal").alias("_o"),
        F.col("realtime_start").alias("_a"), F.col("realtime_end").alias("_b"),
    )
    want = points.select(*keys, "as_of", ref).distinct()
    found = (
        want.join(v, [*keys, ref]).where("_a <= as_of AND as_of < _b")
        .groupBy(*keys, "as_of", ref).agg(F.max_by("_v", "_o").alias(out))
    )
    return points.join(found, [*keys, "as_of", ref], "left")


def year_before(ref: Column) -> Column:
    """The same day one year earlier; NULL for 29 February."""
    return F.when(~((F.month(ref) == 2) & (F.dayofmonth(ref) == 29)), F.add_months(ref, -12))


def yoy(cur: Column, base: Column) -> Column:
    """Percent change on the year; NULL if either is missing or the base is zero."""
    return (F.try_divide(cur, base) - 1.0) * 100.0


def yoy_in_state(state: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Add ``yoy`` inside each as-of state: a self equi-join on (keys, as_of, reference day a year before)."""
    keys = keys or []
    base = state.select(*keys, "as_of", F.col("ref_date").alias("_base"), F.col("value").alias("_v"))
    return (
        state.withColumn("_base", year_before(F.col("ref_date")))
        .join(base, [*keys, "as_of", "_base"], "left")
        .select(*state.columns, yoy(F.col("value"), F.col("_v")).alias("yoy"))
    )


# ------------------------------------------------------------------ carries
def forward_fill(df: DataFrame, value: str, order: str = "date", keys: list[str] | None = None) -> DataFrame:
    """Replace ``value`` by its last non-NULL reading so far, per series."""
    w = Window.partitionBy(*keys) if keys else Window
    frame = w.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(value, F.last(value, ignorenulls=True).over(frame))


def spine_by_series(spine: DataFrame, series: DataFrame) -> DataFrame:
    """Every session for every series: each series row carries the spine's day range and expands it.

    Size is (series x sessions), which is the result's own size.
    """
    days = spine.agg(F.sort_array(F.collect_list("date"))).scalar()  # calendar-bounded
    return series.select("series", F.explode(days).alias("date"))
