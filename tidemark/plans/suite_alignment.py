"""Queries on the spine, as-of alignment, macro series, events and calendar context."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import scalar
from tidemark.operators import asof, calendar, events, macro
from tidemark.plans import builders as b
from tidemark.plans import recipes as r
from tidemark.plans.registry import query
from tidemark.sources.calendar import election_days, session_dates

SPINE_NEXT = "(SELECT min(s.date) FROM spine s WHERE s.date >= {0})"


# ------------------------------------------------------------------- spine
@query("s9_session_calendar", "SELECT date FROM spine")
def _(spark, sf):
    return session_dates(r.order_span(spark, sf), r.closures(spark, sf))


@query("s10_election_days", "SELECT event_date, kind FROM elections")
def _(spark, sf):
    return election_days(r.order_span(spark, sf))


@query("p4_calendar_parts", """SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, CAST(isodow(o_orderdate) AS INTEGER) AS weekday,
  CAST(month(o_orderdate) AS INTEGER) AS month, CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(day(o_orderdate) AS INTEGER) AS day_of_month, CAST(week(o_orderdate) AS INTEGER) AS week_of_year FROM orders""")
def _(spark, sf):
    d = r.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    return d.select("date", *[c.alias(n) for n, c in scalar.calendar_parts(F.col("date")).items()])


COUNTERS = "trading_day_of_month trading_day_of_year days_to_month_end is_month_end is_quarter_end is_year_end prev_trading_date next_trading_date".split()


@query("w9_trading_day_counters", f"SELECT date, {', '.join(COUNTERS)} FROM trading_days")
def _(spark, sf):
    return calendar.trading_days(r.spine(spark, sf)).select("date", *COUNTERS)


@query("w10_period_transitions", "SELECT date, is_turn_of_month, is_quarter_transition, is_year_transition FROM calendar_context")
def _(spark, sf):
    t = b.table(spark, sf, "trading_days")
    return t.select("date", *[c.alias(n) for n, c in calendar.transitions().items()])


@query("w13_iso_week_sessions", "SELECT date, trading_days_in_week, is_shortened_week FROM calendar_context")
def _(spark, sf):
    return calendar.week_counts(r.spine(spark, sf))


@query("j10_gap_closures", "SELECT prev, next, closed, name, type FROM gap_days")
def _(spark, sf):
    return calendar.closed_weekdays(b.table(spark, sf, "trading_days"), b.holiday_catalog(spark, sf))


@query("j11_holiday_catalog", "SELECT date, name, type FROM closures")
def _(spark, sf):
    return b.holiday_catalog(spark, sf)


@query("a17_holiday_names", "SELECT date, is_day_before_holiday, is_day_after_holiday, holiday_name, holiday_type FROM calendar_context")
def _(spark, sf):
    return calendar.holiday_context(b.table(spark, sf, "trading_days"), b.holiday_catalog(spark, sf))


@query("u2_early_closes_on_spine", "SELECT date FROM early_closes")
def _(spark, sf):
    t = b.table(spark, sf, "trading_days")
    days = r.early_closes(spark, sf).unionByName(r.closures(spark, sf).select("date"))
    return days.select("date").intersect(t.select("date"))


# ------------------------------------------------------------- availability
def _ship_days(spark, sf):
    return r.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("day")).distinct()


SHIP = "(SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem)"


@query("j1_on_spine", "SELECT date, symbol, close FROM bars")
def _(spark, sf):
    return asof.on_spine(r.all_bars(spark, sf), r.spine(spark, sf)).select("date", "symbol", "close")


@query("j1_off_spine", "SELECT date, symbol, close FROM all_bars WHERE date NOT IN (SELECT date FROM spine)")
def _(spark, sf):
    return asof.off_spine(r.all_bars(spark, sf), r.spine(spark, sf)).select("date", "symbol", "close")


@query("j3_pre_open", f"SELECT day, (SELECT min(date) FROM spine WHERE date >= day) AS session FROM {SHIP}")
def _(spark, sf):
    return asof.map_to_session(_ship_days(spark, sf), r.spine(spark, sf), "day", "pre_open")


@query("j3_after_close", f"SELECT day, (SELECT min(date) FROM spine WHERE date > day) AS session FROM {SHIP}")
def _(spark, sf):
    return asof.map_to_session(_ship_days(spark, sf), r.spine(spark, sf), "day", "after_close")


@query("j3_observation_date", f"SELECT day, (SELECT min(date) FROM spine WHERE date = day) AS session FROM {SHIP}")
def _(spark, sf):
    return asof.map_to_session(_ship_days(spark, sf), r.spine(spark, sf), "day", "observation_date")


@query("j12_nearest_sessions", f"""SELECT day, (SELECT max(date) FROM spine WHERE date < day) AS prev_session,
  (SELECT min(date) FROM spine WHERE date > day) AS next_session FROM {SHIP}""")
def _(spark, sf):
    return asof.neighbours(_ship_days(spark, sf), r.spine(spark, sf), "day")


@query("j12_neighbour_rows", f"""SELECT day, p.date AS prev_session, p.weekday AS prev_weekday, p.trading_day_of_year AS prev_day_of_year, p.is_month_end AS prev_month_end,
  n.date AS next_session, n.weekday AS next_weekday, n.trading_day_of_year AS next_day_of_year, n.is_month_end AS next_month_end
FROM (SELECT day, (SELECT max(date) FROM spine WHERE date < day) AS a, (SELECT min(date) FROM spine WHERE date > day) AS b FROM {SHIP})
LEFT JOIN trading_days p ON p.date = a LEFT JOIN trading_days n ON n.date = b""")
def _(spark, sf):
    x = asof.neighbour_rows(_ship_days(spark, sf), b.table(spark, sf, "trading_days"), "day")
    part = lambda s, n: [F.col(f"{s}.date").alias(f"{n}_session"), F.col(f"{s}.weekday").alias(f"{n}_weekday"), F.col(f"{s}.trading_day_of_year").alias(f"{n}_day_of_year"), F.col(f"{s}.is_month_end").alias(f"{n}_month_end")]
    return x.select("day", *part("previous", "prev"), *part("next", "next"))


@query("w24_sessions_between", f"""SELECT day, CAST(day + 11 AS DATE) AS through,
  (SELECT count(*) FROM spine WHERE date > day AND date <= day + 11) AS lag_sessions FROM {SHIP}""")
def _(spark, sf):
    x = _ship_days(spark, sf).withColumn("through", F.date_add("day", 11))
    return asof.sessions_between(x, r.spine(spark, sf), "day", "through").withColumn("lag_sessions", F.col("lag_sessions").cast("bigint"))


# ------------------------------------------------------------------ vintages
@query("j4_as_of_state", "SELECT series, as_of, ref_date, value FROM state", "value")
def _(spark, sf):
    v = r.vintages(spark, sf)
    return asof.as_of_state(v, macro.release_days(v), ["series"])


@query("j6_yoy_in_state", "SELECT series, as_of, ref_date, value, yoy FROM state_yoy", "value yoy")
def _(spark, sf):
    v = r.vintages(spark, sf)
    return asof.yoy_in_state(asof.as_of_state(v, macro.release_days(v), ["series"]), ["series"])


@query("j5_latest_readings", "SELECT series, as_of, reading FROM readings", "reading")
def _(spark, sf):
    return macro.pit_readings(r.vintages(spark, sf))


@query("j5_point_in_time_series", "SELECT date, series, value FROM filled WHERE series <> 'walcl'", "value")
def _(spark, sf):
    return macro.carried(macro.sparse_pit(r.vintages(spark, sf), r.spine(spark, sf)), r.spine(spark, sf))


@query("j7_current_series", "SELECT series, date, value FROM sparse_current", "value")
def _(spark, sf):
    s = r.spine(spark, sf)
    return macro.sparse_current(r.observations(spark, sf), s, "observation_date").unionByName(
        macro.sparse_current(r.weekly_level(spark, sf), s, "after_close", 1)
    )


@query("w8_forward_fill", "SELECT date, series, value FROM filled WHERE series = 'walcl'", "value")
def _(spark, sf):
    s = r.spine(spark, sf)
    return macro.carried(macro.sparse_current(r.weekly_level(spark, sf), s, "after_close", 1), s)


@query("j2_reindex", """SELECT s.date, max(value) FILTER (series = 'dff') AS dff, max(value) FILTER (series = 'dgs10') AS dgs10
FROM spine s LEFT JOIN sparse_current c ON c.date = s.date GROUP BY 1""", "dff dgs10")
def _(spark, sf):
    s = r.spine(spark, sf)
    return asof.reindex(macro.sparse_current(r.observations(spark, sf), s, "observation_date"), s, {"dff": "dff", "dgs10": "dgs10"})


@query("a7_first_prints", "SELECT series, ref_date, value, realtime_start FROM first_prints", "value")
def _(spark, sf):
    return macro.first_prints(r.vintages(spark, sf), ["series"])


@query("a8_release_yoy", "SELECT date, yoy FROM releases", "yoy")
def _(spark, sf):
    return macro.release_yoy(r.vintages(spark, sf).where("series = 'cpi'"), r.spine(spark, sf))


@query("f4_month_start_coverage", """SELECT ref_date, realtime_start FROM first_prints
WHERE series = 'cpi' AND day(ref_date) = 1 AND realtime_start BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
def _(spark, sf):
    p = macro.first_prints(r.vintages(spark, sf).where("series = 'cpi'"))
    return p.where("dayofmonth(ref_date) = 1 AND realtime_start BETWEEN DATE'1996-01-01' AND DATE'1999-12-31'").select("ref_date", "realtime_start")


@query("p12_yield_spread", "SELECT date, round(treasury_10y_yield - treasury_2y_yield, 8) AS spread FROM macro_levels", "spread")
def _(spark, sf):
    m = b.table(spark, sf, "macro_conditions")
    return m.select("date", scalar.spread(F.col("treasury_10y_yield"), F.col("treasury_2y_yield")).alias("spread"))


@query("w20_rate_regime", "SELECT date, rate_regime FROM rate_labels")
def _(spark, sf):
    return macro.rate_regime(b.table(spark, sf, "macro_conditions"))


@query("w21_inflation_regime", "SELECT date, inflation_regime FROM macro_conditions WHERE inflation_rate IS NOT NULL")
def _(spark, sf):
    releases = macro.release_yoy(r.vintages(spark, sf).where("series = 'cpi'"), r.spine(spark, sf))
    return macro.inflation_regime(b.table(spark, sf, "macro_conditions"), releases)


@query("w22_level_changes", """SELECT date, inflation_rate, previous FROM (
  SELECT date, inflation_rate, lag(inflation_rate) OVER (ORDER BY date) AS previous FROM macro_levels)
WHERE inflation_rate IS DISTINCT FROM previous""", "inflation_rate previous")
def _(spark, sf):
    from pyspark.sql import Window

    m = b.table(spark, sf, "macro_conditions").select("date", "inflation_rate")
    m = m.withColumn("previous", F.lag("inflation_rate").over(Window.orderBy("date")))
    return m.where(~F.col("inflation_rate").eqNullSafe(F.col("previous")))


# -------------------------------------------------------------------- events
@query("p5_event_id", "SELECT event_id FROM scheduled_events")
def _(spark, sf):
    e = b.table(spark, sf, "scheduled_events")
    return e.select(
        scalar.event_id(F.col("event_type"), F.col("event_date"), F.coalesce("reference_period", F.lit("")), F.col("symbol")).alias("event_id")
    )


@query("p6_reference_month", "SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS month FROM lineitem")
def _(spark, sf):
    return r.table(spark, sf, "lineitem").select(scalar.reference_month(F.col("l_shipdate")).alias("month")).distinct()


@query("p7_release_timing", """SELECT d AS date, CASE WHEN d >= DATE '2013-03-20' THEN 'during_session' ELSE 'unknown' END AS meeting_session,
  CASE WHEN d >= DATE '2013-03-20' THEN '14:00:00' END AS meeting_time, 'pre_open' AS release_session,
  CASE WHEN d >= DATE '1990-01-01' THEN '08:30:00' END AS release_time
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events UNION SELECT DISTINCT CAST(o_orderdate AS DATE) - 3650 FROM orders)""")
def _(spark, sf):
    d = r.table(spark, sf, "events").select(F.col("ts").cast("date").alias("date"))
    d = d.union(r.table(spark, sf, "orders").select(F.date_sub(F.col("o_orderdate").cast("date"), 3650))).distinct()
    (ms, mt), (rs, rt) = scalar.meeting_timing(F.col("date")), scalar.release_timing(F.col("date"))
    return d.select("date", ms.alias("meeting_session"), mt.alias("meeting_time"), rs.alias("release_session"), rt.alias("release_time"))


@query("j8_effective_sessions", "SELECT event_type, date AS session FROM anchors WHERE date IS NOT NULL")
def _(spark, sf):
    return events.anchors(b.table(spark, sf, "scheduled_events"), r.spine(spark, sf))


FLAGS = [f for f, _ in schemas.EVENT_FLAGS.values()]
SINCE = [s for _, s in schemas.EVENT_FLAGS.values()]


@query("j9_event_day_flags", f"SELECT date, {', '.join(FLAGS)} FROM calendar_context")
def _(spark, sf):
    return events.event_flags(b.table(spark, sf, "trading_days"), b.table(spark, sf, "scheduled_events"))


@query("w12_sessions_since_event", f"SELECT date, {', '.join(SINCE)} FROM calendar_context")
def _(spark, sf):
    return events.sessions_since(b.table(spark, sf, "trading_days"), b.table(spark, sf, "scheduled_events"))


@query("s7_events_by_type", "SELECT event_type, event_date FROM scheduled_events WHERE event_type IN ('fomc', 'cpi')")
def _(spark, sf):
    return events.by_type(b.table(spark, sf, "scheduled_events"), ["fomc", "cpi"])


@query("u1_union_of_families", "SELECT event_id, event_type, event_date FROM scheduled_events")
def _(spark, sf):
    e = events.scheduled_events(b.event_families(spark, sf), r.spine(spark, sf))
    return e.orderBy("event_date", "event_type", "event_id").select("event_id", "event_type", "event_date")


@query("u3_distinct_meeting_days", "SELECT DISTINCT event_date FROM meetings")
def _(spark, sf):
    e = b.table(spark, sf, "scheduled_events").where("event_type = 'fomc'")
    return e.unionByName(e).select("event_date").distinct().orderBy("event_date")
