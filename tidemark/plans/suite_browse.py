"""Browse, page, export and day-inspection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import browse
from tidemark.plans import builders as b
from tidemark.plans import recipes as r
from tidemark.plans.registry import query


def tbl(spark, sf, name):
    return b.table(spark, sf, name)


@query("f1_browse_filter", "SELECT date, symbol, close FROM bars WHERE date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AND symbol = 'BUILDING'", "close")
def _(spark, sf):
    f = browse.Filters("1996-01-01", "1997-12-31", "BUILDING", "cpi")
    return browse.filtered(tbl(spark, sf, "daily_market_data"), browse.spec_of("daily_market_data"), f).select("date", "symbol", "close")


@query("f1_flag_filter", "SELECT date FROM calendar_context WHERE is_turn_of_month AND NOT is_quarter_transition")
def _(spark, sf):
    f = browse.Filters(flags={"is_turn_of_month": True, "is_quarter_transition": False})
    return browse.filtered(tbl(spark, sf, "calendar_context"), browse.spec_of("calendar_context"), f).select("date")


@query("f1_event_type_filter", "SELECT event_id FROM scheduled_events WHERE event_type = 'cpi' AND event_date >= DATE '1998-01-01'")
def _(spark, sf):
    f = browse.Filters(date_from="1998-01-01", event_type="cpi")
    return browse.filtered(tbl(spark, sf, "scheduled_events"), browse.spec_of("scheduled_events"), f).select("event_id")


@query("f2_symbol_scope", "SELECT symbol, symbol IN ('BUILDING', 'FURNITURE') AS scoped, count(*) AS n FROM bars WHERE symbol <> 'HOUSEHOLD' GROUP BY 1")
def _(spark, sf):
    d = tbl(spark, sf, "daily_market_data").where(~F.col("symbol").isin(r.CLOSE_ONLY))
    return d.groupBy("symbol", F.col("symbol").isin("BUILDING", "FURNITURE").alias("scoped")).agg(F.count("*").alias("n"))


LAST = "(SELECT max(date) FROM spine)"


def last_day(spark, sf):
    return tbl(spark, sf, "trading_days").agg(F.max("date")).scalar()


@query("f3_rows_on_day", f"SELECT date, symbol, close FROM bars WHERE date = {LAST} ORDER BY symbol LIMIT 500", "close")
def _(spark, sf):
    return browse.rows_on(tbl(spark, sf, "daily_market_data"), "daily_market_data", last_day(spark, sf)).select("date", "symbol", "close")


@query("f3_events_on_day", "SELECT event_id, event_type FROM scheduled_events WHERE event_date = (SELECT max(event_date) FROM scheduled_events) ORDER BY event_id LIMIT 500")
def _(spark, sf):
    e = tbl(spark, sf, "scheduled_events")
    return browse.rows_on(e, "scheduled_events", e.agg(F.max("event_date")).scalar()).select("event_id", "event_type")


@query("q1_default_sort", "SELECT date, symbol, close FROM bars ORDER BY date ASC, symbol ASC LIMIT 100", "close")
def _(spark, sf):  # the asked direction is ignored without a column
    return browse.page(tbl(spark, sf, "daily_market_data"), "daily_market_data", direction="desc").select("date", "symbol", "close")


@query("q2_tie_breaks", """SELECT date, symbol, momentum_regime FROM asset_regimes
ORDER BY momentum_regime DESC NULLS FIRST, date ASC, symbol ASC LIMIT 400""")
def _(spark, sf):
    p = browse.page(tbl(spark, sf, "asset_regimes"), "asset_regimes", size=400, sort="momentum_regime", direction="desc")
    return p.select("date", "symbol", "momentum_regime")


@query("q3_page", """SELECT date, symbol, return_5d, (SELECT count(*) FROM bars WHERE date >= DATE '1996-06-01') AS total_count FROM market_outcomes
WHERE date >= DATE '1996-06-01' ORDER BY return_5d ASC NULLS LAST, date ASC, symbol ASC LIMIT 500 OFFSET 1000""", "return_5d")
def _(spark, sf):
    p = browse.page(
        tbl(spark, sf, "market_outcomes"), "market_outcomes", browse.Filters(date_from="1996-06-01"), number=3, size=9999, sort="return_5d"
    )
    return p.select("date", "symbol", "return_5d", "total_count")


@query("q3_keyset_page", "SELECT date, symbol FROM bars WHERE date > DATE '1999-03-01' OR (date = DATE '1999-03-01' AND symbol > 'FURNITURE') ORDER BY date, symbol LIMIT 250")
def _(spark, sf):
    import datetime as dt

    return browse.page_after(
        tbl(spark, sf, "daily_market_data"), "daily_market_data", {"date": dt.date(1999, 3, 1), "symbol": "FURNITURE"}, 250
    ).select("date", "symbol")


@query("q4_top_k", "SELECT date, inflation_rate FROM macro_conditions ORDER BY inflation_rate DESC NULLS LAST, date LIMIT 25", "inflation_rate")
def _(spark, sf):
    return browse.top_k(tbl(spark, sf, "macro_conditions"), "inflation_rate", 25, ["date"]).select("date", "inflation_rate")


@query("q6_capped_export", "SELECT date, symbol, close, volume FROM bars ORDER BY volume DESC NULLS FIRST, date ASC, symbol ASC LIMIT 2000", "close")
def _(spark, sf):
    e = browse.export(tbl(spark, sf, "daily_market_data"), "daily_market_data", sort="volume", direction="desc", max_rows=2000)
    return e.select("date", "symbol", "close", "volume")


@query("j13_inspect_day", f"""SELECT calendar_date, calendar_date IN (SELECT date FROM spine) AS is_trading_day,
  (SELECT max(date) FROM spine WHERE date < calendar_date) AS prev_session, (SELECT min(date) FROM spine WHERE date > calendar_date) AS next_session,
  (SELECT count(*) FROM bars WHERE date = calendar_date) AS bars, (SELECT count(*) FROM scheduled_events WHERE event_date = calendar_date) AS events,
  (SELECT string_agg(symbol, ',' ORDER BY symbol) FROM bars WHERE date = calendar_date) AS symbols, (SELECT coalesce(CAST(sum(volume) AS BIGINT), 0) FROM bars WHERE date = calendar_date) AS volume,
  (SELECT string_agg(event_id, ',' ORDER BY event_id) FROM scheduled_events WHERE event_date = calendar_date) AS event_ids,
  (SELECT weekday FROM trading_days WHERE date = (SELECT max(date) FROM spine WHERE date < calendar_date)) AS prev_weekday,
  CAST(CASE WHEN EXISTS (SELECT 1 FROM spine WHERE date > calendar_date) THEN 0 ELSE 1 END AS INTEGER) AS messages FROM (SELECT {LAST} AS calendar_date)""")
def _(spark, sf):
    day = browse.inspect_day(b.tables(spark, sf), last_day(spark, sf), r.universe(spark))
    n = lambda c: F.json_array_length(c).cast("bigint")
    bars = F.from_json("daily_market_data", "array<struct<symbol:string,volume:bigint>>")
    return day.select(
        "calendar_date", "is_trading_day", "prev_session", "next_session", n("daily_market_data").alias("bars"),
        n("scheduled_events").alias("events"), F.array_join(bars["symbol"], ",").alias("symbols"), F.aggregate(bars["volume"], F.lit(0).cast("bigint"), lambda a, v: a + F.coalesce(v, F.lit(0))).alias("volume"),
        F.nullif(F.array_join(F.from_json("scheduled_events", "array<struct<event_id:string>>")["event_id"], ","), F.lit("")).alias("event_ids"),
        F.get_json_object("prev_trading_day", "$.weekday").cast("int").alias("prev_weekday"), F.size("messages").alias("messages"),
    )


@query("j13_inspect_closed_day", """SELECT calendar_date, false AS is_trading_day, (SELECT max(date) FROM spine WHERE date < calendar_date) AS prev_session,
  (SELECT min(date) FROM spine WHERE date > calendar_date) AS next_session, CAST(0 AS BIGINT) AS bars, CAST(2 AS INTEGER) AS messages
FROM (SELECT date AS calendar_date FROM closures WHERE type = 'exceptional')""")
def _(spark, sf):
    closed = r.closures(spark, sf).where("type = 'exceptional'").agg(F.min("date")).scalar()
    day = browse.inspect_day(b.tables(spark, sf), closed, r.universe(spark), symbol="NOPE")
    return day.select(
        "calendar_date", "is_trading_day", "prev_session", "next_session",
        F.json_array_length("daily_market_data").cast("bigint").alias("bars"), F.size("messages").alias("messages"),
    )


@query("s11_domains", " UNION ALL ".join(
    f"SELECT '{t}' AS domain, '{schemas.DATE_COLUMN[t]}' AS date_column, {repr('symbol') if s.symbol_column else 'NULL'} AS symbol_column, '{schemas.TABLE_GRAINS[t]}' AS grain, count(*) AS rows FROM {t}"
    for t, s in browse.REGISTRY.items()))
def _(spark, sf):
    from tidemark.operators.coverage import table_coverage
    from tidemark.sources.tables import domains

    n = table_coverage(b.tables(spark, sf)).select(F.col("table").alias("domain"), F.col("row_count").alias("rows"))
    return domains(spark).join(n, "domain")
