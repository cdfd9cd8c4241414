"""Write semantics: merges, partition upserts, refresh, export, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalar
from tidemark.operators import browse, health, quality
from tidemark.plans import builders as b
from tidemark.plans import recipes as r
from tidemark.plans import suite_quality
from tidemark.plans.registry import query
from tidemark.session import scratch_path
from tidemark.sinks import deltas, upsert

PK = ["date", "symbol"]
UPSERTED = """SELECT date, symbol, CASE WHEN year(date) = 1998 THEN close * 2 ELSE close END AS close, volume FROM bars
WHERE NOT (year(date) = 1999 AND symbol = 'MACHINERY')
UNION ALL SELECT date, symbol, close * 3, volume FROM bars WHERE year(date) = 1999 AND symbol = 'MACHINERY'"""


def _old_new(spark, sf):
    """Stored bars without one symbol-year; new rows for that and changed rows for another year."""
    d = b.table(spark, sf, "daily_market_data").select("date", "symbol", "close", "volume")
    gap = (F.year("date") == 1999) & (F.col("symbol") == "MACHINERY")
    new = d.where((F.year("date") == 1998) | gap).withColumn("close", F.when(gap, F.col("close") * 3).otherwise(F.col("close") * 2))
    return d.where(~gap), new


@query("k1_keyed_upsert", UPSERTED, "close")
def _(spark, sf):
    old, new = _old_new(spark, sf)
    return upsert.merged(old, new, PK)


@query("k1_partition_upsert", UPSERTED, "close")
def _(spark, sf):
    old, new = (x.withColumn("year", F.year("date")) for x in _old_new(spark, sf))
    stored = upsert.PartitionedTable(spark, scratch_path(spark, "upsert"), "year")
    stored.upsert(old, PK)
    stored.upsert(new, PK)
    stored.upsert(new, PK)  # a second run changes nothing
    return stored.read(new.schema).drop("year")


@query("k2_partial_upsert", """SELECT date, symbol, CASE WHEN symbol = 'FURNITURE' THEN close ELSE close END AS close,
  CASE WHEN symbol = 'FURNITURE' THEN 9.0::DOUBLE ELSE return_1d END AS return_1d FROM daily_market_data WHERE symbol <> 'MACHINERY'
UNION ALL SELECT date, symbol, -1.0::DOUBLE, 9.0::DOUBLE FROM bars WHERE symbol = 'MACHINERY'""", "close return_1d")
def _(spark, sf):
    d = b.table(spark, sf, "daily_market_data").select("date", "symbol", "close", "return_1d")
    new = d.where("symbol IN ('FURNITURE', 'MACHINERY')").withColumns({"close": F.lit(-1.0), "return_1d": F.lit(9.0)})
    return upsert.merged_columns(d.where("symbol <> 'MACHINERY'"), new, PK, ["return_1d"])


@query("k3_full_refresh", "SELECT date, inflation_regime, rate_regime FROM macro_conditions")
def _(spark, sf):
    path = scratch_path(spark, "refresh")
    m = b.table(spark, sf, "macro_conditions").select("date", "inflation_regime", "rate_regime")
    upsert.replace(m.where("year(date) = 1996"), path)
    upsert.replace(m, path, ["date"])
    return spark.read.schema(m.schema).parquet(path)


@query("k4_range_sync", """SELECT date, weekday FROM trading_days WHERE date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""")
def _(spark, sf):
    t = b.table(spark, sf, "trading_days").select("date", "weekday")
    lo, hi = F.to_date(F.lit("1996-01-01")), F.to_date(F.lit("1998-12-31"))
    old = t.withColumn("weekday", F.when(F.year("date") == 1997, 0).otherwise(F.col("weekday")))
    return upsert.synced(old, t.where(F.year("date") == 1997), ["date"], lo, hi)


@query("k5_csv_export", "SELECT date, symbol, close FROM bars ORDER BY date DESC, symbol ASC LIMIT 3000", "close")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    e = browse.export(b.table(spark, sf, "daily_market_data"), "daily_market_data", sort="date", direction="desc", max_rows=3000)
    e = e.select("date", "symbol", "close")
    upsert.write_csv(e, path)
    return spark.read.schema(e.schema).option("header", True).csv(path)


@query("k6_json_report", f"SELECT status, 'PASS' AS validation FROM ({suite_quality.STATUS}) AS s")
def _(spark, sf):
    t = b.tables(spark, sf)
    path = scratch_path(spark, "report")
    upsert.write_json_report(health.report(t, r.universe(spark), r.CLOSE_ONLY, quality.database_checks(t, r.universe(spark), r.CLOSE_ONLY)), path)
    return spark.read.text(path).select(F.get_json_object("value", "$.status").alias("status"), F.get_json_object("value", "$.validation").alias("validation"))


@query("k7_sanitised_values", """SELECT event_id, CASE WHEN event_id % 5 IN (0, 1) THEN NULL ELSE value END AS value,
  CAST(trunc(value) AS BIGINT) AS whole FROM events""", "value")
def _(spark, sf):
    e = r.table(spark, sf, "events")
    i = F.col("event_id") % 5
    x = e.select(
        "event_id", F.when(i == 0, float("nan")).when(i == 1, float("inf")).otherwise(F.col("value")).alias("value"), F.col("value").alias("whole")
    )
    return scalar.sanitize(x, ("whole",))


COLUMNS = ["date", "symbol", "close", "volume", "return_1d"]
ROWS = """SELECT date, symbol, CASE WHEN symbol = 'MACHINERY' THEN -1.0::DOUBLE ELSE close END AS close, volume,
  CASE WHEN symbol IN ('FURNITURE', 'MACHINERY') AND year(date) >= 1996 THEN 9.0::DOUBLE ELSE return_1d END AS return_1d FROM daily_market_data WHERE symbol <> 'MACHINERY' OR year(date) >= 1996"""


def _table(spark, sf):
    """A stored table without one symbol, and after a partial-column upsert of two symbols' later years, run twice."""
    d = b.table(spark, sf, "daily_market_data").select(*COLUMNS)
    stored = deltas.KeyedTable(spark, scratch_path(spark, "deltas"), d.schema, PK)
    stored.replace(d.where("symbol <> 'MACHINERY'"))
    new = d.where("symbol IN ('FURNITURE', 'MACHINERY') AND year(date) >= 1996").withColumns({"close": F.lit(-1.0), "return_1d": F.lit(9.0)})
    stored.update(new, ["return_1d"])
    stored.update(new, ["return_1d"])  # a second run changes nothing
    return stored, d


@query("k2_partial_upsert_of_rows", ROWS, "close return_1d")
def _(spark, sf):
    return _table(spark, sf)[0].read()


@query("k2_rows_written", f"""SELECT CAST(1 AS INTEGER) AS delta, 'set' AS op, count(*) AS rows FROM daily_market_data WHERE symbol IN ('FURNITURE', 'MACHINERY') AND year(date) >= 1996""")
def _(spark, sf):
    return _table(spark, sf)[0].written()


SYNCED = f"""SELECT date, symbol, CASE WHEN year(date) = 1997 AND month(date) = 5 THEN close + 1 ELSE close END AS close, volume, return_1d FROM ({ROWS}) AS t WHERE year(date) BETWEEN 1995 AND 1997"""


def _synced(spark, sf):
    import datetime as dt

    stored, _ = _table(spark, sf)
    new = stored.read().where("year(date) = 1997").withColumn("close", F.when(F.month("date") == 5, F.col("close") + 1).otherwise(F.col("close")))
    stored.sync(new, dt.date(1995, 1, 1), dt.date(1997, 12, 31))
    return stored


@query("k4_range_sync_of_rows", SYNCED, "close return_1d")
def _(spark, sf):
    return _synced(spark, sf).read()


@query("k4_compacted_rows", SYNCED, "close return_1d")
def _(spark, sf):
    stored = _synced(spark, sf)
    stored.compact()
    return stored.read()


@query("k4_rows_written", f"""SELECT CAST(2 AS INTEGER) AS delta, 'put' AS op, count(*) AS rows FROM ({ROWS}) AS t WHERE year(date) = 1997 AND month(date) = 5
UNION ALL SELECT CAST(2 AS INTEGER), 'delete', count(*) FROM ({ROWS}) AS t WHERE year(date) NOT BETWEEN 1995 AND 1997""")
def _(spark, sf):
    return _synced(spark, sf).written().where("delta = 2")
