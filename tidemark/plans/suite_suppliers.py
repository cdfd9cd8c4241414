"""The panel operators on a panel that grows with the data: one symbol for each supplier.

The panel by market segment has five symbols at any scale; here the number of
symbols, and so of window groups, follows the supplier table, and the bars are
made of line items. The statements are those of the first panel over other raw bars.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import asof, browse, coverage, health, market, pages, regimes
from tidemark.plans import recipes as r
from tidemark.plans import registry, suite_market, suite_quality
from tidemark.plans.builders import PANEL_ORDER
from tidemark.plans.reference_sql import CTES
from tidemark.plans.store import stored

RAW = """
SELECT CAST(l_shipdate AS DATE) AS date, 'S' || l_suppkey AS symbol,
  arg_min(l_extendedprice, l_orderkey * 10 + l_linenumber) AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low,
  arg_max(l_extendedprice, l_orderkey * 10 + l_linenumber) AS close, count(*) AS volume
FROM lineitem GROUP BY 1, 2"""


ITEMS_PER_TASK = 500_000


def query(name: str, statement: str, doubles: str = ""):
    add = registry.query(name, statement, doubles)

    def run(fn):
        add(fn)
        held = registry.ORACLES[name]
        assert CTES["raw_bars"].strip() in held
        registry.ORACLES[name] = held.replace(CTES["raw_bars"].strip(), RAW.strip())
        return fn

    return run


def build_bars(spark, sf):
    """Bars of the line items. Hardly two items share a day and a supplier, so items aren't summed up before their one
    exchange, by symbol alone: the bars, and every window by symbol over them, then stay in place. Its partitions are as many
    as the items need to be sorted in memory, a multiple of the buckets the panel is kept in, so that each writes to one."""
    li = r.table(spark, sf, "lineitem")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = buckets * max(1, -(-li.count() // (buckets * ITEMS_PER_TASK)))
    symbol = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    sales = li.select(
        F.col("l_shipdate").cast("date").alias("date"), symbol.alias("symbol"), F.col("l_extendedprice").alias("px"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"),
    ).repartition(parts, "symbol")
    raw = sales.groupBy("date", "symbol").agg(
        F.min_by("px", "at").alias("open"), F.max("px").alias("high"), F.min("px").alias("low"), F.max_by("px", "at").alias("close"), F.count("*").alias("volume")
    )
    return asof.on_spine(r.adjusted(raw), r.spine(spark, sf))


def build_daily(spark, sf):
    return schemas.conform(market.daily_fields(build_bars(spark, sf), []), "daily_market_data")


def build_trailing(spark, sf):
    return regimes.trailing_fields(daily(spark, sf), universe(spark, sf), [])


def daily(spark, sf):
    return stored(spark, sf, "supplier_daily", build_daily, together=PANEL_ORDER)


def universe(spark, sf):
    return r.table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"), F.lit("etf").alias("asset_type"), F.lit(False).alias("close_only")
    )


@query("b2_daily_by_supplier", suite_market._all("daily_market_data"), suite_market.DMD)
def _(spark, sf):
    return build_daily(spark, sf)


@query("b3_outcomes_by_supplier", suite_market._all("market_outcomes"), suite_market.OUT)
def _(spark, sf):
    return schemas.conform(market.forward_outcomes(daily(spark, sf), []), "market_outcomes")


@query("b4_regimes_by_supplier", suite_market._all("asset_regimes"), suite_market.REG)
def _(spark, sf):
    return schemas.conform(regimes.labelled(stored(spark, sf, "supplier_trailing", build_trailing, together=PANEL_ORDER)), "asset_regimes")


@query("a2_coverage_by_supplier", suite_quality.A2, "coverage_pct")
def _(spark, sf):
    return coverage.symbol_coverage(daily(spark, sf), suite_quality.tbl(spark, sf, "trading_days"), universe(spark, sf))


@query("h1_gaps_by_supplier", suite_quality.H1)
def _(spark, sf):
    return health.gap_findings(coverage.symbol_coverage(daily(spark, sf), suite_quality.tbl(spark, sf, "trading_days"), universe(spark, sf)), [])


@query("q3_page_by_supplier", """SELECT date, symbol, return_1d, (SELECT count(*) FROM bars WHERE date >= DATE '1996-06-01') AS total_count FROM daily_market_data
WHERE date >= DATE '1996-06-01' ORDER BY date ASC, symbol ASC LIMIT 500 OFFSET 1000""", "return_1d")
def _(spark, sf):
    p = browse.page(daily(spark, sf), "daily_market_data", browse.Filters(date_from="1996-06-01"), number=3, size=500, sort="date")
    return p.select("date", "symbol", "return_1d", "total_count")


def outcomes(spark, sf):
    return stored(spark, sf, "supplier_outcomes", lambda s, f: schemas.conform(market.forward_outcomes(daily(s, f), []), "market_outcomes"))


def index(spark, sf, key: str, sort: str, direction: str = "asc") -> pages.Index:
    """An index of a table of the panel, written once; ranges are small here, so that the small tables have some dozens."""
    table = {"daily_market_data": daily, "market_outcomes": outcomes}[key]
    name = f"supplier_{key}_by_{sort}_{direction}"
    rows = stored(spark, sf, name, lambda s, f: pages.ranged(table(s, f), key, sort, direction, rows_per_range=2000), by=pages.RANGE)
    ranges = stored(spark, sf, f"{name}_ranges", lambda s, f: pages.summary(rows, sort))
    return pages.Index(key, sort, direction, rows, ranges)


@query("q3_deep_page_by_supplier", """SELECT date, symbol, volume, (SELECT count(*) FROM bars) AS total_count FROM daily_market_data
ORDER BY volume DESC NULLS FIRST, date ASC, symbol ASC LIMIT 5 OFFSET 49995""")
def _(spark, sf):
    p = pages.page(index(spark, sf, "daily_market_data", "volume", "desc"), number=10_000, size=5)
    return p.select("date", "symbol", "volume", "total_count")


@query("q3_deep_filtered_page_by_supplier", """SELECT date, symbol, return_20d, (SELECT count(*) FROM market_outcomes WHERE date BETWEEN DATE '1993-03-01' AND DATE '1997-06-30') AS total_count
FROM market_outcomes WHERE date BETWEEN DATE '1993-03-01' AND DATE '1997-06-30' ORDER BY return_20d ASC NULLS LAST, date ASC, symbol ASC LIMIT 500 OFFSET 2000""", "return_20d")
def _(spark, sf):
    f = browse.Filters("1993-03-01", "1997-06-30")
    p = pages.page(index(spark, sf, "market_outcomes", "return_20d"), number=5, size=9999, filters=f)
    return p.select("date", "symbol", "return_20d", "total_count")


@query("q3_seek_page_by_supplier", """SELECT date, symbol, volume FROM daily_market_data
WHERE volume < 2 OR (volume = 2 AND (date > DATE '1996-02-29' OR (date = DATE '1996-02-29' AND symbol > 'S3')))
ORDER BY volume DESC NULLS FIRST, date ASC, symbol ASC LIMIT 300""")
def _(spark, sf):
    last = {"volume": 2, "date": dt.date(1996, 2, 29), "symbol": "S3"}
    return pages.page_after(index(spark, sf, "daily_market_data", "volume", "desc"), last, 300).select("date", "symbol", "volume")


@query("q3_seek_nulls_by_supplier", """SELECT date, symbol, return_20d FROM market_outcomes WHERE symbol = 'S7' AND (return_20d IS NOT NULL
  OR date > DATE '1998-06-01' OR (date = DATE '1998-06-01' AND symbol > 'S5')) ORDER BY return_20d DESC NULLS FIRST, date ASC, symbol ASC LIMIT 40""", "return_20d")
def _(spark, sf):
    last = {"return_20d": None, "date": dt.date(1998, 6, 1), "symbol": "S5"}
    p = pages.page_after(index(spark, sf, "market_outcomes", "return_20d", "desc"), last, 40, browse.Filters(symbol="S7"))
    return p.select("date", "symbol", "return_20d")
