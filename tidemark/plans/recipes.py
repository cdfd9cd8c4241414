"""How the raw star-schema tables stand in for landed market and macro data.

Heavy inputs (orders, lineitem) are reduced by one partially aggregating
groupBy to day or month grain; everything after that is bounded by the calendar.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.store import stored

CLOSE_ONLY = ["HOUSEHOLD"]
SPLIT_SYMBOL = "BUILDING"
SPLIT_DATE = "1998-06-01"
# instrument list of the stand-in universe: (symbol, asset_type, close_only)
UNIVERSE = [
    ("AUTOMOBILE", "etf", False),
    ("BUILDING", "etf", False),
    ("FURNITURE", "etf", False),
    ("HOUSEHOLD", "commodity", True),
    ("MACHINERY", "etf", False),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def universe(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(UNIVERSE, "symbol string, asset_type string, close_only boolean")


def order_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: first and last order day."""
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").agg(F.min(d).alias("lo"), F.max(d).alias("hi"))


def build_closures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, name, type): the full-day closures of the covered years."""
    y = F.explode(F.sequence(F.year("lo"), F.year("hi")))
    years = order_span(spark, sf_dir).select(y.alias("y"))
    day = lambda m, d: F.make_date("y", F.lit(m), F.lit(d))
    rules = F.array(
        F.struct(day(1, 1).alias("date"), F.lit("New Year").alias("name")),
        F.struct(day(7, 4).alias("date"), F.lit("Independence").alias("name")),
        F.struct(day(12, 25).alias("date"), F.lit("Christmas").alias("name")),
        F.struct(F.next_day(day(11, 21), "THU").alias("date"), F.lit("Thanksgiving").alias("name")),
    )
    regular = years.select(F.inline(rules)).withColumn("type", F.lit("regular"))
    special = spark.range(1).select(
        F.to_date(F.lit("1998-09-15")).alias("date"),
        F.lit("Exceptional Closure").alias("name"),
        F.lit("exceptional").alias("type"),
    )
    return regular.unionByName(special)


def build_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources.calendar import session_dates

    return session_dates(order_span(spark, sf_dir), closures(spark, sf_dir))


def early_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spine(spark, sf_dir)
    md = F.date_format("date", "MMdd")
    after = closures(spark, sf_dir).where("name = 'Thanksgiving'").select(F.date_add("date", 1).alias("date"))
    fixed = s.where(md.isin("1224", "0703"))
    return fixed.unionByName(s.join(F.broadcast(after), "date", "left_semi"))


def build_all_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per market segment, session or not; one segment is close-only."""
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("date")
    )
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("symbol"))
    px = F.col("o_totalprice")
    raw = (
        o.join(c, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("date", "symbol")
        .agg(
            F.min_by(px, "o_orderkey").alias("open"),
            F.max(px).alias("high"),
            F.min(px).alias("low"),
            F.max_by(px, "o_orderkey").alias("close"),
            F.count("*").alias("volume"),
        )
    )
    return adjusted(raw)


def adjusted(raw: DataFrame) -> DataFrame:
    full = ~F.col("symbol").isin(CLOSE_ONLY)
    split = F.col("symbol") == SPLIT_SYMBOL
    late = F.col("date") >= F.lit(SPLIT_DATE).cast("date")
    k = F.when(split & ~late, 0.5).otherwise(1.0)
    from tidemark.operators.market import by_symbol

    first_late = late & ~F.coalesce(F.lag(late).over(by_symbol()), F.lit(False))  # in the order of the panel's other windows
    keep = lambda c: F.when(full, c)
    return raw.select(
        "date", "symbol",
        keep(F.col("open")).alias("open"), keep(F.col("high")).alias("high"), keep(F.col("low")).alias("low"),
        "close", keep(F.col("volume")).alias("volume"),
        keep(F.col("open") * k).alias("adj_open"), keep(F.col("high") * k).alias("adj_high"),
        keep(F.col("low") * k).alias("adj_low"), keep(F.col("close") * k).alias("adj_close"),
        keep(F.col("volume")).alias("adj_volume"), keep(F.lit(0.0)).alias("dividend_cash"),
        keep(F.when(split & first_late, 2.0).otherwise(1.0)).alias("split_factor"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.asof import on_spine

    return on_spine(all_bars(spark, sf_dir), spine(spark, sf_dir))


def build_vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series, ref_date, print, value, realtime_start, realtime_end, ordinal) in four series."""
    li = table(spark, sf_dir, "lineitem")
    line = F.col("l_linenumber")
    price = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    qty = F.round(F.col("l_quantity") * 100).cast("bigint")
    ref = F.trunc("l_shipdate", "month").alias("ref_date")
    aggs = []
    for m in range(2, 8):
        aggs += [
            F.sum(F.when(line <= m, price)).alias(f"price{m}"),
            F.sum(F.when(line <= m, qty)).alias(f"qty{m}"),
            F.count_if(line <= m).alias(f"n{m}"),
        ]
    monthly = li.groupBy(ref).agg(*aggs)
    prints = F.array(
        *[
            F.struct(
                F.lit(s).alias("series"), F.lit(k).alias("print"), F.col(f"{v}{2 * k + odd}").alias("s"),
                F.col(f"n{2 * k + odd}").alias("n"), F.lit(lag).alias("lag_days"),
            )
            for k in (1, 2, 3)
            for s, v, odd, lag in (
                ("cpi", "price", 1, 10), ("core", "price", 0, 10), ("unrate", "qty", 1, 5), ("icsa", "qty", 0, 5),
            )
        ]
    )
    x = monthly.select("ref_date", F.inline(prints)).where("n > 0")
    start = F.expr("date_add(last_day(ref_date), lag_days + 30 * (print - 1))")
    return x.select(
        "series", "ref_date", "print",
        F.expr("((2 * s + n) div (2 * n)) / 100.0D").alias("value"),
        start.alias("realtime_start"),
        F.when(F.col("print") == 3, F.lit("9999-12-31").cast("date")).otherwise(F.date_add(start, 30)).alias("realtime_end"),
        F.expr("cast((year(ref_date) * 12 + month(ref_date)) * 4 + print as bigint)").alias("ordinal"),
    )


def build_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series, date, value text): four daily rate-like series, '.' on the 13th."""
    li = table(spark, sf_dir, "lineitem")
    bp = lambda c: F.round(c * 10000).cast("bigint")
    low = F.col("l_linenumber") <= 3
    daily = li.groupBy(F.col("l_shipdate").cast("date").alias("date")).agg(
        F.count("*").alias("n"),
        F.sum(bp(F.col("l_tax"))).alias("tax"),
        F.sum(bp(F.col("l_discount"))).alias("disc"),
        F.sum(F.when(low, bp(F.col("l_discount")))).alias("disc_low"),
        F.count_if(low).alias("n_low"),
        F.sum(bp(F.col("l_discount") + F.col("l_tax"))).alias("both"),
    )
    parts = F.array(
        *[
            F.struct(F.lit(series).alias("series"), F.col(s).alias("s"), F.col(n).alias("n"))
            for series, s, n in (
                ("dff", "tax", "n"), ("dgs2", "disc_low", "n_low"), ("dgs10", "disc", "n"), ("baa10y", "both", "n"),
            )
        ]
    )
    x = daily.select("date", F.inline(parts)).where("n > 0")
    value = F.expr("((2 * s + n) div (2 * n)) / 100.0D").cast("string")
    return x.select("series", "date", F.when(F.dayofmonth("date") == 13, ".").otherwise(value).alias("value"))


def build_weekly_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series, date, value): quantity per ISO week, stamped on its Wednesday."""
    wednesday = F.date_add(F.trunc("l_shipdate", "week"), 2).alias("date")
    return (
        table(spark, sf_dir, "lineitem").groupBy(wednesday)
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("value"))
        .select(F.lit("walcl").alias("series"), "date", "value")
    )


def build_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(d, n, title): one meeting-like heading per order month, some of kinds to be left out."""
    d = F.col("o_orderdate").cast("date")
    x = (
        table(spark, sf_dir, "orders").where(F.dayofmonth("o_orderdate").between(2, 28))
        .groupBy(F.trunc("o_orderdate", "month").alias("m")).agg(F.max(d).alias("d"), F.count("*").alias("n"))
    )
    title = F.expr("""
        CASE WHEN n % 5 = 4 THEN date_format(d, 'MMMM') || '/' || date_format(add_months(d, 1), 'MMMM') || ' 30-1'
             WHEN n % 3 = 0 THEN date_format(d, 'MMMM d')
             ELSE date_format(d, 'MMMM') || ' ' || (day(d) - 1) || '-' || day(d) END
        || CASE n % 8 WHEN 0 THEN ' (unscheduled) Meeting' WHEN 1 THEN ' Conference Call' WHEN 2 THEN ' (notation vote)'
                      WHEN 3 THEN ' (cancelled) Meeting' ELSE ' Meeting' END
        || ' - ' || year(d)""")
    return x.select("d", "n", title.alias("title"))


def heading_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, html): one year page of <h4>/<h5> headings with tags, entities and line breaks inside."""
    h = headings(spark, sf_dir)
    tag = F.when(F.col("n") % 2 == 0, "h4").otherwise("h5")
    words = F.regexp_replace("title", " ", "\n &nbsp;")
    fragment = F.concat(F.lit("<"), tag, F.lit(' class="x"><b>'), words, F.lit("</b></"), tag, F.lit(">\n<p>text</p>"))
    rows = h.groupBy(F.year("d").alias("page_id")).agg(  # at most 12 headings a year
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("d", fragment.alias("f")))), lambda s: s["f"]), "\n").alias("html")
    )
    return rows


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _stored(name: str, build):
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        return stored(spark, sf_dir, name, build)

    read.__name__ = name
    read.__doc__ = f"{build.__doc__ or name} Written once, then read."
    return read


closures = _stored("closures", build_closures)
spine = _stored("spine", build_spine)
all_bars = _stored("all_bars", build_all_bars)
vintages = _stored("vintages", build_vintages)
observations = _stored("observations", build_observations)
weekly_level = _stored("weekly_level", build_weekly_level)
headings = _stored("headings", build_headings)
