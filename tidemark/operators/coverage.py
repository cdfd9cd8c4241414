"""How much of each table, symbol and field is there."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.asof import session_index, sessions_between


def table_coverage(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, grain, row_count, first_date, last_date): one aggregate scan of one column per table."""
    parts = []
    for name, df in tables.items():
        d = schemas.DATE_COLUMN[name]
        parts.append(
            df.agg(F.count("*").alias("row_count"), F.min(d).alias("first_date"), F.max(d).alias("last_date")).select(
                F.lit(name).alias("table"), F.lit(schemas.TABLE_GRAINS[name]).alias("grain"), "row_count", "first_date", "last_date"
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def session_gaps(bars: DataFrame, spine: DataFrame) -> DataFrame:
    """(symbol, before, after): session indexes around each internal run of missing sessions.

    Neighbouring rows of a symbol are compared by session index, so no
    (symbols x sessions) grid is made.
    """
    idx = F.broadcast(session_index(spine))
    x = bars.select("symbol", "date").distinct().join(idx, "date")
    prev = F.lag("i").over(Window.partitionBy("symbol").orderBy("date"))
    return x.select("symbol", prev.alias("before"), F.col("i").alias("after")).where("after - before > 1")


def missing_sessions(bars: DataFrame, spine: DataFrame) -> DataFrame:
    """(symbol, date, i): sessions inside a symbol's span without a row."""
    gaps = session_gaps(bars, spine)
    i = F.explode(F.sequence(F.col("before") + 1, F.col("after") - 1)).alias("i")
    return gaps.select("symbol", i).join(F.broadcast(session_index(spine)), "i").select("symbol", "date", "i")


def longest_run(df: DataFrame, keys: list[str], position: str, out: str = "longest_run") -> DataFrame:
    """Longest stretch of consecutive positions per key (islands share position minus row number)."""
    island = F.col(position) - F.row_number().over(Window.partitionBy(*keys).orderBy(position))
    runs = df.withColumn("_island", island).groupBy(*keys, "_island").agg(F.count("*").alias("_n"))
    return runs.groupBy(*keys).agg(F.max("_n").alias(out))


def symbol_coverage(bars: DataFrame, spine: DataFrame, universe: DataFrame) -> DataFrame:
    """Span, rows, eligible sessions, coverage, missing sessions, longest run and first five missing days.

    Only universe symbols that have rows; the numerator is all rows of the symbol.
    """
    span = bars.groupBy("symbol").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("row_count")
    )
    span = span.join(universe.select("symbol", "asset_type"), "symbol")
    span = span.withColumn("_eve", F.date_sub("first_date", 1))
    span = sessions_between(span, spine, "_eve", "last_date", "eligible_sessions").drop("_eve")
    gaps = session_gaps(bars, spine)
    # one pass: the first five missing days come from at most the first five gaps, five sessions each
    rank = F.row_number().over(Window.partitionBy("symbol").orderBy("before"))
    size = F.col("after") - F.col("before") - 1
    holes = gaps.withColumn("_r", rank).groupBy("symbol").agg(
        F.sum(size).cast("bigint").alias("missing"), F.max(size).cast("bigint").alias("run"),
        F.array_sort(F.collect_list(F.when(F.col("_r") <= 5, F.struct("before", "after")))).alias("_gaps"),
    )
    days = spine.agg(F.sort_array(F.collect_list("date"))).scalar()  # calendar-bounded
    places = F.flatten(F.transform("_gaps", lambda g: F.sequence(g["before"] + 1, F.least(g["before"] + 5, g["after"] - 1))))
    sample = F.transform(F.slice(places, 1, 5), lambda i: F.date_format(F.get(F.col("_days"), i - 1), "yyyy-MM-dd"))
    x = span.join(holes, "symbol", "left").withColumn("_days", days).withColumn("sample", sample)
    pct = F.round(F.lit(100.0) * F.col("row_count") / F.col("eligible_sessions"), 2)
    return x.select(
        "symbol", "asset_type", "first_date", "last_date", "row_count",
        F.col("eligible_sessions").cast("bigint").alias("eligible_sessions"),
        F.when(F.col("eligible_sessions") > 0, pct).otherwise(0.0).alias("coverage_pct"),
        F.coalesce("missing", F.lit(0)).alias("internal_missing_sessions"),
        F.coalesce("run", F.lit(0)).alias("max_consecutive_missing"),
        F.coalesce("sample", F.array().cast("array<string>")).alias("sample_missing_dates"),
    )


def field_profile(df: DataFrame, fields: list[str], date: str = "date") -> DataFrame:
    """(field, known, rows, first_known, last_known, pct): every field in one aggregate, then turned to rows."""
    aggs = [F.count("*").alias("_rows")]
    for c in fields:
        known = F.when(F.col(c).isNotNull(), F.col(date))
        aggs += [F.count(c).alias(f"{c}_n"), F.min(known).alias(f"{c}_a"), F.max(known).alias(f"{c}_b")]
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("field"), F.col(f"{c}_n").alias("known"), F.col(f"{c}_a").alias("first_known"), F.col(f"{c}_b").alias("last_known"))
            for c in fields
        ]
    )
    return df.agg(*aggs).select(F.col("_rows").alias("rows"), F.inline(rows)).select(
        "field", "known", "rows", "first_known", "last_known",
        F.round(F.try_divide(F.lit(100.0) * F.col("known"), F.col("rows")), 2).alias("pct"),
    )


def flag_counts(df: DataFrame, flags: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c)).alias(c) for c in flags])


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(
        F.count("*").alias("n"), F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date"),
        F.count("event_time_et").alias("timed"), F.count("reference_period").alias("with_reference"),
        F.countDistinct("event_date").alias("days"),
    )


def duplicates(df: DataFrame, pk: list[str]) -> DataFrame:
    """(pk, n): keys held more than once; NULL keys count as equal."""
    return df.groupBy(*pk).agg(F.count("*").alias("n")).where("n > 1")


def checksum(df: DataFrame, name: str) -> DataFrame:
    """(table, rows, close, adj_close): a cheap before/after comparison; sums of twelve decimals are exact, so order cannot change them."""
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,12)")).alias(c)
    return df.agg(F.count("*").alias("rows"), exact("close"), exact("adj_close")).select(
        F.lit(name).alias("table"), "rows", "close", "adj_close"
    )


def diagnostics(tables: dict[str, DataFrame]) -> DataFrame:
    """One row of counts and ranges over all tables, as scalar subqueries."""
    td, dmd = tables["trading_days"], tables["daily_market_data"]
    n = lambda t: tables[t].agg(F.count("*")).scalar().alias(t)
    return td.sparkSession.range(1).select(
        n("trading_days"), td.agg(F.min("date")).scalar().alias("td_min"), td.agg(F.max("date")).scalar().alias("td_max"),
        n("daily_market_data"), dmd.agg(F.min("date")).scalar().alias("dmd_min"), dmd.agg(F.max("date")).scalar().alias("dmd_max"),
        dmd.agg(F.countDistinct("symbol")).scalar().alias("symbols"),
        *[n(t) for t in ("market_outcomes", "asset_regimes", "macro_conditions", "scheduled_events", "calendar_context")],
    )
