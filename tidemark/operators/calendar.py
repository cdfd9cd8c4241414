"""The trading-day table and holiday context of the spine (calendar-bounded data)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import calendar_parts



def _spine():
    """One group: the spine is bounded by the calendar."""
    return Window.orderBy("date")



def counters() -> dict[str, Column]:
    """Ordinals and ends by position among the sessions of a month, quarter or year."""
    m, q, y = Window.partitionBy("year", "month"), Window.partitionBy("year", "quarter"), Window.partitionBy("year")
    date = F.col("date")
    in_month = F.row_number().over(m.orderBy("date"))
    return {
        "trading_day_of_month": in_month,
        "trading_day_of_year": F.row_number().over(y.orderBy("date")),
        "days_to_month_end": (F.count("*").over(m) - in_month).cast("int"),
        "is_month_end": date == F.max("date").over(m),
        "is_quarter_end": date == F.max("date").over(q),
        "is_year_end": date == F.max("date").over(y),
        "prev_trading_date": F.lag("date").over(_spine()),
        "next_trading_date": F.lead("date").over(_spine()),
    }


def trading_days(sessions: DataFrame) -> DataFrame:
    """Calendar parts and counters of each session."""
    x = sessions.select("date", *[c.alias(n) for n, c in calendar_parts(F.col("date")).items()])
    return x.select("*", *[c.alias(n) for n, c in counters().items()])


# ---------------------------------------------------------------- holidays
def holiday_catalog(rules: DataFrame, special: DataFrame) -> DataFrame:
    """(date, name, type): named rule days and ad-hoc closures.

    ``rules`` is (date, name, position): the first rule of a day names it.  A day
    in ``special`` (date) is exceptional, named by a rule if one matches.
    """
    named = rules.groupBy("date").agg(F.min_by("name", "position").alias("name"))
    adhoc = special.select("date").distinct().withColumn("_x", F.lit(True))
    both = named.join(adhoc, "date", "full_outer")
    return both.select(
        "date",
        F.coalesce("name", F.lit("Exceptional Closure")).alias("name"),
        F.when(F.col("_x"), "exceptional").otherwise("regular").alias("type"),
    )


def closed_weekdays(trading: DataFrame, catalog: DataFrame) -> DataFrame:
    """(prev, next, closed, name, type): weekdays strictly between consecutive sessions.

    A closure missing from the catalog is a regular "Market Closure".
    """
    span = F.sequence(F.date_add("date", 1), F.date_sub("next_trading_date", 1))
    gaps = trading.where(F.date_diff("next_trading_date", "date") > 1)
    x = gaps.select(F.col("date").alias("prev"), F.col("next_trading_date").alias("next"), F.explode(span).alias("closed"))
    c = catalog.select(F.col("date").alias("closed"), "name", "type")
    return (
        x.where(F.weekday("closed") < 5).join(F.broadcast(c), "closed", "left")
        .select("prev", "next", "closed", F.coalesce("name", F.lit("Market Closure")).alias("name"),
                F.coalesce("type", F.lit("regular")).alias("type"))
    )


def gap_names(closed: DataFrame) -> DataFrame:
    """(prev, next, names, exceptional): closure names of each gap, in order, each once."""
    ordered = F.array_sort(F.collect_list(F.struct("closed", "name")))  # at most the weekdays of one gap
    return closed.groupBy("prev", "next").agg(
        F.array_distinct(F.transform(ordered, lambda s: s["name"])).alias("names"),
        F.bool_or(F.col("type") == "exceptional").alias("exceptional"),
    )


def join_names(forward: Column, backward: Column) -> Column:
    """Forward then backward gap names, each once, pipe-joined; NULL when neither side has any."""
    none = F.array().cast("array<string>")
    both = F.array_distinct(F.concat(F.coalesce(forward, none), F.coalesce(backward, none)))
    return F.when(F.size(both) > 0, F.array_join(both, "|"))


def holiday_context(trading: DataFrame, catalog: DataFrame) -> DataFrame:
    gaps = gap_names(closed_weekdays(trading, catalog))
    fwd = gaps.select(F.col("prev").alias("date"), F.col("names").alias("_fn"), F.col("exceptional").alias("_fx"))
    back = gaps.select(F.col("next").alias("date"), F.col("names").alias("_bn"), F.col("exceptional").alias("_bx"))
    x = trading.select("date").join(F.broadcast(fwd), "date", "left").join(F.broadcast(back), "date", "left")
    near = F.col("_fn").isNotNull() | F.col("_bn").isNotNull()
    special = F.coalesce("_fx", F.lit(False)) | F.coalesce("_bx", F.lit(False))
    return x.select(
        "date",
        F.col("_fn").isNotNull().alias("is_day_before_holiday"),
        F.col("_bn").isNotNull().alias("is_day_after_holiday"),
        join_names(F.col("_fn"), F.col("_bn")).alias("holiday_name"),
        F.when(near, F.when(special, "exceptional").otherwise("regular")).alias("holiday_type"),
    )


# ------------------------------------------------------- weeks, transitions
def week_counts(trading: DataFrame) -> DataFrame:
    """Sessions in each ISO week; weeks at the edge of the spine count only what it holds."""
    n = F.count("*").over(Window.partitionBy(F.trunc("date", "week")))
    return trading.select("date", n.cast("int").alias("trading_days_in_week"), (n < 5).alias("is_shortened_week"))


def transitions() -> dict[str, Column]:
    q, y = Window.partitionBy("year", "quarter"), Window.partitionBy("year")
    return {
        "is_turn_of_month": F.col("is_month_end") | (F.col("trading_day_of_month") == 1),
        "is_quarter_transition": F.col("is_quarter_end") | (F.col("date") == F.min("date").over(q)),
        "is_year_transition": F.col("is_year_end") | (F.col("date") == F.min("date").over(y)),
    }


def shortened_days(trading: DataFrame, early_closes: DataFrame) -> DataFrame:
    e = F.broadcast(early_closes.select("date").distinct().withColumn("_e", F.lit(True)))
    return trading.select("date").join(e, "date", "left").select(
        "date", F.coalesce("_e", F.lit(False)).alias("is_shortened_trading_day")
    )


def calendar_context(trading: DataFrame, events: DataFrame, catalog: DataFrame, early_closes: DataFrame) -> DataFrame:
    """One row per session: holiday, week, transition and event context."""
    from tidemark.operators.events import event_flags, sessions_since

    base = trading.select("date", *[c.alias(n) for n, c in transitions().items()])
    parts = [
        holiday_context(trading, catalog),
        shortened_days(trading, early_closes),
        week_counts(trading),
        event_flags(trading, events),
        sessions_since(trading, events),
    ]
    for p in parts:
        base = base.join(p, "date", "left")
    return base
