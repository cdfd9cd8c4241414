"""Generated sources: session calendars and statutory election days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_START = "1957-01-01"


def session_dates(span: DataFrame, closures: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Distinct weekdays in each [lo, hi] of ``span`` that are not full closures.

    Empty when hi < lo.  The closure list is calendar-sized, so it is broadcast.
    """
    days = (
        span.where(F.col(lo) <= F.col(hi))
        .select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias("date"))
        .where(F.weekday("date") < 5)
        .distinct()
    )
    return days.join(F.broadcast(closures.select("date")), "date", "left_anti")


def span_of(spark, end: str, start: str = DEFAULT_START) -> DataFrame:
    """A one-row [lo, hi] span with the default first day."""
    return spark.range(1).select(F.lit(start).cast("date").alias("lo"), F.lit(end).cast("date").alias("hi"))


def election_days(span: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """(event_date, kind) for even years: Tuesday after the first Monday of November, inside the span."""
    y0 = F.year(lo) + F.year(lo) % 2
    even = F.when(y0 <= F.year(hi), F.sequence(y0, F.year(hi), F.lit(2)))
    monday = F.next_day(F.date_sub(F.make_date("y", F.lit(11), F.lit(1)), 1), "MON")
    return (
        span.select(lo, hi, F.explode(even).alias("y"))
        .select(
            lo, hi, F.date_add(monday, 1).alias("event_date"),
            F.when(F.col("y") % 4 == 0, "presidential").otherwise("midterm").alias("kind"),
        )
        .where(F.col("event_date").between(F.col(lo), F.col(hi)))
        .select("event_date", "kind")
    )
