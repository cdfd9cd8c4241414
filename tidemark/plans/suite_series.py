"""The window operators on series without a length bound: event streams, few keys holding all rows."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tidemark.functions.scalar import change
from tidemark.operators import longseries, rank
from tidemark.plans import recipes as r
from tidemark.plans.registry import query

S = "FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id)"


def ticks(spark, sf):
    e = r.table(spark, sf, "events").select("event_type", "event_id", F.col("value").alias("p"))
    return longseries.numbered(e, ["event_type"], "event_id")


@query("w1_returns_on_ticks", f"SELECT event_type, event_id, row_number() OVER w - 1 AS i, value / nullif(lag(value) OVER w, 0) - 1 AS return_1 {S}", "return_1")
def _(spark, sf):
    x = longseries.with_windows(ticks(spark, sf), 1, 0, lambda w: {"return_1": change(F.col("p"), F.lag("p").over(w))})
    return x.select("event_type", "event_id", F.col("i").cast("bigint").alias("i"), "return_1")


@query("w4_drawdown_on_ticks", "SELECT event_type, event_id, value / nullif(max(value) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING), 0) - 1 AS drawdown FROM events", "drawdown")
def _(spark, sf):
    x = longseries.running(ticks(spark, sf), "p", "max", "high")
    return x.select("event_type", "event_id", change(F.col("p"), F.col("high")).alias("drawdown"))


@query("w5_forward_returns_on_ticks", f"""SELECT event_type, event_id, lead(value, 5) OVER w / nullif(value, 0) - 1 AS return_5,
  lead(value, 20) OVER w / nullif(value, 0) - 1 AS return_20 {S}""", "return_5 return_20")
def _(spark, sf):
    ahead = lambda w, n: change(F.lead("p", n).over(w), F.col("p"))
    x = longseries.with_windows(ticks(spark, sf), 0, 20, lambda w: {"return_5": ahead(w, 5), "return_20": ahead(w, 20)})
    return x.select("event_type", "event_id", "return_5", "return_20")


@query("w6_forward_extremes_on_ticks", """SELECT event_type, event_id, CASE WHEN count(value) OVER f = 20 THEN max(value) OVER f / nullif(value, 0) - 1 END AS max_up,
  CASE WHEN count(value) OVER f = 20 THEN min(value) OVER f / nullif(value, 0) - 1 END AS max_down FROM events
WINDOW f AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING)""", "max_up max_down")
def _(spark, sf):
    def cols(w):
        f = w.rowsBetween(1, 20)
        whole = F.count("p").over(f) == 20
        return {
            "max_up": F.when(whole, change(F.max("p").over(f), F.col("p"))), "max_down": F.when(whole, change(F.min("p").over(f), F.col("p")))
        }

    return longseries.with_windows(ticks(spark, sf), 0, 20, cols).select("event_type", "event_id", "max_up", "max_down")


@query("w8_forward_fill_on_ticks", """SELECT event_type, event_id, last_value(CASE WHEN event_id % 7 = 0 THEN value END IGNORE NULLS)
  OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS carried FROM events""", "carried")
def _(spark, sf):
    e = r.table(spark, sf, "events").select("event_type", "event_id", F.when(F.col("event_id") % 7 == 0, F.col("value")).alias("p"))
    x = longseries.running(longseries.numbered(e, ["event_type"], "event_id"), "p", "last", "carried")
    return x.select("event_type", "event_id", "carried")


@query("w15_moving_average_on_ticks", """SELECT event_type, event_id, CASE WHEN count(value) OVER a = 50 THEN avg(value) OVER a END AS sma_50,
  CASE WHEN count(value) OVER b = 200 THEN avg(value) OVER b END AS sma_200 FROM events
WINDOW a AS (PARTITION BY event_type ORDER BY event_id ROWS 49 PRECEDING), b AS (PARTITION BY event_type ORDER BY event_id ROWS 199 PRECEDING)""", "sma_50 sma_200")
def _(spark, sf):
    def mean(w, n):
        f = w.rowsBetween(-(n - 1), 0)
        return F.when(F.count("p").over(f) == n, F.avg("p").over(f))

    x = longseries.with_windows(ticks(spark, sf), 199, 0, lambda w: {"sma_50": mean(w, 50), "sma_200": mean(w, 200)})
    return x.select("event_type", "event_id", "sma_50", "sma_200")


@query("w16_volatility_on_ticks", f"""SELECT event_type, event_id, CASE WHEN count(x) OVER v = 20 THEN stddev_samp(x) OVER v * sqrt(252) END AS volatility
FROM (SELECT event_type, event_id, ln(value) AS x FROM events) WINDOW v AS (PARTITION BY event_type ORDER BY event_id ROWS 19 PRECEDING)""", "volatility")
def _(spark, sf):
    e = r.table(spark, sf, "events").select("event_type", "event_id", F.ln("value").alias("p"))
    s = longseries.numbered(e, ["event_type"], "event_id")

    def cols(w):
        f = w.rowsBetween(-19, 0)
        return {"volatility": F.when(F.count("p").over(f) == 20, F.stddev_samp("p").over(f) * math.sqrt(252))}

    return longseries.with_windows(s, 19, 0, cols).select("event_type", "event_id", "volatility")


RANKED = """(SELECT a.event_type, a.event_id, count(*) AS n, count(*) FILTER (b.value <= a.value) AS k
FROM events a JOIN events b ON a.event_type = b.event_type AND b.event_id <= a.event_id GROUP BY 1, 2)"""


def ranked(spark, sf):
    s = ticks(spark, sf)
    return longseries.expanding_rank(s, "p").join(s.rows.select("event_type", "i", "event_id"), ["event_type", "i"])


@query("w19_expanding_rank_on_ticks", f"SELECT event_type, event_id, k, n FROM {RANKED}")
def _(spark, sf):
    return ranked(spark, sf).select("event_type", "event_id", F.col("k").cast("bigint").alias("k"), F.col("n").cast("bigint").alias("n"))


@query("w19_expanding_regime_on_ticks", f"""SELECT event_type, event_id, CASE WHEN n < 252 THEN NULL WHEN 3 * k <= n THEN 'low' WHEN 3 * k <= 2 * n THEN 'normal' ELSE 'high' END AS regime
FROM {RANKED}""")
def _(spark, sf):
    return ranked(spark, sf).select("event_type", "event_id", rank.tercile(F.col("k"), F.col("n"), 252).alias("regime"))


@query("w23_first_rows_on_ticks", "SELECT event_type, min(event_id) AS first_id, arg_min(value, event_id) AS first_value, max(event_id) AS last_id, arg_max(value, event_id) AS last_value FROM events GROUP BY 1", "first_value last_value")
def _(spark, sf):
    e = r.table(spark, sf, "events")
    return e.groupBy("event_type").agg(
        F.min("event_id").alias("first_id"), F.min_by("value", "event_id").alias("first_value"),
        F.max("event_id").alias("last_id"), F.max_by("value", "event_id").alias("last_value"),
    )
