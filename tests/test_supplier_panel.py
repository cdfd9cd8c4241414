"""The panel of suppliers: bars of line items by one exchange, labels without another."""

import datetime as dt
import os
import random

from tidemark.operators import rank, regimes
from tidemark.plans import suite_suppliers

DAY = dt.date(1998, 5, 4)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange " in line and "BroadcastExchange" not in line]


def tables(spark, folder):
    """Two suppliers and one without a key; a day with several items, days without one, weekends (no sessions) and a missing day."""
    days = [DAY + dt.timedelta(days=k) for k in range(40)]
    items = [(s, d, float(100 * s + k), k, s) for s in (1, 2) for k, d in enumerate(days) if (k + s) % 5] + [(1, days[2], 7.0, 99, 1), (None, days[1], 5.0, 98, 1), (2, None, 5.0, 97, 1)]
    cols = "l_suppkey long, l_shipdate date, l_extendedprice double, l_orderkey long, l_linenumber int"
    spark.createDataFrame(items, cols).write.parquet(os.path.join(folder, "lineitem.parquet"))
    spark.createDataFrame([(d,) for d in days], "o_orderdate date").write.parquet(os.path.join(folder, "orders.parquet"))
    return items


def test_bars_and_windows_need_one_exchange(spark, folder):
    items = tables(spark, folder)
    daily = suite_suppliers.build_daily(spark, folder)
    for made in (suite_suppliers.build_bars(spark, folder), daily):
        assert len([e for e in exchanges(made) if "hashpartitioning" in e]) == 1
    got = {(r.symbol, r.date): r for r in daily.collect()}
    held = {}
    for s, d, px, o, n in items:
        if d is not None and d.weekday() < 5:
            held.setdefault((None if s is None else f"S{s}", d), []).append((o * 10 + n, px))
    assert set(got) == set(held)
    for k, xs in held.items():
        r = got[k]
        assert r.close == max(xs)[1]
        if k[0] is not None:
            assert (r.open, r.high, r.low, r.volume) == (min(xs)[1], max(x for _, x in xs), min(x for _, x in xs), len(xs))


def test_earlier_rows_are_counted_in_place(spark):
    pick = random.Random(3)
    rows = [(k, i, pick.choice([1.0, 2.0, 3.0, 4.5])) for k in "ab" for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i int, v double").repartition("k")
    ranked = rank.earlier_not_above(df, ["k"], ["i"], "v", out="n")
    assert len(exchanges(ranked)) == 1 and "Join" not in ranked._jdf.queryExecution().executedPlan().toString()
    assert {(r.k, r.i, r.v, r.n) for r in ranked.collect()} == {
        (k, i, v, sum(1 for a, b, c in rows if a == k and b < i and c <= v)) for k, i, v in rows
    }


def test_labels_meet_rows_by_symbol(spark):
    pick = random.Random(5)
    rows = [(s, DAY + dt.timedelta(days=i), pick.choice([None, round(pick.random(), 1)])) for s in ("A", "B", "C", None) for i in range(400)]
    rows = [(s, d, None if s == "C" else v) for s, d, v in rows]
    df = spark.createDataFrame(rows, "symbol string, date date, volatility_20d double").repartition("symbol")
    labelled, together = regimes.labelled(df), "spark.sql.requireAllClusterKeysForCoPartition"
    held = spark.conf.get(together)
    spark.conf.set(together, "true")  # as a session that sets nothing has it
    try:
        assert not [e for e in exchanges(labelled) if "date" in e]
    finally:
        spark.conf.set(together, held)
    least, want = regimes.schemas.VOL_MIN_OBSERVATIONS, {}
    for s, d, v in rows:
        seen = [x for a, b, x in rows if a == s and b <= d and x is not None]
        k, n = sum(x <= v for x in seen) if v is not None else 0, len(seen)
        none = s is None or v is None or n < least
        want[s, d] = (v, None if none else "low" if 3 * k <= n else "normal" if 3 * k <= 2 * n else "high")
    assert {(r.symbol, r.date): (r.volatility_20d, r.volatility_regime) for r in labelled.collect()} == want


def test_labels_of_repeated_days(spark):
    """Rows and labels of a day meet as in a join by symbol and day; a row without a value takes its day's label, one without a day none."""
    days = [DAY + dt.timedelta(days=i) for i in range(280)]
    rows = [("A", d, 0.5) for d in days for _ in range(2)] + [("B", d, 0.5) for d in days] + [("B", days[-1], None), ("B", None, None), ("C", days[0], None)]
    df = spark.createDataFrame(rows, "symbol string, date date, volatility_20d double")
    got = [(r.symbol, r.date, r.volatility_20d, r.volatility_regime) for r in regimes.labelled(df).collect()]
    assert sum(r[0] == "A" for r in got) == 4 * len(days) and {r[3] for r in got if r[0] == "A"} == {None, "high"}
    assert ("B", days[-1], None, "high") in got and ("B", None, None, None) in got and ("C", days[0], None, None) in got
    assert sum(r[0] == "B" for r in got) == len(days) + 2
