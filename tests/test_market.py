import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import market, rank, regimes

D0 = dt.date(2024, 1, 1)


def days(n):
    return [D0 + dt.timedelta(days=i) for i in range(n)]


def bars(spark, prices, symbol="AAA", **over):
    rows = []
    for d, p in zip(days(len(prices)), prices):
        row = dict(
            date=d, symbol=symbol, open=p, high=p + 1.0, low=p - 1.0, close=p, volume=1, adj_open=p, adj_high=p + 1.0,
            adj_low=p - 1.0, adj_close=p, adj_volume=1, dividend_cash=0.0, split_factor=1.0,
        )
        row.update({k: v(d, p) if callable(v) else v for k, v in over.items()})
        rows.append(tuple(row[c] for c, _ in COLS))
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in COLS))


COLS = [(c, t) for c, t in schemas.TABLE_COLUMNS["daily_market_data"] if c not in schemas.DERIVED_COLUMNS]


def ordered(df):
    return df.orderBy("symbol", "date").collect()


def test_first_row_is_null_and_drawdown_starts_at_zero(spark):
    r = ordered(market.daily_fields(bars(spark, [100.0, 110.0, 99.0]), []))
    assert r[0].return_1d is None and r[0].gap_pct is None and r[0].drawdown_from_high == 0
    assert r[1].return_1d == pytest.approx(0.1)
    assert r[2].drawdown_from_high == pytest.approx(-0.1)


def test_adjusted_prices_carry_over_a_split(spark):
    df = bars(spark, [100.0, 51.0], adj_close=lambda d, p: 50.0 if d == D0 else 51.0)
    assert ordered(market.daily_fields(df, []))[1].return_1d == pytest.approx(0.02)


def test_intraday_and_range_use_raw_prices(spark):
    df = bars(spark, [100.0], open=50.0, adj_open=1.0)
    r = ordered(market.daily_fields(df, []))[0]
    assert r.intraday_return == pytest.approx(1.0) and r.range_pct == pytest.approx(2 / 50)


def test_close_only_symbols_use_close_and_keep_other_fields_null(spark):
    df = bars(spark, [20.0, -37.63, 10.0], symbol="wti", **{c: None for c in schemas.OBSERVED_COLUMNS if c != "close"})
    r = ordered(market.daily_fields(df, ["WTI"]))
    assert r[1].return_1d == pytest.approx(-37.63 / 20 - 1)
    assert all(x.gap_pct is None and x.intraday_return is None and x.range_pct is None for x in r)


def test_zero_denominator_is_null(spark):
    assert ordered(market.daily_fields(bars(spark, [0.0, 5.0]), []))[1].return_1d is None


def test_forward_horizons_have_null_tails(spark):
    r = ordered(market.forward_outcomes(bars(spark, [100.0 + i for i in range(25)]), []))
    for n in schemas.RETURN_HORIZONS:
        assert sum(x[f"return_{n}d"] is None for x in r) == n
    assert r[0].return_5d == pytest.approx(0.05)
    assert r[0].max_up_5d == pytest.approx(106 / 100 - 1) and r[0].max_down_5d == pytest.approx(100 / 100 - 1)
    assert sum(x.max_up_20d is None for x in r) == 20


def test_missing_low_makes_max_up_null(spark):
    gone = days(10)[3]
    r = ordered(market.forward_outcomes(bars(spark, [100.0] * 10, adj_low=lambda d, p: None if d == gone else p), []))
    assert r[0].max_up_5d is None and r[3].max_up_5d is not None


def test_zero_return_is_not_positive(spark):
    r = ordered(market.forward_outcomes(bars(spark, [100.0, 100.0]), []))
    assert r[0].positive_1d is False and r[1].positive_1d is None


def test_price_equal_to_its_average_is_not_above(spark):
    daily = market.daily_fields(bars(spark, [100.0] * 21), [])
    universe = spark.createDataFrame([("AAA", "etf")], "symbol string, asset_type string")
    r = ordered(regimes.trailing_fields(daily, universe, []))
    assert r[18].above_20dma is None and r[19].above_20dma is False and r[19].distance_20dma_pct == 0
    assert r[19].volatility_20d is None and r[20].volatility_20d == 0


def test_zero_return_is_mixed_momentum(spark):
    one = spark.range(1)
    label = lambda a, b: one.select(regimes.momentum_label(F.lit(a), F.lit(b)).alias("m")).first().m
    assert label(0.0, 0.1) == "mixed" and label(0.1, 0.1) == "positive" and label(-0.1, -0.1) == "negative"


def test_unknown_symbol_is_an_error(spark):
    daily = market.daily_fields(bars(spark, [1.0]), [])
    universe = spark.createDataFrame([("BBB", "etf")], "symbol string, asset_type string")
    with pytest.raises(Exception, match="unknown symbol AAA"):
        regimes.asset_types(daily, universe).collect()


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 300])
def test_earlier_not_above_equals_brute_force(spark, n):
    values = [(i * 7919 % 13) / 2 for i in range(n)]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "k string, i0 int, v double")
    got = {r.i0: r.k2 for r in rank.earlier_not_above(df, ["k"], ["i0"], "v", out="k2").collect()}
    assert got == {i: sum(values[j] <= values[i] for j in range(i)) for i in range(n)}


def test_expanding_labels_start_at_the_least_count_and_ignore_the_future(spark):
    values = [((i * 37) % 101) / 10 for i in range(270)]
    df = spark.createDataFrame([("a", d, v) for d, v in zip(days(270), values)], "symbol string, date date, volatility_20d double")
    full = {r.date: r.volatility_regime for r in regimes.volatility_regime(df).collect()}
    assert [full[d] is None for d in days(270)] == [i < 251 for i in range(270)]
    for i in (251, 260):
        k = sum(v <= values[i] for v in values[: i + 1]) / (i + 1)
        assert full[days(270)[i]] == ("low" if k <= 1 / 3 else "normal" if k <= 2 / 3 else "high")
    cut = df.where(F.col("date") < days(270)[260])
    assert all(full[r.date] == r.volatility_regime for r in regimes.volatility_regime(cut).collect())


def test_volatility_is_a_sample_deviation(spark):
    p = [100.0]
    for i in range(25):
        p.append(p[-1] * (1.01 if i % 2 else 0.98))
    universe = spark.createDataFrame([("AAA", "etf")], "symbol string, asset_type string")
    r = ordered(regimes.trailing_fields(market.daily_fields(bars(spark, p), []), universe, []))
    x = [p[i] / p[i - 1] - 1 for i in range(1, 21)]
    m = sum(x) / 20
    assert r[20].volatility_20d == pytest.approx(math.sqrt(sum((v - m) ** 2 for v in x) / 19 * 252))
