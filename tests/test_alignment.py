import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, calendar, events, macro
from tidemark.sources.calendar import election_days, session_dates, span_of

D = dt.date


def frame(spark, days, name="date"):
    return spark.createDataFrame([(d,) for d in days], f"{name} date")


@pytest.fixture(scope="module")
def spine(spark):
    return frame(spark, [D(2024, 1, 2), D(2024, 1, 3), D(2024, 1, 4), D(2024, 1, 5), D(2024, 1, 8)])


@pytest.mark.parametrize(
    "day,timing,want",
    [
        (D(2024, 1, 3), "pre_open", D(2024, 1, 3)), (D(2024, 1, 6), "pre_open", D(2024, 1, 8)),
        (D(2024, 1, 4), "after_close", D(2024, 1, 5)), (D(2024, 1, 6), "observation_date", None),
        (D(2024, 1, 8), "after_close", None), (D(2024, 1, 9), "pre_open", None),
        (D(1900, 5, 5), "pre_open", D(2024, 1, 2)), (D(1900, 5, 5), "observation_date", None),
        (D(2024, 1, 8), "observation_date", D(2024, 1, 8)), (None, "pre_open", None),
    ],
)
def test_availability(spark, spine, day, timing, want):
    df = spark.createDataFrame([(day,)], "day date")
    assert asof.map_to_session(df, spine, "day", timing).first().session == want


def test_unknown_timing(spark, spine):
    with pytest.raises(ValueError):
        asof.map_to_session(frame(spark, [D(2024, 1, 3)], "day"), spine, "day", "noon")


def test_neighbours_and_session_counts(spark, spine):
    days = [D(2023, 12, 1), D(2024, 1, 2), D(2024, 1, 6), D(2024, 1, 8), D(2024, 2, 1)]
    r = asof.neighbours(frame(spark, days, "day"), spine, "day").orderBy("day").collect()
    assert [(x.prev_session, x.next_session) for x in r] == [
        (None, D(2024, 1, 2)), (None, D(2024, 1, 3)), (D(2024, 1, 5), D(2024, 1, 8)), (D(2024, 1, 5), None), (D(2024, 1, 8), None),
    ]
    pairs = spark.createDataFrame([(D(2024, 1, 2), D(2024, 1, 8)), (D(2024, 1, 8), D(2024, 1, 2)), (D(2020, 1, 1), D(2030, 1, 1)), (None, D(2024, 1, 2))], "a date, b date")
    got = [x.lag_sessions for x in asof.sessions_between(pairs, spine, "a", "b").orderBy("a").collect()]
    assert got == [None, 5, 4, 0]


V = "ref_date date, value double, realtime_start date, realtime_end date, ordinal long"


def test_validity_is_half_open_and_the_last_row_wins(spark):
    v = spark.createDataFrame(
        [(D(2020, 1, 1), 1.0, D(2020, 2, 1), D(2020, 3, 1), 1), (D(2020, 1, 1), 2.0, D(2020, 3, 1), D(9999, 12, 31), 2),
         (D(2020, 1, 1), 3.0, D(2020, 3, 1), D(9999, 12, 31), 3)], V)
    days = frame(spark, [D(2020, 1, 31), D(2020, 2, 1), D(2020, 2, 29), D(2020, 3, 1), D(2024, 6, 1)], "as_of")
    got = {r.as_of: r.value for r in asof.as_of_state(v, days).collect()}
    assert got == {D(2020, 2, 1): 1.0, D(2020, 2, 29): 1.0, D(2020, 3, 1): 3.0, D(2024, 6, 1): 3.0}


def test_no_change_on_the_year_for_leap_days_or_zero_base(spark):
    s = spark.createDataFrame(
        [(D(2024, 3, 1), D(2024, 2, 29), 5.0), (D(2024, 3, 1), D(2023, 2, 28), 4.0), (D(2024, 3, 1), D(2023, 1, 1), 0.0),
         (D(2024, 3, 1), D(2024, 1, 1), 3.0), (D(2024, 3, 1), D(2024, 2, 28), 6.0)], "as_of date, ref_date date, value double")
    got = {r.ref_date: r.yoy for r in asof.yoy_in_state(s).collect()}
    assert got[D(2024, 2, 29)] is None and got[D(2024, 1, 1)] is None
    assert got[D(2024, 2, 28)] == pytest.approx(50.0)


def test_missing_reading_does_not_clear_the_series(spark):
    sp = frame(spark, [D(2020, 1, d) for d in (2, 3, 6, 7)])
    v = spark.createDataFrame(
        [("cpi", D(2019, 1, 1), 100.0, D(2020, 1, 1), D(9999, 12, 31), 1), ("cpi", D(2020, 1, 1), 110.0, D(2020, 1, 2), D(9999, 12, 31), 2),
         ("cpi", D(2020, 2, 1), 111.0, D(2020, 1, 6), D(9999, 12, 31), 3)], "series string, " + V)
    got = [r.value for r in macro.carried(macro.sparse_pit(v, sp), sp).orderBy("date").collect()]
    assert got == [pytest.approx(10.0)] * 4  # February has no base, January's stays


def test_nothing_is_known_before_its_release(spark):
    sp = frame(spark, [D(2020, 1, d) for d in (2, 3, 6)])
    v = spark.createDataFrame([("unrate", D(2019, 12, 1), 3.5, D(2020, 1, 3), D(9999, 12, 31), 1)], "series string, " + V)
    assert [r.value for r in macro.carried(macro.sparse_pit(v, sp), sp).orderBy("date").collect()] == [None, 3.5, 3.5]


def test_first_print_ties_keep_the_earlier_row(spark):
    v = spark.createDataFrame([(D(2020, 1, 1), 2.0, D(2020, 2, 1), D(2020, 3, 1), 2), (D(2020, 1, 1), 1.0, D(2020, 2, 1), D(2020, 3, 1), 1)], V)
    assert macro.first_prints(v).first().value == 1.0


@pytest.mark.parametrize("n,first", [(35, None), (36, "high")])
def test_release_labels_need_enough_releases(spark, n, first):
    days = [D(2020, 1, 1) + dt.timedelta(days=i) for i in range(n)]
    rel = spark.createDataFrame([(d, float(i)) for i, d in enumerate(days)], "date date, yoy double")
    lev = spark.createDataFrame([(days[-1], float(n))], "date date, inflation_rate double")
    assert macro.inflation_regime(lev, rel).first().inflation_regime == first


def test_rate_label_after_63_known_values(spark):
    days = [D(2020, 1, 1) + dt.timedelta(days=i) for i in range(65)]
    vals = [1.0] * 63 + [None, 1.25]
    df = spark.createDataFrame(list(zip(days, vals)), "date date, fed_funds_rate double")
    got = {r.date: r.rate_regime for r in macro.rate_regime(df).collect()}
    assert got[days[62]] is None and days[63] not in got and got[days[64]] == "tightening"


def test_bad_vintage_text_raises_and_gaps_drop(spark):
    cols = "date string, value string, realtime_start string, realtime_end string"
    ok = spark.createDataFrame([("2020-01-01", ".", "2020-02-01", "9999-12-31"), ("2020-01-01", "", "2020-02-01", "9999-12-31"),
                                ("2020-01-01T00", "1.5", "2020-02-01", "9999-12-31")], cols)
    assert [r.value for r in macro.parse_vintages(ok).collect()] == [1.5]
    with pytest.raises(Exception):
        macro.parse_vintages(spark.createDataFrame([("2020-01-01", "abc", "2020-02-01", "9999-12-31")], cols)).collect()


def test_weekly_level_is_usable_after_the_next_day(spark):
    sp = frame(spark, [D(2024, 1, 3), D(2024, 1, 4), D(2024, 1, 5)])
    obs = spark.createDataFrame([("walcl", D(2024, 1, 3), 7.0)], "series string, date date, value double")
    assert macro.sparse_current(obs, sp, "after_close", 1).first().date == D(2024, 1, 5)


# ---------------------------------------------------------------- calendar
def test_trading_day_counters_over_a_year_end(spark):
    sp = frame(spark, [D(2020, 12, 30), D(2020, 12, 31), D(2021, 1, 4)])
    a, b, c = calendar.trading_days(sp).orderBy("date").collect()
    assert (a.days_to_month_end, b.is_year_end, b.is_quarter_end, c.trading_day_of_year) == (1, True, True, 1)
    assert a.prev_trading_date is None and c.next_trading_date is None and b.next_trading_date == c.date
    assert (b.week_of_year, b.weekday) == (53, 4)


def test_session_calendar_empty_when_reversed(spark):
    none = spark.createDataFrame([], "date date")
    assert session_dates(span_of(spark, "1956-01-01"), none).count() == 0
    assert session_dates(span_of(spark, "2024-01-07", "2024-01-05"), none).count() == 1


def test_elections(spark):
    got = [(r.event_date, r.kind) for r in election_days(span_of(spark, "2022-12-31", "2019-01-01")).orderBy("event_date").collect()]
    assert got == [(D(2020, 11, 3), "presidential"), (D(2022, 11, 8), "midterm")]
    assert election_days(span_of(spark, "2020-11-02", "2019-01-01")).count() == 0


def test_holiday_names_forward_then_backward_each_once(spark):
    sp = frame(spark, [D(2024, 1, 2), D(2024, 1, 4), D(2024, 1, 8), D(2024, 1, 9)])
    rules = spark.createDataFrame([(D(2024, 1, 3), "A", 2), (D(2024, 1, 3), "First", 1)], "date date, name string, position int")
    cat = calendar.holiday_catalog(rules, frame(spark, [D(2024, 1, 5)]))
    x = {r.date: r for r in calendar.holiday_context(calendar.trading_days(sp), cat).collect()}
    assert x[D(2024, 1, 2)].holiday_name == "First" and x[D(2024, 1, 2)].holiday_type == "regular"
    assert x[D(2024, 1, 4)].holiday_name == "Exceptional Closure|First" and x[D(2024, 1, 4)].holiday_type == "exceptional"
    assert x[D(2024, 1, 9)].holiday_name is None and not x[D(2024, 1, 9)].is_day_after_holiday
    assert calendar.holiday_context(calendar.trading_days(sp), cat.where("false")).where("holiday_name = 'Market Closure'").count() == 3


def test_off_calendar_event_counts_from_the_next_session(spark, spine):
    ev = spark.createDataFrame([("election", D(2024, 1, 6)), ("election", D(2024, 1, 7)), ("cpi", D(2024, 2, 1))], "event_type string, event_date date")
    t = calendar.trading_days(spine)
    since = {r.date: r.days_since_last_election for r in events.sessions_since(t, ev).collect()}
    assert since[D(2024, 1, 5)] is None and since[D(2024, 1, 8)] == 0
    assert events.event_flags(t, ev).where("is_election_day").count() == 0
    assert events.anchors(ev, spine).count() == 1


def test_single_session(spark):
    t = calendar.trading_days(frame(spark, [D(2024, 1, 2)]))
    r = t.first()
    assert r.is_month_end and r.prev_trading_date is None and r.next_trading_date is None
    assert calendar.week_counts(t).first().is_shortened_week


def test_event_id_treats_empty_text_as_missing(spark):
    from tidemark.functions.scalar import event_id

    one = spark.range(1).select(event_id(F.lit("cpi"), F.to_date(F.lit("2024-01-11")), F.lit(""), F.lit(None).cast("string")).alias("e"))
    assert one.first().e == "cpi:2024-01-11:NA:MARKET"
