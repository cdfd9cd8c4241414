"""Pages from an order-statistics index against plain sorting, offsets and filters."""

import datetime as dt
import itertools
import os
import random
import re

import pytest

from tidemark import schemas
from tidemark.operators import browse, pages

DAY = dt.date(2020, 1, 1)


def table(spark, n=700, key="daily_market_data"):
    """Bars with heavy ties and nulls in every sort column."""
    pick = random.Random(7)
    rows = [(DAY + dt.timedelta(days=k // 7), f"S{k % 7}", pick.choice([None, 1.5, 2.0, -3.0]), pick.choice([None, pick.random()]), pick.choice([None, *range(3)])) for k in range(n)]
    pick.shuffle(rows)
    return spark.createDataFrame(rows, "date date, symbol string, close double, adj_close double, volume long"), [r for r in rows]


NAMES = ["date", "symbol", "close", "adj_close", "volume"]


def in_order(rows, column, way):
    order = browse.sort_columns(browse.spec_of("daily_market_data"), column, way)
    out = list(rows)
    for c, up in reversed(order):  # nulls are the greatest values
        k = NAMES.index(c)
        out.sort(key=lambda r: (r[k] is None, r[k] if r[k] is not None else type(next((x[k] for x in rows if x[k] is not None), 0))()), reverse=not up)
    return out


def got(df):
    return [tuple(r[c] for c in NAMES) for r in df.collect()]


@pytest.mark.parametrize("column,way", [("volume", "desc"), ("close", "asc"), ("adj_close", "desc"), ("symbol", "asc"), ("date", "desc")])
def test_pages_equal_offsets(spark, folder, column, way):
    df, rows = table(spark)
    index = pages.write(df, os.path.join(folder, "index"), "daily_market_data", column, way, rows_per_range=60)
    want = in_order(rows, column, way)
    assert index.ranges.count() > 5 and index.ranges.groupBy().sum("rows").first()[0] == len(rows)
    for number, size in ((1, 50), (3, 100), (14, 50), (15, 50), (90, 7), (101, 7)):
        page = pages.page(index, number, size)
        assert got(page) == want[(number - 1) * size : number * size]
        assert all(r.total_count == len(rows) for r in page.collect())
    some = browse.Filters(date_from="2020-02-01", symbol="S3")
    held = [r for r in want if r[0] >= dt.date(2020, 2, 1) and r[1] == "S3"]
    for number in (1, 2, 5, 50):
        page = pages.page(index, number, 9, some)
        assert got(page) == held[(number - 1) * 9 : number * 9] and all(r.total_count == len(held) for r in page.collect())


@pytest.mark.parametrize("column,way", [("volume", "desc"), ("close", "asc")])
def test_pages_after_a_row(spark, folder, column, way):
    df, rows = table(spark, 300)
    index = pages.write(df, os.path.join(folder, "index"), "daily_market_data", column, way, rows_per_range=40)
    want = in_order(rows, column, way)
    for k in (0, 7, 99, 150, 290, 299):
        last = dict(zip(NAMES, want[k], strict=True))
        assert got(pages.page_after(index, last, 13)) == want[k + 1 : k + 14]
        some = browse.Filters(symbol="S2")
        assert got(pages.page_after(index, last, 30, some)) == [r for r in want[k + 1 :] if r[1] == "S2"][:30]


def test_order_of_rows_with_nulls(spark):
    """Of any two different keys exactly one comes after the other, in every mix of directions."""
    keys = [(a, b) for a in (None, 1, 2) for b in (None, 1, 2)]
    df = spark.createDataFrame(keys, "a int, b int")
    for up in itertools.product((True, False), repeat=2):
        order = list(zip("ab", up, strict=True))
        later = {k: {(r.a, r.b) for r in df.where(pages.after(order, dict(zip("ab", k, strict=True)))).collect()} for k in keys}
        for x, y in itertools.product(keys, keys):
            assert (x in later[y]) + (y in later[x]) == (x != y)
        assert sorted(len(v) for v in later.values()) == list(range(len(keys)))


def test_a_deep_page_reads_few_ranges(spark, folder):
    df, _ = table(spark)
    index = pages.write(df, os.path.join(folder, "index"), "daily_market_data", "volume", rows_per_range=60)
    plan = pages.page(index, 60, 10)._jdf.queryExecution().executedPlan().toString()
    asked = re.findall(r"PartitionFilters: \[(.*?)\], Pushed", plan)
    assert len(asked) == 1 and "_range" in asked[0] and "Exchange" not in plan
    assert len(re.findall(r"\b\d+\b", re.sub(r"#\d+", "", asked[0]))) <= 2  # the ranges that hold ranks 590 to 599


def test_ranges_grow_where_they_would_be_too_many(spark, folder, monkeypatch):
    monkeypatch.setattr(pages, "MAX_RANGES", 6)
    df, rows = table(spark, 300)
    index = pages.write(df, os.path.join(folder, "index"), "daily_market_data", "close", "desc", rows_per_range=5)
    assert 3 < index.ranges.count() <= 6
    want = in_order(rows, "close", "desc")
    assert got(pages.page(index, 12, 20)) == want[220:240]
    assert got(pages.page_after(index, dict(zip(NAMES, want[149], strict=True)), 30, browse.Filters(symbol="S2"))) == [r for r in want[150:] if r[1] == "S2"][:30]


def test_an_empty_table_has_empty_pages(spark, folder):
    df, _ = table(spark, 5)
    index = pages.write(df.limit(0), os.path.join(folder, "index"), "daily_market_data", "volume")
    assert got(pages.page(index)) == [] == got(pages.page_after(index, {"volume": 1, "date": DAY, "symbol": "S1"}))


def test_what_a_table_does_not_allow_is_refused(spark, folder):
    df, _ = table(spark, 5)
    with pytest.raises(browse.BrowseError):
        pages.write(df, os.path.join(folder, "index"), "daily_market_data", "open")
    assert browse.sort_columns(browse.spec_of("daily_market_data"), "symbol", "desc") == [("symbol", False), ("date", True)]
    assert set(schemas.PRIMARY_KEYS["daily_market_data"]) == {"date", "symbol"}
