"""Series split over blocks against one pass over the key, with one key holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import longseries


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = [("hot" if rnd.random() < 0.8 else f"k{rnd.randrange(3)}", i, float(rnd.randrange(12)) if rnd.random() > 0.1 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    by_key = {}
    for k, t, v in rows:
        by_key.setdefault(k, []).append((t, v))
    return df, by_key


@pytest.fixture(scope="module")
def series(spark, data):
    s = longseries.numbered(data[0], ["k"], "t", parts=30)
    assert s.block <= 100
    return s


def test_numbering_is_the_row_number(series, data):
    got = {(r.k, r.t): r.i for r in series.rows.collect()}
    assert got == {(k, t): i for k, rows in data[1].items() for i, (t, _) in enumerate(rows)}


def test_frames_reach_over_block_edges(series, data):
    def cols(w):
        return {"lag7": F.lag("v", 7).over(w), "lead3": F.lead("v", 3).over(w), "sum": F.sum("v").over(w.rowsBetween(-9, 4))}

    got = {(r.k, r.t): (r.lag7, r.lead3, r["sum"]) for r in longseries.with_windows(series, 9, 4, cols).collect()}
    for k, rows in data[1].items():
        v = [x for _, x in rows]
        for i, (t, _) in enumerate(rows):
            near = [x for x in v[max(0, i - 9): i + 5] if x is not None]
            want = (v[i - 7] if i >= 7 else None, v[i + 3] if i + 3 < len(v) else None, sum(near) if near else None)
            assert got[(k, t)] == want
    assert len(got) == sum(map(len, data[1].values()))


@pytest.mark.parametrize("fold", ["max", "last"])
def test_running_folds(series, data, fold):
    got = {(r.k, r.t): r.x for r in longseries.running(series, "v", fold, "x").collect()}
    for k, rows in data[1].items():
        cur = None
        for t, v in rows:
            if v is not None:
                cur = v if fold == "last" or cur is None else max(cur, v)
            assert got[(k, t)] == cur


def test_expanding_rank_with_many_ties(spark, data):
    known = data[0].where("v IS NOT NULL")
    s = longseries.numbered(known, ["k"], "t", parts=30)
    out = longseries.expanding_rank(longseries.Series(s.rows.withColumnRenamed("k", "key"), ["key"], s.block, s.parts), "v").collect()
    got = {(r.key, r.i): (r.k, r.n) for r in out}
    for k, rows in data[1].items():
        v = [x for _, x in rows if x is not None]
        for i in range(len(v)):
            assert got[(k, i)] == (sum(x <= v[i] for x in v[: i + 1]), i + 1)


def test_unknown_fold(series):
    with pytest.raises(ValueError):
        longseries.running(series, "v", "min", "x")


@pytest.mark.parametrize("n,parts", [(900, 40), (300, 280), (1, 3), (0, 2)])
def test_expanding_rank_over_levels(spark, n, parts):
    """More blocks than a node has children, blocks of one row, equal values and nulls across blocks."""
    pick = random.Random(n)
    values = {1: [pick.choice([None, *range(20)]) for _ in range(n)], 2: [pick.random() for _ in range(min(n, 50))]}
    rows = [(s, i, None if v is None else float(v)) for s, vs in values.items() for i, v in enumerate(vs)]
    s = longseries.numbered(spark.createDataFrame(rows, "s int, o int, v double"), ["s"], "o", parts)
    got = sorted((r.s, r.i, r.k, r.n) for r in longseries.expanding_rank(s, "v").collect())
    want = [(s, i, sum(w is not None and w <= v for w in vs[: i + 1]), i + 1) for s, vs in values.items() for i, v in enumerate(vs) if v is not None]
    assert got == sorted(want)
