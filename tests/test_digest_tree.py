"""Hash trees over keyed tables: the same table by any way has the same root, and edits are found where they are."""

import datetime as dt
import random

import pytest

from tidemark.operators import digest_tree

KEYS = ["symbol", "date"]
SCHEMA = "date date, symbol string, close double, note string"


def rows(n, seed=1):
    pick = random.Random(seed)
    return [(dt.date(2000, 1, 1) + dt.timedelta(days=k // 9), f"S{k % 9}" if k % 9 else None, pick.choice([None, 1.5, pick.random()]), pick.choice([None, "", "x|y"])) for k in range(n)]


def tree(spark, data, parts=5):
    return digest_tree.tree(spark.createDataFrame(data, SCHEMA).repartition(parts), KEYS)


def test_order_and_partitions_make_no_difference(spark):
    data = rows(3000)
    a, b = tree(spark, data, 2), tree(spark, sorted(data, key=str, reverse=True), 7)
    assert a.root().first() == b.root().first() and a.root().first().row_count == 3000
    assert len(a.levels) >= 2 and a.levels[0].count() > 3 and a.levels[-1].count() == 1
    assert digest_tree.differing_ranges(a, b).count() == 0 == digest_tree.differing_rows(a, b).count()
    assert tree(spark, data[1:]).root().first() != a.root().first()


@pytest.mark.parametrize("n", [3000, 40])
def test_edits_are_found(spark, n):
    data = rows(n)
    edited, want = [], {}
    for k, r in enumerate(data):
        if k % 197 == 11:
            want[r[1], r[0]] = "removed"
        elif k % 211 == 12:
            want[r[1], r[0]] = "changed"
            edited.append((r[0], r[1], r[2], "new"))
        else:
            edited.append(r)
    for k in range(3):
        new = (dt.date(1990 + 30 * k, 5, 5), f"S{k}", 1.0, None)
        edited.append(new)
        want[new[1], new[0]] = "added"
    a, b = tree(spark, data), tree(spark, edited)
    ranges = digest_tree.differing_ranges(a, b)
    found = {(r.symbol, r.date): r.change for r in digest_tree.differing_rows(a, b, ranges).collect()}
    assert found == want
    # a range is named after its first key, and holds an edit or borders on one
    touched = {r.range_from for r in ranges.collect()}
    where = {(r.symbol, r.date): r.node for t in (a, b) for r in t.rows.collect()}
    assert {where[k] for k in want} <= touched and len(touched) <= 2 * len(want)


def test_equal_keys_and_empty_tables(spark):
    data = [(dt.date(2000, 1, 1), "A", float(k), None) for k in range(20)]
    assert tree(spark, data).root().first() == tree(spark, data[::-1], 3).root().first()
    none = tree(spark, [])
    assert none.root().first().row_count == 0 and none.root().first().sha256.startswith("sha256:")
    some = tree(spark, rows(30))
    assert {r.change for r in digest_tree.differing_rows(none, some).collect()} == {"added"}
    assert {r.change for r in digest_tree.differing_rows(some, none).collect()} == {"removed"}
    assert digest_tree.differing_rows(none, none).count() == 0
