"""Row-level writes: merged results against plain frames, what is written, failures and conflicts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import deltas, upsert

SCHEMA = "date date, symbol string, close double, note string"
PK = ["date", "symbol"]
DAY = dt.date(2020, 1, 1)


def rows(n, seed, days=40):
    pick = random.Random(seed)
    keys = pick.sample([(d, s) for d in range(days) for s in "ABCD"], n)
    return [(DAY + dt.timedelta(days=d), s, pick.choice([None, 1.0, 2.0]), pick.choice([None, "x"])) for d, s in keys]


def table(spark, folder, data):
    df = spark.createDataFrame(data, SCHEMA)
    out = deltas.KeyedTable(spark, f"{folder}/t", df.schema, PK)
    out.replace(df)
    return out


def content(df):
    return sorted(map(tuple, df.select(*[c.split()[0] for c in SCHEMA.split(", ")]).collect()), key=repr)


def test_writes_equal_frames(spark, folder):
    frame = spark.createDataFrame(rows(90, 1), SCHEMA)
    stored = table(spark, folder, rows(90, 1))
    for step in range(2):
        new = spark.createDataFrame(rows(60, 10 + step), SCHEMA)
        frame = upsert.merged_columns(frame, new, PK, ["note"])
        stored.update(new, ["note"])
        assert content(stored.read()) == content(frame)
        new = spark.createDataFrame(rows(30, 20 + step), SCHEMA)
        frame = upsert.merged(frame, new, PK)
        stored.upsert(new)
        assert content(stored.read()) == content(frame)
        lo, hi = DAY + dt.timedelta(days=3 + step), DAY + dt.timedelta(days=33 - step)
        new = spark.createDataFrame([r for r in rows(25, 30 + step) if lo <= r[0] <= hi], SCHEMA)
        frame = spark.createDataFrame(content(upsert.synced(frame, new, PK, lo, hi)), SCHEMA)
        stored.sync(new, lo, hi)
        assert content(stored.read()) == content(frame)
    before, version = content(stored.read()), stored.current()[0]
    stored.compact()
    assert content(stored.read()) == before == content(stored.read(version)) and stored.written().count() == 0
    stored.vacuum()
    assert content(stored.read()) == before and len(stored.versions()) == 1


def test_a_key_that_went_comes_back_whole(spark, folder):
    stored = table(spark, folder, [(DAY, "A", 1.0, "x")])
    stored.delete(spark.createDataFrame([(DAY, "A")], "date date, symbol string"))
    assert stored.read().count() == 0
    stored.update(spark.createDataFrame([(DAY, "A", 5.0, "new")], SCHEMA), ["note"])
    assert content(stored.read()) == [(DAY, "A", 5.0, "new")]


def test_only_changed_rows_are_written(spark, folder):
    data = rows(100, 2)
    stored = table(spark, folder, data)
    new = spark.createDataFrame(data, SCHEMA)
    assert stored.upsert(new) == 1 == stored.update(new.withColumn("close", F.lit(9.0)), ["note"]) and stored.versions() == [1]
    changed = new.withColumn("note", F.when(F.col("symbol") == "B", "changed").otherwise(F.col("note")))
    assert stored.update(changed, ["note"]) == 2 and stored.update(changed, ["note"]) == 2
    assert [tuple(r) for r in stored.written().collect()] == [(1, "set", sum(r[1] == "B" for r in data))]


def test_a_failed_write_changes_nothing(spark, folder):
    data = rows(50, 3)
    stored = table(spark, folder, data)
    bad = spark.createDataFrame(rows(20, 4), SCHEMA).withColumn("note", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        stored.upsert(bad)
    assert stored.versions() == [1] and content(stored.read()) == sorted(data, key=repr)


def test_two_writers_conflict(spark, folder):
    first = table(spark, folder, rows(50, 5))
    second = deltas.KeyedTable(spark, first.path, first.schema, PK)
    seen, folders = second.current()
    first.upsert(spark.createDataFrame(rows(20, 6), SCHEMA))
    after = content(first.read())
    with pytest.raises(deltas.Conflict):
        second._append(seen, folders, spark.createDataFrame(rows(9, 7), SCHEMA).withColumn("_op", F.lit("put")), [])
    assert content(second.read()) == after
    # the same without the look at the versions: the file is there
    second.versions = lambda: [seen]
    with pytest.raises(deltas.Conflict):
        second._commit(seen, folders)
    assert content(first.read()) == after


def test_an_unfinished_list_is_not_read(spark, folder):
    stored = table(spark, folder, rows(30, 8))
    before = content(stored.read())
    with open(f"{folder}/t/versions/v2.json", "w") as f:
        f.write('{"folders": [{"na')
    assert content(stored.read()) == before
    with pytest.raises(deltas.Conflict):
        stored.upsert(spark.createDataFrame(rows(20, 9), SCHEMA))
    stored.recover()
    stored.upsert(spark.createDataFrame(rows(20, 9), SCHEMA))
    assert len(content(stored.read())) > 0 and stored.versions() == [1, 2, 3, 4]


def test_an_empty_table_takes_writes(spark, folder):
    df = spark.createDataFrame(rows(10, 1), SCHEMA)
    stored = deltas.KeyedTable(spark, f"{folder}/e", df.schema, PK)
    assert stored.read().count() == 0 and stored.current() == (0, [])
    stored.sync(df, DAY, DAY + dt.timedelta(days=99))
    assert content(stored.read()) == content(df)
