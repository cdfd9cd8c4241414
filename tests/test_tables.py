import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import scalar
from tidemark.operators import browse, coverage, fingerprint, health, quality
from tidemark.plans import builders as b
from tidemark.plans import recipes as r
from tidemark.sinks import upsert
from tidemark.sources import tables

D = dt.date


@pytest.mark.parametrize(
    "value,dtype,want",
    [
        (None, T.DoubleType(), "\\N"), (True, T.BooleanType(), "true"), (D(2024, 1, 2), T.DateType(), "2024-01-02"), (1.0, T.DoubleType(), "1"),
        (-0.0, T.DoubleType(), "0"), (0.1, T.DoubleType(), "0.1"), (1e-7, T.DoubleType(), "0.0000001"), (1.5e10, T.DoubleType(), "15000000000"),
        (float("nan"), T.DoubleType(), "NaN"), (float("-inf"), T.DoubleType(), "-Infinity"), (Decimal("10.500"), T.DecimalType(10, 3), "10.5"),
        (Decimal("-0.000"), T.DecimalType(10, 3), "0"), (Decimal("100.000"), T.DecimalType(10, 3), "100"), (7, T.LongType(), "7"),
        (1e-40, T.DoubleType(), "0." + "0" * 39 + "1"), (2e-40, T.DoubleType(), "0." + "0" * 39 + "2"), (1.2345678901234566e-25, T.DoubleType(), "0." + "0" * 24 + "12345678901234566"),
        (-1.5e300, T.DoubleType(), "-15" + "0" * 299), (12345678.25, T.DoubleType(), "12345678.25"), (123456789012345.0, T.DoubleType(), "123456789012345"), (5e-324, T.DoubleType(), "0." + "0" * 323 + "49"),
    ],
)
def test_canonical_text(spark, value, dtype, want):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", dtype)]))
    assert df.select(scalar.canonical_text(F.col("x"), dtype).alias("t")).first().t == want


def test_digests_ignore_order_and_see_changes(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "id int, v string")
    digest = lambda x: fingerprint.table_digest(x, "t").first().sha256
    assert digest(df) == digest(df.orderBy(F.desc("id")).repartition(7))
    changed = [df, df.withColumn("v", F.when(F.col("id") == 3, "x").otherwise(F.col("v"))), df.where("id <> 3"), df.union(df.where("id = 3")), df.union(df.where("id = 3")).union(df.where("id = 3"))]
    assert len({digest(x) for x in changed}) == len(changed)


def test_digests_count_repeated_rows(spark):
    one = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    two = spark.createDataFrame([(2,), (2,), (3,)], "id int")
    assert fingerprint.table_digest(one, "t").first().sha256 != fingerprint.table_digest(two, "t").first().sha256


def test_digest_is_the_sum_of_row_hashes(spark):
    import hashlib

    df = spark.createDataFrame([(2, None), (1, "a"), (1, "a")], "id int, v string")
    rows = [hashlib.sha256(x).hexdigest() for x in (b"2|\\N", b"1|a", b"1|a")]
    sums = [sum(int(h[i : i + 16], 16) for h in rows) for i in (0, 16, 32, 48)]
    want = hashlib.sha256(":".join(map(str, [3, *sums])).encode()).hexdigest()
    assert fingerprint.table_digest(df, "t").first().sha256 == "sha256:" + want


# ------------------------------------------------------------------ browse
def test_requests_outside_the_registry(spark, sf_dir):
    spec = browse.spec_of("daily_market_data")
    with pytest.raises(browse.BrowseError):
        browse.spec_of("nope")
    with pytest.raises(browse.BrowseError):
        browse.resolve_sort(spec, "open", "asc")
    with pytest.raises(browse.BrowseError):
        browse.resolve_sort(spec, "date", "up")
    with pytest.raises(browse.BrowseError):
        browse.clamp_page_size(0)
    with pytest.raises(browse.BrowseError):
        cc = b.table(spark, sf_dir, "calendar_context")
        browse.filtered(cc, browse.spec_of("calendar_context"), browse.Filters(flags={"is_shortened_week": True}))
    assert browse.clamp_page_size(9999) == 500 and browse.resolve_sort(spec, None, "desc") == ("date", "asc")
    with pytest.raises(ValueError):
        tables.fields(b.table(spark, sf_dir, "trading_days"), "nope")


def test_pages_cover_every_row_once(spark, sf_dir):
    ar = b.table(spark, sf_dir, "asset_regimes")
    n = ar.count()
    seen = []
    for i in range(1, -(-n // 500) + 2):
        seen += [(r.date, r.symbol) for r in browse.page(ar, "asset_regimes", number=i, size=500, sort="trend_regime").collect()]
    assert len(seen) == n == len(set(seen))


def test_filters_that_do_not_apply_are_ignored(spark, sf_dir):
    td = b.table(spark, sf_dir, "trading_days")
    f = browse.Filters(symbol="X", event_type="cpi", flags={"whatever": True})
    assert browse.filtered(td, browse.spec_of("trading_days"), f).count() == td.count()


# ------------------------------------------------------------------- sinks
def test_upsert_by_partition_is_idempotent_and_leaves_other_partitions(spark, folder):
    old = spark.createDataFrame([(1, 2020, "a"), (2, 2020, "b"), (3, 2021, "c")], "id int, year int, v string")
    t = upsert.PartitionedTable(spark, f"{folder}/t", "year")
    t.upsert(old, ["id"])
    kept = t.folders()["2021"]
    new = spark.createDataFrame([(2, 2020, "B"), (4, 2020, "d")], "id int, year int, v string")
    for _ in range(2):
        t.upsert(new, ["id"])
        assert {(r.id, r.v) for r in t.read(old.schema).collect()} == {(1, "a"), (2, "B"), (3, "c"), (4, "d")}
    assert t.folders()["2021"] == kept
    plan = t.read(old.schema, [2020]).where(F.col("year").isin([2020]))._jdf.queryExecution().toString()
    assert "year=2021" not in plan and "year#" in plan.split("PartitionFilters: [")[-1].split("]")[0]
    t.vacuum()
    assert t.read(old.schema).count() == 4


def test_a_failing_write_leaves_the_table_as_it_was(spark, folder):
    old = spark.createDataFrame([(1, 2020, "a")], "id int, year int, v string")
    t = upsert.PartitionedTable(spark, f"{folder}/t", "year")
    t.upsert(old, ["id"])
    bad = old.withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        t.upsert(bad, ["id"])
    assert t.read(old.schema).collect() == old.collect()


def test_partial_upsert_keeps_observed_values(spark):
    old = spark.createDataFrame([(1, "obs", None), (2, "obs", "x")], "id int, o string, d string")
    new = spark.createDataFrame([(1, "NEW", "d1"), (2, "NEW", None), (3, "NEW", "d3")], "id int, o string, d string")
    got = {r.id: (r.o, r.d) for r in upsert.merged_columns(old, new, ["id"], ["d"]).collect()}
    assert got == {1: ("obs", "d1"), 2: ("obs", None), 3: ("NEW", "d3")}


def test_range_sync_drops_rows_outside(spark):
    old = spark.createDataFrame([(D(2020, 1, 1), 1), (D(2021, 1, 1), 1), (D(2022, 1, 1), 1)], "date date, v int")
    new = spark.createDataFrame([(D(2021, 1, 1), 2)], "date date, v int")
    got = upsert.synced(old, new, ["date"], F.to_date(F.lit("2020-06-01")), F.to_date(F.lit("2021-12-31")))
    assert [(r.date, r.v) for r in got.collect()] == [(D(2021, 1, 1), 2)]


# ------------------------------------------------------------------ health
def test_gap_ladder(spark):
    rows = [("A", 1, 1), ("B", 4, 2), ("C", 9, 5), ("D", 20, 10), ("WTI", 50, 20), ("E", 0, 0)]
    cov = spark.createDataFrame([(s, D(2020, 1, 1), D(2020, 12, 31), m, x) for s, m, x in rows],
                                "symbol string, first_date date, last_date date, internal_missing_sessions int, max_consecutive_missing int")
    got = {r.dataset.split(".")[1]: (r.severity, r.code) for r in health.gap_findings(cov, ["WTI"]).collect()}
    m = "MARKET_INTERNAL_GAP"
    assert got == {"A": ("INFO", m), "B": ("WARNING", m), "C": ("WARNING", m), "D": ("ERROR", m), "WTI": ("INFO", "WTI_PROVIDER_GAP")}


@pytest.mark.parametrize("found,want", [([], "HEALTHY"), (["PASS", "INFO"], "HEALTHY"), (["WARNING"], "HEALTHY WITH WARNINGS"), (["WARNING", "ERROR"], "UNHEALTHY"), (["FATAL"], "UNHEALTHY")])
def test_status_is_the_worst_severity(spark, found, want):
    df = spark.createDataFrame([(s,) for s in found], "severity string")
    assert health.overall_status(df).first().status == want
    assert spark.range(1).select(health.exit_code(F.lit("HEALTHY WITH WARNINGS"), True).alias("a"), health.exit_code(F.lit("HEALTHY WITH WARNINGS"), False).alias("b")).first() == (1, 0)


def test_duplicates_treat_null_keys_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "a int, b int")
    assert [(r.a, r.n) for r in coverage.duplicates(df, ["a", "b"]).collect()] == [(None, 2)]


def test_tables_have_their_declared_schemas(spark, sf_dir):
    for name, df in b.tables(spark, sf_dir).items():
        assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == schemas.TABLE_COLUMNS[name]


def test_gate_joins_a_pair_once_where_it_lies(spark, sf_dir):
    t = b.tables(spark, sf_dir)
    found = quality.database_checks(t, r.universe(spark), r.CLOSE_ONLY)
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert len(joins) == 2 and all("FullOuter" in line for line in joins)
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(symbol" in line]
    assert len(moved) == 1  # the universe's few symbols, which are counted
    for name in b.PANEL:
        assert len(t[name].inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_beside_keeps_unmatched_and_null_keys(spark):
    rows = [(D(2020, 1, 2), "A", 0.1), (D(2020, 1, 3), "A", 0.2), (None, "A", 0.3), (D(2020, 1, 2), "B", None)]
    child = spark.createDataFrame(rows, "date date, symbol string, drawdown_pct double")
    parent = spark.createDataFrame([(D(2020, 1, 2), "A", 0.5), (None, "A", 0.3), (D(2020, 1, 6), "A", 0.0)], "date date, symbol string, drawdown_from_high double")
    got = Counter((str(x.date), x.symbol, x._child, x._parent) for x in quality.beside(child, parent).collect())
    assert got == Counter([
        ("2020-01-02", "A", True, True), ("2020-01-03", "A", True, None), ("None", "A", True, None), ("2020-01-02", "B", True, None),
        ("None", "A", None, True), ("2020-01-06", "A", None, True),
    ])
