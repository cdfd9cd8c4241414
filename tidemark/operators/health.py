"""Gap and freshness findings, the rolled-up health report and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.asof import sessions_between
from tidemark.operators.coverage import symbol_coverage, table_coverage

# Thresholds in sessions.
GAP_ERROR, GAP_WARNING, GAP_INFO_TOTAL = 10, 5, 3
LAG_INFO, LAG_WARNING = 3, 5
FIELD_CURRENT, FIELD_DAILY, FIELD_WEEKLY, FIELD_MONTHLY = 3, 5, 10, 45
WEEKLY_FIELDS = ["jobless_claims"]
MONTHLY_FIELDS = ["inflation_rate", "core_inflation_rate", "unemployment_rate", "fed_balance_sheet"]
FRESHNESS_FIELDS = [
    "inflation_rate", "core_inflation_rate", "unemployment_rate", "jobless_claims", "fed_funds_rate",
    "treasury_2y_yield", "treasury_10y_yield", "yield_curve_10y_2y", "fed_balance_sheet", "credit_spread",
]
SEVERITIES = ["PASS", "INFO", "WARNING", "ERROR", "FATAL"]
MIN_SNAPSHOTS = 23


def gap_findings(coverage: DataFrame, close_only: list[str]) -> DataFrame:
    """(severity, code, dataset, message) for symbols with internal gaps."""
    x = coverage.where("internal_missing_sessions > 0")
    closed = F.upper("symbol").isin([s.upper() for s in close_only])
    run, total = F.col("max_consecutive_missing"), F.col("internal_missing_sessions")
    severity = (
        F.when(closed, "INFO").when(run >= GAP_ERROR, "ERROR").when(run >= GAP_WARNING, "WARNING")
        .when(total <= GAP_INFO_TOTAL, "INFO").otherwise("WARNING")
    )
    # The wording of the message.
    message = F.concat(
        F.col("symbol"), F.lit(" missing "), total.cast("string"), F.lit(" sessions in active span ("),
        F.date_format("first_date", "yyyy-MM-dd"), F.lit(".."), F.date_format("last_date", "yyyy-MM-dd"),
        F.lit("); max consecutive="), run.cast("string"),
    )
    return x.select(
        severity.alias("severity"),
        F.when(closed, "WTI_PROVIDER_GAP").otherwise("MARKET_INTERNAL_GAP").alias("code"),
        F.concat(F.lit("daily_market_data."), F.col("symbol")).alias("dataset"), message.alias("message"),
    )


def lag_severity(lag: Column) -> Column:
    return F.when(lag <= 0, "PASS").when(lag <= LAG_INFO, "INFO").when(lag <= LAG_WARNING, "WARNING").otherwise("ERROR")


def freshness(tables: dict[str, DataFrame], close_only: list[str]) -> DataFrame:
    """(dataset, latest_observation, freshness_anchor, lag_sessions, classification, severity, missingness).

    Each latest day is a one-row aggregate; all field maxima come from one scan
    of macro_conditions, all event families from one of scheduled_events.
    """
    spine, dmd, macro = tables["trading_days"], tables["daily_market_data"], tables["macro_conditions"]
    spark = spine.sparkSession
    closed = F.upper("symbol").isin([s.upper() for s in close_only])
    spine_max = spine.agg(F.max("date")).scalar()
    market = dmd.agg(F.max(F.when(~closed, F.col("date"))).alias("etf"), F.max(F.when(closed, F.col("date"))).alias("wti"))
    market = market.select(
        F.inline(
            F.array(
                F.struct(F.lit("etf_market_data").alias("dataset"), F.col("etf").alias("latest"), spine_max.alias("anchor"), F.lit("market").alias("kind")),
                F.struct(F.lit("wti_market_data").alias("dataset"), F.col("wti").alias("latest"), F.coalesce(F.col("etf"), spine_max).alias("anchor"), F.lit("market").alias("kind")),
            )
        )
    )
    shape = lambda name, latest, kind: F.struct(
        F.lit(name).alias("dataset"), latest.alias("latest"), spine_max.alias("anchor"), F.lit(kind).alias("kind")
    )
    cal_max = tables["calendar_context"].agg(F.max("date")).scalar()
    rows = spark.range(1).select(
        F.inline(
            F.array(
                shape("macro_conditions_row", macro.agg(F.max("date")).scalar(), "row"),
                shape("calendar_context", cal_max, "row"),
            )
        )
    )
    last_known = macro.agg(*[F.max(F.when(F.col(c).isNotNull(), F.col("date"))).alias(c) for c in FRESHNESS_FIELDS])
    kind = lambda c: "monthly" if c in MONTHLY_FIELDS else "weekly" if c in WEEKLY_FIELDS else "daily"
    fields = last_known.select(F.inline(F.array(*[shape(f"macro.{c}", F.col(c), kind(c)) for c in FRESHNESS_FIELDS])))
    fields = fields.where("latest IS NOT NULL")
    ev = tables["scheduled_events"].agg(
        F.max("event_date").alias("_all"),
        *[F.max(F.when(F.col("event_type") == t, F.col("event_date"))).alias(t) for t in schemas.EVENT_TYPES],
    )
    ev = ev.select(
        F.inline(
            F.array(
                *[shape(f"scheduled_events.{t}", F.col(t), "family") for t in schemas.EVENT_TYPES],
                shape("scheduled_events", F.col("_all"), "events"),
            )
        )
    )
    every = market.unionByName(rows).unionByName(fields).unionByName(ev)
    x = sessions_between(every, spine, "latest", "anchor", "n")
    k, n = F.col("kind"), F.col("n")
    same = F.col("latest").eqNullSafe(F.col("anchor"))
    lag = (
        F.when(k == "market", F.coalesce(n, F.lit(0))).when(k == "row", F.when(same, 0))
        .when(k.isin("daily", "weekly", "monthly"), n)
    )
    limit = F.when(k == "monthly", FIELD_MONTHLY).when(k == "weekly", FIELD_WEEKLY).otherwise(FIELD_DAILY)
    severity = (
        F.when(k == "market", lag_severity(lag)).when(k == "row", F.when(same, "PASS").otherwise("ERROR"))
        .when(k.isin("family", "events"), "PASS")
        .when(n <= FIELD_CURRENT, "PASS").when(n <= limit, "INFO").otherwise("WARNING")
    )
    word = F.col("severity")
    label = (
        F.when(k.isin("family", "events"), "UNKNOWN").when(word == "PASS", "CURRENT")
        .when(word == "INFO", "EXPECTED_LAG").otherwise("STALE")
    )
    missing = (
        F.when((k == "market") & (F.col("lag_sessions") > 0), "EXPECTED_LAG").when(k == "family", "NOT_APPLICABLE")
        .when(k.isin("daily", "weekly", "monthly") & (n > FIELD_CURRENT), "NOT_YET_PUBLISHED")
    )
    x = x.withColumns({"lag_sessions": lag.cast("bigint"), "severity": severity})
    return x.select(
        "dataset", F.col("latest").alias("latest_observation"), F.col("anchor").alias("freshness_anchor"), "lag_sessions",
        label.alias("classification"), "severity", missing.alias("missingness"),
    )


def freshness_findings(fresh: DataFrame) -> DataFrame:
    """Findings from market lags and spine mismatches; field and event rows are informational only."""
    late = F.col("severity") == "INFO"
    code = (
        F.when(F.col("dataset") == "etf_market_data", F.when(late, "ETF_EXPECTED_LAG").otherwise("ETF_STALE"))
        .when(F.col("dataset") == "wti_market_data", F.when(late, "WTI_EXPECTED_LAG").otherwise("WTI_STALE"))
        .when(F.col("dataset") == "macro_conditions_row", "MACRO_SPINE_MISMATCH")
        .when(F.col("dataset") == "calendar_context", "CALENDAR_SPINE_MISMATCH")
    )
    lag = F.coalesce(F.col("lag_sessions").cast("string"), F.lit("?"))
    return fresh.withColumn("code", code).where("code IS NOT NULL AND severity <> 'PASS'").select(
        "severity", "code", "dataset", F.concat(F.col("dataset"), F.lit(" lags by "), lag, F.lit(" session(s)")).alias("message")
    )


def severity_rank(c: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), c)


def overall_status(findings: DataFrame) -> DataFrame:
    """(status): by the worst severity."""
    worst = F.coalesce(F.max(severity_rank(F.col("severity"))), F.lit(1))
    return findings.agg(
        F.when(worst >= 4, "UNHEALTHY").when(worst == 3, "HEALTHY WITH WARNINGS").otherwise("HEALTHY").alias("status")
    )


def finding_counts(findings: DataFrame) -> DataFrame:
    """(severity, n) of every severity but PASS, zeros included."""
    names = F.explode(F.array(*[F.lit(s) for s in SEVERITIES[1:]])).alias("severity")
    every = findings.sparkSession.range(1).select(names)
    n = findings.groupBy("severity").agg(F.count("*").alias("n"))
    return every.join(n, "severity", "left").select("severity", F.coalesce("n", F.lit(0)).alias("n"))


def exit_code(status: Column, strict: bool) -> Column:
    bad = ["UNHEALTHY", "HEALTHY WITH WARNINGS"] if strict else ["UNHEALTHY"]
    return F.when(status.isin(bad), 1).otherwise(0)


def findings(tables: dict[str, DataFrame], universe: DataFrame, close_only: list[str], violations: DataFrame) -> DataFrame:
    """All findings: gaps, freshness, and one per violated check of the whole-database gate."""
    gaps = gap_findings(symbol_coverage(tables["daily_market_data"], tables["trading_days"], universe), close_only)
    late = freshness_findings(freshness(tables, close_only))
    broken = violations.groupBy("check_id").agg(F.count("*").alias("n")).select(
        F.lit("FATAL").alias("severity"), F.lit("VALIDATION_FAIL").alias("code"), F.lit("database").alias("dataset"),
        F.concat(F.col("check_id"), F.lit(": "), F.col("n").cast("string")).alias("message"),
    )
    return gaps.unionByName(late).unionByName(broken)


def _documents(df: DataFrame, order: str) -> Column:
    """A small report table (tables, symbols, findings) as one ordered array."""
    cells = F.struct(F.col(order), *[F.col(c) for c in sorted(df.columns) if c != order])
    return df.agg(F.array_sort(F.collect_list(cells))).scalar()


# What is known not to be there, as listings show it.
LIMITATIONS = [
    "WTI begins 1986-01-02",
    "CPI scheduled events from ~1972 (ALFRED)",
    "Employment events from ~1960",
    "core CPI PIT from ~1996",
    "DGS2 from 1976-06-01",
    "BAA10Y from ~1986",
    "ICSA sparse pre-2009",
    "Per-symbol ETF inception dates",
    "PMI unresolved",
    "XAU/USD and DXY unresolved",
    "No raw snapshot archive (Phase 9)",
]
UNRESOLVED_SYMBOLS = ["XAU/USD", "DXY"]
UNRESOLVED_MACRO = ["pmi"]


def coverage_snapshot(
    tables: dict[str, DataFrame], universe: DataFrame, close_only: list[str], limitations: list[str] = LIMITATIONS,
    unresolved: dict[str, list[str]] | None = None,
) -> DataFrame:
    """(part, name, code, severity, first_date, last_date, n, share, detail): all that is known of coverage, a row each.

    Parts: table and symbol (dates, rows, and of symbols the share of eligible sessions), freshness (classification as code,
    lag), gap (finding with its code, severity and message), limitation, unresolved_symbol and unresolved_macro. The
    rows grow with the symbols and nothing is gathered into one cell.
    """
    spark = tables["trading_days"].sparkSession
    unresolved = {"unresolved_symbol": UNRESOLVED_SYMBOLS, "unresolved_macro": UNRESOLVED_MACRO} if unresolved is None else unresolved
    cover = symbol_coverage(tables["daily_market_data"], tables["trading_days"], universe)
    kinds = {"part": "string", "name": "string", "code": "string", "severity": "string", "first_date": "date", "last_date": "date", "n": "bigint", "share": "double", "detail": "string"}

    def part(df: DataFrame, kind: str, **columns: str | Column) -> DataFrame:
        given = {"part": F.lit(kind), **{k: F.col(v) if isinstance(v, str) else v for k, v in columns.items()}}
        return df.select(*[given.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()])

    known = [("limitation", x) for x in limitations] + [(k, x) for k, xs in unresolved.items() for x in xs]
    parts = [
        part(table_coverage(tables), "table", name="table", first_date="first_date", last_date="last_date", n="row_count"),
        part(cover, "symbol", name="symbol", code="asset_type", first_date="first_date", last_date="last_date", n="row_count", share="coverage_pct"),
        part(freshness(tables, close_only), "freshness", name="dataset", code="classification", severity="severity", last_date="latest_observation", n="lag_sessions", detail="missingness"),
        part(gap_findings(cover, close_only), "gap", name="dataset", code="code", severity="severity", detail="message"),
        spark.createDataFrame(known, "part string, name string").select(*[(F.col(k) if k in ("part", "name") else F.lit(None).cast(t)).alias(k) for k, t in kinds.items()]),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def report(tables: dict[str, DataFrame], universe: DataFrame, close_only: list[str], violations: DataFrame) -> DataFrame:
    """(report): the health report as one JSON document.

    Every array is a catalog-sized aggregate: tables, universe symbols, fields, findings.
    """
    cover = symbol_coverage(tables["daily_market_data"], tables["trading_days"], universe)
    found = findings(tables, universe, close_only, violations)
    body = F.struct(
        _documents(table_coverage(tables), "table").alias("tables"),
        _documents(cover, "symbol").alias("symbols"),
        _documents(freshness(tables, close_only), "dataset").alias("freshness"),
        _documents(found, "dataset").alias("findings"),
        _documents(finding_counts(found), "severity").alias("finding_counts"),
        overall_status(found).scalar().alias("status"),
        F.when(violations.agg(F.count("*")).scalar() == 0, "PASS").otherwise("FAIL").alias("validation"),
    )
    return tables["trading_days"].sparkSession.range(1).select(F.to_json(body).alias("report"))


def manifest_entries(build_id: str, snapshots: DataFrame) -> DataFrame:
    """(build_id, entry, snapshot_id, ...): the manifest's snapshots, one row each, whatever their number."""
    return snapshots.select(F.lit(build_id).alias("build_id"), *snapshots.columns)


def manifest(build_id: str, coverage: DataFrame, snapshots: DataFrame, fingerprints: DataFrame, success: bool, validation: str) -> DataFrame:
    """(manifest): dataset counts, digests, number of snapshots and capability flags as one JSON document.

    The snapshots themselves are rows of ``manifest_entries``. They are captured if
    the build succeeded with at least 23 of them, and the build can be replayed
    exactly if its validation also passed.
    """
    n = snapshots.agg(F.count("*")).scalar()
    capture = F.lit(success) & (n >= MIN_SNAPSHOTS)
    body = F.struct(
        F.lit(build_id).alias("build_id"), _documents(coverage, "table").alias("datasets"),
        (capture & F.lit(validation == "PASS")).alias("exact_rebuild_capable"), F.lit("1.1").alias("schema_version"),
        capture.alias("snapshot_capture"), n.alias("snapshot_count"),
        F.lit(success).alias("success"), _documents(fingerprints, "table").alias("table_fingerprints"),
        F.lit(validation).alias("validation_result"),
    )
    return coverage.sparkSession.range(1).select(F.to_json(body).alias("manifest"))
