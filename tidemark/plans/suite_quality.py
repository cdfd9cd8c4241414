"""Queries on coverage, gaps, freshness, fingerprints and checks.

Checks run on tables with faults put in by rule, so their answers are not empty.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import scalar
from tidemark.operators import coverage, digest_tree, fingerprint, health, macro, quality
from tidemark.plans import builders as b
from tidemark.plans import recipes as r
from tidemark.plans.registry import query


def tbl(spark, sf, name):
    return b.table(spark, sf, name)


# ----------------------------------------------------------------- coverage
A1 = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{schemas.TABLE_GRAINS[t]}' AS grain, count(*) AS row_count, min({schemas.DATE_COLUMN[t]}) AS first_date, "
    f"max({schemas.DATE_COLUMN[t]}) AS last_date FROM {t}" for t in schemas.TABLE_COLUMNS
)


@query("a1_table_coverage", A1)
def _(spark, sf):
    return coverage.table_coverage(b.tables(spark, sf))


GRID = """(SELECT s.symbol, i.date, i.i FROM (SELECT symbol, min(date) AS a, max(date) AS z FROM bars GROUP BY 1) s
  JOIN session_index i ON i.date BETWEEN s.a AND s.z
  WHERE NOT EXISTS (SELECT 1 FROM bars q WHERE q.symbol = s.symbol AND q.date = i.date))"""
RUNS = f"""(SELECT symbol, max(n) AS run FROM (SELECT symbol, count(*) AS n FROM (
  SELECT symbol, i - row_number() OVER (PARTITION BY symbol ORDER BY i) AS g FROM {GRID}) GROUP BY symbol, g) GROUP BY 1)"""
A2 = f"""SELECT s.symbol, CASE WHEN s.symbol = 'HOUSEHOLD' THEN 'commodity' ELSE 'etf' END AS asset_type, first_date, last_date, row_count,
  eligible AS eligible_sessions, round(100.0::DOUBLE * row_count / eligible, 2) AS coverage_pct, coalesce(m.missing, 0) AS internal_missing_sessions,
  coalesce(u.run, 0) AS max_consecutive_missing, coalesce(m.sample, []) AS sample_missing_dates
FROM (SELECT symbol, min(date) AS first_date, max(date) AS last_date, count(*) AS row_count,
    (SELECT count(*) FROM spine WHERE date BETWEEN min(q.date) AND max(q.date)) AS eligible FROM bars q GROUP BY 1) s
LEFT JOIN (SELECT symbol, count(*) AS missing, list(CAST(date AS VARCHAR) ORDER BY date)[1:5] AS sample FROM {GRID} GROUP BY 1) m ON m.symbol = s.symbol
LEFT JOIN {RUNS} u ON u.symbol = s.symbol"""


@query("a2_symbol_coverage", A2, "coverage_pct")
def _(spark, sf):
    return coverage.symbol_coverage(tbl(spark, sf, "daily_market_data"), tbl(spark, sf, "trading_days"), r.universe(spark))


@query("w11_longest_missing_run", f"SELECT symbol, run AS longest_run FROM {RUNS}")
def _(spark, sf):
    gone = coverage.missing_sessions(tbl(spark, sf, "daily_market_data"), tbl(spark, sf, "trading_days"))
    return coverage.longest_run(gone, ["symbol"], "i")


H1 = f"""SELECT CASE WHEN symbol = 'HOUSEHOLD' THEN 'INFO' WHEN max_consecutive_missing >= 10 THEN 'ERROR'
    WHEN max_consecutive_missing >= 5 THEN 'WARNING' WHEN internal_missing_sessions <= 3 THEN 'INFO' ELSE 'WARNING' END AS severity,
  CASE WHEN symbol = 'HOUSEHOLD' THEN 'WTI_PROVIDER_GAP' ELSE 'MARKET_INTERNAL_GAP' END AS code, 'daily_market_data.' || symbol AS dataset,
  symbol || ' missing ' || CAST(internal_missing_sessions AS VARCHAR) || ' sessions in active span (' || CAST(first_date AS VARCHAR) || '..'
    || CAST(last_date AS VARCHAR) || '); max consecutive=' || CAST(max_consecutive_missing AS VARCHAR) AS message
FROM ({A2}) WHERE internal_missing_sessions > 0"""


@query("h1_gap_findings", H1)
def _(spark, sf):
    c = coverage.symbol_coverage(tbl(spark, sf, "daily_market_data"), tbl(spark, sf, "trading_days"), r.universe(spark))
    return health.gap_findings(c, r.CLOSE_ONLY)


FIELDS = health.FRESHNESS_FIELDS
A3 = " UNION ALL ".join(
    f"SELECT '{c}' AS field, count({c}) AS known, count(*) AS rows, min(date) FILTER ({c} IS NOT NULL) AS first_known, "
    f"max(date) FILTER ({c} IS NOT NULL) AS last_known, round(100.0::DOUBLE * count({c}) / count(*), 2) AS pct FROM macro_conditions" for c in FIELDS
)


@query("a3_field_profile", A3, "pct")
def _(spark, sf):
    return coverage.field_profile(tbl(spark, sf, "macro_conditions"), FIELDS)


FLAGS = [c for c, t in schemas.TABLE_COLUMNS["calendar_context"] if t == "boolean"]


@query("a4_flag_counts", f"SELECT {', '.join(f'count(*) FILTER ({c}) AS {c}' for c in FLAGS)} FROM calendar_context")
def _(spark, sf):
    return coverage.flag_counts(tbl(spark, sf, "calendar_context"), FLAGS)


@query("a5_event_counts", """SELECT event_type, count(*) AS n, min(event_date) AS first_date, max(event_date) AS last_date, count(event_time_et) AS timed,
  count(reference_period) AS with_reference, count(DISTINCT event_date) AS days FROM scheduled_events GROUP BY 1""")
def _(spark, sf):
    return coverage.event_counts(tbl(spark, sf, "scheduled_events"))


@query("a5_weeks_by_sessions", "SELECT trading_days_in_week, count(*) AS sessions, count(DISTINCT date_trunc('week', date)) AS weeks FROM calendar_context GROUP BY 1")
def _(spark, sf):
    c = tbl(spark, sf, "calendar_context")
    return c.groupBy("trading_days_in_week").agg(F.count("*").alias("sessions"), F.countDistinct(F.trunc("date", "week")).alias("weeks"))


@query("a6_duplicate_keys", "SELECT CAST(o_orderdate AS DATE) AS date, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark, sf):
    o = r.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"), "o_custkey")
    return coverage.duplicates(o, ["date", "o_custkey"])


@query("a9_diagnostics", """SELECT (SELECT count(*) FROM trading_days) AS trading_days, (SELECT min(date) FROM trading_days) AS td_min,
  (SELECT max(date) FROM trading_days) AS td_max, (SELECT count(*) FROM bars) AS daily_market_data, (SELECT min(date) FROM bars) AS dmd_min,
  (SELECT max(date) FROM bars) AS dmd_max, (SELECT count(DISTINCT symbol) FROM bars) AS symbols, (SELECT count(*) FROM market_outcomes) AS market_outcomes,
  (SELECT count(*) FROM asset_regimes) AS asset_regimes, (SELECT count(*) FROM macro_conditions) AS macro_conditions,
  (SELECT count(*) FROM scheduled_events) AS scheduled_events, (SELECT count(*) FROM calendar_context) AS calendar_context""")
def _(spark, sf):
    return coverage.diagnostics(b.tables(spark, sf))


@query("a10_checksums", """SELECT 'daily_market_data' AS "table", count(*) AS rows, CAST(sum(CAST(close AS DECIMAL(38, 12))) AS DOUBLE) AS close,
  CAST(sum(CAST(adj_close AS DECIMAL(38, 12))) AS DOUBLE) AS adj_close FROM bars""")
def _(spark, sf):
    c = coverage.checksum(tbl(spark, sf, "daily_market_data"), "daily_market_data")
    return c.select("table", "rows", F.col("close").cast("double").alias("close"), F.col("adj_close").cast("double").alias("adj_close"))


@query("a15_days_with_several_events", """SELECT date, CAST(is_fomc_day AS INTEGER) + CAST(is_cpi_release_day AS INTEGER)
  + CAST(is_employment_situation_day AS INTEGER) + CAST(is_election_day AS INTEGER) AS families FROM calendar_context
WHERE CAST(is_fomc_day AS INTEGER) + CAST(is_cpi_release_day AS INTEGER) + CAST(is_employment_situation_day AS INTEGER) + CAST(is_election_day AS INTEGER) > 1""")
def _(spark, sf):
    n = sum((F.col(f).cast("int") for f, _ in schemas.EVENT_FLAGS.values()), F.lit(0))
    return tbl(spark, sf, "calendar_context").select("date", n.alias("families")).where("families > 1")


@query("w23_first_and_last_rows", """SELECT symbol, min(date) AS first_date, arg_min(close, date) AS first_close, max(date) AS last_date,
  arg_max(close, date) AS last_close FROM bars GROUP BY 1""", "first_close last_close")
def _(spark, sf):
    d = tbl(spark, sf, "daily_market_data")
    return d.groupBy("symbol").agg(
        F.min("date").alias("first_date"), F.min_by("close", "date").alias("first_close"),
        F.max("date").alias("last_date"), F.max_by("close", "date").alias("last_close"),
    )


# ---------------------------------------------------------------- freshness
def _late(spark, sf):
    """The tables with market rows ending early and one symbol earlier still."""
    t = b.tables(spark, sf)
    d = t["daily_market_data"]
    last = t["trading_days"].agg(F.max("date")).scalar()
    t["daily_market_data"] = d.where(
        ((F.col("symbol") != "HOUSEHOLD") & (F.col("date") <= F.date_sub(last, 5))) | (F.col("date") <= F.date_sub(last, 15))
    )
    m = t["macro_conditions"]
    t["macro_conditions"] = m.withColumn("credit_spread", F.when(F.col("date") <= F.date_sub(last, 12), F.col("credit_spread")))
    return t


BETWEEN = "(SELECT count(*) FROM spine s WHERE s.date > latest AND s.date <= anchor)"
H2 = f"""WITH top AS (SELECT max(date) AS top FROM spine),
late AS (SELECT bars.date, symbol FROM bars, top WHERE (symbol <> 'HOUSEHOLD' AND bars.date <= top - 5) OR bars.date <= top - 15),
market AS (SELECT (SELECT max(date) FROM late WHERE symbol <> 'HOUSEHOLD') AS etf, (SELECT max(date) FROM late WHERE symbol = 'HOUSEHOLD') AS wti),
src AS (
  SELECT 'etf_market_data' AS dataset, etf AS latest, top AS anchor, 'market' AS kind FROM market, top
  UNION ALL SELECT 'wti_market_data', wti, coalesce(etf, top), 'market' FROM market, top
  UNION ALL SELECT 'macro_conditions_row', (SELECT max(date) FROM macro_conditions), top, 'row' FROM top
  UNION ALL SELECT 'calendar_context', (SELECT max(date) FROM calendar_context), top, 'row' FROM top
  {' '.join(f"UNION ALL SELECT 'macro.{c}', (SELECT max(date) FROM macro_conditions WHERE {c} IS NOT NULL" + (" AND date <= top - 12" if c == "credit_spread" else "") + f"), top, '{'monthly' if c in health.MONTHLY_FIELDS else 'weekly' if c in health.WEEKLY_FIELDS else 'daily'}' FROM top" for c in FIELDS)}
  {' '.join(f"UNION ALL SELECT 'scheduled_events.{t}', (SELECT max(event_date) FROM scheduled_events WHERE event_type = '{t}'), top, 'family' FROM top" for t in schemas.EVENT_TYPES)}
  UNION ALL SELECT 'scheduled_events', (SELECT max(event_date) FROM scheduled_events), top, 'events' FROM top),
lagged AS (SELECT *, {BETWEEN} AS n, CASE kind WHEN 'monthly' THEN 45 WHEN 'weekly' THEN 10 ELSE 5 END AS most FROM src)
SELECT dataset, latest AS latest_observation, anchor AS freshness_anchor,
  CASE kind WHEN 'row' THEN CASE WHEN latest = anchor THEN 0 END WHEN 'family' THEN NULL WHEN 'events' THEN NULL ELSE n END AS lag_sessions,
  CASE WHEN kind IN ('family', 'events') THEN 'UNKNOWN' WHEN kind = 'row' THEN CASE WHEN latest = anchor THEN 'CURRENT' ELSE 'STALE' END
    WHEN kind = 'market' THEN CASE WHEN n <= 0 THEN 'CURRENT' WHEN n <= 3 THEN 'EXPECTED_LAG' ELSE 'STALE' END
    WHEN n <= 3 THEN 'CURRENT' WHEN n <= most THEN 'EXPECTED_LAG' ELSE 'STALE' END AS classification,
  CASE WHEN kind IN ('family', 'events') THEN 'PASS' WHEN kind = 'row' THEN CASE WHEN latest = anchor THEN 'PASS' ELSE 'ERROR' END
    WHEN kind = 'market' THEN CASE WHEN n <= 0 THEN 'PASS' WHEN n <= 3 THEN 'INFO' WHEN n <= 5 THEN 'WARNING' ELSE 'ERROR' END
    WHEN n <= 3 THEN 'PASS' WHEN n <= most THEN 'INFO' ELSE 'WARNING' END AS severity,
  CASE WHEN kind = 'family' THEN 'NOT_APPLICABLE' WHEN kind = 'market' AND n > 0 THEN 'EXPECTED_LAG'
    WHEN kind IN ('daily', 'weekly', 'monthly') AND n > 3 THEN 'NOT_YET_PUBLISHED' END AS missingness FROM lagged"""


@query("h2_freshness", H2)
def _(spark, sf):
    return health.freshness(_late(spark, sf), r.CLOSE_ONLY)


COUNTS = f"""(SELECT severity FROM (SELECT CASE WHEN symbol = 'HOUSEHOLD' THEN 'INFO' WHEN max_consecutive_missing >= 10 THEN 'ERROR'
    WHEN max_consecutive_missing >= 5 THEN 'WARNING' WHEN internal_missing_sessions <= 3 THEN 'INFO' ELSE 'WARNING' END AS severity
  FROM ({A2}) WHERE internal_missing_sessions > 0))"""


def _gaps(spark, sf):
    c = coverage.symbol_coverage(tbl(spark, sf, "daily_market_data"), tbl(spark, sf, "trading_days"), r.universe(spark))
    return health.gap_findings(c, r.CLOSE_ONLY)


@query("a14_finding_counts", f"""SELECT s.severity, count(c.severity) AS n FROM (SELECT unnest(['INFO', 'WARNING', 'ERROR', 'FATAL']) AS severity) s
LEFT JOIN {COUNTS} c ON c.severity = s.severity GROUP BY 1""")
def _(spark, sf):
    return health.finding_counts(_gaps(spark, sf))


@query("a14_overall_status", f"""SELECT CASE WHEN bool_or(severity IN ('ERROR', 'FATAL')) THEN 'UNHEALTHY' WHEN bool_or(severity = 'WARNING') THEN 'HEALTHY WITH WARNINGS'
  ELSE 'HEALTHY' END AS status FROM {COUNTS}""")
def _(spark, sf):
    return health.overall_status(_gaps(spark, sf))


@query("h3_health_report")
def _(spark, sf):
    t = b.tables(spark, sf)
    return health.report(t, r.universe(spark), r.CLOSE_ONLY, quality.database_checks(t, r.universe(spark), r.CLOSE_ONLY))


@query("h3_report_parts", f"""SELECT 'tables' AS part, "table" AS name, row_count AS n FROM ({A1}) UNION ALL SELECT 'symbols', symbol, row_count FROM ({A2})
UNION ALL SELECT 'gaps', symbol, internal_missing_sessions FROM ({A2})""")
def _(spark, sf):
    t = b.tables(spark, sf)
    doc = health.report(t, r.universe(spark), r.CLOSE_ONLY, quality.database_checks(t, r.universe(spark), r.CLOSE_ONLY))
    cells = lambda part, name, n: doc.select(F.explode(F.from_json(F.get_json_object("report", f"$.{part}"), f"array<struct<{name}:string,{n}:bigint>>")).alias("c")).select(
        F.lit(part).alias("part"), F.col(f"c.{name}").alias("name"), F.col(f"c.{n}").alias("n"))
    return quality.union([cells("tables", "table", "row_count"), cells("symbols", "symbol", "row_count"), cells("symbols", "symbol", "internal_missing_sessions").withColumn("part", F.lit("gaps"))])


#: Freshness of the whole tables: the same statement without the cuts of ``_late``.
H2_WHOLE = H2.replace("(symbol <> 'HOUSEHOLD' AND bars.date <= top - 5) OR bars.date <= top - 15", "true").replace(" AND date <= top - 12", "")
ALL_FOUND = f"(SELECT severity FROM ({H1}) AS g UNION ALL SELECT severity FROM ({H2_WHOLE}) AS h WHERE severity <> 'PASS')"
STATUS = f"""SELECT CASE WHEN bool_or(severity IN ('ERROR', 'FATAL')) THEN 'UNHEALTHY' WHEN bool_or(severity = 'WARNING') THEN 'HEALTHY WITH WARNINGS' ELSE 'HEALTHY' END AS status FROM {ALL_FOUND} AS f"""


@query("h3_report_content", f"""SELECT 'table' AS part, "table" AS name, CAST(first_date AS VARCHAR) AS a, CAST(last_date AS VARCHAR) AS b, row_count AS n FROM ({A1}) AS x
UNION ALL SELECT 'symbol', symbol, CAST(first_date AS VARCHAR), CAST(last_date AS VARCHAR), max_consecutive_missing FROM ({A2}) AS x
UNION ALL SELECT 'freshness', dataset, classification, severity, lag_sessions FROM ({H2_WHOLE}) AS x
UNION ALL SELECT 'gap', dataset, severity, message, NULL FROM ({H1}) AS x
UNION ALL SELECT 'count', k.severity, NULL, NULL, count(x.severity) FROM (VALUES ('INFO'), ('WARNING'), ('ERROR'), ('FATAL')) AS k(severity) LEFT JOIN {ALL_FOUND} AS x ON x.severity = k.severity GROUP BY 2
UNION ALL SELECT 'status', status, NULL, NULL, NULL FROM ({STATUS}) AS x UNION ALL SELECT 'validation', 'PASS', NULL, NULL, NULL""")
def _(spark, sf):
    t = b.tables(spark, sf)
    doc = health.report(t, r.universe(spark), r.CLOSE_ONLY, quality.database_checks(t, r.universe(spark), r.CLOSE_ONLY))
    null = F.lit(None).cast("string")

    def cells(path, kind, name, a, c, n, where="true"):
        fields = [x for x in dict.fromkeys([name, a, c, n, *(["code"] if path == "findings" else [])]) if x]
        held = doc.select(F.explode(F.from_json(F.get_json_object("report", f"$.{path}"), f"array<struct<{','.join(f'{x}:string' for x in fields)}>>")).alias("c")).select("c.*").where(where)
        pick = lambda x: F.col(x) if x else null
        return held.select(F.lit(kind).alias("part"), F.col(name).alias("name"), pick(a).alias("a"), pick(c).alias("b"), pick(n).cast("bigint").alias("n"))

    one = lambda x: doc.select(F.lit(x).alias("part"), F.get_json_object("report", f"$.{x}").alias("name"), null.alias("a"), null.alias("b"), F.lit(None).cast("bigint").alias("n"))
    return quality.union([
        cells("tables", "table", "table", "first_date", "last_date", "row_count"), cells("symbols", "symbol", "symbol", "first_date", "last_date", "max_consecutive_missing"),
        cells("freshness", "freshness", "dataset", "classification", "severity", "lag_sessions"), cells("findings", "gap", "dataset", "severity", "message", None, "code LIKE '%GAP'"),
        cells("finding_counts", "count", "severity", None, None, "n"), one("status"), one("validation"),
    ])


@query("h4_coverage_snapshot", f"""SELECT 'table' AS part, "table" AS name, row_count AS n FROM ({A1})
UNION ALL SELECT 'symbol', symbol, row_count FROM ({A2}) UNION ALL SELECT 'freshness', dataset, lag_sessions FROM ({H2}) AS h
UNION ALL SELECT 'gap', symbol, internal_missing_sessions FROM ({A2}) WHERE internal_missing_sessions > 0""")
def _(spark, sf):
    t = b.tables(spark, sf)
    cover = coverage.symbol_coverage(t["daily_market_data"], t["trading_days"], r.universe(spark))
    part = lambda df, kind, name, n: df.select(F.lit(kind).alias("part"), F.col(name).alias("name"), F.col(n).alias("n"))
    return quality.union(
        [
            part(coverage.table_coverage(t), "table", "table", "row_count"), part(cover, "symbol", "symbol", "row_count"),
            part(health.freshness(_late(spark, sf), r.CLOSE_ONLY), "freshness", "dataset", "lag_sessions"),
            part(cover.where("internal_missing_sessions > 0"), "gap", "symbol", "internal_missing_sessions"),
        ]
    )


_KNOWN = ", ".join(f"('{part}', '{x}')" for part, xs in (("limitation", health.LIMITATIONS), ("unresolved_symbol", health.UNRESOLVED_SYMBOLS), ("unresolved_macro", health.UNRESOLVED_MACRO)) for x in xs)


@query("h4_coverage_with_findings", f"""SELECT 'table' AS part, "table" AS name, NULL AS code, NULL AS severity, first_date, last_date, row_count AS n, CAST(NULL AS DOUBLE) AS share, NULL AS detail FROM ({A1}) AS a
UNION ALL SELECT 'symbol', symbol, asset_type, NULL, first_date, last_date, row_count, coverage_pct, NULL FROM ({A2}) AS a
UNION ALL SELECT 'freshness', dataset, classification, severity, NULL, latest_observation, lag_sessions, NULL, missingness FROM ({H2}) AS h
UNION ALL SELECT 'gap', dataset, code, severity, NULL, NULL, NULL, NULL, message FROM ({H1}) AS g
UNION ALL SELECT part, name, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM (VALUES {_KNOWN}) AS k(part, name)""", "share")
def _(spark, sf):
    # sizes and gaps of the whole tables, freshness of late ones, so that every class occurs
    whole, late = (health.coverage_snapshot(t, r.universe(spark), r.CLOSE_ONLY) for t in (b.tables(spark, sf), _late(spark, sf)))
    return whole.where("part <> 'freshness'").unionByName(late.where("part = 'freshness'"))


@query("h5_quick_audit", """SELECT 'on_spine_events' AS item, count(*) AS n FROM scheduled_events WHERE event_date IN (SELECT date FROM spine)
UNION ALL SELECT 'off_spine_events', count(*) FROM scheduled_events WHERE event_date NOT IN (SELECT date FROM spine)
UNION ALL SELECT 'labelled_regimes', count(volatility_regime) FROM asset_regimes UNION ALL SELECT 'labelled_rates', count(rate_regime) FROM macro_conditions""")
def _(spark, sf):
    t = b.tables(spark, sf)
    days = F.broadcast(t["trading_days"].select(F.col("date").alias("event_date")))
    item = lambda df, name, c: df.agg(c.alias("n")).select(F.lit(name).alias("item"), "n")
    ev = t["scheduled_events"]
    return quality.union(
        [
            item(ev.join(days, "event_date", "left_semi"), "on_spine_events", F.count("*")),
            item(ev.join(days, "event_date", "left_anti"), "off_spine_events", F.count("*")),
            item(t["asset_regimes"], "labelled_regimes", F.count("volatility_regime")),
            item(t["macro_conditions"], "labelled_rates", F.count("rate_regime")),
        ]
    )


@query("h6_manifest")
def _(spark, sf):
    t = b.tables(spark, sf)
    return health.manifest("build", coverage.table_coverage(t), _entries(spark, sf), _prints(spark, sf), True, "PASS")


def _entries(spark, sf):
    pages = r.table(spark, sf, "pages")
    digest = F.concat(F.lit("sha256:"), F.sha2(F.col("html").cast("binary"), 256))
    return pages.select(F.col("page_id").alias("entry"), digest.alias("snapshot_id"), F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"))


@query("h6_manifest_entries", """SELECT 'build' AS build_id, page_id AS entry, 'sha256:' || sha256(html) AS snapshot_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages""")
def _(spark, sf):
    return health.manifest_entries("build", _entries(spark, sf))


# ------------------------------------------------------------- fingerprints
def _text(col: str, dtype: str) -> str:
    if dtype == "double":  # see six_places
        return f"coalesce(nullif(regexp_replace(CAST(CAST({col} AS DECIMAL(28,6)) AS VARCHAR), '\\.?0+$', ''), '-0'), '\\N')"
    if dtype == "boolean":
        return f"CASE WHEN {col} THEN 'true' WHEN NOT {col} THEN 'false' ELSE '\\N' END"
    return f"coalesce(CAST({col} AS VARCHAR), '\\N')"


def six_places(df):
    """Doubles at six places: two engines agree on them where they may differ in a last bit."""
    return df.select(*[F.col(f.name).cast("decimal(28,6)").alias(f.name) if f.dataType.typeName() in ("double", "float") else f.name for f in df.schema.fields])


def _line(columns) -> str:
    return " || '|' || ".join(_text(c, t) for c, t in sorted(columns))


ALL_TABLES = list(schemas.TABLE_COLUMNS)
_WORDS = [f"sum(CAST('0x' || substr(d, {a}, 16) AS UBIGINT))" for a in fingerprint.LANES]


def _digest(table: str, source: str = "", columns=None) -> str:
    sums = " || ':' || ".join(f"CAST(coalesce({w}, 0) AS VARCHAR)" for w in _WORDS)
    return f"""SELECT '{table}' AS "table", count(*) AS row_count, 'sha256:' || sha256(CAST(count(*) AS VARCHAR) || ':' || {sums}) AS sha256
FROM (SELECT sha256({_line(columns or schemas.TABLE_COLUMNS[table])}) AS d FROM {source or table})"""


def _prints(spark, sf, **edited):
    tables = {t: edited.get(t, tbl(spark, sf, t)) for t in ALL_TABLES}
    return quality.union([fingerprint.table_digest(six_places(df), t) for t, df in tables.items()])


@query("h6_manifest_content", f"""SELECT 'dataset' AS part, "table" AS name, CAST(first_date AS VARCHAR) || '/' || CAST(last_date AS VARCHAR) AS value, row_count AS n FROM ({A1}) AS a
UNION ALL SELECT 'print', "table", sha256, row_count FROM ({' UNION ALL '.join(f'({_digest(t)})' for t in ALL_TABLES)}) AS d
UNION ALL SELECT 'header', 'build', 'PASS/1.1', (SELECT count(*) FROM pages)
UNION ALL SELECT 'flags', 'true', CASE WHEN (SELECT count(*) FROM pages) >= 23 THEN 'true/true' ELSE 'false/false' END, NULL""")
def _(spark, sf):
    t = b.tables(spark, sf)
    doc = health.manifest("build", coverage.table_coverage(t), _entries(spark, sf), _prints(spark, sf), True, "PASS")
    m = doc.select(F.from_json("manifest", """struct<build_id:string,schema_version:string,validation_result:string,success:string,snapshot_capture:string,exact_rebuild_capable:string,snapshot_count:bigint,
      datasets:array<struct<table:string,first_date:string,last_date:string,row_count:bigint>>,table_fingerprints:array<struct<table:string,sha256:string,row_count:bigint>>>""").alias("m")).select("m.*")
    row = lambda df, part, name, value, n: df.select(F.lit(part).alias("part"), name.alias("name"), value.alias("value"), n.cast("bigint").alias("n"))
    sets, prints = m.select(F.explode("datasets").alias("c")).select("c.*"), m.select(F.explode("table_fingerprints").alias("c")).select("c.*")
    return quality.union([
        row(sets, "dataset", F.col("table"), F.concat_ws("/", "first_date", "last_date"), F.col("row_count")), row(prints, "print", F.col("table"), F.col("sha256"), F.col("row_count")),
        row(m, "header", F.col("build_id"), F.concat_ws("/", "validation_result", "schema_version"), F.col("snapshot_count")),
        row(m, "flags", F.col("success"), F.concat_ws("/", "snapshot_capture", "exact_rebuild_capable"), F.lit(None)),
    ])


@query("p13_canonical_text", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '\\N' WHEN o_totalprice = floor(o_totalprice) THEN CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR)
  ELSE CAST(o_totalprice AS VARCHAR) END AS price, CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS even, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at, '0.00000012' AS tiny, '-Infinity' AS low FROM orders""")
def _(spark, sf):
    from pyspark.sql import types as T

    o = r.table(spark, sf, "orders")
    text = scalar.canonical_text
    return o.select(
        "o_orderkey", text(F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")), T.DoubleType()).alias("price"),
        text(F.col("o_orderkey") % 2 == 0, T.BooleanType()).alias("even"), text(F.col("o_orderdate").cast("date"), T.DateType()).alias("day"),
        text(F.col("o_orderdate").cast("timestamp_ntz"), T.TimestampNTZType()).alias("at"),
        text(F.when(F.col("o_orderkey").isNotNull(), 1.2e-7), T.DoubleType()).alias("tiny"),
        text(-F.lit(float("inf")), T.DoubleType()).alias("low"),
    )


@query("p13_canonical_doubles", """SELECT l_orderkey, l_linenumber, true AS plain, true AS exact, CAST(CASE WHEN e >= 0 THEN length(CAST(l_partkey + 1 AS VARCHAR)) + e ELSE 1 END AS INTEGER) AS whole_digits
  FROM (SELECT *, CAST(CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey % 280 ELSE -20 - l_suppkey % 280 END AS INTEGER) AS e FROM lineitem)""")
def _(spark, sf):
    from pyspark.sql import types as T

    e = F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey") % 280).otherwise(-20 - F.col("l_suppkey") % 280)
    x = F.concat((F.col("l_partkey") + 1).cast("string"), F.lit("E"), e.cast("string")).cast("double")
    text = r.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", x.alias("x"), scalar.canonical_text(x, T.DoubleType()).alias("text"))
    return text.select(
        "l_orderkey", "l_linenumber", F.col("text").rlike(r"^\d+(\.\d*[1-9])?$").alias("plain"), (F.col("text").cast("double") == F.col("x")).alias("exact"),
        F.length(F.substring_index("text", ".", 1)).alias("whole_digits"),
    )


@query("p14_row_lines", f"SELECT event_id, {_line(schemas.TABLE_COLUMNS['scheduled_events'])} AS line FROM scheduled_events")
def _(spark, sf):
    e = tbl(spark, sf, "scheduled_events")
    return e.select("event_id", scalar.canonical_line(e).alias("line"))


@query("a11_exact_digests", " UNION ALL ".join(f"({_digest(t)})" for t in ALL_TABLES))
def _(spark, sf):
    return _prints(spark, sf)


LINEITEM = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "date"),
]


@query("a11_block_digest", _digest("lineitem", "(SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem)", LINEITEM))
def _(spark, sf):
    li = r.table(spark, sf, "lineitem")
    return fingerprint.table_digest(six_places(li.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))), "lineitem")


@query("a12_database_digest", f"""SELECT 'sha256:' || sha256(string_agg("table" || ':' || sha256 || ':' || CAST(row_count AS VARCHAR) || ':1.0' || chr(10), '' ORDER BY pos)) AS database_fingerprint
FROM ({' UNION ALL '.join(f'SELECT *, {i} AS pos FROM ({_digest(t)})' for i, t in enumerate(ALL_TABLES))})""")
def _(spark, sf):
    return fingerprint.database_digest(_prints(spark, sf), ALL_TABLES)


def _two_prints(spark, sf):
    cc = tbl(spark, sf, "calendar_context")
    edited = cc.withColumn("holiday_name", F.when(F.col("is_election_day"), "X").otherwise(F.col("holiday_name")))
    return _prints(spark, sf, calendar_context=edited), _prints(spark, sf)


EDITED = _digest("calendar_context", "(SELECT * REPLACE (CASE WHEN is_election_day THEN 'X' ELSE holiday_name END AS holiday_name) FROM calendar_context)")
_NOW = " UNION ALL ".join(f"({_digest(t)})" for t in ALL_TABLES)
_BEFORE = " UNION ALL ".join(f"({EDITED if t == 'calendar_context' else _digest(t)})" for t in ALL_TABLES)


@query("j18_fingerprint_comparison", f"""SELECT a."table", e.sha256 AS expected, a.sha256 AS actual, e.sha256 = a.sha256 AS match
FROM ({_NOW}) a JOIN ({_BEFORE}) e ON e."table" = a."table" """)
def _(spark, sf):
    before, now = _two_prints(spark, sf)
    return fingerprint.compare(before, now)


@query("a13_change_classification", "SELECT CASE WHEN count(*) FILTER (event_type = 'election') > 0 THEN 'UPDATED' ELSE 'NO_CHANGE' END AS change FROM scheduled_events")
def _(spark, sf):
    before, now = _two_prints(spark, sf)
    return fingerprint.change(fingerprint.database_digest(before, ALL_TABLES), fingerprint.database_digest(now, ALL_TABLES))


ORDERS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderdate", "date"), ("o_orderpriority", "string")]
DATED = "(SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders)"
EDITED_ORDERS = f"""(SELECT * REPLACE (CASE WHEN o_orderkey % 977 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM {DATED} WHERE o_orderkey % 1499 <> 7
  UNION ALL SELECT * REPLACE (-o_orderkey AS o_orderkey) FROM {DATED} WHERE o_orderkey % 1999 = 3)"""


def _tree_levels(name: str, source: str, levels: int) -> str:
    """CTEs {name}0, {name}1, ...: rows, then nodes, each (place, name, rows, digest, node); node is the one above."""
    at = lambda k: f"""coalesce(last_value(CASE WHEN substr(sha256('{k}:' || name), 1, 2) = '{digest_tree.CUT}' THEN name END IGNORE NULLS) OVER (ORDER BY place ROWS UNBOUNDED PRECEDING), '{digest_tree.START}')"""
    out = f"""{name}r AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS place, CAST(o_orderkey AS VARCHAR) AS name, 1 AS rows, sha256({_line(ORDERS)}) AS digest FROM {source}),
{name}0 AS (SELECT *, {at(0)} AS node FROM {name}r)"""
    for k in range(1, levels + 1):
        out += f""",
{name}n{k} AS (SELECT min(place) AS place, node AS name, CAST(sum(rows) AS BIGINT) AS rows, sha256(string_agg(digest, '' ORDER BY place)) AS digest FROM {name}{k - 1} GROUP BY node),
{name}{k} AS (SELECT *, {at(k)} AS node FROM {name}n{k})"""
    return out


def _orders(spark, sf):
    return r.table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def _order_trees(spark, sf):
    o = _orders(spark, sf)
    edited = o.where("o_orderkey % 1499 <> 7").withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey") % 977 == 5, 1.0).otherwise(0.0))
    more = o.where("o_orderkey % 1999 = 3").withColumn("o_orderkey", -F.col("o_orderkey"))
    return [digest_tree.tree(six_places(x), ["o_orderkey"]) for x in (o, edited.unionByName(more))]


@query("a11_ordered_digest", f"""WITH {_tree_levels('t', DATED, 5)}
SELECT CAST(rows AS BIGINT) AS row_count, 'sha256:' || digest AS sha256 FROM (
  {' UNION ALL '.join(f"SELECT {k} AS level, count(*) AS nodes, sum(rows) AS rows, min(digest) AS digest FROM tn{k}" for k in range(1, 6))}) WHERE nodes = 1 ORDER BY level LIMIT 1""")
def _(spark, sf):
    return digest_tree.tree(six_places(_orders(spark, sf)), ["o_orderkey"]).root()


@query("j18_differing_ranges", f"""WITH {_tree_levels('a', DATED, 1)}, {_tree_levels('b', EDITED_ORDERS, 1)}
SELECT coalesce(a.name, b.name) AS range_from, a.rows AS rows_before, b.rows AS rows_after FROM an1 a FULL JOIN bn1 b ON a.name = b.name WHERE a.digest IS DISTINCT FROM b.digest""")
def _(spark, sf):
    return digest_tree.differing_ranges(*_order_trees(spark, sf))


@query("j18_differing_rows", """SELECT o_orderkey, CASE WHEN o_orderkey % 1499 = 7 THEN 'removed' ELSE 'changed' END AS change FROM orders WHERE o_orderkey % 1499 = 7 OR o_orderkey % 977 = 5
UNION ALL SELECT -o_orderkey AS o_orderkey, 'added' AS change FROM orders WHERE o_orderkey % 1999 = 3""")
def _(spark, sf):
    return digest_tree.differing_rows(*_order_trees(spark, sf))


# ------------------------------------------------------------------- checks
def V(check: str, key: str, source: str, detail: str = "''") -> str:
    return f"SELECT '{check}' AS check_id, {key} AS \"key\", {detail} AS detail FROM {source}"


def allv(*parts: str) -> str:
    return " UNION ALL ".join(parts)


DAY = "CAST(date AS VARCHAR)"
BAR = "symbol || '/' || CAST(date AS VARCHAR)"


@query("v1_spine_checks", allv(
    V("spine_iso_weekday", DAY, "trading_days WHERE day_of_month = 3"),
    V("spine_iso_week", DAY, "trading_days WHERE day_of_month = 4"),
    V("spine_month_end", DAY, "trading_days WHERE is_month_end AND month = 2"),
    V("spine_year_numbering", DAY, "trading_days WHERE trading_day_of_year = 100"),
    V("spine_prev_chain", DAY, "trading_days WHERE day_of_month = 9"),
    V("spine_one_first", "''", "(SELECT count(*) + 1 AS n FROM trading_days WHERE day_of_month = 9)", "CAST(n AS VARCHAR) || ' against 1'"),
    V("spine_known_open", DAY, "closures WHERE type = 'exceptional'"),
    V("spine_known_closed", DAY, "early_closes"),
))
def _(spark, sf):
    t = tbl(spark, sf, "trading_days")
    bad = t.withColumns(
        {
            "weekday": F.when(F.col("day_of_month") == 3, 9).otherwise(F.col("weekday")),
            "week_of_year": F.when(F.col("day_of_month") == 4, 99).otherwise(F.col("week_of_year")),
            "days_to_month_end": F.when(F.col("is_month_end") & (F.col("month") == 2), 5).otherwise(F.col("days_to_month_end")),
            "trading_day_of_year": F.when(F.col("trading_day_of_year") == 100, 0).otherwise(F.col("trading_day_of_year")),
            "prev_trading_date": F.when(F.col("day_of_month") != 9, F.col("prev_trading_date")),
        }
    )
    special = r.closures(spark, sf).where("type = 'exceptional'").select("date")
    return quality.spine_checks(bad, special, r.early_closes(spark, sf).select("date"))


@query("f6_known_dates", "SELECT date, date IN (SELECT date FROM spine) AS is_session FROM closures WHERE date BETWEEN (SELECT min(date) FROM spine) AND (SELECT max(date) FROM spine)")
def _(spark, sf):
    t = tbl(spark, sf, "trading_days").select("date", F.lit(True).alias("s"))
    lo, hi = t.agg(F.min("date")).scalar(), t.agg(F.max("date")).scalar()
    known = r.closures(spark, sf).where((F.col("date") >= lo) & (F.col("date") <= hi)).select("date")
    return known.join(F.broadcast(t), "date", "left").select("date", F.coalesce("s", F.lit(False)).alias("is_session"))


@query("v2_bar_set_checks", allv(
    V("bars_off_spine", BAR, "all_bars WHERE date NOT IN (SELECT date FROM spine)"),
    V("bars_weekend", BAR, "all_bars WHERE isodow(date) > 5"),
    V("bars_duplicate", "CAST(date AS VARCHAR) || '/' || symbol", "all_bars WHERE day(date) = 7 AND symbol = 'MACHINERY'", "'2'"),
    V("bars_off_spine", BAR, "all_bars WHERE day(date) = 7 AND symbol = 'MACHINERY' AND date NOT IN (SELECT date FROM spine)"),
    V("bars_weekend", BAR, "all_bars WHERE day(date) = 7 AND symbol = 'MACHINERY' AND isodow(date) > 5"),
    "SELECT 'bars_missing_symbol', 'GOLD', ''",
))
def _(spark, sf):
    a = r.all_bars(spark, sf).select("date", "symbol")
    twice = a.unionByName(a.where("dayofmonth(date) = 7 AND symbol = 'MACHINERY'"))
    u = r.universe(spark).unionByName(spark.createDataFrame([("GOLD", "etf", False)], "symbol string, asset_type string, close_only boolean"))
    return quality.bar_set_checks(twice, r.spine(spark, sf), u)


@query("v3_bar_row_checks", allv(
    V("full_volume_missing", BAR, "bars WHERE symbol = 'BUILDING' AND day(date) = 2"),
    V("full_high_low", BAR, "bars WHERE symbol = 'FURNITURE' AND day(date) = 3"),
    V("full_high_open", BAR, "bars WHERE symbol = 'FURNITURE' AND day(date) = 3"),
    V("full_high_close", BAR, "bars WHERE symbol = 'FURNITURE' AND day(date) = 3"),
    V("full_split_factor", BAR, "bars WHERE symbol = 'MACHINERY' AND day(date) = 4"),
    V("full_dividend", BAR, "bars WHERE symbol = 'MACHINERY' AND day(date) = 6"),
    V("full_adj_volume_negative", BAR, "bars WHERE symbol = 'MACHINERY' AND day(date) = 8"),
    V("close_only_missing", BAR, "bars WHERE symbol = 'HOUSEHOLD' AND day(date) = 9"),
    V("close_only_extra", BAR, "bars WHERE symbol = 'HOUSEHOLD' AND day(date) = 10"),
))
def _(spark, sf):
    d, s = F.dayofmonth("date"), F.col("symbol")
    at = lambda sym, n: (s == sym) & (d == n)
    x = r.bars(spark, sf).withColumns(
        {
            "volume": F.when(~at("BUILDING", 2), F.col("volume")),
            "high": F.when(at("FURNITURE", 3), F.col("low") - 1e9).otherwise(F.col("high")),
            "split_factor": F.when(at("MACHINERY", 4), 0.0).otherwise(F.col("split_factor")),
            "dividend_cash": F.when(at("MACHINERY", 6), -1.0).otherwise(F.col("dividend_cash")),
            "adj_volume": F.when(at("MACHINERY", 8), -1).otherwise(F.col("adj_volume")),
            "close": F.when(~at("HOUSEHOLD", 9), F.col("close")),
            "adj_open": F.when(at("HOUSEHOLD", 10), 1.0).otherwise(F.col("adj_open")),
        }
    )
    return quality.bar_row_checks(x, r.CLOSE_ONLY)


@query("f5_row_shapes", "SELECT date, symbol, symbol <> 'HOUSEHOLD' AS complete, symbol = 'HOUSEHOLD' AS close_only FROM bars")
def _(spark, sf):
    x = tbl(spark, sf, "daily_market_data")
    every = " AND ".join(f"{c} IS NOT NULL" for c in quality.OHLC)
    none = " AND ".join(f"{c} IS NULL" for c in quality.OHLC)
    return x.select("date", "symbol", F.expr(every).alias("complete"), F.expr(f"close IS NOT NULL AND {none}").alias("close_only"))


FIRST = "(SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM daily_market_data)"


@query("v4_derived_checks", allv(
    V("derived_first_return", BAR, f"{FIRST} WHERE rn = 1"),
    V("derived_later_gap", BAR, f"{FIRST} WHERE rn > 1 AND symbol <> 'HOUSEHOLD' AND day(date) = 5"),
    V("derived_close_only", BAR, f"{FIRST} WHERE symbol = 'HOUSEHOLD' AND day(date) = 6"),
    V("derived_drawdown_missing", BAR, f"{FIRST} WHERE day(date) = 7"),
    V("derived_drawdown_positive", BAR, f"{FIRST} WHERE day(date) = 8"),
    V("derived_drawdown_first", BAR, f"{FIRST} WHERE day(date) = 8 AND rn = 1"),
))
def _(spark, sf):
    d = F.dayofmonth("date")
    x = tbl(spark, sf, "daily_market_data").withColumns(
        {
            "return_1d": F.coalesce("return_1d", F.lit(0.0)),
            "gap_pct": F.when(d != 5, F.col("gap_pct")),
            "range_pct": F.when((F.col("symbol") == "HOUSEHOLD") & (d == 6), 1.0).otherwise(F.col("range_pct")),
            "drawdown_from_high": F.when(d == 8, 0.5).when(d != 7, F.col("drawdown_from_high")),
        }
    )
    return quality.derived_checks(x, r.CLOSE_ONLY)


@query("v5_outcome_checks", allv(
    V("outcomes_flag_5d", BAR, "market_outcomes WHERE day(date) = 5 AND positive_5d IS NOT NULL"),
    V("outcomes_absent", "CAST(date AS VARCHAR) || '/' || symbol", "bars WHERE year(date) = 1996 AND day(date) = 6"),
    V("outcomes_null_count", "symbol || '/return_10d'", "(SELECT symbol, count(*) FILTER (return_10d IS NULL) AS n FROM market_outcomes GROUP BY 1)",
      "CAST(n + (SELECT count(*) FROM market_outcomes q WHERE q.symbol = \"from\".symbol AND day(date) = 7 AND return_10d IS NOT NULL) AS VARCHAR) || ' against 10'").replace('"from"', "t").replace("GROUP BY 1)", "GROUP BY 1) t"),
    V("outcomes_next_return", BAR, "market_outcomes WHERE day(date) = 8 AND abs(return_1d) > 1e-9"),
))
def _(spark, sf):
    d = F.dayofmonth("date")
    x = tbl(spark, sf, "market_outcomes").withColumns(
        {
            "positive_5d": F.when(d == 5, ~F.col("positive_5d")).otherwise(F.col("positive_5d")),
            "return_10d": F.when(d != 7, F.col("return_10d")),
            "return_1d": F.when(d == 8, F.col("return_1d") * 2).otherwise(F.col("return_1d")),
        }
    ).where(~((F.year("date") == 1996) & (d == 6)))
    found = quality.outcome_checks(x, tbl(spark, sf, "daily_market_data"), r.CLOSE_ONLY)
    gone = "key LIKE '%/return_10d'"  # the removed rows leave the other counts alone
    return found.where(f"check_id <> 'outcomes_null_count' OR {gone}")


@query("j15_drawdown_mirror", allv(V("regimes_drawdown", BAR, "bars WHERE day(date) IN (11, 12)")))
def _(spark, sf):
    d = F.dayofmonth("date")
    x = tbl(spark, sf, "asset_regimes").withColumn("drawdown_pct", F.when(d == 11, F.col("drawdown_pct") + 1e-6).when(d != 12, F.col("drawdown_pct")))
    return quality.drawdown_mismatch(x, tbl(spark, sf, "daily_market_data"))


@query("j16_next_row_identity", """SELECT o.date, o.symbol, o.return_1d AS forward, d.next AS next_return FROM market_outcomes o
JOIN (SELECT date, symbol, lead(return_1d) OVER (PARTITION BY symbol ORDER BY date) AS next FROM daily_market_data) d ON d.date = o.date AND d.symbol = o.symbol
WHERE abs(o.return_1d - d.next) <= 1e-9""", "forward next_return")
def _(spark, sf):
    from tidemark.operators.market import by_symbol

    d = tbl(spark, sf, "daily_market_data").select("date", "symbol", F.lead("return_1d").over(by_symbol()).alias("next_return"))
    o = tbl(spark, sf, "market_outcomes").select("date", "symbol", F.col("return_1d").alias("forward"))
    return o.join(d, ["date", "symbol"]).where("abs(forward - next_return) <= 1e-9")


@query("v6_regime_checks", allv(
    V("regimes_asset_type", BAR, "bars WHERE day(date) = 2"),
    V("regimes_trend_label", BAR, "asset_regimes WHERE day(date) = 3 AND trend_regime IS NOT NULL"),
    V("regimes_momentum_early", BAR, "asset_regimes WHERE day(date) = 4 AND momentum_regime IS NULL"),
    V("regimes_drawdown", BAR, "bars WHERE day(date) = 9"),
))
def _(spark, sf):
    d = F.dayofmonth("date")
    x = tbl(spark, sf, "asset_regimes").withColumns(
        {
            "asset_type": F.when(d == 2, "bond").otherwise(F.col("asset_type")),
            "trend_regime": F.when((d == 3) & F.col("trend_regime").isNotNull(), "sideways").otherwise(F.col("trend_regime")),
            "momentum_regime": F.when(d == 4, F.coalesce("momentum_regime", F.lit("mixed"))).otherwise(F.col("momentum_regime")),
            "drawdown_pct": F.when(d == 9, F.col("drawdown_pct") - 0.1).otherwise(F.col("drawdown_pct")),
        }
    )
    return quality.regime_checks(x, tbl(spark, sf, "daily_market_data"), r.universe(spark))


FULL = """(SELECT a.date, a.symbol, count(*) FILTER (b.volatility_20d <= a.volatility_20d) AS k, count(*) AS n
  FROM trail_stats a JOIN trail_stats b ON a.symbol = b.symbol WHERE a.volatility_20d IS NOT NULL AND b.volatility_20d IS NOT NULL GROUP BY 1, 2)"""


@query("v7_leakage", allv(V("leakage_label", "f.symbol || '/' || CAST(f.date AS VARCHAR)", f"""{FULL} f JOIN asset_regimes r ON r.date = f.date AND r.symbol = f.symbol
WHERE r.volatility_regime IS NOT NULL AND r.volatility_regime <> CASE WHEN 3 * f.k <= f.n THEN 'low' WHEN 3 * f.k <= 2 * f.n THEN 'normal' ELSE 'high' END""")))
def _(spark, sf):
    from tidemark.operators.regimes import full_sample_tercile

    x = tbl(spark, sf, "asset_regimes")
    leaky = full_sample_tercile(x, "volatility_20d", "leaky")
    x = x.join(leaky, ["symbol", "date"], "left").withColumn("volatility_regime", F.when(F.col("volatility_regime").isNotNull(), F.col("leaky")))
    return quality.volatility_leakage(x)


@query("v8_volatility_formula", allv(V("volatility_formula", BAR, "trail_stats WHERE day(date) = 5 AND volatility_20d IS NOT NULL")))
def _(spark, sf):
    x = tbl(spark, sf, "asset_regimes")
    x = x.withColumn("volatility_20d", F.when(F.dayofmonth("date") == 5, F.col("volatility_20d") * F.sqrt(F.lit(19 / 20))).otherwise(F.col("volatility_20d")))
    return quality.volatility_formula(x, tbl(spark, sf, "daily_market_data"))


@query("v9_macro_checks", allv(
    V("macro_spread", DAY, "macro_conditions WHERE day(date) = 3 AND yield_curve_10y_2y IS NOT NULL"),
    V("macro_spread_leg", DAY, "macro_conditions WHERE day(date) = 13"),
    V("macro_rate_label", DAY, "macro_conditions WHERE day(date) = 4"),
    V("macro_absent", DAY, "spine WHERE day(date) = 6"),
    V("macro_count", "''", "(SELECT count(*) FILTER (day(date) <> 6) AS a, count(*) AS n FROM spine)", "CAST(a AS VARCHAR) || ' against ' || CAST(n AS VARCHAR)"),
    "SELECT 'macro_forbidden_column', 'pmi', ''",
))
def _(spark, sf):
    d = F.dayofmonth("date")
    x = tbl(spark, sf, "macro_conditions").where(d != 6).withColumns(
        {
            "yield_curve_10y_2y": F.when(d == 3, F.col("yield_curve_10y_2y") + 1).when(d == 13, 0.0).otherwise(F.col("yield_curve_10y_2y")),
            "rate_regime": F.when(d == 4, "frozen").otherwise(F.col("rate_regime")), "pmi": F.lit(None).cast("double"),
        }
    )
    return quality.macro_checks(x, tbl(spark, sf, "trading_days"))


@query("v10_release_honesty", allv(
    V("honesty_early_label", DAY, "inflation_labels WHERE n < 36 AND day(date) = 5"),
    V("honesty_future_release", DAY, "inflation_labels WHERE n < 36 AND day(date) = 5"),
    V("honesty_rate_lookback", DAY, "(SELECT date, row_number() OVER (ORDER BY date) AS i FROM macro_levels WHERE fed_funds_rate IS NOT NULL) WHERE i <= 63 AND day(date) = 7"),
))
def _(spark, sf):
    d = F.dayofmonth("date")
    releases = macro.release_yoy(r.vintages(spark, sf).where("series = 'cpi'"), r.spine(spark, sf))
    m = tbl(spark, sf, "macro_conditions").withColumns(
        {
            "inflation_regime": F.when(F.col("inflation_rate").isNotNull() & (d == 5), F.coalesce("inflation_regime", F.lit("low"))).otherwise(F.col("inflation_regime")),
            "rate_regime": F.when(d == 7, F.coalesce("rate_regime", F.lit("stable"))).otherwise(F.col("rate_regime")),
        }
    )
    # rows before the first release have no count to be early against
    cut = releases.agg(F.max("date")).scalar()
    return quality.release_honesty(m, releases, cut)


EV = "scheduled_events WHERE event_type = '{}'"


@query("v11_event_checks", allv(
    V("events_type", "event_id", EV.format("election")),
    V("events_symbol", "event_id", EV.format("fomc")),
    V("events_meeting_reference", "event_id", EV.format("fomc")),
    V("events_reference_month", "event_id", EV.format("cpi") + " AND month(event_date) = 3"),
    V("events_time_unknown", "event_id", EV.format("employment_situation") + " AND month(event_date) = 4"),
    V("events_forbidden_day", DAY, "(SELECT DISTINCT event_date AS date FROM scheduled_events WHERE event_type = 'fomc' AND month(event_date) = 5)"),
))
def _(spark, sf):
    t, m = F.col("event_type"), F.month("event_date")
    e = tbl(spark, sf, "scheduled_events")
    forbidden = e.where((t == "fomc") & (m == 5)).select(F.col("event_date").alias("date"))
    x = e.withColumns(
        {
            "event_type": F.when(t == "election", "poll").otherwise(t),
            "symbol": F.when(t == "fomc", "SPY").otherwise(F.col("symbol")),
            "reference_period": F.when(t == "fomc", "2001-01").when((t == "cpi") & (m == 3), "2001").otherwise(F.col("reference_period")),
            "release_session": F.when((t == "employment_situation") & (m == 4), "unknown").otherwise(F.col("release_session")),
        }
    )
    return quality.event_checks(x, forbidden)


@query("v12_context_checks", allv(
    V("context_is_fomc_day", DAY, "calendar_context WHERE is_fomc_day"),
    V("context_count_fomc", "''", "(SELECT count(*) AS n FROM calendar_context WHERE is_fomc_day) WHERE n > 0", "'0 against ' || CAST(n AS VARCHAR)"),
    V("context_holiday_name", DAY, "calendar_context WHERE holiday_name IS NOT NULL AND is_shortened_week"),
    V("context_week_short", DAY, "calendar_context WHERE day(date) = 6"),
    V("context_early_close", DAY, "calendar_context WHERE is_shortened_trading_day"),
    V("context_null_is_turn_of_month", DAY, "calendar_context WHERE day(date) = 7"),
))
def _(spark, sf):
    d = F.dayofmonth("date")
    x = tbl(spark, sf, "calendar_context").withColumns(
        {
            "is_fomc_day": F.lit(False), "is_shortened_trading_day": F.lit(False),
            "holiday_name": F.when(~F.col("is_shortened_week"), F.col("holiday_name")),
            "is_turn_of_month": F.when(d != 7, F.col("is_turn_of_month")),
        }
    ).withColumn("is_shortened_week", F.when(d == 6, ~F.col("is_shortened_week")).otherwise(F.col("is_shortened_week")))
    return quality.context_checks(x, tbl(spark, sf, "trading_days"), tbl(spark, sf, "scheduled_events"), r.early_closes(spark, sf))


@query("j17_flag_event_mismatch", allv(V("context_is_cpi_release_day", DAY, "calendar_context WHERE day(date) = 10"),
    V("context_is_election_day", DAY, "calendar_context WHERE is_election_day")))
def _(spark, sf):
    x = tbl(spark, sf, "calendar_context").withColumn(
        "is_cpi_release_day", F.when(F.dayofmonth("date") == 10, ~F.col("is_cpi_release_day")).otherwise(F.col("is_cpi_release_day"))
    ).withColumn("is_election_day", F.lit(False))
    return quality.flag_mismatch(x, tbl(spark, sf, "scheduled_events"))


@query("j14_referential_orphans", allv(
    V("orphan", "CAST(date AS VARCHAR) || '/' || symbol", "bars WHERE day(date) = 3"), V("off_spine", DAY, "all_bars WHERE date NOT IN (SELECT date FROM spine)")))
def _(spark, sf):
    d = tbl(spark, sf, "daily_market_data")
    return quality.orphans(tbl(spark, sf, "market_outcomes"), d.where("dayofmonth(date) <> 3"), ["date", "symbol"], "orphan").unionByName(
        quality.orphans(r.all_bars(spark, sf), tbl(spark, sf, "trading_days"), ["date"], "off_spine")
    )


@query("v13_whole_gate", "SELECT * FROM (SELECT '' AS check_id, '' AS \"key\", '' AS detail) WHERE false")
def _(spark, sf):
    return quality.database_checks(b.tables(spark, sf), r.universe(spark), r.CLOSE_ONLY)


@query("v13_whole_gate_on_faults", allv(
    V("gate_macro_count", "''", "(SELECT count(*) FILTER (day(date) <> 5) AS a, count(*) AS n FROM spine)", "CAST(a AS VARCHAR) || ' against ' || CAST(n AS VARCHAR)"),
    V("gate_macro_absent", DAY, "spine WHERE day(date) = 5"),
    V("gate_outcome_count", "''", "(SELECT count(*) FILTER (day(date) <> 6) AS a, count(*) AS n FROM bars)", "CAST(a AS VARCHAR) || ' against ' || CAST(n AS VARCHAR)"),
    V("gate_close_only_shape", BAR, "bars WHERE symbol = 'HOUSEHOLD' AND day(date) = 8"),
    V("regimes_drawdown", BAR, "bars WHERE day(date) = 9"),
    "SELECT 'gate_symbols', '', '5 against 6'",
))
def _(spark, sf):
    t, d = b.tables(spark, sf), F.dayofmonth("date")
    t["macro_conditions"] = t["macro_conditions"].where(d != 5)
    t["market_outcomes"] = t["market_outcomes"].where(d != 6)
    t["daily_market_data"] = t["daily_market_data"].withColumn("volume", F.when((F.col("symbol") == "HOUSEHOLD") & (d == 8), 1).otherwise(F.col("volume")))
    t["asset_regimes"] = t["asset_regimes"].withColumn("drawdown_pct", F.when(d != 9, F.col("drawdown_pct")))
    u = r.universe(spark).unionByName(spark.createDataFrame([("GOLD", "etf", False)], "symbol string, asset_type string, close_only boolean"))
    return quality.database_checks(t, u, r.CLOSE_ONLY)
