"""Queries on landed documents: payloads, pages, artifacts, blobs, metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import macro, snapshots
from tidemark.plans import builders as b
from tidemark.plans import landed
from tidemark.plans import recipes as r
from tidemark.plans.registry import query
from tidemark.sources import artifacts, bars, html, json_paths, observations, tables

SOUND = """symbol <> 'HOUSEHOLD' AND NOT (symbol = 'MACHINERY' AND year(date) = 1997) AND NOT (symbol = 'FURNITURE' AND year(date) = 1996)"""


@query("s1_bar_documents", f"""SELECT lower(symbol) AS symbol, strftime(date, '%Y-%m-%dT00:00:00.000Z') AS date, close, volume,
  adj_close FROM all_bars WHERE {SOUND}""", "close adj_close")
def _(spark, sf):
    rows = bars.bar_rows(landed.bar_documents(spark, sf), ["symbol", "year"])
    return rows.select(
        "symbol", "date", F.col("close").cast("double").alias("close"), F.col("volume").cast("bigint").alias("volume"),
        F.col("adjClose").cast("double").alias("adj_close"),
    )


@query("s1_bar_document_errors", """SELECT DISTINCT lower(symbol) AS symbol, CAST(year(date) AS INTEGER) AS year,
  CASE WHEN symbol = 'MACHINERY' THEN 'not an array' WHEN symbol = 'FURNITURE' THEN 'empty'
    ELSE 'missing fields: adjClose,adjHigh,adjLow,adjOpen,adjVolume,divCash,high,low,open,splitFactor,volume' END AS error
FROM all_bars WHERE symbol = 'HOUSEHOLD' OR (symbol = 'MACHINERY' AND year(date) = 1997) OR (symbol = 'FURNITURE' AND year(date) = 1996)""")
def _(spark, sf):
    return bars.document_errors(landed.bar_documents(spark, sf), ["symbol", "year"])


@query("s1_bar_files", f"""SELECT lower(symbol) AS symbol, CAST(year(date) AS INTEGER) AS year, strftime(date, '%Y-%m-%dT00:00:00.000Z') AS date,
  close, volume, adj_close FROM all_bars WHERE {SOUND}""", "close adj_close")
def _(spark, sf):
    docs = bars.read_bar_documents(spark, landed.bar_files(spark, sf))
    named = [F.regexp_extract("path", f"/{c}=([^/]*)/", 1).alias(c) for c in ("symbol", "year")]
    rows = bars.bar_rows(docs.select(*named, "payload"), ["symbol", "year"])
    return rows.select(
        F.url_decode("symbol").alias("symbol"), F.col("year").cast("int").alias("year"), "date", F.col("close").cast("double").alias("close"),
        F.col("volume").cast("bigint").alias("volume"), F.col("adjClose").cast("double").alias("adj_close"),
    )


OBS = ", ".join(schemas.OBSERVED_COLUMNS)
OBSD = " ".join(c for c in schemas.OBSERVED_COLUMNS if not c.endswith("volume"))


def _bar_rows(spark, sf):
    return bars.bar_rows(landed.bar_documents(spark, sf), ["symbol", "year"])


@query("p1_normalised_bars", f"SELECT date, symbol, {OBS} FROM bars WHERE {SOUND} AND NOT (symbol = 'BUILDING' AND day(date) = 5)", OBSD)
def _(spark, sf):
    return bars.normalize_bars(_bar_rows(spark, sf), r.spine(spark, sf))


@query("p1_rejected_bars", f"SELECT date, symbol FROM all_bars WHERE {SOUND} AND date NOT IN (SELECT date FROM spine)")
def _(spark, sf):
    return bars.bar_rejects(_bar_rows(spark, sf), r.spine(spark, sf))


@query("p1_bad_numbers", f"SELECT date, symbol, 'open' AS field FROM bars WHERE {SOUND} AND symbol = 'BUILDING' AND day(date) = 5")
def _(spark, sf):
    return bars.bar_number_errors(_bar_rows(spark, sf), r.spine(spark, sf))


LEVELS = """SELECT date, CASE WHEN day(date) = 15 THEN -CAST(value AS DOUBLE) ELSE CAST(value AS DOUBLE) END AS close
FROM observations WHERE series = 'dff' AND day(date) NOT IN (13, 14, 16, 17, 18)"""


@query("p2_close_only_rows", f"""SELECT date, 'WTI' AS symbol, close, CAST(NULL AS DOUBLE) AS open, CAST(NULL AS BIGINT) AS volume,
  CAST(NULL AS DOUBLE) AS adj_close FROM ({LEVELS}) WHERE date IN (SELECT date FROM spine)""", "close")
def _(spark, sf):
    x = bars.normalize_close_only("wti", landed.messy_levels(spark, sf), r.spine(spark, sf))
    return x.select("date", "symbol", "close", "open", "volume", "adj_close")


@query("p2_close_only_rejects", f"SELECT date FROM ({LEVELS}) WHERE date NOT IN (SELECT date FROM spine)")
def _(spark, sf):
    return bars.close_only_rejects(landed.messy_levels(spark, sf), r.spine(spark, sf))


RN = "(SELECT *, row_number() OVER (PARTITION BY series ORDER BY ordinal) - 1 AS rn FROM vintages)"


@query("s2_paged_observations", f"""SELECT series, CAST(rn // 100 AS INTEGER) AS page, CAST(rn % 100 AS INTEGER) AS pos,
  strftime(ref_date, '%Y-%m-%d') AS date,
  CASE WHEN month(ref_date) = 6 AND print = 2 THEN '.' ELSE CAST(value AS VARCHAR) END AS value,
  strftime(realtime_start, '%Y-%m-%d') AS realtime_start, strftime(realtime_end, '%Y-%m-%d') AS realtime_end FROM {RN}""")
def _(spark, sf):
    o = observations.observations(landed.vintage_payloads(spark, sf), "series")
    return o.select("series", F.col("ordinal.page").alias("page"), F.col("ordinal.pos").alias("pos"), "date", "value", "realtime_start", "realtime_end")


@query("s2_paged_files", f"""SELECT series, CAST(rn AS BIGINT) AS place, CAST(rn % 100 AS INTEGER) AS pos,
  strftime(ref_date, '%Y-%m-%d') AS date,
  CASE WHEN month(ref_date) = 6 AND print = 2 THEN '.' ELSE CAST(value AS VARCHAR) END AS value,
  strftime(realtime_start, '%Y-%m-%d') AS realtime_start, strftime(realtime_end, '%Y-%m-%d') AS realtime_end FROM {RN}""")
def _(spark, sf):
    pages = observations.read_pages(spark, landed.vintage_files(spark, sf), "series")
    rows = pages.select("series", "offset", F.posexplode(F.from_json("body", observations.BODY)["observations"]).alias("pos", "o"))
    return rows.select("series", (F.col("offset") + F.col("pos")).alias("place"), "pos", "o.*")


@query("p3_parsed_vintage_files", """SELECT series, ref_date, value, realtime_start, realtime_end FROM vintages
WHERE NOT (month(ref_date) = 6 AND print = 2)""", "value")
def _(spark, sf):
    o = observations.read_observations(spark, landed.vintage_files(spark, sf), "series")
    return macro.parse_vintages(o).select("series", "ref_date", "value", "realtime_start", "realtime_end")


@query("s3_concatenated_pages", f"""SELECT series, CAST(count(*) AS BIGINT) AS pages, string_agg(CAST(o AS VARCHAR), ',' ORDER BY o) AS offsets
FROM (SELECT DISTINCT series, rn // 100 * 100 AS o FROM {RN}) GROUP BY 1""")
def _(spark, sf):
    text = landed.vintage_payloads(spark, sf)
    heads = F.regexp_extract_all("payload", F.lit(r"(?m)^offset=(\d+)$"), F.lit(1))
    return text.select("series", F.size(heads).cast("bigint").alias("pages"), F.array_join(heads, ",").alias("offsets"))


@query("p3_parsed_vintages", """SELECT series, ref_date, value, realtime_start, realtime_end FROM vintages
WHERE NOT (month(ref_date) = 6 AND print = 2)""", "value")
def _(spark, sf):
    o = observations.observations(landed.vintage_payloads(spark, sf), "series")
    return macro.parse_vintages(o).select("series", "ref_date", "value", "realtime_start", "realtime_end")


@query("s4_page_text", "SELECT page_id, length(html) AS chars, md5(html) AS md5 FROM pages")
def _(spark, sf):
    p = r.table(spark, sf, "pages").select("page_id", F.col("html").cast("binary").alias("content"))
    text = html.page_text(F.col("content"))
    return p.select("page_id", F.length(text).cast("bigint").alias("chars"), F.md5(text.cast("binary")).alias("md5"))


CLEAN = r"""regexp_replace(regexp_replace(frag, '<[^>]+>', '', 'g'), '\s+', ' ', 'g')"""
for _e, _c in [  # the references that the pages hold; the last one undoes the escape the others start with
    ("&nbsp;", "\u00a0"), ("&ndash;", "–"), ("&mdash;", "—"), ("&rsquo;", "’"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"),
]:
    CLEAN = f"replace({CLEAN}, '{_e.replace(chr(39), chr(39) * 2)}', '{_c.replace(chr(39), chr(39) * 2)}')"


@query("p10_page_headings", f"""SELECT page_id, CAST(position AS INTEGER) AS position,
  regexp_replace({CLEAN}, '^[\\s ]+|[\\s ]+$', '', 'g') AS title
FROM (SELECT page_id, unnest(f) AS frag, unnest(range(len(f))) AS position FROM (
  SELECT page_id, regexp_extract_all(html, '(?is)<h[123][^>]*>(.*?)</h[123]>', 1) AS f FROM pages))""")
def _(spark, sf):
    return html.headings(r.table(spark, sf, "pages"), "page_id", (1, 2, 3)).withColumn("position", F.col("position").cast("int"))


@query("p10_character_references", """SELECT event_id, 'x' || chr(n) || 'a' || chr(n) || 'b' || chr(128512 + n % 60) || 'é…&bogus;&lt;' AS title FROM (SELECT event_id, CAST(200 + event_id % 20000 AS INTEGER) AS n FROM events)""")
def _(spark, sf):
    n = (200 + F.col("event_id") % 20000).cast("int")
    parts = ["<b>x&#", n.cast("string"), ";</b>a&#x", F.hex(n), ";b&#", (128512 + n % 60).cast("string"), ";&eacute;&hellip;&bogus;&amp;lt;"]
    text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return r.table(spark, sf, "events").select("event_id", html.strip_tags(text).alias("title"))


@query("p9_meeting_headings", "SELECT event_date FROM (SELECT CASE WHEN n % 5 = 4 THEN CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) ELSE d END AS event_date FROM headings WHERE n % 8 NOT IN (0, 1, 2, 3))")
def _(spark, sf):
    return html.meeting_days(r.heading_pages(spark, sf), "page_id").select("event_date")


@query("p11_panel_meeting_days", """SELECT CAST(year(d) + 5 AS INTEGER) AS year, CAST(d + INTERVAL 5 YEAR AS DATE) AS event_date FROM headings
WHERE year(d) + 5 BETWEEN 2001 AND 2005""")
def _(spark, sf):
    days = html.panel_meeting_days(landed.panel_pages(spark, sf), "page", F.col("year").between(2001, 2005))
    return days.select("year", "event_date")


# -------------------------------------------------------------- table scans
@query("s5_derive_scan", f"SELECT date, symbol, {OBS} FROM bars WHERE symbol IN ('BUILDING', 'HOUSEHOLD')", OBSD)
def _(spark, sf):
    return tables.market_scan(b.table(spark, sf, "daily_market_data"), "derive", ["BUILDING", "HOUSEHOLD"])


@query("s5_outcomes_scan", "SELECT date, symbol, close, adj_close, adj_high, adj_low FROM bars WHERE symbol IN ('FURNITURE')", "close adj_close adj_high adj_low")
def _(spark, sf):
    return tables.market_scan(b.table(spark, sf, "daily_market_data"), "outcomes", ["FURNITURE"])


@query("s5_regimes_scan", "SELECT date, symbol, close, adj_close, return_1d, drawdown_from_high FROM daily_market_data WHERE symbol IN ('MACHINERY', 'BUILDING')",
       "close adj_close return_1d drawdown_from_high")
def _(spark, sf):
    return tables.market_scan(b.table(spark, sf, "daily_market_data"), "regimes", ["MACHINERY", "BUILDING"])


@query("s6_spine_scan", f"SELECT {', '.join(schemas.columns('trading_days'))} FROM trading_days")
def _(spark, sf):
    return tables.full_spine(b.table(spark, sf, "trading_days"))


@query("s11_instruments", "SELECT symbol, CASE WHEN symbol = 'HOUSEHOLD' THEN 'commodity' ELSE 'etf' END AS asset_type, symbol = 'HOUSEHOLD' AS close_only, count(*) AS bars FROM bars GROUP BY 1")
def _(spark, sf):
    n = b.table(spark, sf, "daily_market_data").groupBy("symbol").agg(F.count("*").alias("bars"))
    return tables.instruments(r.universe(spark)).join(n, "symbol")


@query("s11_fields", """SELECT 'market_outcomes' AS domain, column_name AS field, column_name IN ('date', 'symbol', 'return_1d', 'return_5d', 'return_20d') AS sortable,
  false AS boolean_filter FROM (DESCRIBE SELECT * FROM market_outcomes)""")
def _(spark, sf):
    return tables.fields(b.table(spark, sf, "market_outcomes"), "market_outcomes").drop("type")


# ---------------------------------------------------------------- artifacts
BROKEN = "event_id % 13 = 0"
ROOT = "event_id % 17 = 0"
HITS = """CASE WHEN event_id % 7 = 0 AND event_id % 11 = 0 THEN 'api_key,password' WHEN event_id % 7 = 0 THEN 'api_key' WHEN event_id % 11 = 0 THEN 'password' END"""
USABLE = f"NOT ({BROKEN}) AND NOT ({ROOT}) AND event_id % 7 <> 0 AND event_id % 11 <> 0"
STARTED = "CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END"


@query("s8_artifact_scan", f"""SELECT 'reports/' || k || CAST(event_id AS VARCHAR) || '.json' AS path, CASE WHEN k = 'run_' THEN 'run_report' ELSE 'manifest' END AS kind,
  CASE WHEN error IS NULL THEN (CASE WHEN k = 'run_' THEN 'r' ELSE 'b' END) ELSE '' END || CAST(event_id AS VARCHAR) AS artifact_id,
  CASE WHEN error IS NULL THEN {STARTED} END AS started_at, error
FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'manifest_' ELSE 'run_' END AS k,
    CASE WHEN {BROKEN} THEN 'malformed JSON' WHEN {ROOT} THEN 'root is not an object' ELSE 'secret-like keys: ' || {HITS} END AS error FROM events)""")
def _(spark, sf):
    docs = landed.artifact_documents(spark, sf)
    both = artifacts.scan(docs, "manifest").unionByName(artifacts.scan(docs, "run_report"))
    return artifacts.newest_first(both).drop("text")


NEW = "schema_version = '1.1'"
MAN = f"""(SELECT event_id, 'b' || CAST(event_id AS VARCHAR) AS build_id, CASE WHEN user_id % 2 = 0 THEN '1.0' ELSE '1.1' END AS schema_version,
  CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END AS validation_result, CAST(event_id % 4 AS INTEGER) AS snaps,
  event_id % 3 <> 0 AS cap, event_id % 4 <> 0 AS exact_, 'f' || CAST(event_id AS VARCHAR) AS print FROM events WHERE event_id % 2 = 0 AND {USABLE})"""


@query("p15_manifest_classes", f"""SELECT build_id, true AS provenance_capable, {NEW} AND cap AND snaps > 0 AS snapshot_capture,
  {NEW} AND cap AND snaps > 0 AND exact_ AS exact_rebuild_capable FROM {MAN}""")
def _(spark, sf):
    s = artifacts.manifest_summaries(artifacts.scan(landed.artifact_documents(spark, sf), "manifest"))
    return s.select("build_id", "provenance_capable", "snapshot_capture", "exact_rebuild_capable")


@query("p16_manifest_summaries", f"SELECT build_id, schema_version, validation_result, snaps AS snapshot_count, CAST(1 AS INTEGER) AS table_fingerprint_count, print AS database_fingerprint FROM {MAN}")
def _(spark, sf):
    s = artifacts.manifest_summaries(artifacts.scan(landed.artifact_documents(spark, sf), "manifest"))
    return s.select("build_id", "schema_version", "validation_result", "snapshot_count", "table_fingerprint_count", "database_fingerprint")


@query("p16_run_summaries", f"""SELECT 'r' || CAST(event_id AS VARCHAR) AS run_id,
  CASE event_type WHEN 'click' THEN 'SUCCESS_UPDATED' WHEN 'view' THEN 'SUCCESS_NO_CHANGE' ELSE 'FAILED' END AS status,
  CASE WHEN event_id % 4 = 1 THEN 'derive' END AS failure_stage,
  CASE WHEN event_id % 3 = 0 THEN 'boom' WHEN event_id % 4 = 1 THEN 'derive' END AS failure_reason
FROM events WHERE event_id % 2 = 1 AND {USABLE}""")
def _(spark, sf):
    s = artifacts.run_summaries(artifacts.scan(landed.artifact_documents(spark, sf), "run_report"))
    return s.select("run_id", "status", "failure_stage", "failure_reason")


RUNS = f"""(SELECT 'r' || CAST(event_id AS VARCHAR) AS id, coalesce({STARTED}, 'r' || CAST(event_id AS VARCHAR)) AS o, event_type IN ('click', 'view') AS ok
  FROM events WHERE event_id % 2 = 1 AND {USABLE})"""


@query("q5_operational_runs", f"""SELECT (SELECT id FROM {RUNS} ORDER BY o DESC, id DESC LIMIT 1) AS latest_attempt,
  (SELECT id FROM {RUNS} WHERE ok ORDER BY o DESC, id DESC LIMIT 1) AS latest_success""")
def _(spark, sf):
    return artifacts.operational_runs(artifacts.scan(landed.artifact_documents(spark, sf), "run_report"))


@query("h7_rebuild_eligibility", f"""SELECT build_id, CASE WHEN NOT ({NEW}) THEN 'schema version'
  WHEN NOT (cap AND snaps > 0 AND exact_) THEN 'not exact-rebuild capable' END AS reason FROM {MAN}""")
def _(spark, sf):
    return artifacts.rebuild_eligibility(artifacts.scan(landed.artifact_documents(spark, sf), "manifest"))


@query("p17_secret_keys", f"SELECT 'reports/' || CASE WHEN event_id % 2 = 0 THEN 'manifest_' ELSE 'run_' END || CAST(event_id AS VARCHAR) || '.json' AS path, {HITS} AS keys FROM events WHERE NOT ({BROKEN}) AND NOT ({ROOT}) AND (event_id % 7 = 0 OR event_id % 11 = 0)")
def _(spark, sf):
    d = landed.artifact_documents(spark, sf).select("path", artifacts.secret_keys(F.col("text")).alias("k"))
    return d.where("size(k) > 0").select("path", F.array_join("k", ",").alias("keys"))


@query("p18_scrubbed_identities", """SELECT event_id, '/v1/' || event_type AS url, CAST(user_id % 10 AS VARCHAR) AS user,
  CAST(CASE WHEN event_id % 97 = 0 THEN 3 ELSE 2 END AS INTEGER) AS kept, event_id % 97 = 0 AS leaks,
  CAST(2 + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END + CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END AS INTEGER) AS listed FROM events""")
def _(spark, sf):
    i = json_paths.scrubbed(landed.identities(spark, sf).select("event_id", "identity"), "identity")
    m = F.from_json("scrubbed_text", "map<string,string>")
    return i.select(
        "event_id", m["url"].alias("url"), m["user"].alias("user"), F.size(m).alias("kept"), "leaks",
        F.size(artifacts.listed_metadata(F.col("identity"))).alias("listed"),
    )


NESTED = r"""(SELECT event_id, CASE WHEN event_id % 13 = 0 THEN t || '}' ELSE t END AS text FROM (SELECT event_id, '{"request":{' ||
  CASE WHEN event_id % 5 = 0 THEN '"auth":{"password":"p","user":"u' || user_id || '","api_key":{"secret":"s","n":1}},' ELSE '' END || '"url":"/v1/' || event_type || '"},' ||
  CASE WHEN event_id % 7 = 0 THEN '"items":[{"id":' || event_id || ',"token":"t"},[[{"Api-Key":null}],2],{}],' ELSE '' END ||
  CASE WHEN event_id % 11 = 0 THEN '"note":"Token abc",' WHEN event_id % 11 = 1 THEN '"no\\u0074e":"plain",' ELSE '' END || '"user":' || user_id || '}' AS t FROM events))"""


@query("p17_secret_paths", f"""SELECT event_id, regexp_replace(fullkey, '"([^"]*)"', '\\1', 'g')[3:] AS path FROM {NESTED} AS d, json_tree(text) AS j
WHERE event_id % 13 <> 0 AND regexp_matches(key, '(?i)api[_-]?key|password|secret|authorization')""")
def _(spark, sf):
    return json_paths.secret_paths(landed.nested_documents(spark, sf), ["event_id"])


@query("p18_scrubbed_documents", """SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN '{' || CASE WHEN event_id % 7 = 0 THEN '"items":[{"id":' || event_id || '},[[{}],2],{}],' ELSE '' END ||
  CASE WHEN event_id % 11 = 0 THEN '"note":"Token abc",' WHEN event_id % 11 = 1 THEN '"note":"plain",' ELSE '' END || '"request":{' ||
  CASE WHEN event_id % 5 = 0 THEN '"auth":{"user":"u' || user_id || '"},' ELSE '' END || '"url":"/v1/' || event_type || '"},"user":' || user_id || '}' END AS text,
  CASE WHEN event_id % 13 <> 0 THEN event_id % 11 = 0 END AS leaks FROM events""")
def _(spark, sf):
    x = json_paths.scrubbed(landed.nested_documents(spark, sf))
    # documents with nothing to look for keep their order of keys, so content is compared in the order of keys
    return x.select("event_id", F.to_json(F.try_parse_json("scrubbed_text")).alias("text"), "leaks")


@query("p19_identity_keys", """SELECT event_id, '{"url":"/v1/' || event_type || '","user":"' || CAST(user_id % 10 AS VARCHAR) || '"}' AS key FROM events""")
def _(spark, sf):
    return landed.identities(spark, sf).select("event_id", artifacts.identity_key(F.col("clean")).alias("key"))


@query("j20_replay_resolution", """WITH k AS (SELECT event_id, event_type || '/' || CAST(user_id % 10 AS VARCHAR) AS key FROM events),
latest AS (SELECT key, max(event_id) AS last FROM k WHERE event_id % 3 = 0 AND key NOT LIKE 'view/%' GROUP BY 1)
SELECT event_id AS request, 'sha256:' || CAST(last AS VARCHAR) AS snapshot_id,
  CASE WHEN last IS NULL THEN 'no snapshot for request identity' END AS error FROM k LEFT JOIN latest USING (key)""")
def _(spark, sf):
    i = landed.identities(spark, sf)
    registered = i.where("event_id % 3 = 0 AND clean NOT LIKE '%/v1/view%'").select(F.col("clean").alias("identity"), "ordinal", "snapshot_id")
    return snapshots.resolve(i.select(F.col("event_id").alias("request"), F.col("clean").alias("identity")), registered)


@query("a16_deduplicated_payloads", "SELECT 'sha256:' || sha256(html) AS snapshot_id, CAST(page_id AS VARCHAR) || '/0' AS meta, CAST(octet_length(encode(html)) AS BIGINT) AS byte_size FROM pages")
def _(spark, sf):
    return snapshots.deduplicated(landed.landed_pages(spark, sf)).withColumn("byte_size", F.col("byte_size").cast("bigint"))


@query("a16_landing_counts", """SELECT CAST(count(*) + count(*) FILTER (page_id % 10 = 0) AS BIGINT) AS retrieval_events, count(*) AS unique_payloads,
  CAST(sum(octet_length(encode(html))) AS BIGINT) AS total_bytes FROM pages""")
def _(spark, sf):
    return snapshots.landing_counts(landed.landed_pages(spark, sf))


VERIFY = """SELECT page_id AS entry, CASE WHEN page_id % 31 <> 0 THEN CASE WHEN page_id % 29 = 0 THEN 'md5:' ELSE 'sha256:' END || sha256(html) END AS snapshot_id,
  CASE WHEN page_id % 31 = 0 OR page_id % 29 = 0 OR page_id % 23 = 0 THEN 'invalid_metadata'
    WHEN page_id % 17 = 0 OR page_id % 37 = 0 THEN 'missing' WHEN page_id % 19 = 0 THEN 'corrupt' ELSE 'ok' END AS status FROM pages"""


@query("j19_snapshot_verification", VERIFY)
def _(spark, sf):
    return snapshots.verify(landed.snapshot_entries(spark, sf), landed.snapshot_blobs(spark, sf))


@query("h7_verified_rebuilds", f"""WITH s AS ({VERIFY}), found AS (SELECT p.page_id, bool_or(status <> 'ok') AS bad FROM pages p JOIN s ON s.entry IN (p.page_id, p.page_id + 1) WHERE p.page_id % 8 <> 0 GROUP BY 1)
SELECT 'm' || CAST(page_id AS VARCHAR) AS build_id, CASE WHEN page_id % 3 = 0 THEN 'schema version' WHEN page_id % 7 = 0 OR page_id % 8 = 0 THEN 'not exact-rebuild capable'
  WHEN page_id % 5 = 0 THEN 'no database fingerprint' WHEN bad THEN 'snapshot verification failed' END AS reason FROM pages LEFT JOIN found USING (page_id)
WHERE NOT (page_id % 8 <> 0 AND (page_id % 23 = 0 OR (page_id + 1) % 23 = 0 AND page_id < (SELECT max(page_id) FROM pages)))""")
def _(spark, sf):
    # a manifest with a secret in an entry is unusable as a whole; without snapshots it is never capable, so that reason can't be reached
    usable = artifacts.scan(landed.rebuild_manifests(spark, sf), "manifest").where("error IS NULL")
    verified = snapshots.verify(artifacts.snapshot_entries(usable), landed.snapshot_blobs(spark, sf))
    return artifacts.rebuild_eligibility(usable, verified.withColumnRenamed("entry", "build_id"))


@query("j19_verification_counts", f"""SELECT count(*) AS checked, count(DISTINCT snapshot_id) AS unique_payloads, count(*) FILTER (status = 'missing') AS missing,
  count(*) FILTER (status = 'corrupt') AS corrupt, count(*) FILTER (status = 'invalid_metadata') AS invalid_metadata FROM ({VERIFY})""")
def _(spark, sf):
    return snapshots.verify_counts(snapshots.verify(landed.snapshot_entries(spark, sf), landed.snapshot_blobs(spark, sf)))
