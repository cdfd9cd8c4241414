"""Landed documents made from the raw tables: payloads, pages, artifacts and blobs, some of them faulty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans import recipes as r
from tidemark.plans.store import stored
from tidemark.session import scratch_path
from tidemark.sources.observations import concat_pages, write_pages

PAGE_ROWS = 100


def bar_documents(spark: SparkSession, sf: str) -> DataFrame:
    """(symbol, year, payload): one JSON bar array per symbol and year (at most 366 bars).

    One payload is no array, one is empty; close-only bars lack fields; some opens are no number.
    """
    b = r.all_bars(spark, sf)
    bad = (F.col("symbol") == "BUILDING") & (F.dayofmonth("date") == 5)
    bar = F.struct(
        F.date_format("date", "yyyy-MM-dd'T'00:00:00.000'Z'").alias("date"),
        F.when(bad, "bad").otherwise(F.col("open").cast("string")).alias("open"),
        "high", "low", "close", "volume",
        F.col("adj_open").alias("adjOpen"), F.col("adj_high").alias("adjHigh"), F.col("adj_low").alias("adjLow"),
        F.col("adj_close").alias("adjClose"), F.col("adj_volume").alias("adjVolume"),
        F.col("dividend_cash").alias("divCash"), F.col("split_factor").alias("splitFactor"), F.lit("x").alias("extra"),
    )
    docs = b.groupBy("symbol", F.year("date").alias("year")).agg(F.to_json(F.array_sort(F.collect_list(bar))).alias("payload"))
    payload = (
        F.when((F.col("symbol") == "MACHINERY") & (F.col("year") == 1997), '{"detail":"limit"}')
        .when((F.col("symbol") == "FURNITURE") & (F.col("year") == 1996), "[]")
        .otherwise(F.col("payload"))
    )
    return docs.select(F.lower("symbol").alias("symbol"), "year", payload.alias("payload"))


def messy_levels(spark: SparkSession, sf: str) -> DataFrame:
    """(date, value): one daily level with gaps, bad text, negatives and non-finite numbers, all as text."""
    o = r.observations(spark, sf).where("series = 'dff'")
    d = F.dayofmonth("date")
    value = (
        F.when(d == 14, "n/a").when(d == 15, F.concat(F.lit("-"), "value")).when(d == 16, "NaN").when(d == 17, "")
        .when(d == 18, None).otherwise(F.col("value"))
    )
    return o.select(F.date_format("date", "yyyy-MM-dd").alias("date"), value.alias("value"))


def vintage_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(series, offset, body): vintages as JSON pages of 100 rows, a tenth of them missing values."""
    v = r.vintages(spark, sf)
    rn = F.row_number().over(Window.partitionBy("series").orderBy("ordinal")) - 1
    value = F.when((F.month("ref_date") == 6) & (F.col("print") == 2), ".").otherwise(F.col("value").cast("string"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    x = v.select("series", rn.alias("rn"), F.date_format("ref_date", "yyyy-MM-dd").alias("date"), value.alias("value"),
                 day("realtime_start"), day("realtime_end"))
    row = F.struct("rn", "date", "value", "realtime_start", "realtime_end")
    rows = F.transform(
        F.array_sort(F.collect_list(row)),
        lambda s: F.struct(*[s[c].alias(c) for c in ("date", "value", "realtime_start", "realtime_end")]),
    )
    page = x.groupBy("series", (F.expr(f"rn div {PAGE_ROWS}") * PAGE_ROWS).alias("offset"))
    return page.agg(F.to_json(F.struct(rows.alias("observations"))).alias("body"))


def vintage_payloads(spark: SparkSession, sf: str) -> DataFrame:
    return concat_pages(vintage_pages(spark, sf), "series")


def vintage_files(spark: SparkSession, sf: str) -> str:
    """The folder the same pages are landed in, one file per series."""
    path = scratch_path(spark, "vintage_files")
    write_pages(vintage_pages(spark, sf), "series", path)
    return path


def bar_files(spark: SparkSession, sf: str) -> str:
    """The folder the bar documents are landed in, one file per symbol and year."""
    path = scratch_path(spark, "bar_files")
    docs = bar_documents(spark, sf).select("symbol", "year", "payload")
    docs.write.partitionBy("symbol", "year").text(path)
    return path


def build_artifact_documents(spark: SparkSession, sf: str) -> DataFrame:
    """(path, text): a manifest or run report per event; some malformed, no object, or with secret-like keys."""
    e = r.table(spark, sf, "events")
    i = F.col("event_id")
    kind = F.when(i % 2 == 0, "manifest_").otherwise("run_")
    status = (
        F.when(F.col("event_type") == "click", "SUCCESS_UPDATED").when(F.col("event_type") == "view", "SUCCESS_NO_CHANGE")
        .otherwise("FAILED")
    )
    fields = F.struct(
        F.concat(F.lit("b"), i).alias("build_id"), F.concat(F.lit("r"), i).alias("run_id"),
        F.when(i % 5 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("started_at"),
        F.when(F.col("user_id") % 2 == 0, "1.0").otherwise("1.1").alias("schema_version"),
        status.alias("status"), F.when(i % 3 == 0, "boom").alias("error"), F.when(i % 4 == 1, "derive").alias("failure_stage"),
        F.when(F.col("event_type") == "error", "FAIL").otherwise("PASS").alias("validation_result"),
        (i % 3 != 0).alias("snapshot_capture"), (i % 4 != 0).alias("exact_rebuild_capable"),
        F.expr("transform(slice(sequence(1, 3), 1, cast(event_id % 4 as int)), x -> named_struct('snapshot_id', concat('s', x)))").alias("snapshots"),
        F.array(F.lit("t")).alias("table_fingerprints"),
        F.lit('a "api_key": in a value').alias("note"),
        F.when(i % 7 == 0, "k").alias("api_key"),
        F.when(i % 11 == 0, F.array(F.struct(F.lit("p").alias("password")))).alias("nested"),
    )
    fields_text = F.to_json(fields)
    print_ = F.when(i % 6 == 0, F.concat(F.lit('{"database_fingerprint":"f'), i, F.lit('"}'))).otherwise(F.concat(F.lit('"f'), i, F.lit('"')))
    whole = F.concat(F.expr("left({t}, length({t}) - 1)".replace("{t}", "doc")), F.lit(',"database_fingerprint":'), print_, F.lit("}"))
    text = F.when(i % 13 == 0, '{"broken": ').when(i % 17 == 0, "[1, 2]").otherwise(whole)
    x = e.withColumn("doc", fields_text)
    return x.select(F.concat(F.lit("reports/"), kind, i, F.lit(".json")).alias("path"), text.alias("text"))


def artifact_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The artifact documents as landed (written once, then read)."""
    return stored(spark, sf, "artifact_documents", build_artifact_documents)


def identities(spark: SparkSession, sf: str) -> DataFrame:
    """(event_id, identity, ordinal, snapshot_id): request identities of landed payloads, keys in varying order."""
    e = r.table(spark, sf, "events")
    url = F.concat(F.lit('"url":"/v1/'), "event_type", F.lit('"'))
    user = F.concat(F.lit('"user":"'), (F.col("user_id") % 10).cast("string"), F.lit('"'))
    both = F.when(F.col("event_id") % 2 == 0, F.concat(url, F.lit(","), user)).otherwise(F.concat(user, F.lit(","), url))
    secret = F.when(F.col("event_id") % 7 == 0, ',"api_key":"k","token":"t"').otherwise("")
    leak = F.when(F.col("event_id") % 97 == 0, ',"header":"Token abc"').otherwise("")
    return e.select(
        "event_id", F.concat(F.lit("{"), both, secret, leak, F.lit("}")).alias("identity"),
        F.concat(F.lit("{"), both, F.lit("}")).alias("clean"),
        F.col("event_id").alias("ordinal"), F.concat(F.lit("sha256:"), F.col("event_id").cast("string")).alias("snapshot_id"),
    )


def nested_documents(spark: SparkSession, sf: str) -> DataFrame:
    """(event_id, text): request records with secrets at several depths, in lists, below other secrets, or nowhere."""
    e = r.table(spark, sf, "events")
    i, user = F.col("event_id"), F.col("user_id").cast("string")
    auth = F.when(i % 5 == 0, F.concat(F.lit('"auth":{"password":"p","user":"u'), user, F.lit('","api_key":{"secret":"s","n":1}},'))).otherwise("")
    items = F.when(i % 7 == 0, F.concat(F.lit('"items":[{"id":'), i.cast("string"), F.lit(',"token":"t"},[[{"Api-Key":null}],2],{}],'))).otherwise("")
    note = F.when(i % 11 == 0, '"note":"Token abc",').when(i % 11 == 1, '"no\\u0074e":"plain",').otherwise("")
    text = F.concat(F.lit('{"request":{'), auth, F.lit('"url":"/v1/'), "event_type", F.lit('"},'), items, note, F.lit('"user":'), user, F.lit("}"))
    return e.select("event_id", F.when(i % 13 == 0, F.concat(text, F.lit("}"))).otherwise(text).alias("text"))


def landed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(content, retrieved_at, meta): every page, each tenth one landed twice."""
    p = r.table(spark, sf, "pages").select("page_id", F.col("html").cast("binary").alias("content"))
    copies = F.explode(F.when(F.col("page_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return p.select(
        "content", copies, "page_id"
    ).select("content", (F.col("page_id") + 1_000_000 * F.col("copy")).alias("retrieved_at"), F.concat_ws("/", "page_id", "copy").alias("meta"))


def snapshot_entries(spark: SparkSession, sf: str) -> DataFrame:
    """(entry, snapshot_id, meta): a manifest entry per page; some without id, ill-formed, or with secret-like keys."""
    i = F.col("page_id")
    ident = F.concat(F.when(i % 29 == 0, "md5:").otherwise("sha256:"), F.sha2(F.col("html").cast("binary"), 256))
    meta = F.when(i % 23 == 0, '{"api_key":"k"}').otherwise('{"provider":"p"}')
    return r.table(spark, sf, "pages").select(i.alias("entry"), F.when(i % 31 != 0, ident).alias("snapshot_id"), meta.alias("meta"))


def rebuild_manifests(spark: SparkSession, sf: str) -> DataFrame:
    """(path, text): a manifest for every page, naming the page's snapshot and the next page's; some old, incapable or without parts."""
    entries = snapshot_entries(spark, sf).select("entry", F.to_json(F.struct("snapshot_id", F.get_json_object("meta", "$.api_key").alias("api_key"))).alias("j"))
    p = F.col("page_id")
    both = r.table(spark, sf, "pages").select("page_id", F.explode(F.array(p, p + 1)).alias("entry")).join(entries, "entry")
    snaps = both.groupBy("page_id").agg(F.array_join(F.sort_array(F.collect_list(F.struct("entry", "j")))["j"], ",").alias("snaps"))
    text = F.concat(
        F.lit('{"build_id":"m'), p.cast("string"), F.lit('","snapshot_capture":true,"exact_rebuild_capable":'), (p % 7 != 0).cast("string"),
        F.when(p % 3 != 0, ',"schema_version":"1.1"').otherwise(""), F.when(p % 5 != 0, F.concat(F.lit(',"database_fingerprint":"f'), p.cast("string"), F.lit('"'))).otherwise(""),
        F.lit(',"snapshots":['), F.when(p % 8 != 0, F.col("snaps")).otherwise(""), F.lit("]}"),
    )
    return snaps.select(F.concat(F.lit("reports/manifest_"), p.cast("string"), F.lit(".json")).alias("path"), text.alias("text"))


def snapshot_blobs(spark: SparkSession, sf: str) -> DataFrame:
    """(snapshot_id, content, sidecar): stored payloads; some absent, altered, or without a sidecar."""
    i = F.col("page_id")
    digest = F.sha2(F.col("html").cast("binary"), 256)
    content = F.when(i % 19 == 0, F.concat("html", F.lit("x"))).otherwise(F.col("html")).cast("binary")
    sidecar = F.concat(F.lit('{"sha256":"'), digest, F.lit('"}'))
    return r.table(spark, sf, "pages").where(i % 17 != 0).select(
        F.concat(F.lit("sha256:"), digest).alias("snapshot_id"), content.alias("content"), F.when(i % 37 != 0, sidecar).alias("sidecar")
    )


def panel_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(page, html): one panel page over all years, a block per year and a row per heading month."""
    h = r.headings(spark, sf)
    y = F.year("d") + 5  # panels carry years from 2000 on
    span = F.when(F.col("n") % 3 == 0, F.dayofmonth("d").cast("string")).otherwise(
        F.concat((F.dayofmonth("d") - 1).cast("string"), F.lit("-"), F.dayofmonth("d").cast("string"), F.lit("*"))
    )
    row = F.concat(
        F.lit('<div class="row fomc-meeting"><div class="fomc-meeting__month col"><strong>'), F.date_format("d", "MMMM"),
        F.lit('</strong></div><div class="fomc-meeting__date col">'), span, F.lit("</div></div>"),
    )
    blocks = h.groupBy(y.alias("y")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("d", row.alias("row")))), lambda s: s["row"]), "\n").alias("rows"))
    block = F.concat(F.lit("<h4><a>"), F.col("y").cast("string"), F.lit(" FOMC Meetings</a></h4>\n"), F.col("rows"))
    one = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y", block.alias("b")))), lambda s: s["b"]), "\n")
    return blocks.agg(F.concat(F.lit("<html><body>"), one, F.lit("</body></html>")).alias("html")).select(F.lit(1).alias("page"), "html")
