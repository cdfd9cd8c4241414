"""JSON artifacts (build manifests, run reports): tolerant scan, classification, summaries, secrets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
SECRET_KEY = r"(?i)api[_-]?key|password|secret|authorization|postgresql\+psycopg://[^@]+@"
SECRET_METADATA_KEY = r"(?i)api[_-]?key|^token$|authorization|password|secret|credential|database[_-]?url"
SECRET_VALUE = r"(?i)postgresql\+psycopg://[^@]+@|Token\s+[A-Za-z0-9]+"
SUCCESS_STATUSES = ["SUCCESS_NO_CHANGE", "SUCCESS_UPDATED"]

MANIFEST = (
    "struct<build_id:string,schema_version:string,build_started_at:string,started_at:string,validation_result:string,"
    "health_status:string,snapshot_capture:boolean,exact_rebuild_capable:boolean,snapshots:array<string>,"
    "table_fingerprints:array<string>,database_fingerprint:string>"
)
RUN_REPORT = (
    "struct<run_id:string,started_at:string,status:string,run_as_of:string,failure_stage:string,error:string,"
    "validation_result:string,health_status:string,change_classification:string>"
)


def read_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): one document per file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def json_keys(text: Column) -> Column:
    """Every object key at any depth, in text order, escapes resolved: string tokens that a colon follows."""
    tokens = F.regexp_extract_all(text, F.lit(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"\s*+:?'), F.lit(0))
    keys = F.transform(F.filter(tokens, lambda t: t.endswith(":")), lambda t: F.regexp_replace(t, r"\s*:$", ""))
    plain = F.transform(keys, lambda t: F.substring(t, F.lit(2), F.length(t) - 2))
    escaped = F.transform(keys, lambda t: F.get(F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<string>"), 0))
    return F.when(text.contains("\\"), escaped).otherwise(plain)


def secret_keys(text: Column, pattern: str = SECRET_KEY) -> Column:
    """Keys, at any depth, that look like secrets.

    Only text in which the pattern occurs anywhere, or that has escapes, is cut into tokens.
    """
    suspicious = text.rlike(pattern.replace("^token$", "token")) | text.contains("\\")
    none = F.array().cast("array<string>")
    return F.when(suspicious, F.filter(json_keys(text), lambda k: k.rlike(pattern))).when(text.isNotNull(), none)


def with_error(docs: DataFrame) -> DataFrame:
    """Add why a document is not usable: malformed, no object, or secret-like keys; else NULL.

    Made inside a generator, so that what tests or shows the error reads a column
    and the document is parsed and searched once.
    """
    kind = F.coalesce(F.schema_of_variant(F.try_parse_json("text")), F.lit(""))
    root = F.when(F.json_object_keys("text").isNotNull(), "OBJECT").otherwise(kind)  # the cheap test first
    x = docs.select("*", F.inline(F.array(F.struct(
        root.alias("_root"), secret_keys(F.col("text")).alias("_hits")
    ))))
    error = (
        F.when(F.col("_root") == "", "malformed JSON")
        .when(~F.col("_root").startswith("OBJECT"), "root is not an object")
        .when(F.size("_hits") > 0, F.concat(F.lit("secret-like keys: "), F.array_join("_hits", ",")))
    )
    return x.withColumn("error", error).drop("_root", "_hits")


def scan(docs: DataFrame, kind: str) -> DataFrame:
    """(path, kind, artifact_id, started_at, error, text): unusable documents stay, with their error."""
    prefix, ident = {"manifest": ("manifest_", "build_id"), "run_report": ("run_", "run_id")}[kind]
    stem = F.regexp_replace(F.regexp_extract("path", r"([^/]*?)(?:\.json)?$", 1), "^" + prefix, "")
    x = with_error(docs.where(F.col("path").rlike(rf"(^|/){prefix}[^/]*\.json$")))
    head = F.from_json("text", f"struct<{ident}:string,build_started_at:string,started_at:string>")
    x = x.withColumn("_h", F.when(F.col("error").isNull(), head))
    blank = lambda c: F.nullif(c, F.lit(""))
    started = blank(F.col("_h.started_at"))
    if kind == "manifest":
        started = F.coalesce(blank(F.col("_h.build_started_at")), started)
    return x.select(
        "path", F.lit(kind).alias("kind"), F.coalesce(F.col("_h")[ident], stem).alias("artifact_id"),
        started.alias("started_at"), "error", F.when(F.col("error").isNull(), F.col("text")).alias("text"),
    )


def newest_first(artifacts: DataFrame) -> DataFrame:
    return artifacts.orderBy(F.desc(F.coalesce("started_at", "artifact_id")), F.desc("artifact_id"))


# --------------------------------------------------------------- manifests
def classify(m: Column) -> dict[str, Column]:
    """Capability flags of a parsed manifest: schema 1.0 proves provenance only."""
    old = F.coalesce(m["schema_version"], F.lit("1.0")) == "1.0"
    some = F.coalesce(F.size(m["snapshots"]), F.lit(0)) > 0
    capture = ~old & F.coalesce(m["snapshot_capture"], F.lit(False)) & some
    exact = capture & F.coalesce(m["exact_rebuild_capable"], F.lit(False))
    return {"provenance_capable": F.lit(True), "snapshot_capture": capture, "exact_rebuild_capable": exact}


def _length(c: Column) -> Column:
    return F.when(c.isNull(), 0).otherwise(F.size(c))


def manifest_summaries(artifacts: DataFrame) -> DataFrame:
    """Identity, verdicts, capability and nested counts of each usable manifest."""
    x = artifacts.where("error IS NULL").withColumn("m", F.from_json("text", MANIFEST))
    m = F.col("m")
    raw = m["database_fingerprint"]
    nested = F.get_json_object("text", "$.database_fingerprint.database_fingerprint")
    flags = classify(m)
    return x.select(
        "path", m["build_id"].alias("build_id"), m["schema_version"].alias("schema_version"),
        m["validation_result"].alias("validation_result"), m["health_status"].alias("health_status"),
        *[c.alias(n) for n, c in flags.items()],
        _length(m["snapshots"]).alias("snapshot_count"),
        _length(m["table_fingerprints"]).alias("table_fingerprint_count"),
        F.when(raw.startswith("{"), nested).otherwise(raw).alias("database_fingerprint"),
    )


def run_summaries(artifacts: DataFrame) -> DataFrame:
    """Outcome fields of each usable run report; the failure reason falls back to the stage."""
    r = F.from_json("text", RUN_REPORT)
    x = artifacts.where("error IS NULL").select("path", r.alias("r"))
    blank = lambda c: F.nullif(c, F.lit(""))
    return x.select(
        "path", "r.run_id", "r.status", "r.run_as_of", "r.failure_stage",
        F.coalesce(blank(F.col("r.error")), blank(F.col("r.failure_stage")), F.col("r.error")).alias("failure_reason"),
        "r.validation_result", "r.health_status", "r.change_classification",
    )


def operational_runs(artifacts: DataFrame) -> DataFrame:
    """(latest_attempt, latest_success): ids of the newest usable run and the newest successful one."""
    x = artifacts.where("error IS NULL")
    order = F.struct(F.coalesce("started_at", "artifact_id"), "artifact_id")
    ok = F.get_json_object("text", "$.status").isin(SUCCESS_STATUSES)
    return x.agg(
        F.max_by("artifact_id", order).alias("latest_attempt"),
        F.max_by("artifact_id", F.when(ok, order)).alias("latest_success"),
    )


def rebuild_eligibility(artifacts: DataFrame, verified: DataFrame | None = None) -> DataFrame:
    """(build_id, reason): first unmet condition for an exact rebuild; NULL when eligible.

    ``verified``: (build_id, status) of each snapshot of each build, see ``snapshots.verify``; a build with one that is
    not ok can't be rebuilt.
    """
    s = manifest_summaries(artifacts)
    failed = F.lit(False)
    if verified is not None:
        bad = verified.where("status <> 'ok'").select("build_id", F.lit(True).alias("_bad")).distinct()
        s = s.join(bad, "build_id", "left")
        failed = F.coalesce("_bad", F.lit(False))
    reason = (
        F.when(F.coalesce("schema_version", F.lit("1.0")) != "1.1", "schema version")
        .when(~F.col("exact_rebuild_capable"), "not exact-rebuild capable")
        .when(F.col("database_fingerprint").isNull(), "no database fingerprint")
        .when(F.col("snapshot_count") == 0, "no snapshots")
        .when(failed, "snapshot verification failed")
    )
    return s.select("build_id", reason.alias("reason"))


def snapshot_entries(artifacts: DataFrame) -> DataFrame:
    """(entry, snapshot_id, meta): one row for each snapshot that a usable manifest names; the entry is its build_id."""
    x = artifacts.where("error IS NULL").select(F.inline(F.array(F.from_json("text", "struct<build_id:string,snapshots:array<string>>"))))
    x = x.select(F.col("build_id").alias("entry"), F.explode("snapshots").alias("meta"))
    return x.select("entry", F.get_json_object("meta", "$.snapshot_id").alias("snapshot_id"), "meta")


# ---------------------------------------------------------------- metadata
def listed_metadata(identity: Column) -> Column:
    """The identity as shown in listings: no key with 'authorization' or 'api' in it."""
    return F.map_filter(
        F.from_json(identity, "map<string,string>"), lambda k, v: ~F.lower(k).contains("authorization") & ~F.lower(k).contains("api")
    )


def identity_key(identity: Column) -> Column:
    """Canonical text of a flat identity: compact JSON with sorted keys."""
    m = F.from_json(identity, "map<string,string>")
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))
