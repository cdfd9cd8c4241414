"""Content-addressed payloads: dedup, verification and replay lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.artifacts import SECRET_METADATA_KEY, identity_key, secret_keys

PREFIX = "sha256:"


def snapshot_id(content: Column) -> Column:
    return F.concat(F.lit(PREFIX), F.sha2(content, 256))


def deduplicated(landed: DataFrame) -> DataFrame:
    """(snapshot_id, meta, byte_size): one blob per content, with the metadata it first came with.

    Only digests and metadata are shuffled, never the payloads, and the first is
    chosen before the shuffle by a partial minimum, so copies of one hot payload are cheap.
    """
    x = landed.select(
        snapshot_id(F.col("content")).alias("snapshot_id"), F.length("content").alias("byte_size"),
        "retrieved_at", "meta",
    )
    return x.groupBy("snapshot_id").agg(
        F.min_by("meta", F.struct("retrieved_at", "meta")).alias("meta"), F.first("byte_size").alias("byte_size")
    )


def landing_counts(landed: DataFrame) -> DataFrame:
    """(retrieval_events, unique_payloads, total_bytes); bytes count each payload once."""
    x = landed.select(snapshot_id(F.col("content")).alias("id"), F.length("content").alias("n"))
    per = x.groupBy("id").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    return per.agg(
        F.sum("c").alias("retrieval_events"), F.count("*").alias("unique_payloads"), F.sum("n").cast("bigint").alias("total_bytes")
    )


def verify(entries: DataFrame, blobs: DataFrame) -> DataFrame:
    """(entry, snapshot_id, status): invalid_metadata, missing, corrupt or ok, tested in that order.

    ``entries``: (entry, snapshot_id, meta JSON); ``blobs``: (snapshot_id, content,
    sidecar JSON or NULL), one per id.  Digests are recomputed next to the
    payloads, so the join carries a flag, not the bytes.  A sidecar names its digest
    as ``sha256`` or else ``digest``; one without either agrees with nothing.
    """
    recomputed = F.sha2("content", 256)
    told = F.coalesce(F.get_json_object("sidecar", "$.sha256"), F.get_json_object("sidecar", "$.digest"))
    b = blobs.select(
        F.col("snapshot_id").alias("_id"),
        F.col("content").isNotNull().alias("_payload"),
        (F.concat(F.lit(PREFIX), recomputed) == F.col("snapshot_id")).alias("_sound"),
        F.col("sidecar").isNotNull().alias("_side"),
        (F.size(secret_keys(F.col("sidecar"), SECRET_METADATA_KEY)) > 0).alias("_leaks"),
        (F.concat(F.lit(PREFIX), told) == F.col("snapshot_id")).alias("_agrees"),
    )
    ident = F.col("snapshot_id")
    formed = F.coalesce(ident.startswith(PREFIX), F.lit(False))
    secret = F.coalesce(F.size(secret_keys(F.col("meta"), SECRET_METADATA_KEY)) > 0, F.lit(False))
    status = (
        F.when(~formed | secret, "invalid_metadata")
        .when(~F.coalesce("_side", F.lit(False)), "missing")
        .when(F.coalesce("_leaks", F.lit(False)), "invalid_metadata")
        .when(~F.coalesce("_payload", F.lit(False)), "missing")
        .when(~F.col("_sound"), "corrupt")
        .when(~F.coalesce("_agrees", F.lit(False)), "invalid_metadata")
        .otherwise("ok")
    )
    return entries.join(b, ident == F.col("_id"), "left").select("entry", "snapshot_id", status.alias("status"))


def verify_counts(verified: DataFrame) -> DataFrame:
    """(checked, unique_payloads, missing, corrupt, invalid_metadata)."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return verified.agg(
        F.count("*").alias("checked"), F.countDistinct("snapshot_id").alias("unique_payloads"),
        n("missing"), n("corrupt"), n("invalid_metadata"),
    )


def resolve(requests: DataFrame, registered: DataFrame) -> DataFrame:
    """(request, snapshot_id, error): the latest registered snapshot of each request identity.

    The newest registration per identity is found by a partial maximum first, so
    a hot identity reaches the join as one row.
    """
    latest = registered.select(identity_key(F.col("identity")).alias("_k"), "ordinal", "snapshot_id").groupBy("_k").agg(
        F.max_by("snapshot_id", "ordinal").alias("snapshot_id")
    )
    r = requests.select("request", identity_key(F.col("identity")).alias("_k"))
    return r.join(latest, "_k", "left").select(
        "request", "snapshot_id", F.when(F.col("snapshot_id").isNull(), "no snapshot for request identity").alias("error")
    )
