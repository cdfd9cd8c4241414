"""Paged observation payloads: pages joined by a boundary line, each headed by its offset.

A payload held in a column is one row and so one task. A landed file is read by pages instead: the boundary is the
reader's record separator, so a file is split by bytes as any text is, and no task holds more than a page at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BOUNDARY = "---PAGE_BOUNDARY---\n"  # pass another marker for payloads landed with one
BODY = "struct<observations:array<struct<date:string,value:string,realtime_start:string,realtime_end:string>>>"


def concat_pages(pages: DataFrame, key: str, boundary: str = BOUNDARY) -> DataFrame:
    """(key, offset, body) to one payload per key, pages by ascending offset.

    A payload is one landed file, so a group is as large as one file may be.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col("offset").cast("bigint").alias("offset"), "body")))
    text = F.transform(ordered, lambda p: F.concat(F.lit(boundary + "offset="), p["offset"].cast("string"), F.lit("\n"), p["body"]))
    return pages.groupBy(key).agg(F.array_join(text, "").alias("payload"))


def _offset(chunk: Column, name: Column) -> Column:
    """The offset a page is headed by; a page without one is an error."""
    head = F.regexp_extract(chunk, r"^offset=(\d+)(?:\n|$)", 1)
    bad = F.raise_error(F.concat(F.lit("bad page header in "), name.cast("string")))
    return F.when(head != "", head.cast("bigint")).otherwise(bad.cast("bigint"))


def _body(chunk: Column) -> Column:
    return F.regexp_replace(chunk, r"^[^\n]*\n?", "")


def split_pages(payloads: DataFrame, key: str, boundary: str = BOUNDARY) -> DataFrame:
    """(key, page, offset, body) in stored order; a page without an offset header is an error."""
    marker = "".join("\\" + ch if not ch.isalnum() and ch != "\n" else ch for ch in boundary)
    chunks = F.filter(
        F.transform(F.split("payload", marker), lambda c: F.regexp_replace(c, r"^\n+", "")), lambda c: c != ""
    )
    x = payloads.select(key, F.posexplode(chunks).alias("page", "chunk"))
    return x.select(key, "page", _offset(F.col("chunk"), F.col(key)).alias("offset"), _body(F.col("chunk")).alias("body"))


def write_pages(pages: DataFrame, key: str, path: str, boundary: str = BOUNDARY) -> None:
    """(key, offset, body) as one payload file per key in a folder ``key=...``, pages by ascending offset.

    Pages are sorted, not gathered: a payload may be larger than memory. A page without a body, or without an offset, is
    refused, since it could not be read back.
    """
    refused = F.raise_error(F.concat(F.lit("no offset or body in a page of "), F.coalesce(F.col(key).cast("string"), F.lit("NULL"))))
    text = F.concat(F.lit(boundary + "offset="), F.col("offset").cast("bigint").cast("string"), F.lit("\n"), "body")
    ordered = pages.repartition(key).sortWithinPartitions(key, F.col("offset").cast("bigint"))
    ordered.select(key, F.coalesce(text, refused.cast("string")).alias("text")).write.partitionBy(key).text(path)


def read_pages(spark: SparkSession, path: str, key: str, boundary: str = BOUNDARY) -> DataFrame:
    """(key, ordinal, offset, body) of the payload files in the folders ``key=...`` below a path, without a shuffle.

    ``ordinal`` (block, place) ascends in stored order within a file: the byte at which the part of the file that a page
    was read from starts, and the page's place among those the task read. Empty pages are left out; a page without an
    offset header is an error.
    """
    files = spark.read.schema(f"value string, `{key}` string").option("lineSep", boundary).text(path)
    ordinal = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    x = files.select(F.col(key), ordinal.alias("ordinal"), F.regexp_replace("value", r"^\n+", "").alias("chunk")).where("chunk <> ''")
    return x.select(key, "ordinal", _offset(F.col("chunk"), F.col(key)).alias("offset"), _body(F.col("chunk")).alias("body"))


def observations(payloads: DataFrame, key: str, boundary: str = BOUNDARY) -> DataFrame:
    """(key, ordinal, date, value, realtime_start, realtime_end) as text, ordinal in stored order."""
    return _rows(split_pages(payloads, key, boundary), key, ["page"])


def read_observations(spark: SparkSession, path: str, key: str, boundary: str = BOUNDARY) -> DataFrame:
    """As ``observations``, of payload files; ordinal ascends in stored order within a file."""
    return _rows(read_pages(spark, path, key, boundary).select(key, "ordinal.*", "offset", "body"), key, ["block", "place"])


def _rows(pages: DataFrame, key: str, order: list[str]) -> DataFrame:
    rows = pages.select(key, *order, F.posexplode(F.from_json("body", BODY)["observations"]).alias("pos", "o"))
    return rows.select(key, F.struct(*order, "pos").alias("ordinal"), "o.*")
