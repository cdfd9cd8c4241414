"""Deterministic table digests and their comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import canonical_line

VERSION = "1.0"
LANES = (1, 17, 33, 49)  # starts of the four 16-digit words of a row's hash


def table_digest(df: DataFrame, table: str) -> DataFrame:
    """(table, row_count, sha256): a digest of the rows of a table of any size, each as often as it occurs.

    The SHA-256 of a row's canonical text is read as four 64-bit numbers, and each is summed exactly over all rows, so
    partial sums are made where the rows are, no row is moved and no order matters. A changed, lost, added or doubled
    row changes the sums; the row count is part of the digest.
    """
    words = [F.conv(F.substring("d", a, 16), 16, 10).cast("decimal(20,0)") for a in LANES]
    folded = df.select(F.sha2(canonical_line(df), 256).alias("d")).agg(
        F.count("*").alias("row_count"), *[F.sum(w.cast("decimal(38,0)")).alias(f"l{a}") for w, a in zip(words, LANES)]
    )
    sums = [F.coalesce(F.col(f"l{a}"), F.lit(0)).cast("string") for a in LANES]
    text = F.concat_ws(":", F.col("row_count").cast("string"), *sums)
    return folded.select(F.lit(table).alias("table"), "row_count", F.concat(F.lit("sha256:"), F.sha2(text, 256)).alias("sha256"))


def database_digest(fingerprints: DataFrame, order: list[str]) -> DataFrame:
    """(database_fingerprint): SHA-256 over one line per table, in table order."""
    line = F.concat_ws(":", "table", "sha256", F.col("row_count").cast("string"), F.lit(VERSION))
    at = F.array_position(F.array(*[F.lit(t) for t in order]), F.col("table"))
    lines = F.array_sort(F.collect_list(F.struct(at.alias("at"), F.concat(line, F.lit("\n")).alias("line"))))
    text = F.array_join(F.transform(lines, lambda s: s["line"]), "")
    return fingerprints.agg(F.concat(F.lit("sha256:"), F.sha2(text, 256)).alias("database_fingerprint"))


def compare(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(table, expected, actual, match) for every table now present."""
    e = expected.select("table", F.col("sha256").alias("expected"))
    a = actual.select("table", F.col("sha256").alias("actual"))
    return a.join(e, "table", "left").select(
        "table", "expected", "actual", F.col("expected").eqNullSafe(F.col("actual")).alias("match")
    )


def change(before: DataFrame, after: DataFrame) -> DataFrame:
    """(change): whether a run changed the database."""
    b, a = before.agg(F.first("database_fingerprint")).scalar(), after.agg(F.first("database_fingerprint")).scalar()
    return before.sparkSession.range(1).select(F.when(b == a, "NO_CHANGE").otherwise("UPDATED").alias("change"))
