"""Landed price payloads: JSON bar arrays and close-only observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.scalar import finite_or_null, number_or_null
from tidemark.operators.asof import off_spine, on_spine

# Provider field -> canonical column.
FIELD_MAP = {
    "open": "open", "high": "high", "low": "low", "close": "close", "volume": "volume",
    "adjOpen": "adj_open", "adjHigh": "adj_high", "adjLow": "adj_low", "adjClose": "adj_close",
    "adjVolume": "adj_volume", "divCash": "dividend_cash", "splitFactor": "split_factor",
}
REQUIRED_FIELDS = ["date", *FIELD_MAP]
# numbers are taken as text first, so a bad one can be told from a missing one
BAR_ARRAY = "array<struct<date:string," + ",".join(f"{f}:string" for f in FIELD_MAP) + ">>"


def read_bar_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, payload): one landed JSON array per file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload"))


def document_error(payload: Column) -> Column:
    """Why a payload is refused: no array, empty, or a first row without a required field; else NULL."""
    held = F.coalesce(F.json_object_keys(F.get_json_object(payload, "$[0]")), F.array().cast("array<string>"))
    lacking = F.array_except(F.array(*[F.lit(f) for f in REQUIRED_FIELDS]), held)
    n = F.json_array_length(payload)  # NULL for anything but an array
    return (
        F.when(n.isNull(), "not an array")
        .when(n == 0, "empty")
        .when(F.size(lacking) > 0, F.concat(F.lit("missing fields: "), F.array_join(F.array_sort(lacking), ",")))
    )


def document_errors(docs: DataFrame, key: list[str]) -> DataFrame:
    """(key, error) of the refused payloads."""
    return docs.select(*key, document_error(F.col("payload")).alias("error")).where("error IS NOT NULL")


def bar_rows(docs: DataFrame, key: list[str]) -> DataFrame:
    """One row per bar of the sound payloads, provider names, values still text; other fields ignored.

    Refused payloads are filtered where they are read, so no payload is shuffled.
    """
    good = docs.where(document_error(F.col("payload")).isNull())
    return good.select(*key, F.inline(F.from_json("payload", BAR_ARRAY)))


def _canonical(rows: DataFrame) -> DataFrame:
    cols = []
    for source, name in FIELD_MAP.items():
        v = finite_or_null(F.col(source).try_cast("double"))
        cols.append((v.cast("bigint") if name.endswith("volume") else v).alias(name))
    return rows.select(
        F.to_date(F.split("date", "T")[0]).alias("date"), F.upper("symbol").alias("symbol"), *cols
    )


def normalize_bars(rows: DataFrame, spine: DataFrame) -> DataFrame:
    """Canonical bars on the spine.  Rows with a missing or bad number are left to ``bar_number_errors``."""
    bars = on_spine(_canonical(rows), spine)
    sound = " AND ".join(f"{c} IS NOT NULL" for c in schemas.OBSERVED_COLUMNS)
    return bars.where(sound)


def bar_rejects(rows: DataFrame, spine: DataFrame) -> DataFrame:
    """(date, symbol) of bars on no session, told before their numbers are looked at."""
    return off_spine(_canonical(rows), spine).select("date", "symbol")


def bar_number_errors(rows: DataFrame, spine: DataFrame) -> DataFrame:
    """(date, symbol, field) of every missing, unreadable or non-finite number on a session."""
    bars = on_spine(_canonical(rows), spine)
    bad = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in schemas.OBSERVED_COLUMNS]), lambda c: c.isNotNull()
    )
    return bars.select("date", "symbol", F.explode(bad).alias("field"))


def close_only_levels(observations: DataFrame) -> DataFrame:
    """Readable levels of (date text, value text): gaps, bad text and non-finite numbers skipped, negatives kept."""
    return observations.select(
        F.to_date(F.substring("date", 1, 10)).alias("date"), number_or_null(F.col("value")).alias("close")
    ).where("close IS NOT NULL")


def normalize_close_only(symbol: str, observations: DataFrame, spine: DataFrame) -> DataFrame:
    """Canonical close-only rows on the spine; every other observed column is NULL."""
    levels = on_spine(close_only_levels(observations), spine)
    cols = [
        F.col("close") if c == "close" else F.lit(None).cast("bigint" if c.endswith("volume") else "double").alias(c)
        for c in schemas.OBSERVED_COLUMNS
    ]
    return levels.select("date", F.lit(symbol.upper()).alias("symbol"), *cols)


def close_only_rejects(observations: DataFrame, spine: DataFrame) -> DataFrame:
    return off_spine(close_only_levels(observations), spine).select("date")
