"""The registered queries and the equivalent DuckDB statements they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.reference_sql import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DIGITS = 9


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to nine places (and no negative zero), as the statements do."""
    return df.select(
        *[
            (F.round(f.name, DIGITS) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str, statement: str | None = None, doubles: str = ""):
    """Register a query, with the statement it must equal; ``doubles`` are its floating columns."""

    def add(fn):
        QUERIES[name] = lambda spark, sf: _rounded(fn(spark, sf.rstrip("/")))
        if statement is not None:
            body = statement
            if doubles:
                rounded = ", ".join(f"round({c}, {DIGITS}) + 0.0 AS {c}" for c in doubles.split())
                body = f"SELECT * REPLACE ({rounded}) FROM ({statement}) AS q"
            ORACLES[name] = sql(body)
        return fn

    return add


def load() -> None:
    from tidemark.plans import suite_alignment, suite_browse, suite_market, suite_quality, suite_series, suite_sources, suite_suppliers, suite_writes  # noqa: F401
