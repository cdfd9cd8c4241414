"""Pruned scans of the canonical tables and the catalog of what they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.browse import REGISTRY

SCANS = {
    "derive": ["date", "symbol", *schemas.OBSERVED_COLUMNS],
    "outcomes": ["date", "symbol", "close", "adj_close", "adj_high", "adj_low"],
    "regimes": ["date", "symbol", "close", "adj_close", "return_1d", "drawdown_from_high"],
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A canonical table with its declared schema (nothing is inferred)."""
    return spark.read.schema(schemas.ddl(name)).parquet(f"{root}/{name}")


def market_scan(daily: DataFrame, purpose: str, symbols: list[str]) -> DataFrame:
    """The columns one derivation needs, for some symbols; both reach the parquet reader."""
    return daily.select(*SCANS[purpose]).where(F.col("symbol").isin(symbols))


def full_spine(trading: DataFrame) -> DataFrame:
    """The spine; an empty one is an error."""
    n = trading.select(F.lit(1)).limit(1).count()
    if n == 0:
        raise ValueError("trading_days is empty")
    return trading


def instruments(universe: DataFrame) -> DataFrame:
    return universe.select("symbol", "asset_type", "close_only")


def domains(spark: SparkSession) -> DataFrame:
    rows = [(s.key, s.date_column, s.symbol_column, schemas.TABLE_GRAINS[s.key]) for s in REGISTRY.values()]
    return spark.createDataFrame(rows, "domain string, date_column string, symbol_column string, grain string")


def fields(df: DataFrame, domain: str) -> DataFrame:
    """(domain, field, type, sortable, boolean_filter) of a table; an unknown domain is an error."""
    if domain not in REGISTRY:
        raise ValueError(f"unknown domain {domain!r}")
    spec = REGISTRY[domain]
    rows = [
        (domain, f.name, f.dataType.simpleString(), f.name in spec.sortable, f.name in spec.boolean_filters)
        for f in df.schema.fields
    ]
    return df.sparkSession.createDataFrame(
        rows, "domain string, field string, type string, sortable boolean, boolean_filter boolean"
    )
