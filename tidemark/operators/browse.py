"""Filtered, deterministically paged browsing of the canonical tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.asof import neighbour_rows

DEFAULT_PAGE_SIZE = 100
MAX_PAGE_SIZE = 500
EXPORT_ROWS = 10_000


class BrowseError(ValueError):
    """A request outside what a table allows."""


@dataclass(frozen=True)
class Spec:
    key: str
    date_column: str
    symbol_column: str | None
    default_sort: tuple[str, str]
    sortable: frozenset[str]
    boolean_filters: frozenset[str] = frozenset()
    event_type_filter: bool = False


def _spec(key: str, sortable: list[str], symbol: bool = False, **kw) -> Spec:
    date = schemas.DATE_COLUMN[key]
    return Spec(key, date, "symbol" if symbol else None, (date, "asc"), frozenset(sortable), **kw)


# What may be sorted and filtered.
REGISTRY = {
    s.key: s
    for s in (
        _spec("trading_days", ["date", "year", "month", "weekday"]),
        _spec("daily_market_data", ["date", "symbol", "close", "adj_close", "volume"], symbol=True),
        _spec("market_outcomes", ["date", "symbol", "return_1d", "return_5d", "return_20d"], symbol=True),
        _spec("asset_regimes", ["date", "symbol", "trend_regime", "momentum_regime", "volatility_regime"], symbol=True),
        _spec("macro_conditions", ["date", "inflation_rate", "unemployment_rate", "fed_funds_rate"]),
        _spec("scheduled_events", ["event_date", "event_id", "event_type", "symbol", "reference_period"], symbol=True, event_type_filter=True),
        _spec("calendar_context", ["date"], boolean_filters=frozenset([
            "is_day_before_holiday", "is_day_after_holiday", "is_shortened_trading_day", "is_fomc_day", "is_cpi_release_day",
            "is_employment_situation_day", "is_election_day", "is_turn_of_month", "is_quarter_transition", "is_year_transition",
        ])),
    )
}


@dataclass(frozen=True)
class Filters:
    date_from: str | None = None
    date_to: str | None = None
    symbol: str | None = None
    event_type: str | None = None
    flags: dict[str, bool] = field(default_factory=dict)


def spec_of(key: str) -> Spec:
    if key not in REGISTRY:
        raise BrowseError(f"unknown table {key!r}")
    return REGISTRY[key]


def filtered(df: DataFrame, spec: Spec, f: Filters) -> DataFrame:
    """Inclusive dates, symbol, event type where the table has them, and allow-listed IS true/false flags."""
    day = F.col(spec.date_column)
    if f.date_from is not None:
        df = df.where(day >= F.lit(f.date_from).cast("date"))
    if f.date_to is not None:
        df = df.where(day <= F.lit(f.date_to).cast("date"))
    if f.symbol and spec.symbol_column:
        df = df.where(F.col(spec.symbol_column) == f.symbol)
    if f.event_type and spec.event_type_filter:
        df = df.where(F.col("event_type") == f.event_type)
    if spec.boolean_filters:
        for name, value in f.flags.items():
            if name not in spec.boolean_filters:
                raise BrowseError(f"boolean filter not allowed: {name!r}")
            df = df.where(F.col(name).eqNullSafe(F.lit(value)))
    return df


def resolve_sort(spec: Spec, column: str | None, direction: str) -> tuple[str, str]:
    """The allowed sort; without a column the table's own column and direction apply, whatever was asked."""
    way = direction.lower()
    if way not in ("asc", "desc"):
        raise BrowseError(f"invalid sort direction {direction!r}")
    if column is None:
        return spec.default_sort
    if column not in spec.sortable:
        raise BrowseError(f"sort column not allowed: {column!r}")
    return column, way


def sort_columns(spec: Spec, column: str, way: str) -> list[tuple[str, bool]]:
    """(column, ascending): the sort column, its tie-break, then the rest of the primary key, so pages never overlap."""
    out = [(column, way == "asc")]
    ties: list[str] = []
    if spec.symbol_column:
        if column == spec.date_column:
            ties.append(spec.symbol_column)
        elif column != "symbol":
            ties.append(spec.date_column)
    for c in [*ties, *schemas.PRIMARY_KEYS[spec.key]]:
        if c not in [used for used, _ in out]:
            out.append((c, True))
    return out


def sort_keys(spec: Spec, column: str, way: str) -> list[Column]:
    """The order of ``sort_columns``: NULLs sort last ascending and first descending."""
    return [F.asc_nulls_last(c) if up else F.desc_nulls_first(c) for c, up in sort_columns(spec, column, way)]


def clamp_page_size(size: int) -> int:
    if size < 1:
        raise BrowseError("page_size must be >= 1")
    return min(size, MAX_PAGE_SIZE)


def page(
    df: DataFrame, key: str, filters: Filters | None = None, number: int = 1, size: int = DEFAULT_PAGE_SIZE,
    sort: str | None = None, direction: str = "asc",
) -> DataFrame:
    """One page, each row with the filtered set's ``total_count``.

    The order is a top-k over (page x size) rows, never a full sort; for deep pages see ``pages``.
    """
    spec = spec_of(key)
    size = clamp_page_size(size)
    column, way = resolve_sort(spec, sort, direction)
    hits = filtered(df, spec, filters or Filters())
    total = hits.agg(F.count("*")).scalar()
    rows = hits.orderBy(*sort_keys(spec, column, way)).offset((max(1, number) - 1) * size).limit(size)
    return rows.select("*", total.alias("total_count"))


def page_after(df: DataFrame, key: str, last: dict, size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """The page following a known last primary key in primary-key order: deep pages cost one filtered top-k."""
    pk = schemas.PRIMARY_KEYS[key]
    after = F.lit(False)
    for i in range(len(pk) - 1, -1, -1):
        after = (F.col(pk[i]) > F.lit(last[pk[i]])) | ((F.col(pk[i]) == F.lit(last[pk[i]])) & after)
    return df.where(after).orderBy(*pk).limit(clamp_page_size(size))


def export(
    df: DataFrame, key: str, filters: Filters | None = None, sort: str | None = None, direction: str = "asc",
    max_rows: int | None = EXPORT_ROWS,
) -> DataFrame:
    """The ordered export, each row with the filtered set's ``total_count``.

    The default cap is the feature's own; the total tells whether it cut. None exports all.
    """
    spec = spec_of(key)
    column, way = resolve_sort(spec, sort, direction)
    hits = filtered(df, spec, filters or Filters())
    rows = hits.orderBy(*sort_keys(spec, column, way))
    rows = rows if max_rows is None else rows.limit(max_rows)
    return rows.select("*", hits.agg(F.count("*")).scalar().alias("total_count"))


def rows_on(df: DataFrame, key: str, day: Column, symbol: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows of one day, by symbol (events by id); all of them, or the first ``limit`` with the day's ``total_count``."""
    spec = spec_of(key)
    hits = df.where(F.col(spec.date_column) == day)
    if symbol and spec.symbol_column:
        hits = hits.where(F.col(spec.symbol_column) == symbol)
    order = ["event_id"] if key == "scheduled_events" else ([spec.symbol_column] if spec.symbol_column else [])
    rows = hits.orderBy(*order) if order else hits
    if limit is None:
        return rows
    return rows.limit(limit).select("*", hits.agg(F.count("*")).scalar().alias("total_count"))


def top_k(df: DataFrame, column: str, k: int, ties: list[str]) -> DataFrame:
    """The k highest, unknown values last."""
    return df.orderBy(F.desc_nulls_last(column), *ties).limit(k)


def inspect_day(tables: dict[str, DataFrame], day: Column, universe: DataFrame, symbol: str | None = None) -> DataFrame:
    """One nested row about a calendar day; market parts only when it is a session.

    Every part is a filter on one date before anything is gathered, so a part
    holds one row a symbol at most, or one an event of the day.
    """
    spine = tables["trading_days"]
    one = spine.sparkSession.range(1).select(day.alias("calendar_date"))
    one = neighbour_rows(one, spine, "calendar_date")
    is_session = spine.where(F.col("date") == day).agg(F.count("*") > 0).scalar()

    def gathered(name: str, only_sessions: bool = True, sym: str | None = None) -> Column:
        rows = rows_on(tables[name], name, day, sym)
        order = [c for c in ("symbol", "event_id", "date") if c in rows.columns]
        cells = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rows.columns if c not in order])
        found = rows.agg(F.to_json(F.array_sort(F.collect_list(cells)))).scalar()
        return F.when(is_session, found).otherwise(F.lit("[]")) if only_sessions else found

    known = universe.where(F.col("symbol") == (symbol or "")).agg(F.count("*") > 0).scalar()
    unknown = F.when(F.lit(symbol is not None) & ~known, F.lit(f"unknown symbol {symbol}"))
    no_session = F.when(~is_session, "no session on this calendar date")
    return one.select(
        "calendar_date", is_session.alias("is_trading_day"), "prev_session", "next_session",
        F.to_json("previous").alias("prev_trading_day"), F.to_json("next").alias("next_trading_day"),
        gathered("trading_days").alias("trading_day"),
        gathered("calendar_context").alias("calendar_context"),
        gathered("scheduled_events", only_sessions=False).alias("scheduled_events"),
        gathered("macro_conditions").alias("macro_conditions"),
        gathered("daily_market_data", sym=symbol).alias("daily_market_data"),
        gathered("market_outcomes", sym=symbol).alias("market_outcomes"),
        gathered("asset_regimes", sym=symbol).alias("asset_regimes"),
        F.array_compact(F.array(
            unknown, no_session, F.when(F.col("prev_session").isNull(), "no session before this date"),
            F.when(F.col("next_session").isNull(), "no session after this date"),
        )).alias("messages"),
    )
