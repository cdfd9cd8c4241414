"""Declared schemas, closed vocabularies and parameters of the canonical tables."""

from __future__ import annotations

_D, _S, _B, _I, _L, _F = "date", "string", "boolean", "int", "bigint", "double"

OBSERVED_COLUMNS = [
    "open", "high", "low", "close", "volume",
    "adj_open", "adj_high", "adj_low", "adj_close", "adj_volume",
    "dividend_cash", "split_factor",
]
DERIVED_COLUMNS = ["return_1d", "gap_pct", "intraday_return", "range_pct", "drawdown_from_high"]

RETURN_HORIZONS = (1, 3, 5, 10, 20)
EXTREME_HORIZONS = (5, 20)
FLAG_HORIZONS = (1, 5, 20)
TRAILING_HORIZONS = (5, 20, 60)
SMA_WINDOWS = (20, 50, 200)
VOL_WINDOW = 20
SESSIONS_PER_YEAR = 252
VOL_MIN_OBSERVATIONS = 252
MIN_RELEASES = 36
RATE_LOOKBACK = 63
RATE_THRESHOLD = 0.25

EVENT_TYPES = ["cpi", "election", "employment_situation", "fomc"]
EVENT_FLAGS = {
    "fomc": ("is_fomc_day", "days_since_last_fomc"),
    "cpi": ("is_cpi_release_day", "days_since_last_cpi"),
    "employment_situation": (
        "is_employment_situation_day",
        "days_since_last_employment_situation",
    ),
    "election": ("is_election_day", "days_since_last_election"),
}

MACRO_FIELDS = [
    "inflation_rate", "core_inflation_rate", "unemployment_rate", "jobless_claims",
    "fed_funds_rate", "treasury_2y_yield", "treasury_10y_yield", "fed_balance_sheet",
    "credit_spread",
]

TABLE_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "trading_days": [
        ("date", _D), ("weekday", _I), ("month", _I), ("quarter", _I), ("year", _I),
        ("day_of_month", _I), ("week_of_year", _I), ("trading_day_of_month", _I),
        ("trading_day_of_year", _I), ("days_to_month_end", _I), ("is_month_end", _B),
        ("is_quarter_end", _B), ("is_year_end", _B), ("prev_trading_date", _D),
        ("next_trading_date", _D),
    ],
    "daily_market_data": [("date", _D), ("symbol", _S)]
    + [(c, _L if c.endswith("volume") else _F) for c in OBSERVED_COLUMNS]
    + [(c, _F) for c in DERIVED_COLUMNS],
    "market_outcomes": [("date", _D), ("symbol", _S)]
    + [(f"return_{n}d", _F) for n in RETURN_HORIZONS]
    + [(f"max_up_{n}d", _F) for n in EXTREME_HORIZONS]
    + [(f"max_down_{n}d", _F) for n in EXTREME_HORIZONS]
    + [(f"positive_{n}d", _B) for n in FLAG_HORIZONS],
    "asset_regimes": [("date", _D), ("symbol", _S), ("asset_type", _S)]
    + [(f"return_{n}d", _F) for n in TRAILING_HORIZONS]
    + [(f"above_{n}dma", _B) for n in SMA_WINDOWS]
    + [(f"distance_{n}dma_pct", _F) for n in SMA_WINDOWS]
    + [("volatility_20d", _F), ("drawdown_pct", _F), ("trend_regime", _S),
       ("momentum_regime", _S), ("volatility_regime", _S)],
    "macro_conditions": [("date", _D)]
    + [(c, _F) for c in MACRO_FIELDS[:7]]
    + [("yield_curve_10y_2y", _F), ("fed_balance_sheet", _F), ("credit_spread", _F),
       ("inflation_regime", _S), ("rate_regime", _S)],
    "scheduled_events": [
        ("event_id", _S), ("event_type", _S), ("event_date", _D), ("symbol", _S),
        ("reference_period", _S), ("release_session", _S), ("event_time_et", _S),
        ("source", _S),
    ],
    "calendar_context": [
        ("date", _D), ("is_day_before_holiday", _B), ("is_day_after_holiday", _B),
        ("holiday_name", _S), ("holiday_type", _S), ("is_shortened_trading_day", _B),
        ("is_shortened_week", _B), ("trading_days_in_week", _I), ("is_turn_of_month", _B),
        ("is_quarter_transition", _B), ("is_year_transition", _B),
    ]
    + [(c, t) for et in ("fomc", "cpi", "employment_situation", "election")
       for c, t in zip(EVENT_FLAGS[et], (_B, _I))],
}

PRIMARY_KEYS = {
    "trading_days": ["date"],
    "daily_market_data": ["date", "symbol"],
    "market_outcomes": ["date", "symbol"],
    "asset_regimes": ["date", "symbol"],
    "macro_conditions": ["date"],
    "scheduled_events": ["event_id"],
    "calendar_context": ["date"],
}

TABLE_GRAINS = {
    "trading_days": "trading day",
    "daily_market_data": "date × symbol",
    "market_outcomes": "date × symbol",
    "asset_regimes": "date × symbol",
    "macro_conditions": "trading day",
    "scheduled_events": "event",
    "calendar_context": "trading day",
}

DATE_COLUMN = {t: ("event_date" if t == "scheduled_events" else "date") for t in TABLE_COLUMNS}


def ddl(table: str) -> str:
    """DDL schema string of a canonical table."""
    return ", ".join(f"`{c}` {t}" for c, t in TABLE_COLUMNS[table])


def columns(table: str) -> list[str]:
    return [c for c, _ in TABLE_COLUMNS[table]]


def conform(df, table: str):
    """Project a frame onto a canonical table's columns and types."""
    from pyspark.sql import functions as F

    return df.select(*[F.col(c).cast(t).alias(c) for c, t in TABLE_COLUMNS[table]])
