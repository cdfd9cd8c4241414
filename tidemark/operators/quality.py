"""Checks as data: every rule yields (check_id, key, detail) rows of what violates it.

All violations are reported, not only the first.  Row rules are predicates
exploded from one scan of the table; set rules are aggregates and anti-joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import calendar, coverage, macro, market, regimes
from tidemark.operators.asof import map_to_session

OHLC = [c for c in schemas.OBSERVED_COLUMNS if c != "close"]


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _day(c: str = "date") -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _bar_key() -> Column:
    return F.concat_ws("/", F.col("symbol"), _day())


def rows_failing(df: DataFrame, key: Column, rules: dict[str, Column], detail: Column | None = None) -> DataFrame:
    """Rows times the rules they break; a NULL condition is no violation."""
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
    return df.select(F.explode(broken).alias("check_id"), key.alias("key"), (detail if detail is not None else F.lit("")).alias("detail"))


def found(df: DataFrame, check: str, key: Column, detail: Column | None = None) -> DataFrame:
    return df.select(F.lit(check).alias("check_id"), key.alias("key"), (detail if detail is not None else F.lit("")).alias("detail"))


def rules_broken(df: DataFrame, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """As ``rows_failing``, with a key for each rule: every rule between two tables reads one join of them."""
    broken = [F.when(bad, F.struct(F.lit(name).alias("check_id"), key.alias("key"))) for name, (bad, key) in rules.items()]
    return df.select(F.inline(F.array_compact(F.array(*broken)))).select("check_id", "key", F.lit("").alias("detail"))


def beside(child: DataFrame, parent: DataFrame) -> DataFrame:
    """Two panel tables row by row on (symbol, date), ``_child`` and ``_parent`` telling which side a row is on.

    A full join: rows of one side only stay, rows without a symbol or a date match nothing. Tables that are kept by
    symbol (``plans.store``) meet where they lie.
    """
    return child.withColumn("_child", F.lit(True)).join(parent.withColumn("_parent", F.lit(True)), ["symbol", "date"], "full")


def on_spine_flag(df: DataFrame, trading: DataFrame) -> DataFrame:
    """``_on_spine`` beside each row; NULL where the row's date is no trading day."""
    return df.join(trading.select("date").distinct().withColumn("_on_spine", F.lit(True)), "date", "left")


def _pair_key() -> Column:
    return F.concat_ws("/", F.col("date").cast("string"), "symbol")


def mismatch(df: DataFrame, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per pair of numbers that should be equal, from a one-row frame."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias("check_id"), a.cast("string").alias("a"), b.cast("string").alias("b")) for n, (a, b) in rules.items()]
    )
    return df.select(F.inline(pairs)).where("NOT a <=> b").select("check_id", F.lit("").alias("key"), F.concat_ws(" against ", "a", "b").alias("detail"))


def duplicate_keys(df: DataFrame, pk: list[str], check: str) -> DataFrame:
    d = coverage.duplicates(df, pk)
    return found(d, check, F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in pk]), F.col("n").cast("string"))


def orphans(child: DataFrame, parent: DataFrame, on: list[str], check: str) -> DataFrame:
    """Child rows with no parent row."""
    key = F.concat_ws("/", *[F.col(c).cast("string") for c in on])
    return found(child.select(*on).join(parent.select(*on), on, "left_anti"), check, key)


# ------------------------------------------------------------------- spine
def spine_checks(trading: DataFrame, known_open: DataFrame | None = None, known_closed: DataFrame | None = None) -> DataFrame:
    """Order, weekends, chain, ISO parts, numbering and period ends, by recomputation from the dates."""
    again = calendar.trading_days(trading.select("date"))
    x = trading.join(again.select("date", *[F.col(c).alias(f"_{c}") for c in again.columns if c != "date"]), "date")
    off = lambda c: ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    rules = {
        "spine_weekend": F.weekday("date") > 4,
        "spine_prev_chain": off("prev_trading_date"),
        "spine_next_chain": off("next_trading_date"),
        "spine_month_end": (F.col("days_to_month_end") == 0) != F.col("is_month_end"),
        "spine_iso_weekday": off("weekday"),
        "spine_iso_week": off("week_of_year"),
        "spine_month_numbering": off("trading_day_of_month"),
        "spine_year_numbering": off("trading_day_of_year"),
        "spine_quarter_end": off("is_quarter_end"),
        "spine_year_end": off("is_year_end"),
    }
    parts = [rows_failing(x, _day(), rules), duplicate_keys(trading, ["date"], "spine_duplicate")]
    parts.append(
        mismatch(
            trading.agg(
                F.count_if(F.col("prev_trading_date").isNull()).alias("p"),
                F.count_if(F.col("next_trading_date").isNull()).alias("n"), (F.count("*") > 0).alias("some"),
            ),
            {"spine_one_first": (F.col("p"), F.lit(1)), "spine_one_last": (F.col("n"), F.lit(1)), "spine_empty": (F.col("some"), F.lit(True))},
        )
    )
    lo, hi = trading.agg(F.min("date")).scalar(), trading.agg(F.max("date")).scalar()
    inside = lambda d: d.where((F.col("date") >= lo) & (F.col("date") <= hi)).select("date")
    if known_open is not None:
        parts.append(found(inside(known_open).join(trading, "date", "left_anti"), "spine_known_open", _day()))
    if known_closed is not None:
        parts.append(found(inside(known_closed).join(trading, "date", "left_semi"), "spine_known_closed", _day()))
    return union(parts)


# -------------------------------------------------------------------- bars
def bar_set_checks(bars: DataFrame, spine: DataFrame, universe: DataFrame) -> DataFrame:
    """Duplicates, symbols against the universe, rows off the spine or on weekends."""
    have, want = bars.select("symbol").distinct(), universe.select("symbol")
    return union(
        [
            duplicate_keys(bars, ["date", "symbol"], "bars_duplicate"),
            found(want.join(have, "symbol", "left_anti"), "bars_missing_symbol", F.col("symbol")),
            found(have.join(want, "symbol", "left_anti"), "bars_unexpected_symbol", F.col("symbol")),
            found(bars.select("date", "symbol").join(F.broadcast(spine.select("date")), "date", "left_anti"), "bars_off_spine", _bar_key()),
            found(bars.where(F.weekday("date") > 4), "bars_weekend", _bar_key()),
        ]
    )


def bar_row_rules(close_only: list[str]) -> dict[str, Column]:
    """Full-bar and close-only rules as conditions that hold when broken."""
    closed = market.is_close_only(close_only)
    c = F.col
    rules: dict[str, Column] = {}
    for f in schemas.OBSERVED_COLUMNS:
        bad = c(f).isNull()
        if not f.endswith("volume"):
            bad = bad | F.isnan(f) | (F.abs(f) == float("inf"))
        rules[f"full_{f}_missing"] = ~closed & bad
    for p in ("", "adj_"):
        high, low = c(p + "high"), c(p + "low")
        rules[f"full_{p}volume_negative"] = ~closed & (c(p + "volume") < 0)
        rules[f"full_{p}high_low"] = ~closed & (high < low)
        for f in ("open", "close"):
            rules[f"full_{p}high_{f}"] = ~closed & (high < c(p + f))
            rules[f"full_{p}low_{f}"] = ~closed & (low > c(p + f))
    rules["full_split_factor"] = ~closed & (c("split_factor") <= 0)
    rules["full_dividend"] = ~closed & (c("dividend_cash") < 0)
    rules["close_only_missing"] = closed & c("close").isNull()
    rules["close_only_extra"] = closed & reduce(lambda a, b: a | b, [c(f).isNotNull() for f in OHLC])
    return rules


def bar_row_checks(bars: DataFrame, close_only: list[str]) -> DataFrame:
    return rows_failing(bars, _bar_key(), bar_row_rules(close_only))


def derived_checks(daily: DataFrame, close_only: list[str]) -> DataFrame:
    """First rows and later rows of the derived columns."""
    closed = market.is_close_only(close_only)
    x = daily.withColumn("_rn", F.row_number().over(market.by_symbol()))
    first = F.col("_rn") == 1
    null = lambda c: F.col(c).isNull()
    rules = {
        "derived_first_return": first & ~null("return_1d"),
        "derived_first_gap": first & ~null("gap_pct"),
        "derived_later_return": ~first & null("return_1d"),
        "derived_later_gap": ~first & ~closed & null("gap_pct"),
        "derived_intraday": ~closed & (null("intraday_return") | null("range_pct")),
        "derived_close_only": closed & ~(null("gap_pct") & null("intraday_return") & null("range_pct")),
        "derived_drawdown_missing": null("drawdown_from_high"),
        "derived_drawdown_positive": F.col("drawdown_from_high") > 1e-12,
        "derived_drawdown_first": first & (F.abs("drawdown_from_high") > 1e-12),
    }
    return rows_failing(x, _bar_key(), rules)


def null_counts(df: DataFrame, expected: dict[str, int | tuple[int, Column]], check: str) -> DataFrame:
    """Symbols whose NULL count of a column is not min(expected, rows); one grouped pass for all columns."""
    g = df.groupBy("symbol").agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in expected])
    want = lambda e: F.least(F.lit(e), F.col("_n"))
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls"), want(e).alias("want")) for c, e in expected.items()])
    bad = g.select("symbol", F.inline(rows)).where("nulls <> want")
    return bad.select(
        F.lit(check).alias("check_id"), F.concat_ws("/", "symbol", "column").alias("key"),
        F.concat_ws(" against ", F.col("nulls").cast("string"), F.col("want").cast("string")).alias("detail"),
    )


def outcome_checks(outcomes: DataFrame, daily: DataFrame, close_only: list[str]) -> DataFrame:
    """Unfinished horizons, flags against returns, one outcome per bar, and the next bar's return."""
    closed = market.is_close_only(close_only)
    full = outcomes.where(~closed)
    extremes = [f"max_{w}_{n}d" for n in schemas.EXTREME_HORIZONS for w in ("up", "down")]
    rules = {
        f"outcomes_flag_{n}d": ~F.col(f"positive_{n}d").eqNullSafe(F.col(f"return_{n}d") > 0) for n in schemas.FLAG_HORIZONS
    }
    rules["outcomes_close_only_extremes"] = closed & reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in extremes])
    return union(
        [
            duplicate_keys(outcomes, ["date", "symbol"], "outcomes_duplicate"),
            null_counts(outcomes, {f"return_{n}d": n for n in schemas.RETURN_HORIZONS}, "outcomes_null_count"),
            null_counts(full, {f"max_{w}_{n}d": n for n in schemas.EXTREME_HORIZONS for w in ("up", "down")}, "outcomes_null_count"),
            rows_failing(outcomes, _bar_key(), rules),
            rules_broken(
                beside(outcomes.select("date", "symbol", "return_1d"), _next_returns(daily)),
                {
                    "outcomes_orphan": (F.col("_parent").isNull(), _pair_key()),
                    "outcomes_absent": (F.col("_child").isNull(), _pair_key()),
                    "outcomes_next_return": (_next_differs(), _bar_key()),
                },
            ),
        ]
    )


def _next_returns(daily: DataFrame) -> DataFrame:
    return daily.select("date", "symbol", F.lead("return_1d").over(market.by_symbol()).alias("_next"))


def _next_differs(tolerance: float = 1e-9) -> Column:
    return F.abs(F.col("return_1d") - F.col("_next")) > tolerance


def next_return_mismatch(outcomes: DataFrame, daily: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Forward one-day returns that are not the next bar's own return."""
    x = outcomes.select("date", "symbol", "return_1d").join(_next_returns(daily), ["date", "symbol"])
    return found(x.where(_next_differs(tolerance)), "outcomes_next_return", _bar_key())


def drawdown_mismatch(reg: DataFrame, daily: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Regime drawdowns that differ from the bar's, a NULL on one side included."""
    x = reg.select("date", "symbol", "drawdown_pct").join(daily.select("date", "symbol", "drawdown_from_high"), ["date", "symbol"])
    return found(x.where(_drawdowns_differ(tolerance)), "regimes_drawdown", _bar_key())


def _drawdowns_differ(tolerance: float) -> Column:
    a, b = F.col("drawdown_pct"), F.col("drawdown_from_high")
    return (a.isNull() != b.isNull()) | (F.abs(a - b) > tolerance)


# Fixed values.
VOCAB = {
    "trend_regime": ["uptrend", "downtrend", "neutral"],
    "momentum_regime": ["positive", "negative", "mixed"],
    "volatility_regime": ["low", "normal", "high"],
}


def regime_checks(reg: DataFrame, daily: DataFrame, universe: DataFrame) -> DataFrame:
    """Warm-up NULL counts, labels, drawdown mirror, asset types, one regime per bar."""
    warmup = {f"return_{n}d": n for n in schemas.TRAILING_HORIZONS}
    warmup |= {f"{c.format(n)}": n - 1 for n in schemas.SMA_WINDOWS for c in ("above_{}dma", "distance_{}dma_pct")}
    warmup["volatility_20d"] = schemas.VOL_WINDOW
    seen = F.count("volatility_20d").over(market.by_symbol())
    x = reg.withColumn("_seen", seen).join(
        universe.select("symbol", F.col("asset_type").alias("_type")), "symbol", "left"
    )
    early = F.col("_seen") < schemas.VOL_MIN_OBSERVATIONS
    short = F.col("distance_200dma_pct").isNull() | F.col("distance_50dma_pct").isNull()
    blank = F.col("return_20d").isNull() | F.col("return_60d").isNull()
    known = lambda c: F.coalesce(F.col(c).isin(VOCAB[c]), F.lit(False))
    rules = {
        "regimes_asset_type": ~F.col("asset_type").eqNullSafe(F.col("_type")),
        "regimes_volatility_early": early & F.col("volatility_regime").isNotNull(),
        "regimes_volatility_label": ~early & F.col("volatility_20d").isNotNull() & ~known("volatility_regime"),
        "regimes_trend_early": short & F.col("trend_regime").isNotNull(),
        "regimes_trend_label": ~short & ~known("trend_regime"),
        "regimes_momentum_early": blank & F.col("momentum_regime").isNotNull(),
        "regimes_momentum_label": ~blank & ~known("momentum_regime"),
    }
    return union(
        [
            duplicate_keys(reg, ["date", "symbol"], "regimes_duplicate"),
            null_counts(reg, warmup, "regimes_null_count"),
            rows_failing(x, _bar_key(), rules),
            rules_broken(
                beside(reg.select("date", "symbol", "drawdown_pct"), daily.select("date", "symbol", "drawdown_from_high")),
                {
                    "regimes_orphan": (F.col("_parent").isNull(), _pair_key()),
                    "regimes_absent": (F.col("_child").isNull(), _pair_key()),
                    "regimes_drawdown": (F.col("_child") & F.col("_parent") & _drawdowns_differ(1e-12), _bar_key()),
                },
            ),
        ]
    )


def volatility_leakage(reg: DataFrame, least: int = schemas.VOL_MIN_OBSERVATIONS) -> DataFrame:
    """Stored labels against recomputed expanding ones; and, on long series, labels that a
    whole-sample ranking would give must differ somewhere, or the check proves nothing."""
    again = regimes.volatility_regime(reg.select("symbol", "date", "volatility_20d")).withColumnRenamed("volatility_regime", "_again")
    full = regimes.full_sample_tercile(reg, "volatility_20d", "_full")
    n = F.count("volatility_20d").over(market.by_symbol())
    x = reg.select("symbol", "date", "volatility_20d", "volatility_regime", n.alias("_n"))
    x = x.join(again, ["symbol", "date"], "left").join(full, ["symbol", "date"], "left")
    wrong = found(x.where(~F.col("volatility_regime").eqNullSafe(F.col("_again"))), "leakage_label", _bar_key())
    ready = (F.col("_n") >= least) & F.col("_again").isNotNull()
    same = x.groupBy("symbol").agg(
        F.max("_n").alias("n"), F.count_if(ready & (F.col("_again") != F.col("_full"))).alias("differ")
    )
    weak = same.where((F.col("n") >= least + 50) & (F.col("differ") == 0))
    return union([wrong, found(weak, "leakage_inconclusive", F.col("symbol"))])


def volatility_formula(reg: DataFrame, daily: DataFrame) -> DataFrame:
    """Stored volatility against the sample-deviation formula; the population form must differ."""
    w = regimes.last_n(schemas.VOL_WINDOW)
    r = F.col("return_1d")
    whole = F.count(r).over(w) == schemas.VOL_WINDOW
    scale = F.sqrt(F.lit(float(schemas.SESSIONS_PER_YEAR)))
    again = daily.select(
        "symbol", "date", F.when(whole, F.stddev_samp(r).over(w) * scale).alias("_s"), F.when(whole, F.stddev_pop(r).over(w) * scale).alias("_p")
    )
    x = reg.select("symbol", "date", "volatility_20d").join(again, ["symbol", "date"]).where("_s IS NOT NULL AND volatility_20d IS NOT NULL")
    wrong = found(x.where(F.abs(F.col("_s") - F.col("volatility_20d")) > 1e-10), "volatility_formula", _bar_key())
    alike = x.groupBy("symbol").agg(F.max(F.abs(F.col("_s") - F.col("_p"))).alias("d")).where("d < 1e-15")
    return union([wrong, found(alike, "volatility_ddof", F.col("symbol"))])


# ------------------------------------------------------------------- macro
def macro_checks(m: DataFrame, trading: DataFrame, forbidden: tuple[str, ...] = ("pmi",)) -> DataFrame:
    ten, two, curve = F.col("treasury_10y_yield"), F.col("treasury_2y_yield"), F.col("yield_curve_10y_2y")
    rules = {
        "macro_spread": ten.isNotNull() & two.isNotNull() & (curve.isNull() | (F.abs(ten - two - curve) > 1e-9)),
        "macro_spread_leg": (ten.isNull() | two.isNull()) & curve.isNotNull(),
        "macro_inflation_label": ~F.col("inflation_regime").isin("low", "normal", "high"),
        "macro_rate_label": ~F.col("rate_regime").isin("easing", "stable", "tightening"),
    }
    counts = m.agg(F.count("*").alias("n"))
    parts = [
        rows_failing(m, _day(), rules), duplicate_keys(m, ["date"], "macro_duplicate"),
        orphans(m, trading, ["date"], "macro_orphan"), orphans(trading, m, ["date"], "macro_absent"),
        mismatch(counts.withColumn("_t", trading.agg(F.count("*")).scalar()), {"macro_count": (F.col("n"), F.col("_t"))}),
    ]
    parts += [found(counts, "macro_forbidden_column", F.lit(c)) for c in forbidden if c in m.columns]
    return union(parts)


def release_honesty(m: DataFrame, releases: DataFrame, cut: Column) -> DataFrame:
    """Labels before enough releases, carried days passing for releases, labels that later releases
    would change (recomputed on releases up to ``cut``), and rate labels without their look-back."""
    so_far = F.sum(F.when(F.col("_side") == 0, 1).otherwise(0)).over(Window.orderBy("date", "_side"))
    line = releases.select("date", F.lit(0).alias("_side"), F.lit(None).cast("string").alias("inflation_regime"))
    line = line.unionByName(m.select("date", F.lit(1).alias("_side"), "inflation_regime"))
    early = line.withColumn("_n", so_far).where(
        (F.col("_side") == 1) & F.col("inflation_regime").isNotNull() & (F.col("_n") < schemas.MIN_RELEASES)
    )
    n = m.agg(F.count("inflation_rate").alias("days")).withColumn("_r", releases.agg(F.count("*")).scalar())
    known = n.where((F.col("_r") > 0) & (F.col("_r") >= F.col("days")))
    again = macro.inflation_regime(m, releases.where(F.col("date") <= cut)).withColumnRenamed("inflation_regime", "_again")
    leak = m.select("date", "inflation_regime").join(again, "date", "left").where(F.col("date") <= cut)
    leak = leak.where(~F.col("inflation_regime").eqNullSafe(F.col("_again")))
    rated = m.where(F.col("fed_funds_rate").isNotNull()).withColumn("_i", F.row_number().over(Window.orderBy("date")))
    return union(
        [
            found(early, "honesty_early_label", _day()),
            found(known, "honesty_not_distinct", F.lit("")),
            found(leak, "honesty_future_release", _day()),
            found(rated.where((F.col("_i") <= schemas.RATE_LOOKBACK) & F.col("rate_regime").isNotNull()), "honesty_rate_lookback", _day()),
        ]
    )


# ------------------------------------------------------------------ events
# Fixed values.
SESSIONS = ["pre_open", "during_session", "after_close", "unknown"]


def event_checks(ev: DataFrame, forbidden: DataFrame | None = None, required: DataFrame | None = None) -> DataFrame:
    t, ref = F.col("event_type"), F.col("reference_period")
    monthly = t.isin("cpi", "employment_situation")
    rules = {
        "events_type": ~F.coalesce(t.isin(schemas.EVENT_TYPES), F.lit(False)),
        "events_session": ~F.coalesce(F.col("release_session").isin(SESSIONS), F.lit(False)),
        "events_symbol": F.col("symbol").isNotNull(),
        "events_source": F.coalesce(F.col("source"), F.lit("")) == "",
        "events_time_unknown": F.col("event_time_et").isNotNull() & (F.col("release_session") == "unknown"),
        "events_reference_month": monthly & ~F.coalesce(ref.rlike(r"^\d{4}-\d{2}$"), F.lit(False)),
        "events_election_kind": (t == "election") & ~F.coalesce(ref.isin("presidential", "midterm"), F.lit(False)),
        "events_election_timing": (t == "election") & ((F.col("release_session") != "unknown") | F.col("event_time_et").isNotNull()),
        "events_meeting_reference": (t == "fomc") & ref.isNotNull(),
    }
    parts = [
        rows_failing(ev, F.col("event_id"), rules), duplicate_keys(ev, ["event_id"], "events_duplicate_id"),
        duplicate_keys(ev, ["event_type", "event_date", "reference_period", "symbol"], "events_duplicate"),
    ]
    meetings = ev.where(t == "fomc").select(F.col("event_date").alias("date")).distinct()
    if forbidden is not None:
        parts.append(found(meetings.join(forbidden, "date", "left_semi"), "events_forbidden_day", _day()))
    if required is not None:
        last = meetings.agg(F.max("date")).scalar()
        due = required.where(required.agg(F.max("date")).scalar() <= last)
        parts.append(found(due.join(meetings, "date", "left_anti"), "events_required_day", _day()))
    return union(parts)


# ----------------------------------------------------------------- context
def flag_mismatch(ctx: DataFrame, ev: DataFrame) -> DataFrame:
    """Sessions whose event flag is not whether an event of that type falls on them."""
    on = ev.groupBy(F.col("event_date").alias("date")).agg(
        *[F.bool_or(F.col("event_type") == t).alias(f"_{t}") for t in schemas.EVENT_FLAGS]
    )
    x = ctx.join(on, "date", "left")
    rules = {
        f"context_{flag}": ~F.col(flag).eqNullSafe(F.coalesce(F.col(f"_{t}"), F.lit(False))) for t, (flag, _) in schemas.EVENT_FLAGS.items()
    }
    return rows_failing(x, _day(), rules)


def flag_count_mismatch(ctx: DataFrame, ev: DataFrame, trading: DataFrame) -> DataFrame:
    """True flags against distinct on-session event days, per family."""
    true = ctx.agg(*[F.count_if(F.col(f)).alias(t) for t, (f, _) in schemas.EVENT_FLAGS.items()])
    days = ev.join(F.broadcast(trading.select(F.col("date").alias("event_date"))), "event_date", "left_semi")
    days = days.agg(*[F.countDistinct(F.when(F.col("event_type") == t, F.col("event_date"))).alias(t) for t in schemas.EVENT_FLAGS])
    both = true
    for t in schemas.EVENT_FLAGS:
        both = both.withColumn(f"_{t}", days.select(t).scalar())
    return mismatch(both, {f"context_count_{t}": (F.col(t), F.col(f"_{t}")) for t in schemas.EVENT_FLAGS})


def context_checks(ctx: DataFrame, trading: DataFrame, ev: DataFrame, early_closes: DataFrame) -> DataFrame:
    flags = [c for c, t in schemas.TABLE_COLUMNS["calendar_context"] if t == "boolean"]
    near = F.col("is_day_before_holiday") | F.col("is_day_after_holiday")
    e = F.broadcast(early_closes.select("date").distinct().withColumn("_e", F.lit(True)))
    x = ctx.join(e, "date", "left")
    rules = {f"context_null_{c}": F.col(c).isNull() for c in flags}
    rules |= {
        "context_holiday_type": F.col("holiday_type").isNotNull() & ~F.col("holiday_type").isin("regular", "exceptional"),
        "context_holiday_name": F.col("holiday_name").isNull() == near,
        "context_week_range": ~F.col("trading_days_in_week").between(1, 5),
        "context_week_short": F.col("is_shortened_week") != (F.col("trading_days_in_week") < 5),
        "context_early_close": ~F.col("is_shortened_trading_day").eqNullSafe(F.coalesce("_e", F.lit(False))),
    }
    off = map_to_session(ev, trading, "event_date", "pre_open").where(
        F.col("session").isNotNull() & (F.col("session") != F.col("event_date"))
    )
    anchored = off.select("event_type", F.col("session").alias("date")).distinct().join(ctx, "date")
    since = F.coalesce(*[F.when(F.col("event_type") == t, F.col(s)) for t, (_, s) in schemas.EVENT_FLAGS.items()])
    parts = [
        rows_failing(x, _day(), rules), duplicate_keys(ctx, ["date"], "context_duplicate"),
        orphans(ctx, trading, ["date"], "context_orphan"), orphans(trading, ctx, ["date"], "context_absent"),
        flag_mismatch(ctx, ev), flag_count_mismatch(ctx, ev, trading),
        found(anchored.where(~since.eqNullSafe(F.lit(0))), "context_anchor", F.concat_ws("/", F.col("event_type"), _day())),
    ]
    forward = [c for c in ctx.columns if c.startswith("days_to_next_")]
    parts += [found(ctx.limit(1), "context_forward_column", F.lit(c)) for c in forward]
    return union(parts)


# -------------------------------------------------------------- whole gate
def database_checks(t: dict[str, DataFrame], universe: DataFrame, close_only: list[str]) -> DataFrame:
    """The whole-database gate: it passes when this is empty."""
    td, dmd, mo, ar = t["trading_days"], t["daily_market_data"], t["market_outcomes"], t["asset_regimes"]
    mc, cc, ev = t["macro_conditions"], t["calendar_context"], t["scheduled_events"]
    n = lambda name: t[name].agg(F.count("*")).scalar()
    one = td.sparkSession.range(1)
    close_shape = market.is_close_only(close_only)
    bars = on_spine_flag(dmd.withColumn("_rn", F.row_number().over(market.by_symbol())), td)
    bar_rules = {
        "gate_drawdown_missing": F.col("drawdown_from_high").isNull(),
        "gate_first_return": (F.col("_rn") == 1) & F.col("return_1d").isNotNull(),
        "gate_full_shape": ~close_shape & reduce(lambda a, b: a | b, [F.col(c).isNull() for c in OHLC]),
        "gate_close_only_shape": close_shape & (F.col("close").isNull() | reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in OHLC])),
    }
    day, off = F.coalesce(F.col("date").cast("string"), F.lit("")), F.col("_on_spine").isNull()
    by_outcome = on_spine_flag(beside(mo.select("date", "symbol", "return_1d"), _next_returns(dmd)), td)
    by_regime = on_spine_flag(beside(ar.select("date", "symbol", "drawdown_pct"), dmd.select("date", "symbol", "drawdown_from_high")), td)
    return union(
        [
            mismatch(
                one,
                {
                    "gate_macro_count": (n("macro_conditions"), n("trading_days")),
                    "gate_context_count": (n("calendar_context"), n("trading_days")),
                    "gate_outcome_count": (n("market_outcomes"), n("daily_market_data")),
                    "gate_regime_count": (n("asset_regimes"), n("daily_market_data")),
                    "gate_symbols": (
                        dmd.agg(F.countDistinct("symbol")).scalar(), universe.agg(F.countDistinct("symbol")).scalar()
                    ),
                },
            ),
            orphans(td, mc, ["date"], "gate_macro_absent"), orphans(td, cc, ["date"], "gate_context_absent"),
            flag_count_mismatch(cc, ev, td),
            rules_broken(bars, {name: (bad, _bar_key()) for name, bad in bar_rules.items()} | {"gate_bars_off_spine": (off, day)}),
            rules_broken(
                by_outcome,
                {
                    "gate_outcome_orphan": (F.col("_parent").isNull(), _pair_key()),
                    "gate_outcomes_off_spine": (F.col("_child") & off, day),
                    "outcomes_next_return": (_next_differs(), _bar_key()),
                },
            ),
            rules_broken(
                by_regime,
                {
                    "gate_regime_orphan": (F.col("_parent").isNull(), _pair_key()),
                    "gate_regimes_off_spine": (F.col("_child") & off, day),
                    "regimes_drawdown": (F.col("_child") & F.col("_parent") & _drawdowns_differ(1e-9), _bar_key()),
                },
            ),
        ]
    )
