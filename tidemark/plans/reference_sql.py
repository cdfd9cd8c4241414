"""DuckDB text of the input recipes and canonical tables.

Each entry is one common table expression over the raw tables.  ``sql(body)``
prefixes the ones a query body names, so every oracle is a single statement that
starts from the raw parquet views.  None of this is used to compute a Spark
result.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}

# ---------------------------------------------------------------- inputs
CTES["bounds"] = """
SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders"""

CTES["years"] = """
SELECT CAST(unnest(generate_series(year(lo), year(hi))) AS INTEGER) AS y FROM bounds"""

CTES["closures"] = """
SELECT make_date(y, 1, 1) AS date, 'New Year' AS name, 'regular' AS type FROM years
UNION ALL SELECT make_date(y, 7, 4), 'Independence', 'regular' FROM years
UNION ALL SELECT make_date(y, 12, 25), 'Christmas', 'regular' FROM years
UNION ALL SELECT CAST(make_date(y, 11, 22) + CAST((11 - isodow(make_date(y, 11, 22))) % 7 AS INTEGER) AS DATE),
  'Thanksgiving', 'regular' FROM years
UNION ALL SELECT DATE '1998-09-15', 'Exceptional Closure', 'exceptional'"""

CTES["days"] = """
SELECT CAST(d AS DATE) AS date FROM (
  SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM bounds)"""

CTES["spine"] = """
SELECT date FROM days
WHERE isodow(date) <= 5 AND date NOT IN (SELECT date FROM closures)"""

CTES["early_closes"] = """
SELECT date FROM spine WHERE (month(date) = 12 AND day(date) = 24) OR (month(date) = 7 AND day(date) = 3)
  OR date - 1 IN (SELECT date FROM closures WHERE name = 'Thanksgiving')"""

CTES["raw_bars"] = """
SELECT CAST(o_orderdate AS DATE) AS date, c_mktsegment AS symbol,
  arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
  arg_max(o_totalprice, o_orderkey) AS close, count(*) AS volume
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""

CTES["all_bars"] = """
SELECT date, symbol,
  CASE WHEN symbol <> 'HOUSEHOLD' THEN open END AS open,
  CASE WHEN symbol <> 'HOUSEHOLD' THEN high END AS high,
  CASE WHEN symbol <> 'HOUSEHOLD' THEN low END AS low,
  close,
  CASE WHEN symbol <> 'HOUSEHOLD' THEN volume END AS volume,
  CASE WHEN symbol <> 'HOUSEHOLD' THEN open * k END AS adj_open,
  CASE WHEN symbol <> 'HOUSEHOLD' THEN high * k END AS adj_high,
  CASE WHEN symbol <> 'HOUSEHOLD' THEN low * k END AS adj_low,
  CASE WHEN symbol <> 'HOUSEHOLD' THEN close * k END AS adj_close,
  CASE WHEN symbol <> 'HOUSEHOLD' THEN volume END AS adj_volume,
  CASE WHEN symbol <> 'HOUSEHOLD' THEN 0.0::DOUBLE END AS dividend_cash,
  CASE WHEN symbol <> 'HOUSEHOLD' THEN
    CASE WHEN symbol = 'BUILDING' AND date = (SELECT min(date) FROM raw_bars
      WHERE symbol = 'BUILDING' AND date >= DATE '1998-06-01') THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END
  END AS split_factor
FROM (SELECT *, CASE WHEN symbol = 'BUILDING' AND date < DATE '1998-06-01' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS k
      FROM raw_bars)"""

CTES["bars"] = """
SELECT * FROM all_bars WHERE date IN (SELECT date FROM spine)"""

CTES["monthly"] = """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS ref_date, k,
  sum(CAST(round(l_extendedprice * 100) AS BIGINT)) FILTER (l_linenumber <= 2 * k + 1) AS price_odd,
  count(*) FILTER (l_linenumber <= 2 * k + 1) AS n_odd,
  sum(CAST(round(l_extendedprice * 100) AS BIGINT)) FILTER (l_linenumber <= 2 * k) AS price_even,
  count(*) FILTER (l_linenumber <= 2 * k) AS n_even,
  sum(CAST(round(l_quantity * 100) AS BIGINT)) FILTER (l_linenumber <= 2 * k + 1) AS qty_odd,
  sum(CAST(round(l_quantity * 100) AS BIGINT)) FILTER (l_linenumber <= 2 * k) AS qty_even
FROM lineitem, (SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS k) GROUP BY 1, 2"""

CTES["vintages"] = """
SELECT series, ref_date, k AS print,
  CAST((2 * s + n) // (2 * n) AS BIGINT) / 100.0::DOUBLE AS value,
  CAST(last_day(ref_date) + lag_days + 30 * (k - 1) AS DATE) AS realtime_start,
  CASE WHEN k = 3 THEN DATE '9999-12-31' ELSE CAST(last_day(ref_date) + lag_days + 30 * k AS DATE) END AS realtime_end,
  (year(ref_date) * 12 + month(ref_date)) * 4 + k AS ordinal
FROM (
  SELECT 'cpi' AS series, ref_date, k, price_odd AS s, n_odd AS n, CAST(10 AS INTEGER) AS lag_days FROM monthly
  UNION ALL SELECT 'core', ref_date, k, price_even, n_even, 10 FROM monthly
  UNION ALL SELECT 'unrate', ref_date, k, qty_odd, n_odd, 5 FROM monthly
  UNION ALL SELECT 'icsa', ref_date, k, qty_even, n_even, 5 FROM monthly)
WHERE n > 0"""

CTES["daily_rates"] = """
SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS n,
  sum(CAST(round(l_tax * 10000) AS BIGINT)) AS tax,
  sum(CAST(round(l_discount * 10000) AS BIGINT)) AS disc,
  sum(CAST(round(l_discount * 10000) AS BIGINT)) FILTER (l_linenumber <= 3) AS disc_low,
  count(*) FILTER (l_linenumber <= 3) AS n_low,
  sum(CAST(round((l_discount + l_tax) * 10000) AS BIGINT)) AS both_
FROM lineitem GROUP BY 1"""

CTES["observations"] = """
SELECT series, date,
  CASE WHEN day(date) = 13 THEN '.' ELSE CAST(CAST((2 * s + n) // (2 * n) AS BIGINT) / 100.0::DOUBLE AS VARCHAR) END AS value
FROM (
  SELECT 'dff' AS series, date, tax AS s, n FROM daily_rates
  UNION ALL SELECT 'dgs2', date, disc_low, n_low FROM daily_rates WHERE n_low > 0
  UNION ALL SELECT 'dgs10', date, disc, n FROM daily_rates
  UNION ALL SELECT 'baa10y', date, both_, n FROM daily_rates)"""

CTES["weekly"] = """
SELECT 'walcl' AS series, CAST(date_trunc('week', l_shipdate) + INTERVAL 2 DAY AS DATE) AS date,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS value
FROM lineitem GROUP BY 2"""

CTES["headings"] = """
SELECT d, n, CASE
    WHEN n % 5 = 4 THEN strftime(d, '%B') || '/' || strftime(d + INTERVAL 1 MONTH, '%B') || ' 30-1'
    WHEN n % 3 = 0 THEN strftime(d, '%B') || ' ' || CAST(day(d) AS VARCHAR)
    ELSE strftime(d, '%B') || ' ' || CAST(day(d) - 1 AS VARCHAR) || '-' || CAST(day(d) AS VARCHAR) END
  || CASE n % 8 WHEN 0 THEN ' (unscheduled) Meeting' WHEN 1 THEN ' Conference Call' WHEN 2 THEN ' (notation vote)'
       WHEN 3 THEN ' (cancelled) Meeting' ELSE ' Meeting' END
  || ' - ' || CAST(year(d) AS VARCHAR) AS title
FROM (SELECT max(CAST(o_orderdate AS DATE)) AS d, count(*) AS n FROM orders
      WHERE day(o_orderdate) BETWEEN 2 AND 28
      GROUP BY year(o_orderdate), month(o_orderdate))"""

# ---------------------------------------------------------------- tables
CTES["trading_days"] = """
SELECT date, CAST(isodow(date) AS INTEGER) AS weekday, CAST(month(date) AS INTEGER) AS month,
  CAST(quarter(date) AS INTEGER) AS quarter, CAST(year(date) AS INTEGER) AS year,
  CAST(day(date) AS INTEGER) AS day_of_month, CAST(week(date) AS INTEGER) AS week_of_year,
  CAST(row_number() OVER (PARTITION BY year(date), month(date) ORDER BY date) AS INTEGER) AS trading_day_of_month,
  CAST(row_number() OVER (PARTITION BY year(date) ORDER BY date) AS INTEGER) AS trading_day_of_year,
  CAST(row_number() OVER (PARTITION BY year(date), month(date) ORDER BY date DESC) - 1 AS INTEGER) AS days_to_month_end,
  row_number() OVER (PARTITION BY year(date), month(date) ORDER BY date DESC) = 1 AS is_month_end,
  row_number() OVER (PARTITION BY year(date), quarter(date) ORDER BY date DESC) = 1 AS is_quarter_end,
  row_number() OVER (PARTITION BY year(date) ORDER BY date DESC) = 1 AS is_year_end,
  lag(date) OVER (ORDER BY date) AS prev_trading_date,
  lead(date) OVER (ORDER BY date) AS next_trading_date
FROM spine"""

CTES["session_index"] = """
SELECT date, row_number() OVER (ORDER BY date) AS i FROM spine"""

CTES["daily_market_data"] = """
SELECT *,
  p / lag(p) OVER w - 1 AS return_1d,
  CASE WHEN symbol <> 'HOUSEHOLD' THEN adj_open / lag(adj_close) OVER w - 1 END AS gap_pct,
  close / open - 1 AS intraday_return,
  (high - low) / open AS range_pct,
  p / max(p) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS drawdown_from_high
FROM (SELECT *, CASE WHEN symbol = 'HOUSEHOLD' THEN close ELSE adj_close END AS p FROM bars)
WINDOW w AS (PARTITION BY symbol ORDER BY date)"""

CTES["market_outcomes"] = """
SELECT date, symbol,
  lead(p, 1) OVER w / p - 1 AS return_1d, lead(p, 3) OVER w / p - 1 AS return_3d,
  lead(p, 5) OVER w / p - 1 AS return_5d, lead(p, 10) OVER w / p - 1 AS return_10d,
  lead(p, 20) OVER w / p - 1 AS return_20d,
  CASE WHEN count(adj_high) OVER f5 = 5 AND count(adj_low) OVER f5 = 5 THEN max(adj_high) OVER f5 / adj_close - 1 END AS max_up_5d,
  CASE WHEN count(adj_high) OVER f20 = 20 AND count(adj_low) OVER f20 = 20 THEN max(adj_high) OVER f20 / adj_close - 1 END AS max_up_20d,
  CASE WHEN count(adj_high) OVER f5 = 5 AND count(adj_low) OVER f5 = 5 THEN min(adj_low) OVER f5 / adj_close - 1 END AS max_down_5d,
  CASE WHEN count(adj_high) OVER f20 = 20 AND count(adj_low) OVER f20 = 20 THEN min(adj_low) OVER f20 / adj_close - 1 END AS max_down_20d,
  lead(p, 1) OVER w / p - 1 > 0 AS positive_1d, lead(p, 5) OVER w / p - 1 > 0 AS positive_5d,
  lead(p, 20) OVER w / p - 1 > 0 AS positive_20d
FROM (SELECT *, CASE WHEN symbol = 'HOUSEHOLD' THEN close ELSE adj_close END AS p FROM bars)
WINDOW w AS (PARTITION BY symbol ORDER BY date),
  f5 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING),
  f20 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING)"""

CTES["trail_stats"] = """
SELECT date, symbol, CASE WHEN symbol = 'HOUSEHOLD' THEN 'commodity' ELSE 'etf' END AS asset_type, p,
  p / lag(p, 5) OVER w - 1 AS return_5d, p / lag(p, 20) OVER w - 1 AS return_20d, p / lag(p, 60) OVER w - 1 AS return_60d,
  CASE WHEN count(p) OVER w20 = 20 THEN avg(p) OVER w20 END AS sma_20,
  CASE WHEN count(p) OVER w50 = 50 THEN avg(p) OVER w50 END AS sma_50,
  CASE WHEN count(p) OVER w200 = 200 THEN avg(p) OVER w200 END AS sma_200,
  CASE WHEN count(return_1d) OVER w20 = 20 THEN stddev_samp(return_1d) OVER w20 * sqrt(252) END AS volatility_20d,
  drawdown_from_high AS drawdown_pct, return_1d AS r1
FROM daily_market_data
WINDOW w AS (PARTITION BY symbol ORDER BY date),
  w20 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
  w50 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
  w200 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)"""

CTES["vol_rank"] = """
SELECT a.date, a.symbol, count(*) AS n, count(*) FILTER (b.volatility_20d <= a.volatility_20d) AS k
FROM trail_stats a JOIN trail_stats b ON a.symbol = b.symbol AND b.date <= a.date
WHERE a.volatility_20d IS NOT NULL AND b.volatility_20d IS NOT NULL GROUP BY 1, 2"""

CTES["asset_regimes"] = """
SELECT t.date, t.symbol, asset_type, return_5d, return_20d, return_60d,
  p > sma_20 AS above_20dma, p > sma_50 AS above_50dma, p > sma_200 AS above_200dma,
  p / sma_20 - 1 AS distance_20dma_pct, p / sma_50 - 1 AS distance_50dma_pct, p / sma_200 - 1 AS distance_200dma_pct,
  volatility_20d, drawdown_pct,
  CASE WHEN sma_50 IS NULL OR sma_200 IS NULL THEN NULL WHEN p > sma_200 AND sma_50 > sma_200 THEN 'uptrend'
    WHEN p < sma_200 AND sma_50 < sma_200 THEN 'downtrend' ELSE 'neutral' END AS trend_regime,
  CASE WHEN return_20d IS NULL OR return_60d IS NULL THEN NULL WHEN return_20d > 0 AND return_60d > 0 THEN 'positive'
    WHEN return_20d < 0 AND return_60d < 0 THEN 'negative' ELSE 'mixed' END AS momentum_regime,
  CASE WHEN n < 252 THEN NULL WHEN 3 * k <= n THEN 'low' WHEN 3 * k <= 2 * n THEN 'normal' WHEN n IS NOT NULL THEN 'high' END
    AS volatility_regime
FROM trail_stats t LEFT JOIN vol_rank v ON v.date = t.date AND v.symbol = t.symbol"""

# -- macro: readings on each release day, mapped to sessions, carried forward
CTES["starts"] = """
SELECT DISTINCT series, realtime_start AS as_of FROM vintages"""

CTES["state"] = """
SELECT s.series, s.as_of, v.ref_date, arg_max(v.value, v.ordinal) AS value
FROM starts s JOIN vintages v ON v.series = s.series AND v.realtime_start <= s.as_of AND s.as_of < v.realtime_end
GROUP BY 1, 2, 3"""

CTES["state_yoy"] = """
SELECT c.series, c.as_of, c.ref_date, c.value, (c.value / nullif(b.value, 0) - 1) * 100 AS yoy
FROM state c LEFT JOIN state b ON b.series = c.series AND b.as_of = c.as_of
  AND b.ref_date = CAST(c.ref_date - INTERVAL 1 YEAR AS DATE) AND NOT (month(c.ref_date) = 2 AND day(c.ref_date) = 29)"""

CTES["readings"] = """
SELECT series, as_of, CASE WHEN series IN ('cpi', 'core') THEN arg_max(yoy_or_null, ref_date) ELSE arg_max(value, ref_date) END AS reading
FROM (SELECT s.*, s.yoy AS yoy_or_null, max(ref_date) OVER (PARTITION BY series, as_of) AS latest FROM state_yoy s)
WHERE ref_date = latest GROUP BY 1, 2"""

CTES["sparse_pit"] = """
SELECT series, session AS date, arg_max(reading, as_of) AS value FROM (
  SELECT series, as_of, reading, (SELECT min(date) FROM spine WHERE date >= as_of) AS session
  FROM readings WHERE reading IS NOT NULL)
WHERE session IS NOT NULL GROUP BY 1, 2"""

CTES["sparse_current"] = """
SELECT series, session AS date, arg_max(value, obs_date) AS value FROM (
  SELECT o.series, CAST(o.value AS DOUBLE) AS value, o.date AS obs_date, o.date AS session
  FROM observations o WHERE o.value <> '.' AND o.date IN (SELECT date FROM spine)
  UNION ALL
  SELECT series, CAST(value AS DOUBLE), date, (SELECT min(s.date) FROM spine s WHERE s.date > w.date + 1) FROM weekly w)
WHERE session IS NOT NULL GROUP BY 1, 2"""

CTES["sparse"] = """
SELECT * FROM sparse_pit UNION ALL SELECT * FROM sparse_current"""

CTES["filled"] = """
SELECT date, series, last_value(value IGNORE NULLS) OVER (PARTITION BY series ORDER BY date ROWS UNBOUNDED PRECEDING) AS value
FROM (SELECT s.date, k.series, p.value FROM spine s, (SELECT DISTINCT series FROM sparse
        WHERE series IN ('cpi', 'core', 'unrate', 'icsa', 'walcl')) k
      LEFT JOIN sparse p ON p.date = s.date AND p.series = k.series)"""

CTES["macro_levels"] = """
SELECT s.date,
  max(f.value) FILTER (f.series = 'cpi') AS inflation_rate,
  max(f.value) FILTER (f.series = 'core') AS core_inflation_rate,
  max(f.value) FILTER (f.series = 'unrate') AS unemployment_rate,
  max(f.value) FILTER (f.series = 'icsa') AS jobless_claims,
  max(c.dff) AS fed_funds_rate, max(c.dgs2) AS treasury_2y_yield, max(c.dgs10) AS treasury_10y_yield,
  max(f.value) FILTER (f.series = 'walcl') AS fed_balance_sheet, max(c.baa10y) AS credit_spread
FROM spine s LEFT JOIN filled f ON f.date = s.date
LEFT JOIN (SELECT date, max(value) FILTER (series = 'dff') AS dff, max(value) FILTER (series = 'dgs2') AS dgs2,
    max(value) FILTER (series = 'dgs10') AS dgs10, max(value) FILTER (series = 'baa10y') AS baa10y
  FROM sparse_current GROUP BY 1) c ON c.date = s.date
GROUP BY 1"""

CTES["first_prints"] = """
SELECT series, ref_date, value, realtime_start FROM vintages
QUALIFY row_number() OVER (PARTITION BY series, ref_date ORDER BY realtime_start, ordinal) = 1"""

CTES["releases"] = """
SELECT session AS date, arg_max(yoy, struct_pack(a := realtime_start, b := ref_date)) AS yoy FROM (
  SELECT f.realtime_start, f.ref_date, y.yoy, (SELECT min(date) FROM spine WHERE date >= f.realtime_start) AS session
  FROM first_prints f JOIN state_yoy y ON y.series = f.series AND y.as_of = f.realtime_start AND y.ref_date = f.ref_date
  WHERE f.series = 'cpi' AND y.yoy IS NOT NULL)
WHERE session IS NOT NULL GROUP BY 1"""

CTES["inflation_labels"] = """
SELECT m.date, count(r.date) AS n, count(*) FILTER (r.yoy <= m.inflation_rate) AS k
FROM macro_levels m JOIN releases r ON r.date <= m.date WHERE m.inflation_rate IS NOT NULL GROUP BY 1"""

CTES["rate_labels"] = """
SELECT date, CASE WHEN lag(fed_funds_rate, 63) OVER (ORDER BY date) IS NULL THEN NULL
  WHEN fed_funds_rate - lag(fed_funds_rate, 63) OVER (ORDER BY date) <= -0.25 THEN 'easing'
  WHEN fed_funds_rate - lag(fed_funds_rate, 63) OVER (ORDER BY date) >= 0.25 THEN 'tightening' ELSE 'stable' END AS rate_regime
FROM macro_levels WHERE fed_funds_rate IS NOT NULL"""

CTES["macro_conditions"] = """
SELECT m.date, inflation_rate, core_inflation_rate, unemployment_rate, jobless_claims, fed_funds_rate,
  treasury_2y_yield, treasury_10y_yield, round(treasury_10y_yield - treasury_2y_yield, 8) AS yield_curve_10y_2y,
  fed_balance_sheet, credit_spread,
  CASE WHEN n < 36 THEN NULL WHEN 3 * k <= n THEN 'low' WHEN 3 * k <= 2 * n THEN 'normal' WHEN n IS NOT NULL THEN 'high' END
    AS inflation_regime, rate_regime
FROM macro_levels m LEFT JOIN inflation_labels i ON i.date = m.date LEFT JOIN rate_labels r ON r.date = m.date"""

# -- events
CTES["elections"] = """
SELECT d AS event_date, CASE WHEN y % 4 = 0 THEN 'presidential' ELSE 'midterm' END AS kind FROM (
  SELECT y, CAST(make_date(y, 11, 1) + CAST((8 - isodow(make_date(y, 11, 1))) % 7 AS INTEGER) + 1 AS DATE) AS d
  FROM years WHERE y % 2 = 0), bounds WHERE d BETWEEN lo AND hi"""

CTES["meetings"] = """
SELECT DISTINCT day AS event_date FROM (
  SELECT CASE WHEN n % 5 = 4 THEN CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) ELSE d END AS day
  FROM headings WHERE n % 8 NOT IN (0, 1, 2, 3)), bounds WHERE day <= (SELECT max(date) FROM spine)"""

CTES["scheduled_events"] = """
SELECT event_type || ':' || CAST(event_date AS VARCHAR) || ':' || coalesce(reference_period, 'NA') || ':MARKET' AS event_id,
  event_type, event_date, CAST(NULL AS VARCHAR) AS symbol, reference_period, release_session, event_time_et, source
FROM (
  SELECT 'fomc' AS event_type, event_date, CAST(NULL AS VARCHAR) AS reference_period,
    CASE WHEN event_date >= DATE '2013-03-20' THEN 'during_session' ELSE 'unknown' END AS release_session,
    CASE WHEN event_date >= DATE '2013-03-20' THEN '14:00:00' END AS event_time_et,
    'federal_reserve_fomc_historical' AS source FROM meetings
  UNION ALL
  SELECT CASE series WHEN 'cpi' THEN 'cpi' ELSE 'employment_situation' END, realtime_start, strftime(ref_date, '%Y-%m'),
    'pre_open', CASE WHEN realtime_start >= DATE '1990-01-01' THEN '08:30:00' END,
    CASE series WHEN 'cpi' THEN 'alfred_cpiaucsl_first_print' ELSE 'alfred_unrate_first_print' END
  FROM first_prints WHERE series IN ('cpi', 'unrate') AND day(ref_date) = 1
    AND realtime_start BETWEEN DATE '1957-01-01' AND (SELECT max(date) FROM spine)
  UNION ALL
  SELECT 'election', event_date, kind, 'unknown', NULL, 'us_statutory_election_day' FROM elections)"""

# -- calendar context
CTES["gap_days"] = """
SELECT t.date AS prev, t.next_trading_date AS next, d.date AS closed, coalesce(c.name, 'Market Closure') AS name,
  coalesce(c.type, 'regular') AS type
FROM trading_days t JOIN days d ON d.date > t.date AND d.date < t.next_trading_date AND isodow(d.date) <= 5
LEFT JOIN closures c ON c.date = d.date"""

CTES["anchors"] = """
SELECT DISTINCT event_type, (SELECT min(date) FROM spine WHERE date >= event_date) AS date FROM scheduled_events"""

CTES["since"] = """
SELECT t.date, a.event_type, max(s.i) AS last_i, max(t.i) AS i
FROM session_index t JOIN anchors a ON a.date <= t.date JOIN session_index s ON s.date = a.date GROUP BY 1, 2"""

CTES["calendar_context"] = """
SELECT t.date,
  t.next_trading_date IS NOT NULL AND t.date IN (SELECT prev FROM gap_days) AS is_day_before_holiday,
  t.prev_trading_date IS NOT NULL AND t.date IN (SELECT next FROM gap_days) AS is_day_after_holiday,
  h.name AS holiday_name, h.type AS holiday_type,
  t.date IN (SELECT date FROM early_closes) AS is_shortened_trading_day,
  count(*) OVER (PARTITION BY date_trunc('week', t.date)) < 5 AS is_shortened_week,
  CAST(count(*) OVER (PARTITION BY date_trunc('week', t.date)) AS INTEGER) AS trading_days_in_week,
  is_month_end OR trading_day_of_month = 1 AS is_turn_of_month,
  is_quarter_end OR row_number() OVER (PARTITION BY year, quarter ORDER BY t.date) = 1 AS is_quarter_transition,
  is_year_end OR trading_day_of_year = 1 AS is_year_transition,
  t.date IN (SELECT event_date FROM scheduled_events WHERE event_type = 'fomc') AS is_fomc_day,
  CAST((SELECT i - last_i FROM since s WHERE s.date = t.date AND event_type = 'fomc') AS INTEGER) AS days_since_last_fomc,
  t.date IN (SELECT event_date FROM scheduled_events WHERE event_type = 'cpi') AS is_cpi_release_day,
  CAST((SELECT i - last_i FROM since s WHERE s.date = t.date AND event_type = 'cpi') AS INTEGER) AS days_since_last_cpi,
  t.date IN (SELECT event_date FROM scheduled_events WHERE event_type = 'employment_situation') AS is_employment_situation_day,
  CAST((SELECT i - last_i FROM since s WHERE s.date = t.date AND event_type = 'employment_situation') AS INTEGER) AS days_since_last_employment_situation,
  t.date IN (SELECT event_date FROM scheduled_events WHERE event_type = 'election') AS is_election_day,
  CAST((SELECT i - last_i FROM since s WHERE s.date = t.date AND event_type = 'election') AS INTEGER) AS days_since_last_election
FROM trading_days t LEFT JOIN (
  SELECT date, string_agg(name, '|' ORDER BY side, first_closed) AS name, CASE WHEN bool_or(x) THEN 'exceptional' ELSE 'regular' END AS type
  FROM (
    SELECT date, name, min(side) AS side, arg_min(closed, struct_pack(a := side, b := closed)) AS first_closed, bool_or(type = 'exceptional') AS x FROM (
      SELECT prev AS date, 0 AS side, closed, name, type FROM gap_days
      UNION ALL SELECT next, 1, closed, name, type FROM gap_days) GROUP BY 1, 2)
  GROUP BY 1) h ON h.date = t.date"""

_NAMES = re.compile(r"\b(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


def needed(body: str) -> list[str]:
    """Names a body uses, directly or through others, in definition order."""
    found: set[str] = set()
    todo = [body]
    while todo:
        for name in set(_NAMES.findall(todo.pop())) - found:
            found.add(name)
            todo.append(CTES[name])
    return [n for n in CTES if n in found]


def sql(body: str) -> str:
    """One DuckDB statement: the recipes the body needs, then the body."""
    body = body.strip()
    parts = [f"{n} AS ({CTES[n].strip()})" for n in needed(body)]
    if not parts:
        return body
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
