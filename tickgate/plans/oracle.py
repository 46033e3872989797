"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Tables are the driver's pre-registered views. The bar adapter of
``sources.bars.bars_from_events`` is restated here as a CTE.
"""
from __future__ import annotations

ET = "America/New_York"
SESSION = (34200, 57600)  # 09:30:00 and 16:00:00 as seconds of day
VENUE_LIST = "['XNAS.ITCH', 'ARCX.PILLAR', 'BATS.PITCH']"


def bars_cte(wide: bool = False, defects: bool = True, by_venue: bool = False) -> str:
    sym = "'U' || CAST(user_id AS VARCHAR)" if wide else "event_type"
    if defects:
        proj = """
    CASE WHEN symbol = 'signup' THEN open * 1000
         WHEN symbol = 'error' AND hour(ts_event) = 1 THEN -open ELSE open END AS open,
    CASE WHEN symbol = 'signup' THEN high * 1000
         WHEN symbol = 'view' AND hour(ts_event) = 0 THEN low - 1 ELSE high END AS high,
    CASE WHEN symbol = 'signup' THEN low * 1000 ELSE low END AS low,
    CASE WHEN symbol = 'signup' THEN close * 1000 ELSE close END AS close,"""
    else:
        proj = "open, high, low, close,"
    return f"""
raw_bars AS (
  SELECT {sym} AS symbol,
         {VENUE_LIST}[CAST(user_id % 3 AS INTEGER) + 1] AS venue,
         date_trunc('hour', ts) AS ts_event,
         arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, event_id) AS close, CAST(sum(user_id % 10) AS BIGINT) AS volume
  FROM events GROUP BY ALL),
bars AS (
  SELECT symbol, venue, ts_event, {proj} volume FROM raw_bars),
nb1 AS (
  SELECT * {"REPLACE (symbol || '@' || venue AS symbol)" if by_venue else ""},
         (ts_event AT TIME ZONE 'UTC') AT TIME ZONE '{ET}' AS et FROM bars),
nb AS (
  SELECT *, CAST(et AS DATE) AS et_date,
         (hour(et) * 3600 + minute(et) * 60 + second(et)) >= {SESSION[0]}
     AND (hour(et) * 3600 + minute(et) * 60 + second(et)) < {SESSION[1]} AS in_session
  FROM nb1)"""


# daily VWAP days and their shift, over a CTE "vd_src(symbol, et_date, dv, v)"
VWAP_CTES = """
vwap_days AS (
  SELECT symbol, et_date, coalesce(dv, 0.0) AS dv, coalesce(v, 0.0) AS v,
         CASE WHEN coalesce(v, 0.0) > 0 THEN coalesce(dv, 0.0) / greatest(coalesce(v, 0.0), 1.0) END AS vwap
  FROM vd_src),
vwap_ok AS (SELECT * FROM vwap_days WHERE vwap IS NOT NULL),
shift AS (
  SELECT *, coalesce(CASE WHEN prev = 0 THEN vwap <> 0 ELSE abs(vwap / prev - 1) > 0.3 END, false) AS flagged
  FROM (SELECT *, lag(vwap) OVER (PARTITION BY symbol ORDER BY et_date) AS prev FROM vwap_ok)),
shift_sum AS (
  SELECT symbol, count(*) AS n_vwap_days, count_if(flagged) AS n_corp_event_days,
         coalesce(string_agg(CASE WHEN flagged THEN strftime(et_date, '%Y-%m-%d') END, ',' ORDER BY et_date), '')
           AS corp_event_dates
  FROM shift GROUP BY symbol)"""

BAR_VD_SRC = """
vd_src AS (
  SELECT symbol, et_date, sum(close * volume) FILTER (WHERE in_session) AS dv,
         CAST(sum(volume) FILTER (WHERE in_session) AS DOUBLE) AS v
  FROM nb GROUP BY ALL HAVING count_if(in_session) > 0)"""

GAP_CTES = """
per_ts AS (
  SELECT symbol, et_date, ts_event, count(*) AS cnt FROM nb WHERE in_session GROUP BY ALL),
anchors AS (
  SELECT symbol, et_date, min(ts_event) AS t_first, max(ts_event) AS t_last,
         date_diff('microsecond', min(ts_event), max(ts_event)) // 3600000000 AS span
  FROM nb WHERE in_session GROUP BY ALL),
filled AS (
  SELECT DISTINCT p.symbol, p.et_date, date_diff('microsecond', a.t_first, p.ts_event) // 3600000000 AS slot
  FROM per_ts p JOIN anchors a USING (symbol, et_date)
  WHERE date_diff('microsecond', a.t_first, p.ts_event) % 3600000000 = 0),
per_day AS (
  SELECT a.symbol, a.et_date, a.t_first, a.span,
         a.span + 1 - (SELECT count(*) FROM filled f WHERE f.symbol = a.symbol AND f.et_date = a.et_date)
           AS n_missing
  FROM anchors a),
gap_sum AS (
  SELECT symbol, CAST(sum(n_missing) AS BIGINT) AS n_missing_bars, count_if(n_missing > 0) AS n_days_gappy
  FROM per_day GROUP BY symbol),
dup_sum AS (
  SELECT symbol, count(*) - count(DISTINCT ts_event) AS n_dups FROM nb WHERE in_session GROUP BY symbol)"""

SYM_CTE = """
sym AS (
  SELECT symbol, count(*) AS n_rows, count_if(in_session) AS n_kept,
         count_if(open <= 0) + count_if(high <= 0) + count_if(low <= 0) + count_if(close <= 0) AS n_bad_ohlc,
         count_if(volume < 0) AS n_neg_volume, count_if(volume = 0) AS n_zero_volume,
         count_if(high < open OR high < close) AS n_bad_high,
         count_if(low > open OR low > close) AS n_bad_low,
         count_if(high < low) AS n_bad_high_low,
         median(close) AS med
  FROM nb GROUP BY symbol),
w AS (
  SELECT s.*, coalesce(d.n_dups, 0) AS n_dups, coalesce(h.n_corp_event_days, 0) AS n_corp,
         coalesce(g.n_missing_bars, 0) AS n_missing_bars, coalesce(g.n_days_gappy, 0) AS n_days_gappy
  FROM sym s LEFT JOIN dup_sum d USING (symbol) LEFT JOIN shift_sum h USING (symbol)
  LEFT JOIN gap_sum g USING (symbol)),
checks AS (
  SELECT symbol, 'A' AS "check", 0 AS severity_rank,
         CASE WHEN med > 10000 THEN 'ABORT' ELSE 'PASS' END AS status,
         CASE WHEN med > 10000
              THEN 'median close = ' || format('{:,.0f}', med) || ' > 10000 (fixed-point not converted)'
              ELSE 'median close = ' || printf('%.4f', med) END AS detail FROM w
  UNION ALL
  SELECT symbol, 'B', 1,
         CASE WHEN n_bad_ohlc > 0 OR n_neg_volume > 0 THEN 'ABORT' ELSE 'PASS' END,
         CASE WHEN n_bad_ohlc > 0 OR n_neg_volume > 0
              THEN n_bad_ohlc || ' rows with OHLC ≤ 0; ' || n_neg_volume || ' rows with volume < 0'
              ELSE 'all OHLC positive; ' || n_zero_volume || ' bars with volume=0 (valid)' END FROM w
  UNION ALL
  SELECT symbol, 'C', 2, 'PASS', 'index monotonically non-decreasing' FROM w
  UNION ALL
  SELECT symbol, 'D', 3, 'PASS', 'all 5 expected columns present' FROM w
  UNION ALL
  SELECT symbol, 'J', 4,
         CASE WHEN n_bad_high + n_bad_low + n_bad_high_low > 0 THEN 'ABORT' ELSE 'PASS' END,
         CASE WHEN n_bad_high + n_bad_low + n_bad_high_low > 0
              THEN n_bad_high || ' high<open|close; ' || n_bad_low || ' low>open|close; '
                   || n_bad_high_low || ' high<low'
              ELSE 'OHLC relations consistent' END FROM w
  UNION ALL
  SELECT symbol, 'E', 5, 'PASS',
         'kept ' || format('{:,}', n_kept) || ' rows; dropped ' || format('{:,}', n_rows - n_kept)
         || ' outside session' FROM w
  UNION ALL
  SELECT symbol, 'F', 6,
         CASE WHEN n_kept = 0 THEN 'PASS' WHEN n_dups > 0 THEN 'WARNING' ELSE 'PASS' END,
         CASE WHEN n_kept = 0 THEN 'no datetime index or empty'
              WHEN n_dups > 0 THEN n_dups || ' duplicate timestamps'
              ELSE 'no duplicate timestamps' END FROM w
  UNION ALL
  SELECT symbol, 'H', 7,
         CASE WHEN n_kept = 0 THEN 'PASS' WHEN n_corp > 0 THEN 'WARNING' ELSE 'PASS' END,
         CASE WHEN n_kept = 0 THEN 'required columns absent for check H'
              WHEN n_corp > 0 THEN n_corp || ' days with VWAP shift > 30%'
              ELSE 'no VWAP shift > 30% detected' END FROM w
  UNION ALL
  SELECT symbol, 'I', 8,
         CASE WHEN n_kept = 0 THEN 'PASS' WHEN n_missing_bars > 0 THEN 'WARNING' ELSE 'PASS' END,
         CASE WHEN n_kept = 0 THEN 'no datetime index or empty'
              WHEN n_missing_bars > 0 THEN n_missing_bars || ' missing hourly bars across '
                   || n_days_gappy || ' days'
              ELSE 'no intra-day hourly gaps' END FROM w),
report AS (
  SELECT c.symbol, 'ohlcv-1h' AS schema, bool_or(c.status = 'ABORT') AS quarantine,
         coalesce(string_agg(CASE WHEN c.status = 'WARNING' THEN c."check" END, ',' ORDER BY c.severity_rank), '')
           AS warnings,
         any_value(w.n_rows) AS n_rows_in, any_value(w.n_kept) AS n_rows_out
  FROM checks c JOIN w USING (symbol) GROUP BY c.symbol)"""


def with_bars(*ctes: str, wide: bool = False, by_venue: bool = False) -> str:
    return "WITH " + ",".join([bars_cte(wide, by_venue=by_venue)] + list(ctes))


VALIDATION = (BAR_VD_SRC, VWAP_CTES, GAP_CTES, SYM_CTE)


ORACLE: dict[str, str] = {
    "bars_hourly": with_bars() + "\nSELECT symbol, venue, ts_event, open, high, low, close, volume FROM bars",

    "session_filter": with_bars() + """
SELECT symbol, count(*) AS n_rows_in, count_if(in_session) AS n_kept,
       count(*) - count_if(in_session) AS n_dropped
FROM nb GROUP BY symbol""",

    "daily_vwap": with_bars(BAR_VD_SRC, VWAP_CTES) + """
SELECT symbol, et_date, round(dv, 4) AS dv, round(v, 4) AS v, round(vwap, 4) AS vwap FROM vwap_ok""",

    "vwap_shift": with_bars(BAR_VD_SRC, VWAP_CTES) + "\nSELECT * FROM shift_sum",

    "corp_event_symbols": with_bars(BAR_VD_SRC, VWAP_CTES) + """
SELECT DISTINCT symbol FROM shift WHERE flagged""",

    "vwap_shift_lineitem": """
WITH vd_src AS (
  SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS et_date,
         sum((l_extendedprice / l_quantity) * l_quantity) AS dv, sum(l_quantity) AS v
  FROM lineitem GROUP BY ALL),""" + VWAP_CTES + """
SELECT symbol AS l_suppkey, n_vwap_days, n_corp_event_days, corp_event_dates FROM shift_sum""",

    "price_scale_guard": with_bars() + """
SELECT symbol, CASE WHEN median(close) > 10000 THEN 'ABORT' ELSE 'PASS' END AS status,
       round(median(close), 4) AS median_close
FROM nb GROUP BY symbol""",

    "price_scale_guard_orders": """
SELECT o_orderpriority, round(median(o_totalprice), 4) AS median_price,
       CASE WHEN median(o_totalprice) > 10000 THEN 'ABORT' ELSE 'PASS' END AS status
FROM orders GROUP BY o_orderpriority""",

    "price_scale_guard_bracket": """
SELECT l_returnflag, l_linenumber, round(median(l_extendedprice), 4) AS median_price,
       CASE WHEN median(l_extendedprice) > 10000 THEN 'ABORT' ELSE 'PASS' END AS status
FROM lineitem GROUP BY ALL""",

    "nonpositive_prices": with_bars() + """
SELECT symbol,
       count_if(open <= 0) + count_if(high <= 0) + count_if(low <= 0) + count_if(close <= 0) AS n_bad_ohlc,
       count_if(volume < 0) AS n_neg_volume, count_if(volume = 0) AS n_zero_volume,
       CASE WHEN count_if(open <= 0) + count_if(high <= 0) + count_if(low <= 0) + count_if(close <= 0) > 0
              OR count_if(volume < 0) > 0 THEN 'ABORT' ELSE 'PASS' END AS status
FROM nb GROUP BY symbol""",

    "ohlc_sanity": with_bars() + """
SELECT symbol,
       CASE WHEN count_if(high < open OR high < close) + count_if(low > open OR low > close)
                 + count_if(high < low) > 0 THEN 'ABORT' ELSE 'PASS' END AS status,
       count_if(high < open OR high < close) AS n_bad_high,
       count_if(low > open OR low > close) AS n_bad_low,
       count_if(high < low) AS n_bad_high_low
FROM nb GROUP BY symbol""",

    "duplicate_bars": with_bars() + """
SELECT symbol, CASE WHEN count(*) - count(DISTINCT ts_event) > 0 THEN 'WARNING' ELSE 'PASS' END AS status,
       count(*) - count(DISTINCT ts_event) AS n_dups
FROM nb WHERE in_session GROUP BY symbol""",

    "duplicate_rows": with_bars() + """
SELECT symbol, ts_event, venue,
       row_number() OVER (PARTITION BY symbol, ts_event ORDER BY venue) AS copy_no
FROM nb WHERE in_session""",

    "order_violations": """
SELECT o_orderpriority, count_if(o_orderdate < prev) AS n_violations
FROM (SELECT o_orderpriority, o_orderdate,
             lag(o_orderdate) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS prev
      FROM orders)
GROUP BY o_orderpriority""",

    "hourly_gaps": with_bars(GAP_CTES) + """
SELECT s.symbol, coalesce(g.n_missing_bars, 0) AS n_missing_bars, coalesce(g.n_days_gappy, 0) AS n_days_gappy
FROM (SELECT DISTINCT symbol FROM nb) s LEFT JOIN gap_sum g USING (symbol)""",

    "hourly_gaps_wide": with_bars(GAP_CTES, wide=True) + """
SELECT s.symbol, coalesce(g.n_missing_bars, 0) AS n_missing_bars, coalesce(g.n_days_gappy, 0) AS n_days_gappy
FROM (SELECT DISTINCT symbol FROM nb) s LEFT JOIN gap_sum g USING (symbol)""",

    "gap_samples": with_bars(GAP_CTES) + f""",
slots AS (SELECT symbol, et_date, t_first, unnest(range(0, span + 1)) AS slot FROM anchors),
missing AS (SELECT s.* FROM slots s ANTI JOIN filled f USING (symbol, et_date, slot)),
gappy AS (
  SELECT symbol, et_date, count(*) AS n_missing,
         row_number() OVER (PARTITION BY symbol ORDER BY et_date) AS day_no
  FROM missing GROUP BY symbol, et_date),
fmt AS (
  SELECT symbol, et_date, slot, t, (t AT TIME ZONE 'UTC') AT TIME ZONE '{ET}' AS loc,
         row_number() OVER (PARTITION BY symbol, et_date ORDER BY slot) AS k
  FROM (SELECT *, t_first + to_hours(slot) AS t FROM missing)),
fmt2 AS (
  SELECT symbol, et_date, k,
         strftime(loc, '%Y-%m-%d %H:%M:%S')
         || CASE WHEN date_diff('minute', t, loc) < 0 THEN '-' ELSE '+' END
         || lpad(CAST(abs(date_diff('minute', t, loc)) // 60 AS VARCHAR), 2, '0') || ':'
         || lpad(CAST(abs(date_diff('minute', t, loc)) % 60 AS VARCHAR), 2, '0') AS s
  FROM fmt WHERE k <= 3)
SELECT g.symbol, g.et_date, g.day_no, g.n_missing,
       (SELECT string_agg(s, ',' ORDER BY k) FROM fmt2 f WHERE f.symbol = g.symbol AND f.et_date = g.et_date)
         AS missing_hours
FROM gappy g WHERE g.day_no <= 5""",

    "required_columns": """
SELECT c.schema, s.symbol, c.n_required, c.n_missing, c.missing, c.status
FROM (SELECT DISTINCT event_type AS symbol FROM events) s,
     (VALUES ('ohlcv-1h', 5, 0, '', 'PASS'),
             ('trades', 5, 0, '', 'PASS'),
             ('mbp-10', 11, 6, 'bid_px_00,ask_px_00,bid_sz_00,ask_sz_00,bid_px_01,ask_px_01', 'ABORT'))
       AS c(schema, n_required, n_missing, missing, status)""",

    "check_results": with_bars(*VALIDATION) + """
SELECT symbol, "check", severity_rank, status, detail FROM checks""",

    "validation_report": with_bars(*VALIDATION) + "\nSELECT * FROM report",

    "validation_summary": with_bars(*VALIDATION) + """
SELECT count(*) AS total, count_if(NOT quarantine AND warnings = '') AS passed,
       count_if(NOT quarantine AND warnings <> '') AS warned, count_if(quarantine) AS quarantined
FROM report""",

    "validation_summary_wide": with_bars(*VALIDATION, wide=True) + """
SELECT count(*) AS total, count_if(NOT quarantine AND warnings = '') AS passed,
       count_if(NOT quarantine AND warnings <> '') AS warned, count_if(quarantine) AS quarantined
FROM report""",

    "abort_reasons": with_bars(*VALIDATION) + """
SELECT symbol, string_agg("check", ',' ORDER BY severity_rank) AS aborted_checks
FROM checks WHERE status = 'ABORT' GROUP BY symbol""",
}

ORACLE["order_violations_blocked"] = ORACLE["order_violations"]


# ---------------------------------------------------------------------------
# Planning, publishing, files, paths
# ---------------------------------------------------------------------------

def _venues_values(schema: str) -> str:
    from tickgate import config as cfg
    rows = []
    for v in cfg.SCHEMA_VENUES[schema]:
        e = cfg.VENUE_EARLIEST_START.get(v)
        rows.append(f"('{v}', {('DATE ' + repr(e)) if e else 'CAST(NULL AS DATE)'})")
    return "(VALUES " + ", ".join(rows) + ") AS vd(venue, earliest)"


def plan_cte(schema: str = "ohlcv-1h", start: str = "2022-01-01", end: str = "2025-12-31",
             name: str = "plan") -> str:
    return f"""
{name} AS (
  SELECT '{schema}' AS schema, symbol, venue, strftime(m, '%Y-%m') AS year_month,
         strftime(m, '%Y-%m-%dT00:00:00Z') AS start,
         strftime(m + INTERVAL 1 MONTH, '%Y-%m-%dT00:00:00Z') AS "end"
  FROM (SELECT u.symbol, vd.venue,
               date_trunc('month', greatest(DATE '{start}', coalesce(vd.earliest, DATE '{start}'))) AS vs
        FROM (SELECT DISTINCT event_type AS symbol FROM events) u, {_venues_values(schema)}) p,
       LATERAL (SELECT unnest(generate_series(p.vs, date_trunc('month', DATE '{end}'), INTERVAL 1 MONTH)) AS m) g
  WHERE p.vs <= date_trunc('month', DATE '{end}'))"""


LANDED_CTE = """
landed AS (
  SELECT 'ohlcv-1h' AS schema, symbol, venue, strftime(ts_event, '%Y-%m') AS year_month, count(*) AS rows,
         'ok' AS state
  FROM bars GROUP BY ALL)"""

STATUS_SQL = """
status AS (
  SELECT p.*, coalesce(l.state, 'missing') AS state, coalesce(l.rows, 0) AS rows,
         coalesce(l.state, 'missing') IN ('ok', 'empty') AS cached
  FROM {plan} p LEFT JOIN {landed} l USING (schema, symbol, venue, year_month))"""

GATE_CTE = """
gated AS (
  SELECT l.*, CASE WHEN r.quarantine THEN 'reject' ELSE 'publish' END AS decision,
         CASE WHEN r.quarantine IS NULL THEN NULL ELSE NOT r.quarantine END AS validation_ok,
         coalesce(r.warnings, '') AS warnings,
         'raw/' || l.schema || '/' || l.symbol || '/' || replace(l.venue, '.', '_') || '/' || l.year_month
           || '.parquet' AS blob_name
  FROM landed l LEFT JOIN report r USING (schema, symbol))"""

INGEST_CTES = (plan_cte() + "," + LANDED_CTE + """,
cached_before AS (SELECT * FROM landed WHERE venue = 'XNAS.ITCH'),""" + STATUS_SQL.format(
    plan="plan", landed="cached_before") + """,
ledger AS (
  SELECT s.schema, s.symbol, s.venue, s.year_month, true AS success,
         CASE WHEN s.cached THEN 'cached (' || format('{:,}', s.rows) || ' rows)'
              WHEN coalesce(l.rows, 0) > 0 THEN format('{:,}', l.rows) || ' rows'
              ELSE '0 rows (symbol absent at venue)' END AS message,
         CASE WHEN s.cached THEN s.rows ELSE coalesce(l.rows, 0) END AS rows, s.cached
  FROM status s LEFT JOIN landed l USING (schema, symbol, venue, year_month))""")

ORACLE.update({
    "chunk_plan": "WITH " + plan_cte()[1:] + "\nSELECT * FROM plan",

    "chunk_status": with_bars(plan_cte(), LANDED_CTE,
                              STATUS_SQL.format(plan="plan", landed="landed")) + """
SELECT schema, symbol, venue, year_month, state, rows, cached FROM status""",

    "plan_estimate": with_bars(plan_cte(), LANDED_CTE, STATUS_SQL.format(plan="plan", landed="landed")) + """
SELECT schema, count(*) AS n_total, count_if(cached) AS n_cached, count(*) - count_if(cached) AS n_todo,
       (count(*) - count_if(cached)) * 130 AS est_records,
       round((count(*) - count_if(cached)) * 0.01 / 1024.0, 6) AS est_gb,
       round((count(*) - count_if(cached)) * 0.01 / 1024.0 * 0.3, 6) AS est_usd,
       round((count(*) - count_if(cached)) / 50.0, 6) AS est_hours,
       round(count_if(cached) * 100.0 / count(*), 6) AS cached_pct,
       count(DISTINCT symbol) AS n_tickers, count(DISTINCT venue) AS n_venues,
       count(DISTINCT year_month) AS n_months, min(year_month) AS first_month, max(year_month) AS last_month
FROM status GROUP BY schema""",

    "requeue": with_bars(*VALIDATION, LANDED_CTE) + """
SELECT l.schema, l.symbol, l.venue, l.year_month,
       strftime(CAST(l.year_month || '-01' AS DATE), '%Y-%m-%dT00:00:00Z') AS start,
       strftime(CAST(l.year_month || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m-%dT00:00:00Z') AS "end",
       true AS force
FROM landed l WHERE l.symbol IN (SELECT symbol FROM report WHERE quarantine)""",

    "ingest_ledger": with_bars(INGEST_CTES) + "\nSELECT * FROM ledger",

    "ingest_summary": with_bars(INGEST_CTES) + """
SELECT count(*) AS total, count_if(success AND NOT cached) AS downloaded, count_if(cached) AS cached,
       count_if(NOT success) AS failed, CAST(sum(rows) AS BIGINT) AS total_rows FROM ledger""",

    "ingest_outcomes": with_bars(plan_cte(), LANDED_CTE) + """,
r AS (
  SELECT p.schema, p.symbol, p.venue, p.year_month, coalesce(l.rows, 0) AS n,
         NOT (p.symbol IN ('click', 'view') AND p.venue = 'XNAS.ITCH' AND coalesce(l.rows, 0) > 0) AS success
  FROM plan p LEFT JOIN landed l USING (schema, symbol, venue, year_month))
SELECT schema, symbol, venue, year_month, success,
       CASE WHEN NOT success THEN NULL WHEN n > 0 THEN format('{:,}', n) || ' rows' ELSE '0 rows (symbol absent at venue)' END AS message,
       CASE WHEN NOT success THEN true END AS cut, CASE WHEN success THEN n ELSE 0 END AS rows, false AS cached, true AS timed
FROM r""",

    "run_totals": with_bars(*VALIDATION, INGEST_CTES.lstrip(",")) + """,
chunk_rows AS (
  SELECT schema, NOT (symbol = 'error' AND venue = 'BATS.PITCH') AS success, cached, rows FROM ledger
  UNION ALL
  SELECT 'trades', true, false, 0 FROM (SELECT DISTINCT symbol FROM bars), range(4), range(48)),
per_schema AS (
  SELECT coalesce(schema, 'all') AS schema, count(*) AS total, count_if(success AND NOT cached) AS downloaded,
         count_if(cached) AS cached, count_if(NOT success) AS failed, CAST(sum(rows) AS BIGINT) AS total_rows
  FROM chunk_rows GROUP BY ROLLUP (schema)),
report_rows AS (
  SELECT schema, quarantine, warnings FROM report UNION ALL
  SELECT 'trades', quarantine, warnings FROM report WHERE quarantine),
verdicts AS (
  SELECT coalesce(schema, 'all') AS schema, count(*) AS total, count_if(NOT quarantine AND warnings = '') AS passed,
         count_if(NOT quarantine AND warnings <> '') AS warned, count_if(quarantine) AS quarantined
  FROM report_rows GROUP BY ROLLUP (schema))
SELECT 'download' AS step, schema, total, downloaded, cached, failed, total_rows, NULL::BIGINT AS passed,
       NULL::BIGINT AS warned, NULL::BIGINT AS quarantined FROM per_schema
UNION ALL SELECT 'validate', schema, total, NULL, NULL, NULL, NULL, passed, warned, quarantined FROM verdicts""",

    "quarantine_split": with_bars(*VALIDATION) + """
SELECT b.symbol, b.venue,
       CASE WHEN r.quarantine THEN 'quarantine' WHEN r.quarantine IS NULL THEN 'unvalidated' ELSE 'clean' END
         AS route,
       count(*) AS n_rows
FROM bars b LEFT JOIN report r USING (symbol) GROUP BY ALL""",

    "publish_gate": with_bars(*VALIDATION, LANDED_CTE, GATE_CTE) + """
SELECT schema, symbol, venue, year_month, decision, validation_ok, warnings FROM gated""",

    "manifest_build": with_bars(*VALIDATION, LANDED_CTE, GATE_CTE) + """
SELECT schema, symbol, count(*) AS n_files, CAST(sum(rows) AS BIGINT) AS total_rows,
       string_agg(blob_name, ',' ORDER BY blob_name) AS blob_names
FROM gated WHERE decision = 'publish' GROUP BY schema, symbol""",

    "manifest_upsert": with_bars(*VALIDATION, LANDED_CTE, GATE_CTE) + """,
old AS (
  SELECT 'raw/ohlcv-1h/' || event_type || '/' || replace(['XNAS.ITCH', 'ARCX.PILLAR', 'BATS.PITCH'][CAST(user_id % 3 AS INTEGER) + 1], '.', '_')
         || '/' || strftime(ts, '%Y-%m') || '.parquet' AS blob_name, count(*) AS row_count
  FROM events GROUP BY ALL),
new AS (SELECT blob_name, rows AS row_count FROM gated WHERE decision = 'publish')
SELECT blob_name, row_count, 'old' AS origin FROM old WHERE blob_name NOT IN (SELECT blob_name FROM new)
UNION ALL SELECT blob_name, row_count, 'new' FROM new""",

    "publish_summary": with_bars(*VALIDATION, LANDED_CTE, GATE_CTE) + """
SELECT count(*) AS total, count_if(decision = 'publish') AS uploaded, 0 AS skipped,
       count_if(decision = 'reject') AS failed, count_if(decision = 'publish') AS table_loaded, 0 AS bytes
FROM gated""",

    "load_ledger": with_bars(*VALIDATION, LANDED_CTE, GATE_CTE) + """
SELECT 1 AS run, count(*) AS total, count_if(decision = 'publish') AS uploaded, 0 AS skipped,
       count_if(decision = 'reject') AS failed, count_if(decision = 'publish') AS table_loaded FROM gated
UNION ALL
SELECT 2, count(*), 0, count_if(decision = 'publish'), count_if(decision = 'reject'), 0 FROM gated""",

    "publish_roundtrip": with_bars(*VALIDATION, LANDED_CTE, GATE_CTE) + """
SELECT schema, symbol, venue, year_month, decision = 'publish' AS success, rows AS row_count,
       CASE WHEN decision = 'publish' THEN rows ELSE 0 END AS table_rows, decision = 'publish' AS arrived FROM gated""",

    "warehouse_rerun": with_bars() + """
SELECT symbol, venue, count(*) AS n_rows, 1 AS n_loads FROM bars GROUP BY ALL""",

    "file_probe": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CASE WHEN count(*) > 0 THEN 'ok' ELSE 'empty' END AS state, "
        f"count(*) AS rows FROM {t}"
        for t in ("region nation customer supplier part orders lineitem events documents embeddings "
                  "pages benchmark labels conversations").split()),

    "venue_codec": """
SELECT venue, replace(venue, '.', '_') AS venue_safe, venue AS venue_back, true AS round_trip
FROM (SELECT DISTINCT venue FROM """ + _venues_values("ohlcv-1h") + """
      UNION SELECT DISTINCT venue FROM """ + _venues_values("trades") + """)
WHERE EXISTS (SELECT 1 FROM events)""",

    "chunk_paths": with_bars(LANDED_CTE) + """
SELECT schema, symbol, venue, year_month,
       schema || '/' || symbol || '/' || replace(venue, '.', '_') || '/' || year_month || '.parquet' AS relpath,
       'raw/' || schema || '/' || symbol || '/' || replace(venue, '.', '_') || '/' || year_month || '.parquet'
         AS blob_name,
       'raw/' || schema || '/' || symbol || '/' || symbol || '_validation.json' AS report_name,
       'raw/' || schema || '/' || symbol || '/' || symbol || '_manifest.json' AS manifest_name,
       replace(schema, '-', '_') AS table_name, venue AS venue_parsed, true AS round_trip
FROM landed""",

    "month_bounds": "WITH " + plan_cte()[1:] + """
SELECT DISTINCT year_month, start, "end" FROM plan""",

    "validate_landed": ORACLE["validation_report"],

    "range_read": with_bars() + """
SELECT symbol, venue, ts_event, close FROM bars
WHERE symbol = 'click' AND ts_event >= TIMESTAMP '2024-01-10' AND ts_event < TIMESTAMP '2024-01-20'""",

    "consumer_read": with_bars() + """
SELECT symbol, venue, strftime(ts_event, '%Y-%m') AS year_month, ts_event, close, CAST(volume AS DOUBLE) AS volume
FROM bars WHERE symbol = 'click'""",

    "validate_incremental": with_bars(*VALIDATION, LANDED_CTE) + """
SELECT r.*, 0 AS scanned, (SELECT count(*) FROM landed) AS reused FROM report r""",
})


ORACLE["quarantine_preview"] = with_bars(*VALIDATION) + """
SELECT symbol, row_number() OVER (ORDER BY symbol) AS rank,
       (SELECT count(*) FROM report WHERE quarantine) AS n_quarantined,
       greatest((SELECT count(*) FROM report WHERE quarantine) - 20, 0) AS n_more
FROM report WHERE quarantine
ORDER BY symbol LIMIT 20"""

ORACLE["stream_row_checks"] = with_bars() + """
SELECT symbol, et_date, count(*) AS n_rows,
       count_if(open <= 0) + count_if(high <= 0) + count_if(low <= 0) + count_if(close <= 0) AS n_bad_ohlc,
       count_if(volume < 0) AS n_neg_volume,
       count_if(high < open OR high < close) AS n_bad_high,
       count_if(low > open OR low > close) AS n_bad_low,
       count_if(high < low) AS n_bad_high_low,
       count_if(in_session) AS n_kept
FROM nb GROUP BY symbol, et_date"""


# venue grain: the same CTEs over a composite key, split back at the end
ORACLE["check_results_by_venue"] = with_bars(*VALIDATION, by_venue=True) + """
SELECT split_part(symbol, '@', 1) AS symbol, split_part(symbol, '@', 2) AS venue,
       "check", severity_rank, status, detail FROM checks"""

# The bytes of the text files that the file queries write: a line per event, in order of the event.
FILES_CTE = """
f AS (
  SELECT user_id % 64 AS bucket,
         string_agg(event_id || ' ' || event_type, chr(10) ORDER BY event_id) || chr(10) AS body
  FROM events GROUP BY 1)"""

ORACLE.update({
    "file_digest": "WITH" + FILES_CTE + """
SELECT bucket, octet_length(encode(body))::BIGINT AS size_bytes, md5(body) AS md5 FROM f""",
    "storage_report": "WITH" + FILES_CTE + """
SELECT count(*) AS n_files, sum(octet_length(encode(body)))::BIGINT AS total_bytes,
       sum(octet_length(encode(body))) / 1073741824.0::DOUBLE AS total_gib FROM f""",
    "digest_compare": "WITH" + FILES_CTE + """
SELECT bucket, bucket <> 7 AS digest_match FROM f""",
})


def _mode_plan() -> str:
    from tickgate import config as cfg
    modes = [(m, s) for m in ("lit", "ats", "all") for s in cfg.MODE_SCHEMAS[m]]
    ctes = ",".join(plan_cte(s, name=f"plan_{i}") for i, s in enumerate(cfg.SCHEMA_VENUES))
    at = {s: f"plan_{i}" for i, s in enumerate(cfg.SCHEMA_VENUES)}
    return "WITH " + ctes[1:] + "\n" + " UNION ALL ".join(
        f"SELECT '{m}' AS mode, schema, venue, count(*) AS n_chunks, min(year_month) AS first_month FROM {at[s]} GROUP BY ALL"
        for m, s in modes)


CHUNK_ROWS = plan_cte() + "," + LANDED_CTE + """,
chunk_rows AS (
  SELECT p.schema, p.symbol, p.venue, p.year_month, coalesce(l.rows, 0) AS n,
         CASE WHEN coalesce(l.rows, 0) > 0 THEN format('{:,}', l.rows) || ' rows'
              ELSE '0 rows (symbol absent at venue)' END AS message
  FROM plan p LEFT JOIN landed l USING (schema, symbol, venue, year_month))"""

# Whole workflows over files (plans.workflows).
ORACLE.update({
    "validate_flat": ORACLE["validation_report"],

    "validate_one": ORACLE["validation_report"] + " WHERE symbol = 'view'",

    "validate_defects": with_bars(*VALIDATION, LANDED_CTE) + """,
back AS (SELECT CAST(coalesce(sum(rows - 1), 0) AS BIGINT) AS n FROM landed WHERE symbol = 'click'),
found AS (
  SELECT symbol, 'C' AS "check",
         CASE WHEN symbol = 'click' AND n > 0 THEN 'ABORT' ELSE 'PASS' END AS status,
         CASE WHEN symbol = 'click' AND n > 0 THEN n || ' index ordering violations'
              ELSE 'index monotonically non-decreasing' END AS detail FROM report, back
  UNION ALL
  SELECT symbol, 'D', CASE symbol WHEN 'view' THEN 'ABORT' WHEN 'purchase' THEN 'ERROR' ELSE 'PASS' END,
         CASE symbol WHEN 'view' THEN 'missing columns: [''volume'']' WHEN 'purchase' THEN '1 unreadable files'
                     ELSE 'all 5 expected columns present' END FROM report)
SELECT f.*, bool_or(f.status <> 'PASS') OVER (PARTITION BY symbol) OR r.quarantine AS quarantine
FROM found f JOIN report r USING (symbol)""",

    "clean_bars": with_bars(*VALIDATION) + """
SELECT symbol, venue, ts_event, close FROM nb JOIN report USING (symbol) WHERE in_session AND NOT quarantine""",

    "universe_scan": "SELECT DISTINCT 'U' || CAST(user_id AS VARCHAR) AS symbol FROM events",

    "warehouse_rows": """
WITH r AS (
  SELECT CASE WHEN user_id % 5 <> 0 THEN event_type END AS symbol, CASE WHEN user_id % 7 <> 0 THEN ts END AS t,
         user_id % 11 = 0 AS bad, CASE WHEN user_id % 11 <> 0 AND user_id % 13 <> 0 THEN value END AS price,
         user_id % 10 AS size FROM events)
SELECT coalesce(strftime(t, '%Y-%m-%d'), '') AS dt, symbol IS NULL OR t IS NULL OR bad AS unfit, count(*) AS n_rows, count(price) AS n_prices,
       CAST(sum(size) AS BIGINT) AS total_size
FROM r GROUP BY ALL""",

    "run_log": with_bars(CHUNK_ROWS) + """
SELECT level, 'ingest' AS logger, message AS msg, count(*) AS n, true AS dated
FROM chunk_rows, (VALUES ('INFO'), ('WARNING')) AS v(level) GROUP BY ALL""",

    "ingest_rerun": with_bars(CHUNK_ROWS) + """
SELECT 1 AS run, schema, symbol, venue, year_month, true AS success, message, n AS rows, false AS cached FROM chunk_rows
UNION ALL
SELECT 2, schema, symbol, venue, year_month, true, 'cached (' || format('{:,}', n) || ' rows)', n, true FROM chunk_rows""",

    "target_state": with_bars(LANDED_CTE) + """
SELECT 'raw/' || schema || '/' || symbol || '/' || replace(venue, '.', '_') || '/' || year_month || '.parquet' AS blob_name,
       symbol <> 'click' AS in_manifest, symbol <> 'click' AS listed FROM landed""",

    "mode_plan": _mode_plan(),

    "time_axis": with_bars() + """
SELECT axis, symbol, count_if(in_session) AS n_kept, min(et_date) AS first_day, max(ts_event) AS last_ts
FROM nb, (VALUES ('Datetime'), ('datetime'), ('timestamp')) AS a(axis) GROUP BY ALL""",

    "publish_status": with_bars(LANDED_CTE) + """
SELECT run, 'trades' AS schema, symbol, venue, year_month,
       CASE WHEN run = 'again' AND venue = 'XNAS.ITCH' THEN 'SKIPPED' ELSE 'UPLOADED' END AS status
FROM landed, (VALUES ('first'), ('again'), ('overwrite')) AS v(run)""",
})
