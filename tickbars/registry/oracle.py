"""Reference SQL (DuckDB) for the registered queries.

Each statement is a chain of common table expressions followed by a select;
only the ones a select needs cost anything.
"""

from __future__ import annotations


def _in_session(day: str, clock: str, rules: str = "regular") -> str:
    friday = f"({clock} BETWEEN TIME '09:15' AND TIME '12:00' OR {clock} BETWEEN TIME '14:00' AND TIME '16:30')"
    dated = ""
    if rules == "overrides":
        dated = (
            f"WHEN {day} BETWEEN DATE '2024-01-09' AND DATE '2024-01-12' "
            f"THEN {clock} BETWEEN TIME '10:00' AND TIME '13:00' "
        )
    return (
        f"CASE WHEN isodow({day}) = 5 THEN {friday} {dated}"
        f"ELSE {clock} BETWEEN TIME '09:30' AND TIME '15:30' END"
    )


def _moved(now: str, before: str) -> str:
    return f"coalesce(abs({now} - {before}) / {before} > 0.2, false)"


TICK_COLUMNS = "symbol, ts_utc, ts_local, trade_date, price, volume, source_file"
CANDLE_COLUMNS = "symbol, trade_date, ts, minute_local, open, high, low, close, volume, had_trade"

FAILED = "(price IS NULL OR isnan(price) OR volume IS NULL OR ts_utc IS NULL)"
USABLE = f"(NOT {FAILED} AND symbol IS NOT NULL AND price > 0 AND volume >= 0)"


def _candles(source: str) -> str:
    return f"""
  SELECT symbol, trade_date, ts, ts + INTERVAL 5 HOUR AS minute_local,
         arg_min(price, row(ts_utc, price, volume)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, row(ts_utc, price, volume)) AS close, CAST(sum(volume) AS BIGINT) AS volume,
         true AS had_trade
  FROM (SELECT *, date_trunc('minute', ts_utc) AS ts FROM {source})
  GROUP BY symbol, trade_date, ts"""


def _checked(source: str) -> str:
    return f"""
  SELECT *, coalesce(ohlc_valid AND price_valid AND volume_valid AND minute_boundary, false) AS is_valid
  FROM (SELECT *, high >= greatest(open, close) AND low <= least(open, close) AND high >= low AS ohlc_valid,
               open > 0 AND high > 0 AND low > 0 AND close > 0 AS price_valid,
               volume >= 0 AS volume_valid, second(ts) = 0 AS minute_boundary,
               CASE WHEN before > 0 THEN {_moved("close", "before")} ELSE false END AS spike_flag
        FROM (SELECT *, lag(close) OVER (PARTITION BY symbol, trade_date ORDER BY ts) AS before FROM {source}))"""


def _symbol_days(source: str) -> str:
    return f"""
  SELECT symbol, trade_date, count(*) AS bars, count(*) FILTER (WHERE is_valid) AS valid_bars,
         coalesce(max(gap) FILTER (WHERE is_valid), INTERVAL 0 SECOND) AS gap,
         count(*) FILTER (WHERE spike_flag) AS spikes,
         count(*) FILTER (WHERE NOT ohlc_valid) AS f1, count(*) FILTER (WHERE NOT price_valid) AS f2,
         count(*) FILTER (WHERE NOT volume_valid) AS f3, count(*) FILTER (WHERE NOT minute_boundary) AS f4
  FROM (SELECT *, ts - lag(ts) OVER (PARTITION BY symbol, trade_date, is_valid ORDER BY ts) AS gap FROM {source})
  GROUP BY symbol, trade_date"""


def _stats(source: str) -> str:
    return f"""
  SELECT trade_date, CASE WHEN n = 0 OR few THEN 'MISSING' ELSE 'COMPLETE' END AS status,
         CASE WHEN n = 0 THEN 'no_valid_candles'
              WHEN few THEN concat('insufficient_minutes (', n, ' < 80)') END AS reason,
         n AS minutes_count, symbols_count, quarantined, spikes_flagged, ohlc_failures, price_failures,
         volume_failures, boundary_failures, gap > INTERVAL 2 HOUR AS gap_flag
  FROM (SELECT *, n < 80 AND busiest < 20 AS few FROM (
    SELECT trade_date, CAST(sum(valid_bars) AS BIGINT) AS n, max(valid_bars) AS busiest,
           count(*) FILTER (WHERE valid_bars > 0) AS symbols_count,
           CAST(sum(bars - valid_bars) AS BIGINT) AS quarantined, CAST(sum(spikes) AS BIGINT) AS spikes_flagged,
           CAST(sum(f1) AS BIGINT) AS ohlc_failures, CAST(sum(f2) AS BIGINT) AS price_failures,
           CAST(sum(f3) AS BIGINT) AS volume_failures, CAST(sum(f4) AS BIGINT) AS boundary_failures,
           arg_min(gap, row(-valid_bars, symbol)) AS gap
    FROM {source} GROUP BY trade_date))"""


STATS_COLUMNS = (
    "trade_date, status, reason, minutes_count, symbols_count, quarantined, spikes_flagged, "
    "ohlc_failures, price_failures, volume_failures, boundary_failures, gap_flag"
)

CHAIN = f"""
WITH e AS (
  SELECT event_id, event_type, ts, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         day(ts + INTERVAL 5 HOUR) AS ld FROM events),
feed AS (
  SELECT CASE WHEN event_id % 101 = 0 AND NOT c THEN NULL ELSE event_type END AS symbol,
         CASE WHEN event_id % 83 = 0 AND NOT c THEN NULL ELSE ts END AS ts_utc,
         CASE WHEN event_id % 97 = 0 AND NOT c THEN -value ELSE value END AS price,
         CASE WHEN event_id % 89 = 0 AND NOT c THEN NULL
              WHEN event_id % 79 = 0 AND NOT c THEN -1 ELSE k END AS volume,
         'A' AS source_file
  FROM (SELECT *, (ld % 5 = 0 OR ld % 7 = 0) AS c FROM e)
  UNION ALL
  SELECT event_type, ts, CASE WHEN ld % 7 = 0 AND event_id % 5 = 0 THEN value + 1 ELSE value END, k, 'B'
  FROM e WHERE ld % 5 = 0 OR ld % 7 = 0),
ticks AS (
  SELECT symbol, ts_utc, ts_utc + INTERVAL 5 HOUR AS ts_local,
         CAST(ts_utc + INTERVAL 5 HOUR AS DATE) AS trade_date, price, volume, source_file FROM feed),
valid AS (SELECT * FROM ticks WHERE {USABLE}),
trades AS (SELECT DISTINCT symbol, trade_date, ts_utc, ts_local, price, volume FROM valid),
session AS (SELECT * FROM trades WHERE {_in_session("trade_date", "CAST(ts_local AS TIME)")}),
overridden AS (SELECT * FROM trades WHERE {_in_session("trade_date", "CAST(ts_local AS TIME)", "overrides")}),
candles AS ({_candles("session")}),
checked AS ({_checked("candles")}),
symbol_days AS ({_symbol_days("checked")}),
bar_stats AS ({_stats("symbol_days")}),
stats AS (
  SELECT trade_date, coalesce(status, 'MISSING') AS status,
         CASE WHEN status IS NULL THEN 'corrupt' ELSE reason END AS reason,
         coalesce(minutes_count, 0) AS minutes_count, coalesce(symbols_count, 0) AS symbols_count,
         coalesce(quarantined, 0) AS quarantined, coalesce(spikes_flagged, 0) AS spikes_flagged,
         coalesce(ohlc_failures, 0) AS ohlc_failures, coalesce(price_failures, 0) AS price_failures,
         coalesce(volume_failures, 0) AS volume_failures, coalesce(boundary_failures, 0) AS boundary_failures,
         coalesce(gap_flag, false) AS gap_flag
  FROM (SELECT DISTINCT trade_date FROM ticks WHERE trade_date IS NOT NULL) LEFT JOIN bar_stats USING (trade_date)),
complete AS (SELECT trade_date FROM stats WHERE status = 'COMPLETE'),
loaded AS (
  SELECT {CANDLE_COLUMNS}, spike_flag FROM checked
  WHERE is_valid AND trade_date IN (SELECT trade_date FROM complete)),
ruled AS (
  SELECT *, CASE WHEN minute(ts) % 17 = 0 THEN 1 WHEN minute(ts) % 19 = 0 THEN 2 WHEN minute(ts) % 23 = 0 THEN 3
                 WHEN minute(ts) % 29 = 0 THEN 4 WHEN minute(ts) % 31 = 0 THEN 5 ELSE 0 END AS rule
  FROM candles),
imported AS (
  SELECT symbol, trade_date, CASE WHEN rule = 4 THEN ts + INTERVAL 5 SECOND ELSE ts END AS ts, minute_local,
         CASE WHEN rule = 2 THEN -open ELSE open END AS open,
         CASE WHEN rule = 1 THEN low - 0.01 ELSE high END AS high, low,
         CASE WHEN rule <> 5 THEN close END AS close,
         CASE WHEN rule = 3 THEN -1 ELSE volume END AS volume, had_trade
  FROM ruled),
imported_checked AS ({_checked("imported")}),
imported_days AS ({_symbol_days("imported_checked")}),
imported_stats AS ({_stats("imported_days")}),
repeated AS (SELECT * FROM imported UNION ALL SELECT * FROM imported WHERE minute(ts) % 37 = 0),
copy_trades AS (SELECT DISTINCT symbol, trade_date, ts_utc, price, volume, source_file FROM valid),
copy_bars AS (
  SELECT trade_date, source_file, symbol, date_trunc('minute', ts_utc) AS ts,
         arg_min(price, row(ts_utc, price, volume)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, row(ts_utc, price, volume)) AS close, sum(volume) AS volume
  FROM copy_trades GROUP BY ALL),
copies AS (
  SELECT trade_date, count(DISTINCT source_file) AS n_copies, min(source_file) AS first_source
  FROM copy_trades GROUP BY trade_date HAVING count(DISTINCT source_file) > 1),
copy_minutes AS (
  SELECT trade_date, symbol, ts, n_copies, first_source, count(*) AS copies_present,
         count(DISTINCT row(open, high, low, close, volume)) > 1 AS values_differ
  FROM copy_bars JOIN copies USING (trade_date) GROUP BY ALL),
verdicts AS (
  SELECT trade_date, n_copies, first_source,
         count(*) FILTER (WHERE copies_present < n_copies OR values_differ) AS disagreeing
  FROM copy_minutes GROUP BY ALL),
span AS (
  SELECT min(CAST(ts + INTERVAL 5 HOUR AS DATE)) AS first_day, max(CAST(ts + INTERVAL 5 HOUR AS DATE)) AS last_day
  FROM events),
expected AS (
  SELECT CAST(d AS DATE) AS trade_date
  FROM (SELECT unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY)) AS d
        FROM span)
  WHERE isodow(d) <= 5 AND CAST(d AS DATE) NOT IN (DATE '2024-01-05', DATE '2024-01-15', DATE '2024-01-20')),
own_status AS (
  SELECT symbol, trade_date, 'COMPLETE' AS status, CAST(NULL AS VARCHAR) AS reason, count(*) AS minutes_count,
         min(ts) AS first_ts, max(ts) AS last_ts, TIMESTAMP '2024-02-01 00:00:00' AS built_at
  FROM loaded GROUP BY symbol, trade_date),
market_status AS (
  SELECT '*' AS symbol, trade_date, status, reason, CAST(0 AS BIGINT) AS minutes_count,
         CAST(NULL AS TIMESTAMP) AS first_ts, CAST(NULL AS TIMESTAMP) AS last_ts,
         TIMESTAMP '2024-02-01 00:00:00' AS built_at
  FROM stats WHERE status <> 'COMPLETE'),
all_status AS (SELECT * FROM own_status UNION ALL SELECT * FROM market_status),
candle_status AS (
  SELECT symbol, trade_date, count(*) AS minutes_count, min(ts) AS first_ts, max(ts) AS last_ts
  FROM candles GROUP BY symbol, trade_date),
cover AS (
  SELECT trade_date, dayname(trade_date) AS day_of_week, coalesce(status, 'MISSING') AS status,
         CASE WHEN status IS NULL THEN 'absent' ELSE reason END AS reason,
         coalesce(minutes_count, 0) AS minutes_count, coalesce(symbols_count, 0) AS symbols_count
  FROM expected LEFT JOIN stats USING (trade_date)),
cover_totals AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE status = 'COMPLETE') AS complete,
         count(*) FILTER (WHERE status = 'MISSING') AS missing,
         count(*) FILTER (WHERE status = 'CONFLICT') AS conflict FROM cover),
daily AS (
  SELECT symbol, trade_date, arg_min(open, ts) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, ts) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS minutes_count
  FROM loaded GROUP BY symbol, trade_date)
"""


def _stored(select: str) -> str:
    return CHAIN + select


def _parsed(expression: str) -> str:
    return f"""
SELECT event_id, t AS ts_utc, t + INTERVAL 5 HOUR AS ts_local, CAST(t + INTERVAL 5 HOUR AS DATE) AS trade_date
FROM (SELECT event_id, CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 THEN NULL
                            ELSE {expression} END AS t FROM events)"""


def _rollup(minutes: int) -> str:
    return _stored(f"""
SELECT symbol, trade_date, bucket - INTERVAL 5 HOUR AS ts, arg_min(open, ts) AS open, max(high) AS high,
       min(low) AS low, arg_max(close, ts) AS close, CAST(sum(volume) AS BIGINT) AS volume
FROM (SELECT *, time_bucket(INTERVAL {minutes} MINUTE, minute_local) AS bucket FROM candles)
GROUP BY symbol, trade_date, bucket""")


SCANNED = _stored("SELECT symbol, ts_utc, ts_local, trade_date, price, volume FROM ticks")
TICKS = _stored(f"SELECT {TICK_COLUMNS} FROM ticks")
SYMBOL_VERDICTS = """
, symbol_copies AS (
  SELECT trade_date, symbol, count(DISTINCT source_file) AS n_copies, min(source_file) AS first_source
  FROM copy_trades GROUP BY trade_date, symbol HAVING count(DISTINCT source_file) > 1),
symbol_verdicts AS (
  SELECT trade_date, symbol, n_copies, first_source,
         count(*) FILTER (WHERE present < n_copies OR kinds > 1) AS disagreeing
  FROM (SELECT trade_date, symbol, ts, count(*) AS present, count(DISTINCT row(open, high, low, close, volume)) AS kinds
        FROM copy_bars GROUP BY ALL) JOIN symbol_copies USING (trade_date, symbol)
  GROUP BY ALL)"""
#: What is left after file A came again with the days up to the 15th.
FEWER = "source_file = 'B' OR day(CAST(ts_utc + INTERVAL 5 HOUR AS DATE)) <= 15"

ORACLE: dict[str, str] = {
    "ts_epoch_s": _parsed("date_trunc('second', ts)"),
    "ts_epoch_ms": _parsed("date_trunc('millisecond', ts)"),
    "ts_naive_utc": _parsed("CASE WHEN event_id % 11 <> 0 THEN date_trunc('second', ts) END"),
    "ts_naive_local": _parsed("date_trunc('second', ts)"),
    "ts_iso": _parsed("ts"),
    "ts_auto": _parsed(
        "CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('millisecond', ts) "
        "WHEN 2 THEN date_trunc('second', ts) ELSE ts END"
    ),
    "tz_selftest": """
SELECT CAST(ts + INTERVAL 5 HOUR AS DATE) AS trade_date, count(*) AS n_ticks,
       CAST(18000 AS BIGINT) AS min_offset, CAST(18000 AS BIGINT) AS max_offset, true AS passed
FROM events GROUP BY 1""",
    "file_date": """
SELECT event_id, source_file,
       CASE WHEN length(digits) >= 8
            THEN CAST(try_strptime(right(digits, 8), '%Y%m%d') AS DATE) END AS file_date
FROM (SELECT *, regexp_replace(regexp_extract(source_file, '([^/]*)\\.[a-z]+$', 1), '[^0-9]', '', 'g') AS digits
      FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN concat('/landing/ticks_', day, '.db')
                                 WHEN 1 THEN concat('1m_', day, '.csv')
                                 WHEN 2 THEN concat('ticks_', day, '_v2.db') ELSE 'ticks.csv' END AS source_file
            FROM (SELECT event_id, strftime(ts, '%Y%m%d') AS day FROM events)))""",
    "scan_csv_ticks": SCANNED,
    "scan_sqlite_ticks": SCANNED,
    "normalise_ticks": TICKS,
    "coerce_ticks": """
SELECT event_id,
       CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL ELSE value END AS price,
       CASE WHEN event_id % 5 = 0 OR event_id % 17 = 0 THEN NULL
            ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS volume
FROM events""",
    "merge_sources": TICKS,
    "ticks_for_dates": _stored(
        f"SELECT {TICK_COLUMNS} FROM ticks "
        "WHERE trade_date IN (DATE '2024-01-05', DATE '2024-01-14', DATE '2024-01-23')"
    ),
    "date_window": _stored("""
SELECT symbol, ts_utc, ts_local, trade_date, price, volume,
       CASE WHEN source_file = 'A' THEN 'ticks_20240110.csv' ELSE 'ticks_20240118.csv' END AS source_file
FROM ticks WHERE trade_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-19'"""),
    "archive_roundtrip": TICKS,
    "archive_same_name": _stored(f"""
SELECT symbol, ts_utc, ts_local, trade_date, price, volume, 'ticks.csv' AS source_file,
       concat('/landing/', source_file, '/ticks.csv') AS source_path
FROM ticks WHERE {FEWER}"""),
    "replay_after_stop": CHAIN.replace("FROM feed)", f"FROM feed WHERE {FEWER})") + f"SELECT {CANDLE_COLUMNS}, spike_flag FROM loaded",
    "archive_replace": _stored(f"SELECT {TICK_COLUMNS} FROM ticks WHERE source_file = 'B' OR day(trade_date) <= 15"),
    "stale_days": _stored("""
SELECT trade_date, count(*) AS n_rows FROM ticks
WHERE trade_date NOT BETWEEN DATE '2024-01-03' AND DATE '2024-01-19' GROUP BY trade_date"""),
    "drop_invalid": _stored(f"SELECT {TICK_COLUMNS} FROM valid"),
    "rejected_ticks": _stored(f"""
SELECT {TICK_COLUMNS},
       CASE WHEN ts_utc IS NULL THEN 'no_timestamp' WHEN price IS NULL OR isnan(price) THEN 'no_price'
            WHEN volume IS NULL THEN 'no_volume' WHEN symbol IS NULL THEN 'no_symbol'
            WHEN price <= 0 THEN 'price_not_positive' ELSE 'volume_negative' END AS defect
FROM ticks WHERE NOT coalesce({USABLE}, false)"""),
    "dedup_ticks": _stored("SELECT symbol, trade_date, ts_utc, price, volume FROM trades"),
    "session_filter": _stored(
        f"SELECT {TICK_COLUMNS} FROM valid "
        f"WHERE {_in_session('trade_date', 'CAST(ts_local AS TIME)', 'overrides')}"
    ),
    "session_windows": _stored("""
SELECT trade_date, w.n AS window_no, w.a AS start_second, w.b AS end_second FROM (
  SELECT trade_date, unnest(
    CASE WHEN isodow(trade_date) = 5
         THEN [{'n': 1, 'a': 33300, 'b': 43200}, {'n': 2, 'a': 50400, 'b': 59400}]
         WHEN trade_date BETWEEN DATE '2024-01-09' AND DATE '2024-01-12' THEN [{'n': 1, 'a': 36000, 'b': 46800}]
         ELSE [{'n': 1, 'a': 34200, 'b': 55800}] END) AS w
  FROM (SELECT DISTINCT trade_date FROM ticks WHERE trade_date IS NOT NULL))"""),
    "tick_spikes": _stored(f"""
SELECT symbol, trade_date, ts_utc, price, volume, {_moved("price", "before")} AS spike_flag
FROM (SELECT *, lag(price) OVER (PARTITION BY symbol, trade_date ORDER BY ts_utc, price, volume) AS before
      FROM session)"""),
    "clean_ticks": _stored(f"""
SELECT symbol, trade_date, ts_utc, ts_local, price, volume, {_moved("price", "before")} AS spike_flag
FROM (SELECT *, lag(price) OVER (PARTITION BY symbol, trade_date ORDER BY ts_utc, price, volume) AS before
      FROM overridden)"""),
    "clean_stats": _stored(f"""
SELECT trade_date, coalesce(input_rows, 0) AS input_rows, coercion_failures, invalid_dropped,
       usable_rows - coalesce(n_trades, 0) AS duplicates_dropped,
       coalesce(n_trades, 0) - coalesce(n_session, 0) AS out_of_session_dropped,
       coalesce(n_spikes, 0) AS spikes_flagged, coalesce(n_session, 0) AS output_rows
FROM (SELECT trade_date, count(*) AS input_rows, count(*) FILTER (WHERE {FAILED}) AS coercion_failures,
             count(*) FILTER (WHERE NOT coalesce({USABLE}, false)) AS invalid_dropped,
             count(*) FILTER (WHERE {USABLE}) AS usable_rows FROM ticks GROUP BY trade_date) a
LEFT JOIN (SELECT trade_date, count(*) AS n_trades FROM trades GROUP BY trade_date) b USING (trade_date)
LEFT JOIN (SELECT trade_date, count(*) AS n_session, count(*) FILTER (WHERE {_moved("price", "before")}) AS n_spikes
           FROM (SELECT *, lag(price) OVER (PARTITION BY symbol, trade_date ORDER BY ts_utc, price, volume) AS before
                 FROM session) GROUP BY trade_date) c USING (trade_date)"""),
    "candles_1m": _stored(f"SELECT {CANDLE_COLUMNS} FROM candles"),
    "bars_5m": _rollup(5),
    "bars_15m": _rollup(15),
    "bars_5m_dst": """
WITH moved AS (
  SELECT *, CASE WHEN ts_utc < TIMESTAMP '2024-11-03 06:00:00' THEN INTERVAL 4 HOUR ELSE INTERVAL 5 HOUR END AS behind
  FROM (SELECT event_type AS symbol, ts + INTERVAL 300 DAY AS ts_utc, value AS price,
               CAST(json_extract(props, '$.k') AS BIGINT) AS volume FROM events))
SELECT symbol, trade_date, bucket AS ts, arg_min(price, row(ts_utc, price, volume)) AS open, max(price) AS high,
       min(price) AS low, arg_max(price, row(ts_utc, price, volume)) AS close, CAST(sum(volume) AS BIGINT) AS volume
FROM (SELECT *, CAST(ts_utc - behind AS DATE) AS trade_date,
             date_trunc('minute', ts_utc) - to_minutes(minute(ts_utc - behind) % 5) AS bucket FROM moved)
GROUP BY symbol, trade_date, bucket""",
    "daily_bars": _stored("SELECT *, 'COMPLETE' AS status FROM daily"),
    "flat_fill": _stored("""
, windows AS (
  SELECT symbol, trade_date, first_minute, unnest(
    CASE WHEN isodow(trade_date) = 5 THEN [{'a': 33300, 'b': 43140}, {'a': 50400, 'b': 59340}]
         ELSE [{'a': 34200, 'b': 55740}] END) AS w
  FROM (SELECT symbol, trade_date, min(minute_local) AS first_minute FROM loaded GROUP BY symbol, trade_date)),
slots AS (
  SELECT symbol, trade_date, m AS minute_local FROM (
    SELECT symbol, trade_date, first_minute,
           unnest(generate_series(CAST(trade_date AS TIMESTAMP) + to_seconds(w.a),
                                  CAST(trade_date AS TIMESTAMP) + to_seconds(w.b), INTERVAL 1 MINUTE)) AS m
    FROM windows) WHERE m >= first_minute
  UNION SELECT symbol, trade_date, minute_local FROM loaded),
filled AS (
  SELECT symbol, trade_date, minute_local, open, high, low, close, volume,
         last_value(close IGNORE NULLS) OVER (PARTITION BY symbol, trade_date ORDER BY minute_local
                                              ROWS UNBOUNDED PRECEDING) AS carried
  FROM slots LEFT JOIN loaded USING (symbol, trade_date, minute_local))
SELECT symbol, trade_date, minute_local - INTERVAL 5 HOUR AS ts, minute_local, coalesce(open, carried) AS open,
       coalesce(high, carried) AS high, coalesce(low, carried) AS low, coalesce(close, carried) AS close,
       coalesce(volume, 0) AS volume, close IS NOT NULL AS had_trade
FROM filled"""),
    "carry_close": _stored("""
, grid AS (
  SELECT symbol, trade_date FROM (SELECT symbol, min(trade_date) AS first_day FROM daily GROUP BY symbol)
  JOIN expected ON trade_date >= first_day
  UNION SELECT symbol, trade_date FROM daily)
SELECT symbol, trade_date, coalesce(status, 'MISSING') AS status, open, high, low, close, volume,
       last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY trade_date
                                            ROWS UNBOUNDED PRECEDING) AS mark_close
FROM grid LEFT JOIN daily USING (symbol, trade_date)
LEFT JOIN (SELECT trade_date, status FROM stats) USING (trade_date)"""),
    "validate_candles": _stored(f"""
SELECT {CANDLE_COLUMNS}, ohlc_valid, price_valid, volume_valid, minute_boundary, is_valid, spike_flag
FROM imported_checked"""),
    "candle_spikes": _stored(f"SELECT {CANDLE_COLUMNS}, spike_flag FROM checked"),
    "quarantine": _stored(f"""
SELECT {CANDLE_COLUMNS}, spike_flag, trade_date AS quarantine_date FROM imported_checked WHERE NOT is_valid"""),
    "day_stats": _stored(f"SELECT {STATS_COLUMNS} FROM imported_stats"),
    "gap_flag_sessions": _stored("""
, open_gaps AS (
  SELECT symbol, trade_date, is_valid,
         CASE WHEN a IS NULL THEN NULL
              WHEN isodow(trade_date) = 5
              THEN greatest(0, least(b, 12 * 3600) - greatest(a, 9 * 3600 + 900))
                   + greatest(0, least(b, 16 * 3600 + 1800) - greatest(a, 14 * 3600))
              ELSE greatest(0, least(b, 15 * 3600 + 1800) - greatest(a, 9 * 3600 + 1800)) END AS gap
  FROM (SELECT *, epoch(minute_local) - epoch(trade_date) AS b,
               lag(epoch(minute_local) - epoch(trade_date)) OVER (PARTITION BY symbol, trade_date, is_valid ORDER BY ts) AS a
        FROM imported_checked)),
open_days AS (
  SELECT symbol, trade_date, count(*) FILTER (WHERE is_valid) AS valid_bars, coalesce(max(gap) FILTER (WHERE is_valid), 0) AS gap
  FROM open_gaps GROUP BY symbol, trade_date)
SELECT trade_date, arg_min(symbol, row(-valid_bars, symbol)) AS top_symbol,
       CAST(arg_min(gap, row(-valid_bars, symbol)) AS BIGINT) AS longest_gap_seconds,
       arg_min(gap, row(-valid_bars, symbol)) > 7200 AS gap_flag
FROM open_days WHERE valid_bars > 0 GROUP BY trade_date"""),
    "day_minutes": _stored("""
, marked AS (SELECT symbol, trade_date, hour(minute_local) * 60 + minute(minute_local) AS m FROM candles),
market AS (SELECT trade_date, count(DISTINCT m) AS n FROM marked GROUP BY trade_date),
counted AS (
  SELECT symbol, trade_date, count(DISTINCT m) AS k FROM marked GROUP BY symbol, trade_date
  UNION ALL SELECT '*', trade_date, n FROM market)
SELECT symbol, trade_date, k AS distinct_minutes, k / n AS share,
       CASE WHEN k < 40 THEN 'below' WHEN k > 60 THEN 'above' ELSE 'within' END AS band
FROM counted JOIN market USING (trade_date)"""),
    "guarded_upsert": _stored(f"""
, given AS (
  SELECT symbol, trade_date, ts, minute_local, open, high, low, close,
         CASE WHEN minute(ts) % 11 = 0 THEN 0 ELSE volume END AS volume, had_trade FROM repeated),
counted AS (SELECT *, count(*) FILTER (WHERE close IS NOT NULL) OVER (PARTITION BY symbol, ts) AS n FROM given)
SELECT {CANDLE_COLUMNS}, CASE WHEN close IS NULL THEN 'null_close' WHEN n > 1 THEN 'repeated_key' END AS rule FROM counted"""),
    "replication_audit_symbols": _stored(SYMBOL_VERDICTS + """
SELECT trade_date, symbol, n_copies, CASE WHEN disagreeing = 0 THEN 'collapsed_identical' ELSE 'CONFLICT' END AS action,
       CASE WHEN disagreeing = 0 THEN '' ELSE concat(disagreeing, ' minute(s) disagree') END AS detail,
       CASE WHEN disagreeing = 0 THEN first_source END AS kept_source FROM symbol_verdicts"""),
    "collapse_copies_symbols": _stored(SYMBOL_VERDICTS + f"""
SELECT {TICK_COLUMNS} FROM ticks LEFT JOIN symbol_verdicts USING (trade_date, symbol)
WHERE trade_date IS NOT NULL AND (disagreeing IS NULL OR (disagreeing = 0 AND source_file = first_source))"""),
    "gap_flag": _stored("""
SELECT trade_date, arg_min(symbol, row(-valid_bars, symbol)) AS top_symbol,
       CAST(epoch(arg_min(gap, row(-valid_bars, symbol))) AS BIGINT) AS longest_gap_seconds,
       arg_min(gap, row(-valid_bars, symbol)) > INTERVAL 2 HOUR AS gap_flag
FROM imported_days WHERE valid_bars > 0 GROUP BY trade_date"""),
    "top_symbol": _stored("""
SELECT trade_date, arg_min(symbol, row(-n, symbol)) AS top_symbol, max(n) AS minutes_count
FROM (SELECT trade_date, symbol, count(*) AS n FROM candles GROUP BY trade_date, symbol) GROUP BY trade_date"""),
    "duplicate_keys": _stored("""
SELECT symbol, ts, count(*) AS n FROM repeated GROUP BY symbol, ts HAVING count(*) > 1"""),
    "constraint_violations": _stored("""
SELECT symbol, ts, 'duplicate_key' AS violation, count(*) AS n_rows FROM repeated
GROUP BY symbol, ts HAVING count(*) > 1
UNION ALL
SELECT symbol, ts, 'null_close', count(*) FROM repeated WHERE close IS NULL GROUP BY symbol, ts"""),
    "validation_report": _stored(f"SELECT {STATS_COLUMNS} FROM stats"),
    "duplicate_days": _stored("""
SELECT trade_date, count(DISTINCT source_file) AS n_copies FROM ticks WHERE trade_date IS NOT NULL
GROUP BY trade_date HAVING count(DISTINCT source_file) > 1"""),
    "replication_diff": _stored("""
SELECT trade_date, symbol, ts, n_copies, copies_present, values_differ FROM copy_minutes
WHERE copies_present < n_copies OR values_differ"""),
    "replication_audit": _stored("""
SELECT trade_date, n_copies, CASE WHEN disagreeing = 0 THEN 'collapsed_identical' ELSE 'CONFLICT' END AS action,
       CASE WHEN disagreeing = 0 THEN '' ELSE concat(disagreeing, ' minute(s) disagree') END AS detail,
       CASE WHEN disagreeing = 0 THEN first_source END AS kept_source FROM verdicts"""),
    "drop_conflicts": _stored(f"""
SELECT {TICK_COLUMNS} FROM ticks WHERE trade_date IS NOT NULL
AND trade_date NOT IN (SELECT trade_date FROM verdicts WHERE disagreeing > 0)"""),
    "collapse_copies": _stored(f"""
SELECT {TICK_COLUMNS} FROM ticks LEFT JOIN verdicts USING (trade_date) WHERE trade_date IS NOT NULL
AND (disagreeing IS NULL OR (disagreeing = 0 AND source_file = first_source))"""),
    "loadable_candles": _stored(f"SELECT {CANDLE_COLUMNS}, spike_flag FROM loaded"),
    "symbol_day_status": _stored("SELECT * FROM own_status"),
    "classified_days": _stored("""
SELECT * EXCLUDE (contradicted)
         REPLACE (CASE WHEN contradicted THEN 'CONFLICT' ELSE status END AS status,
                  CASE WHEN contradicted THEN 'conflict' ELSE reason END AS reason)
FROM (SELECT *, trade_date IN (SELECT trade_date FROM verdicts WHERE disagreeing > 0) AS contradicted FROM stats)"""),
    "expected_days": _stored("SELECT trade_date FROM expected"),
    "coverage": _stored("SELECT * FROM cover"),
    "coverage_csv": _stored("SELECT * FROM cover"),
    "coverage_summary": _stored("SELECT * FROM cover_totals"),
    "run_summary": _stored("""
SELECT (SELECT min(trade_date) FROM expected) AS first_date, (SELECT max(trade_date) FROM expected) AS last_date,
       total, complete, missing, conflict, (SELECT count(*) FROM loaded) AS n_candles,
       (SELECT count(DISTINCT symbol) FROM loaded) AS n_symbols FROM cover_totals"""),
    "candle_count": _stored("SELECT count(*) AS n_candles FROM loaded"),
    "day_status_summary": _stored(
        "SELECT status, count(DISTINCT trade_date) AS n_dates FROM all_status GROUP BY status"
    ),
    "absent_days": _stored("""
SELECT '*' AS symbol, trade_date, 'MISSING' AS status,
       CASE WHEN trade_date IN (SELECT trade_date FROM stats WHERE day(trade_date) % 2 = 0) THEN 'ingest_failed'
            ELSE 'scrape_failed' END AS reason, CAST(0 AS BIGINT) AS minutes_count,
       CAST(NULL AS TIMESTAMP) AS first_ts, CAST(NULL AS TIMESTAMP) AS last_ts,
       TIMESTAMP '2024-02-01 00:00:00' AS built_at
FROM expected WHERE trade_date NOT IN (SELECT trade_date FROM stats WHERE day(trade_date) % 3 = 0)"""),
    "upsert_last_wins": _stored("""
SELECT symbol, trade_date, ts, minute_local, open, high, low, close,
       volume + CASE WHEN minute(ts) % 2 = 0 THEN 1 ELSE 0 END AS volume, had_trade, spike_flag
FROM checked"""),
    "upsert_candles": _stored(f"""
SELECT symbol, trade_date, ts, minute_local, open, high, low, close,
       CASE WHEN day(trade_date) < 8 THEN volume + 1 ELSE volume END AS volume, had_trade, spike_flag
FROM checked"""),
    "upsert_day_status": _stored("""
SELECT symbol, trade_date, 'COMPLETE' AS status, CAST(NULL AS VARCHAR) AS reason,
       CASE WHEN day(trade_date) < 8 THEN 5 ELSE minutes_count END AS minutes_count, first_ts, last_ts,
       CASE WHEN day(trade_date) < 8 THEN TIMESTAMP '2024-02-01 00:00:00'
            ELSE TIMESTAMP '2024-02-02 00:00:00' END AS built_at
FROM candle_status"""),
    "upsert_partial": _stored("""
SELECT symbol, trade_date, CASE WHEN d >= 15 THEN 'MISSING' ELSE 'COMPLETE' END AS status,
       CASE WHEN d >= 15 THEN 'corrupt' END AS reason,
       CAST(CASE WHEN d <= 20 THEN 5 ELSE 0 END AS BIGINT) AS minutes_count,
       CASE WHEN d <= 20 THEN first_ts END AS first_ts, CASE WHEN d <= 20 THEN last_ts END AS last_ts,
       CASE WHEN d >= 15 THEN TIMESTAMP '2024-02-02 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS built_at
FROM (SELECT *, day(trade_date) AS d FROM candle_status)"""),
    "candle_csv_roundtrip": _stored(
        "SELECT symbol, minute_local, ts, open, high, low, close, volume, had_trade FROM loaded"
    ),
    "backfill_candles": _stored(f"SELECT {CANDLE_COLUMNS}, spike_flag FROM loaded"),
    "incremental_update": _stored("SELECT * FROM all_status"),
}
