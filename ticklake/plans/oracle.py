"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The driver registers the raw tables as views; every statement rebuilds the
same projections as ``ticklake.sources`` in SQL and then states the
operator plainly (ordinary window functions, joins, aggregates), so it is
an independent formulation of the same semantics.
"""

from __future__ import annotations

# ---- projections (FIXTURES.md §2) -----------------------------------------
_MESSAGES = """messages AS (
  SELECT CAST(event_id AS VARCHAR) AS trade_id, event_type AS instrument, ts AS timestamp,
         value AS price, CAST(1 + event_id % 97 AS DOUBLE) AS volume,
         CASE WHEN event_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side,
         event_id AS sequence_id,
         CASE event_id % 10 WHEN 0 THEN 'A' WHEN 1 THEN 'C' ELSE 'T' END AS msg_type
  FROM events)"""
_TRADES = """trades AS (
  SELECT trade_id, instrument, timestamp, price, volume, side, sequence_id
  FROM messages WHERE msg_type = 'T')"""
_TRADES_DUP = """trades_dup AS (
  SELECT * FROM trades UNION ALL
  SELECT 'D' || trade_id, instrument, timestamp, price, volume, side, sequence_id + 1000000000
  FROM trades WHERE sequence_id % 20 = 2)"""
_MESSAGES_BAD = """messages_bad AS (
  SELECT trade_id, instrument,
         CASE WHEN sequence_id % 50 = 2 THEN timestamp + INTERVAL 1000 DAY ELSE timestamp END AS timestamp,
         CASE WHEN sequence_id % 50 = 3 THEN -10.5 ELSE price END AS price,
         CASE WHEN sequence_id % 50 = 4 THEN 0.0 ELSE volume END AS volume,
         side, sequence_id, msg_type
  FROM messages)"""
_TRADES_RT = """trades_rt AS (
  SELECT trade_id, instrument, timestamp,
         CASE WHEN sequence_id % 41 = 0 THEN price * 1.5 ELSE price END AS price,
         volume, side, sequence_id
  FROM trades WHERE sequence_id % 40 <> 2)"""


def _line(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return (f"concat_ws(',', coalesce({a}trade_id, ''), coalesce({a}instrument, ''), "
            f"coalesce(CAST(epoch_us({a}timestamp) AS VARCHAR), ''), "
            f"coalesce(printf('%.2f', {a}price), ''), coalesce(CAST({a}volume AS VARCHAR), ''), "
            f"coalesce({a}side, ''), coalesce({a}msg_type, 'T'))")


def _raw(src: str) -> str:
    """The wire lines of a message table with their faults, as text."""
    start = "concat_ws(',', trade_id, instrument)"
    fields = ("coalesce(CAST(epoch_us(timestamp) AS VARCHAR), ''), {p}, {v}, coalesce(side, ''), coalesce(msg_type, 'T')")
    price, volume = "coalesce(printf('%.2f', price), '')", "coalesce(CAST(volume AS VARCHAR), '')"
    odd = lambda p, v: f"concat_ws(',', trade_id, instrument, {fields.format(p=p, v=v)})"
    return f"""SELECT sequence_id, instrument AS k,
         CASE sequence_id % 50 WHEN 5 THEN {start} WHEN 16 THEN {start} || chr(65533)
           WHEN 12 THEN {odd("'1.5d'", volume)} WHEN 13 THEN {odd("'0x1p3'", volume)}
           WHEN 14 THEN {odd("'NaN'", volume)} WHEN 15 THEN {odd(price, "'inf'")}
           ELSE {_line()} END AS raw
  FROM {src}"""


_PARSE = """parsed AS (
  SELECT sequence_id, raw, p[1] AS msg_id, p[2] AS instrument,
         TRY_CAST(p[3] AS BIGINT) AS ts_micros, TRY_CAST(p[4] AS DOUBLE) AS price,
         TRY_CAST(p[5] AS DOUBLE) AS volume, p[6] AS side, coalesce(p[7], 'T') AS msg_type,
         (len(p) >= 7 AND coalesce(p[7] <> 'T', true)) AS skipped
  FROM (SELECT sequence_id, raw, string_split(raw, ',') AS p FROM wire)),
checked AS (
  SELECT *, CASE WHEN skipped THEN NULL
                 WHEN ts_micros IS NULL OR price IS NULL OR volume IS NULL THEN 'parse_error'
                 WHEN price <= 0 THEN 'negative_price'
                 WHEN volume <= 0 THEN 'zero_volume'
                 WHEN ts_micros > 1767225600000000 THEN 'future_timestamp'
                 WHEN NOT isfinite(price) OR NOT isfinite(volume) THEN 'non_finite' END AS error
  FROM parsed),
decoded AS (
  SELECT sequence_id, raw, msg_id, instrument, ts_micros, price, volume, side, msg_type, error
  FROM checked WHERE NOT skipped)"""
_WIRE = f"wire AS ({_raw('messages_bad')}),\n{_PARSE}"
_LOG = f"""messages_log AS (
  SELECT 'POW-' || lpad(trade_id, 9, '0') AS trade_id, instrument, date_trunc('hour', timestamp) AS timestamp,
         price, volume, side, sequence_id, msg_type FROM messages_bad),
wire AS ({_raw('messages_log')}),
{_PARSE}"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (_MESSAGES, _TRADES)


def _candles(src: str, seconds: int, label: str, realtime: bool, ts: str = "timestamp",
             ok: str = "CAST(epoch_us(timestamp) AS HUGEINT) * 100000000000000000000 + sequence_id") -> str:
    iv = f"INTERVAL '{seconds} seconds'"
    return f"""SELECT instrument, '{label}' AS window_size, time_bucket({iv}, {ts}) AS window_start,
       time_bucket({iv}, {ts}) + {iv} AS window_end,
       arg_min(price, ok) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, ok) AS close, sum(volume) AS volume, count(*) AS trade_count,
       {str(realtime).lower()} AS is_realtime
FROM (SELECT *, {ok} AS ok FROM {src}) GROUP BY instrument, time_bucket({iv}, {ts})"""


def _all_sizes(src: str, realtime: bool) -> str:
    return "\nUNION ALL\n".join(_candles(src, s, lbl, realtime)
                                for s, lbl in ((1, "1s"), (10, "10s"), (60, "1m")))


_PREV = """prev AS (
  SELECT *, lag(timestamp) OVER (PARTITION BY instrument ORDER BY timestamp, sequence_id) AS prev_time
  FROM trades),
gapped AS (
  SELECT *, (epoch_us(timestamp) - epoch_us(prev_time)) // 1000 AS gap_ms FROM prev)"""
_LEVELS = "(VALUES ('HFT', 500.0::DOUBLE), ('Fast', 5000.0::DOUBLE), ('Standard', 30000.0::DOUBLE)) AS lv(threshold_name, threshold_ms)"
_GAPS = f"""gaps AS (
  SELECT instrument, prev_time AS gap_start, timestamp AS gap_end, gap_ms,
         gap_ms / 1000.0 AS gap_seconds, threshold_name, threshold_ms
  FROM gapped JOIN {_LEVELS} ON gapped.gap_ms > lv.threshold_ms)"""


def _outliers_cte(src: str, name: str = "ol") -> str:
    return f"""{name}_w AS (
  SELECT *, CASE WHEN count(price) OVER w = 50 THEN avg(price) OVER w END AS rolling_avg
  FROM {src}
  WINDOW w AS (PARTITION BY instrument ORDER BY timestamp, sequence_id
               ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)),
{name} AS (
  SELECT trade_id, instrument, timestamp, price, rolling_avg,
         abs(price - rolling_avg) / NULLIF(rolling_avg, 0) AS deviation_pct,
         volume, side, 'fat_finger' AS outlier_type, 50 AS window_size, 0.05::DOUBLE AS threshold_pct
  FROM {name}_w
  WHERE rolling_avg IS NOT NULL AND abs(price - rolling_avg) / NULLIF(rolling_avg, 0) > 0.05)"""


_NUMBERED = """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY timestamp, instrument, price, volume, side
                               ORDER BY sequence_id, trade_id) AS row_num
  FROM trades_dup)"""
_CLEAN = """clean AS (
  SELECT trade_id, instrument, timestamp, price, volume, side, sequence_id FROM numbered n
  WHERE row_num = 1 AND trade_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM old o WHERE o.trade_id = n.trade_id))"""
_QBASE = (_MESSAGES, _TRADES, _TRADES_DUP, _NUMBERED, _outliers_cte("trades_dup", "old"), _CLEAN)

_DRIFT = f"""rt AS ({_all_sizes('trades_rt', True)}),
bt AS ({_all_sizes('trades', False)}),
dr AS (
  SELECT coalesce(r.instrument, b.instrument) AS instrument,
         coalesce(r.window_start, b.window_start) AS window_start,
         coalesce(r.window_size, b.window_size) AS window_size,
         r.window_end, r.open, r.high, r.low, r.close, r.volume, r.trade_count, r.is_realtime,
         b.window_end AS window_end_batch, b.open AS open_batch, b.high AS high_batch,
         b.low AS low_batch, b.close AS close_batch, b.volume AS volume_batch,
         b.trade_count AS trade_count_batch, b.is_realtime AS is_realtime_batch,
         r.close IS NULL AS missing_realtime, b.close IS NULL AS missing_batch,
         (r.open - b.open) / NULLIF(b.open, 0) * 100 AS open_drift_pct,
         (r.high - b.high) / NULLIF(b.high, 0) * 100 AS high_drift_pct,
         (r.low - b.low) / NULLIF(b.low, 0) * 100 AS low_drift_pct,
         (r.close - b.close) / NULLIF(b.close, 0) * 100 AS close_drift_pct,
         (r.volume - b.volume) / NULLIF(b.volume, 0) * 100 AS volume_drift_pct,
         r.trade_count - b.trade_count AS trade_count_diff
  FROM rt r FULL OUTER JOIN bt b
    ON r.instrument = b.instrument AND r.window_start = b.window_start AND r.window_size = b.window_size)"""
_DRIFT_BASE = (_MESSAGES, _TRADES, _TRADES_RT, _DRIFT)
_REPORT = """rep0 AS (
  SELECT count(*) AS total_candles,
         CAST(count_if(missing_realtime) AS BIGINT) AS missing_in_realtime,
         CAST(count_if(missing_batch) AS BIGINT) AS missing_in_batch,
         CAST(count_if(NOT missing_realtime AND NOT missing_batch) AS BIGINT) AS matched_candles,
         avg(CASE WHEN NOT missing_realtime AND NOT missing_batch THEN close_drift_pct END) AS close_drift_mean_pct,
         max(abs(CASE WHEN NOT missing_realtime AND NOT missing_batch THEN close_drift_pct END)) AS close_drift_max_pct,
         stddev_samp(CASE WHEN NOT missing_realtime AND NOT missing_batch THEN close_drift_pct END) AS close_drift_std_pct,
         avg(CASE WHEN NOT missing_realtime AND NOT missing_batch THEN volume_drift_pct END) AS volume_drift_mean_pct,
         max(abs(CASE WHEN NOT missing_realtime AND NOT missing_batch THEN volume_drift_pct END)) AS volume_drift_max_pct,
         CAST(count_if(NOT missing_realtime AND NOT missing_batch AND trade_count_diff <> 0) AS BIGINT) AS candles_with_trade_diff,
         avg(CASE WHEN NOT missing_realtime AND NOT missing_batch THEN trade_count_diff END) AS trade_count_diff_mean
  FROM dr),
rep AS (
  SELECT total_candles, missing_in_realtime,
         coalesce(CAST(missing_in_realtime AS DOUBLE) * 100.0 / NULLIF(total_candles, 0), 0.0) AS missing_in_realtime_pct,
         missing_in_batch, matched_candles,
         CASE WHEN matched_candles > 0 THEN close_drift_mean_pct END AS close_drift_mean_pct,
         CASE WHEN matched_candles > 0 THEN close_drift_max_pct END AS close_drift_max_pct,
         CASE WHEN matched_candles > 0 THEN close_drift_std_pct END AS close_drift_std_pct,
         CASE WHEN matched_candles > 0 THEN volume_drift_mean_pct END AS volume_drift_mean_pct,
         CASE WHEN matched_candles > 0 THEN volume_drift_max_pct END AS volume_drift_max_pct,
         CASE WHEN matched_candles > 0 THEN candles_with_trade_diff END AS candles_with_trade_diff,
         CASE WHEN matched_candles > 0 THEN trade_count_diff_mean END AS trade_count_diff_mean,
         CASE WHEN matched_candles = 0 THEN 'no_matched_candles' END AS error
  FROM rep0)"""

_CANDLE_COLS = ("instrument, window_size, window_start, window_end, open, high, low, close, "
                "volume, trade_count, is_realtime")


def _ymd(ts: str = "timestamp") -> str:
    return (f"CAST(year({ts}) AS INTEGER) AS year, CAST(month({ts}) AS INTEGER) AS month, "
            f"CAST(day({ts}) AS INTEGER) AS day")


_FIRST_DAY = f"""days AS (SELECT DISTINCT {_ymd()} FROM clean),
first_day AS (SELECT * FROM days ORDER BY year, month, day LIMIT 1)"""

_ARRIVALS = """arrivals AS (
  SELECT *, sequence_id % 3 AS kafka_partition,
         row_number() OVER (PARTITION BY sequence_id % 3
           ORDER BY CASE WHEN sequence_id % 25 = 2 THEN timestamp + INTERVAL 1 HOUR ELSE timestamp END,
                    sequence_id) AS offset_in_partition
  FROM trades),
hw AS (
  SELECT *, epoch_us(timestamp) AS us,
         epoch_us(max(timestamp) OVER (PARTITION BY kafka_partition ORDER BY offset_in_partition
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS hwm
  FROM arrivals)"""


def _late(label: str, size_us: int, wm_ms: int) -> str:
    return (f"SELECT '{label}' AS window_size, count(*) AS total_ticks, "
            f"CAST(count_if(us - (us % {size_us}) + {size_us} + {2 * wm_ms * 1000} < hwm) AS BIGINT) AS late_ticks, "
            f"CAST(count_if(us - (us % {size_us}) + {size_us} + {2 * wm_ms * 1000} < hwm) AS DOUBLE) / count(*) AS late_rate FROM hw")


# the same log with an instrument's ticks in one partition, tested tick by tick
_EXACT = """arr AS (
  SELECT instrument, timestamp, epoch_us(timestamp) AS us, CAST(printf('%.2f', price) AS DOUBLE) AS price, volume,
         ascii(instrument) % 3 AS part, row_number() OVER (PARTITION BY ascii(instrument) % 3
           ORDER BY CASE WHEN sequence_id % 25 = 2 THEN timestamp + INTERVAL 1 HOUR ELSE timestamp END, sequence_id) AS pos
  FROM trades),
ex AS (SELECT *, max(us) OVER (PARTITION BY part ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS newest FROM arr)"""


def _exact_late(seconds: int, wm_ms: int) -> str:
    size, wm = seconds * 1_000_000, wm_ms * 1000
    return f"us - us % {size} + {size} + {wm} < newest - {wm}"


_STREAM_OK = "CAST(ts_micros AS HUGEINT) * 100000000000000000000 + 1000000000 - sequence_id"
_VALID = "vt AS (SELECT sequence_id, instrument, make_timestamp(ts_micros) AS ts, ts_micros, price, volume FROM decoded WHERE error IS NULL)"


def _stream_candles() -> str:
    return "\nUNION ALL\n".join(
        _candles("vt", s, lbl, True, ts="ts", ok=_STREAM_OK)
        for s, lbl in ((1, "1s"), (10, "10s"), (60, "1m")))


# (label, seconds, watermark in ms) of the three sizes
_SIZE_ROWS = (("1s", 1, 200), ("10s", 10, 1000), ("1m", 60, 5000))


def _snapshot(src: str) -> str:
    """All open candles and the newest 500 finished ones of each size."""
    delay = "CASE window_size " + " ".join(f"WHEN '{lbl}' THEN {2000 * wm}" for lbl, _, wm in _SIZE_ROWS) + " END"
    return (f"SELECT {_CANDLE_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY window_size, open_now "
            "ORDER BY window_start DESC, instrument ASC) AS rn FROM (SELECT *, "
            f"epoch_us(window_end) + {delay} >= epoch_us(max(window_start) OVER (PARTITION BY window_size)) AS open_now "
            f"FROM {src})) WHERE open_now OR rn <= 500")


_MARK = "/* candles */ "
_LATE = "mark AS (SELECT " + ", ".join(
    f"(max(epoch_us(timestamp)) // 1000 - {2 * wm}) * 1000 AS wm_{lbl}" for lbl, _, wm in _SIZE_ROWS) + (
    " FROM trades WHERE sequence_id % 25 <> 2),\nlt AS (SELECT t.* REPLACE (CAST(printf('%.2f', price) AS DOUBLE) AS price), ") + ", ".join(
    f"sequence_id % 25 <> 2 OR epoch_us(timestamp) - epoch_us(timestamp) % {s * 1000000} + {s * 1000000} > wm_{lbl} AS keep_{lbl}"
    for lbl, s, _ in _SIZE_ROWS) + " FROM trades t, mark)"
_HEALTH = """prog AS (
  SELECT instrument AS query, date_trunc('hour', timestamp) AS tm, count(*) AS input_rows,
         count(DISTINCT price) AS rows_updated, max(sequence_id * 17 % 150000) AS source_lag
  FROM trades GROUP BY ALL),
late AS (SELECT date_trunc('hour', timestamp) AS tm, count(*) AS ticks, count_if(sequence_id % 25 = 2) AS late_ticks
         FROM trades GROUP BY ALL),
per_query AS (
  SELECT time_bucket(INTERVAL '6 hours', tm) AS window_start, query, sum(input_rows) AS input_rows,
         sum(rows_updated) AS updated, arg_max(source_lag, tm) AS lag FROM prog GROUP BY ALL),
health AS (
  SELECT p.window_start, CAST(sum(input_rows) AS DOUBLE) / 21600.0 AS ticks_per_sec, CAST(sum(updated) AS BIGINT) AS candles_emitted,
         CAST(any_value(l.share) AS DOUBLE) AS late_share, CAST(sum(lag) AS BIGINT) AS lag, 0.4::DOUBLE AS drift_pct
  FROM per_query p JOIN (SELECT time_bucket(INTERVAL '6 hours', tm) AS ws, CAST(sum(late_ticks) AS DOUBLE) / sum(ticks) AS share
                         FROM late GROUP BY ALL) l ON l.ws = p.window_start
  GROUP BY p.window_start)"""


_KNOWN = """known AS (
  SELECT instrument, min(epoch_us(timestamp)) AS lo,
         CASE WHEN ascii(instrument) % 2 = 0 THEN min(epoch_us(timestamp)) + (max(epoch_us(timestamp)) - min(epoch_us(timestamp))) // 2 END AS hi
  FROM trades GROUP BY instrument),
judged AS (
  SELECT raw, CASE WHEN error IS NULL AND NOT EXISTS (SELECT 1 FROM known k WHERE k.instrument = d.instrument
    AND d.ts_micros >= k.lo AND (k.hi IS NULL OR d.ts_micros < k.hi)) THEN 'unknown_instrument' ELSE error END AS error
  FROM decoded d)"""
# a stream on time, stalled, then reading late ticks only
_LIVE = "ph AS (SELECT *, epoch_us(timestamp) AS us, sequence_id % 25 = 2 AS is_late FROM trades),\nnw AS (SELECT max(us) AS us FROM ph WHERE NOT is_late),\n" + (
    "up AS (" + " UNION ALL ".join(
        f"SELECT CASE WHEN is_late THEN 'late' ELSE 'on_time' END AS phase, count(DISTINCT instrument || ':' || ph.us // {s * 1000000}) AS n FROM ph, nw "
        f"WHERE NOT is_late OR ph.us - ph.us % {s * 1000000} + {s * 1000000} > (nw.us // 1000 - {2 * wm}) * 1000 GROUP BY 1" for _, s, wm in _SIZE_ROWS)
    + "),\nsh AS (" + " UNION ALL ".join(
        f"SELECT count_if(ph.us - ph.us % {s * 1000000} + {s * 1000000} + {2000 * wm} <= nw.us) AS n, count(*) AS ticks FROM ph, nw WHERE is_late" for _, s, wm in _SIZE_ROWS)
    + """),
live AS (
  SELECT p.phase, CAST(CASE p.phase WHEN 'stalled' THEN 0 ELSE (SELECT count(*) FROM ph WHERE is_late = (p.phase = 'late')) END AS BIGINT) AS input_rows,
         CAST(NULL AS DOUBLE) AS ticks_per_sec,
         CAST(coalesce((SELECT sum(n) FROM up WHERE up.phase = p.phase), 0) AS BIGINT) AS candles_emitted,
         CASE p.phase WHEN 'on_time' THEN 0.0::DOUBLE WHEN 'late' THEN (SELECT CAST(sum(n) AS DOUBLE) / sum(ticks) FROM sh) END AS late_share,
         CAST(CASE p.phase WHEN 'stalled' THEN (SELECT count(*) FROM ph WHERE is_late) ELSE 0 END AS BIGINT) AS lag,
         CAST(NULL AS DOUBLE) AS drift_pct
  FROM (VALUES ('on_time'), ('stalled'), ('late')) AS p(phase))""")


def _alerts(src: str, by: str) -> str:
    checks = (("low_throughput", "ticks_per_sec", 10.0, True), ("no_candles_emitted", "candles_emitted", 1.0, True),
              ("high_late_arrivals", "late_share", 0.01, False), ("high_lag", "lag", 10000.0, False),
              ("critical_lag", "lag", 100000.0, False), ("high_drift", "drift_pct", 0.5, False))
    rows = " UNION ALL ".join(f"SELECT {by}, '{n}' AS alert, CAST({c} AS DOUBLE) AS value, {t}::DOUBLE AS threshold, {str(b).lower()} AS below FROM {src}"
                              for n, c, t, b in checks)
    return f"SELECT {by}, alert, value, threshold FROM ({rows}) WHERE CASE WHEN below THEN value < threshold ELSE value > threshold END"


def oracle_sql() -> dict[str, str]:
    w = _with
    q: dict[str, str] = {}
    for s, lbl, name in ((1, "1s", "ohlcv_1s"), (10, "10s", "ohlcv_10s"), (60, "1m", "ohlcv_1m"),
                         (3600, "1h", "ohlcv_1h")):
        q[name] = w(*BASE) + _candles("trades", s, lbl, False)
    allc = f"allc AS ({_all_sizes('trades', False)})"
    q["ohlcv_all_sizes"] = w(*BASE) + _all_sizes("trades", False)
    q["candle_summary"] = w(*BASE, allc) + (
        "SELECT window_size, count(*) AS candle_count, CAST(sum(trade_count) AS BIGINT) AS total_trades "
        "FROM allc GROUP BY window_size")
    q["candle_series"] = w(*BASE, allc) + (
        f"SELECT {_CANDLE_COLS} FROM allc WHERE instrument = 'click' AND window_size = '1m' ORDER BY window_start")
    q["latest_candle"] = w(*BASE, allc) + (
        f"SELECT {_CANDLE_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY instrument, window_size "
        "ORDER BY window_start DESC) AS rn FROM allc) WHERE rn = 1")
    q["snapshot_candles"] = w(*BASE, allc) + _snapshot("allc")
    q["distinct_instruments"] = w(*BASE) + "SELECT DISTINCT instrument FROM trades"
    q["first_messages"] = w(_MESSAGES) + "SELECT * FROM messages ORDER BY timestamp, sequence_id LIMIT 1000"
    q["gaps_by_level"] = w(*BASE, _PREV, _GAPS) + "SELECT * FROM gaps"
    q["gap_counts"] = w(*BASE, _PREV, _GAPS) + (
        "SELECT instrument, count(*) AS gap_count FROM gaps WHERE threshold_name = 'HFT' "
        "GROUP BY instrument ORDER BY gap_count DESC, instrument")
    q["gap_level_counts"] = w(*BASE, _PREV) + (
        f"SELECT threshold_name, threshold_ms, CAST(count_if(gap_ms > threshold_ms) AS BIGINT) AS gap_count "
        f"FROM gapped CROSS JOIN {_LEVELS} GROUP BY threshold_name, threshold_ms")
    ol_cols = ("trade_id, instrument, timestamp, price, round(rolling_avg, 6) AS rolling_avg, "
               "round(deviation_pct, 6) AS deviation_pct, volume, side, outlier_type, window_size, threshold_pct")
    q["outliers"] = w(*BASE, _outliers_cte("trades")) + f"SELECT {ol_cols} FROM ol"
    q["top_outliers"] = w(*BASE, _outliers_cte("trades")) + (
        f"SELECT {ol_cols} FROM ol ORDER BY deviation_pct DESC, trade_id ASC LIMIT 10")
    dq = (_MESSAGES, _TRADES, _TRADES_DUP, _NUMBERED)
    q["duplicates"] = w(*dq) + (
        "SELECT trade_id, instrument, timestamp, price, volume, side, sequence_id, row_num, "
        "'duplicate' AS exclusion_reason FROM numbered WHERE row_num > 1")
    q["deduplicated"] = w(*dq) + (
        "SELECT trade_id, instrument, timestamp, price, volume, side, sequence_id FROM numbered WHERE row_num = 1")
    q["clean_trades"] = w(*_QBASE) + "SELECT * FROM clean"
    q["exclusions"] = w(*_QBASE) + (
        "SELECT trade_id, instrument, timestamp, price, volume, side, sequence_id, 'duplicate' AS exclusion_reason "
        "FROM numbered WHERE row_num > 1 UNION ALL "
        "SELECT trade_id, instrument, timestamp, price, volume, side, sequence_id, 'fat_finger' "
        "FROM numbered n WHERE row_num = 1 AND EXISTS (SELECT 1 FROM old o WHERE o.trade_id = n.trade_id) UNION ALL "
        "SELECT trade_id, instrument, timestamp, price, volume, side, sequence_id, 'missing_trade_id' "
        "FROM numbered WHERE row_num = 1 AND trade_id IS NULL")
    q["quality_summary"] = w(*_QBASE, """cnt AS (
  SELECT (SELECT count(*) FROM trades_dup) AS total_trades,
         (SELECT min(timestamp) FROM trades_dup) AS first_timestamp,
         (SELECT max(timestamp) FROM trades_dup) AS last_timestamp,
         (SELECT count(DISTINCT instrument) FROM trades_dup) AS instrument_count,
         (SELECT count(*) FROM old) AS outlier_count,
         (SELECT count(*) FROM numbered WHERE row_num > 1) AS duplicate_count,
         (SELECT count(*) FROM clean) AS clean_count)""") + (
        "SELECT *, round(CAST(outlier_count AS DOUBLE) * 100.0 / total_trades, 9) AS outlier_pct, "
        "round(CAST(duplicate_count AS DOUBLE) * 100.0 / total_trades, 9) AS duplicate_pct, "
        "round(CAST(clean_count AS DOUBLE) * 100.0 / total_trades, 9) AS clean_pct, "
        "round(100.0 - CAST(outlier_count AS DOUBLE) * 100.0 / total_trades "
        "- CAST(duplicate_count AS DOUBLE) * 100.0 / total_trades, 9) AS clean_pct_reference FROM cnt")
    q["wire_encode"] = w(_MESSAGES) + f"SELECT sequence_id, instrument AS key, {_line()} AS line FROM messages"
    wire = (_MESSAGES, _MESSAGES_BAD, _WIRE)
    q["wire_decode"] = w(*wire) + "SELECT * FROM decoded"
    q["valid_ticks"] = w(*wire) + (
        "SELECT msg_id AS trade_id, instrument, make_timestamp(ts_micros) AS timestamp, price, volume, side "
        "FROM decoded WHERE error IS NULL")
    q["dead_letters"] = w(*wire) + "SELECT raw, error FROM decoded WHERE error IS NOT NULL"
    q["tick_status_counts"] = w(*wire) + (
        "SELECT CASE WHEN skipped THEN 'skipped' ELSE coalesce(error, 'valid') END AS status, count(*) AS n "
        "FROM checked GROUP BY 1")
    q["msg_type_counts"] = w(_MESSAGES) + "SELECT msg_type, count(*) AS count FROM messages GROUP BY msg_type"
    q["drift"] = w(*_DRIFT_BASE) + "SELECT * FROM dr"
    q["drift_matched"] = w(*_DRIFT_BASE) + "SELECT * FROM dr WHERE NOT missing_realtime AND NOT missing_batch"
    q["drift_summary"] = w(*_DRIFT_BASE, _REPORT) + (
        "SELECT total_candles, missing_in_realtime, round(missing_in_realtime_pct, 6) AS missing_in_realtime_pct, "
        "missing_in_batch, matched_candles, round(close_drift_mean_pct, 6) AS close_drift_mean_pct, "
        "close_drift_max_pct, round(close_drift_std_pct, 6) AS close_drift_std_pct, "
        "round(volume_drift_mean_pct, 6) AS volume_drift_mean_pct, volume_drift_max_pct, "
        "candles_with_trade_diff, round(trade_count_diff_mean, 6) AS trade_count_diff_mean, error FROM rep")
    q["drift_by_window"] = w(*_DRIFT_BASE) + (
        "SELECT window_size, count(*) AS total, CAST(count_if(missing_realtime) AS BIGINT) AS missing_rt, "
        "round(avg(close_drift_pct), 6) AS close_drift_mean, round(avg(abs(trade_count_diff)), 6) AS trade_diff_mean "
        "FROM dr GROUP BY window_size")
    q["drift_alerts"] = w(*_DRIFT_BASE, _REPORT) + (
        "SELECT * FROM ("
        "SELECT 'missing_pct' AS alert, round(abs(missing_in_realtime_pct), 6) AS value, 0.5::DOUBLE AS threshold, abs(missing_in_realtime_pct) AS v FROM rep UNION ALL "
        "SELECT 'close_drift_pct', round(abs(close_drift_max_pct), 6), 1.0::DOUBLE, abs(close_drift_max_pct) FROM rep UNION ALL "
        "SELECT 'volume_drift_pct', round(abs(volume_drift_max_pct), 6), 5.0::DOUBLE, abs(volume_drift_max_pct) FROM rep"
        ") WHERE v > threshold").replace("SELECT * FROM (", "SELECT alert, value, threshold FROM (", 1)
    q["partition_counts"] = w(*_QBASE) + (
        f"SELECT {_ymd()}, count(*) AS count FROM clean GROUP BY ALL ORDER BY year, month, day")
    q["partition_day"] = w(*_QBASE, _FIRST_DAY) + (
        f"SELECT c.*, {_ymd('c.timestamp')} FROM clean c JOIN first_day f "
        "ON year(c.timestamp) = f.year AND month(c.timestamp) = f.month AND day(c.timestamp) = f.day")
    q["first_partition"] = w(*_QBASE, _FIRST_DAY) + "SELECT * FROM first_day"
    q["late_rate"] = w(*BASE, _ARRIVALS) + "\nUNION ALL\n".join(
        _late(lbl, s * 1_000_000, wm) for lbl, s, wm in (("1s", 1, 200), ("10s", 10, 1000), ("1m", 60, 5000)))
    log = (_MESSAGES, _MESSAGES_BAD, _LOG)
    q["stream_ohlcv"] = w(*log, _VALID) + _stream_candles()
    q["stream_restart"] = q["stream_ohlcv_routed"] = q["stream_ohlcv"]
    q["stream_dead_letters"] = w(*log) + "SELECT raw, error FROM decoded WHERE error IS NOT NULL"
    q["stream_dead_letters_routed"] = q["stream_dead_letters"]
    q["stream_snapshot"] = w(*log, _VALID, f"sc AS ({_stream_candles()})") + _snapshot("sc")
    q["stream_late_drop"] = w(*BASE, _LATE) + _MARK + "\nUNION ALL\n".join(
        _candles(f"(SELECT * FROM lt WHERE keep_{lbl}) AS kept_{lbl}", s, lbl, True) for lbl, s, _ in _SIZE_ROWS)
    q["stream_append"] = w(*BASE, _LATE, f"c AS ({q['stream_late_drop'].split(_MARK, 1)[1]})") + (
        "SELECT c.* FROM c, mark WHERE epoch_us(window_end) <= CASE window_size " + " ".join(
            f"WHEN '{lbl}' THEN wm_{lbl}" for lbl, _, _ in _SIZE_ROWS) + " END")
    q["stream_late_counts"] = w(*BASE, _LATE) + "\nUNION ALL\n".join(
        f"SELECT '{lbl}' AS window_size, CAST(count(*) + 1 AS BIGINT) AS total_ticks, CAST(count_if(NOT keep_{lbl}) AS BIGINT) AS late_ticks FROM lt"
        for lbl, _, _ in _SIZE_ROWS)
    q["stream_open_state"] = w(*log, _VALID, f"sc AS ({_stream_candles()})") + (
        f"SELECT {_CANDLE_COLS} FROM sc, (SELECT max(ts_micros) // 1000 AS newest FROM vt) m WHERE epoch_us(window_end) > (newest - CASE window_size "
        + " ".join(f"WHEN '{lbl}' THEN {2 * wm}" for lbl, _, wm in _SIZE_ROWS) + " END) * 1000")
    q["stream_exact"] = w(*BASE, _EXACT) + "\nUNION ALL\n".join(
        _candles(f"(SELECT * FROM ex WHERE NOT ({_exact_late(s, wm)})) AS on_time_{lbl}", s, lbl, True,
                 ok="CAST(us AS HUGEINT) * 100000000000000000000 + pos") for lbl, s, wm in _SIZE_ROWS)
    q["stream_exact_late"] = w(*BASE, _EXACT) + "\nUNION ALL\n".join(
        f"SELECT instrument, '{lbl}' AS window_size, make_timestamp(us - us % {s * 1_000_000}) AS window_start, us AS ts_micros, "
        f"pos AS position, price, volume FROM ex WHERE {_exact_late(s, wm)}" for lbl, s, wm in _SIZE_ROWS)
    q["dead_letters_known"] = w(_MESSAGES, _TRADES, _MESSAGES_BAD, _WIRE, _KNOWN) + "SELECT raw, error FROM judged WHERE error IS NOT NULL"
    q["stream_dead_letters_known"] = w(_MESSAGES, _TRADES, _MESSAGES_BAD, _LOG, _KNOWN) + "SELECT raw, error FROM judged WHERE error IS NOT NULL"
    q["gaps_sliced"], q["outliers_sliced"] = q["gaps_by_level"], q["outliers"]
    q["drift_stored"] = q["drift"]
    q["candle_sink"] = q["candles_from_text"] = q["ohlcv_all_sizes"]
    q["audit_exclusions"] = q["exclusions"]
    q["report_gap_levels"] = q["gap_level_counts"]
    q["report_top_outliers"] = q["top_outliers"]
    q["store_stats"] = w(*_QBASE) + (
        f"SELECT {_ymd()}, count(*) AS rows, true AS has_bytes FROM clean GROUP BY ALL ORDER BY year, month, day")
    q["store_totals"] = w(*_QBASE) + (
        "SELECT count(DISTINCT CAST(timestamp AS DATE)) AS partitions, count(*) AS total_rows, true AS has_ratio FROM clean")
    q["pruning_check"] = w(*_QBASE, _FIRST_DAY) + (
        "SELECT count(*) AS store_rows, CAST(count_if(year(timestamp) = f.year AND month(timestamp) = f.month "
        "AND day(timestamp) = f.day) AS BIGINT) AS day_rows, count(DISTINCT CAST(timestamp AS DATE)) AS partitions_total, "
        "CAST(1 AS BIGINT) AS partitions_read, true AS fewer_files, true AS pruned, "
        "any_value(f.year || '-' || f.month || '-' || f.day) AS checked_day FROM clean, first_day f")
    q["fingerprint_groups"] = w(*dq[:3]) + (
        "SELECT min(sequence_id) AS first_sequence, count(*) AS copies FROM trades_dup "
        "GROUP BY timestamp, instrument, price, volume, side HAVING count(*) > 1")
    q["kafka_messages"] = w(_MESSAGES) + f"SELECT instrument AS key, {_line()} AS value FROM messages"
    q["partition_assignment"] = w(_MESSAGES) + (
        "SELECT instrument AS key, count(*) AS messages, true AS one_partition FROM messages GROUP BY instrument")
    q["health_metrics"] = w(*BASE, _HEALTH) + "SELECT * FROM health"
    q["health_alerts"] = w(*BASE, _HEALTH) + _alerts("health", "window_start")
    q["health_live"] = w(*BASE, _LIVE) + "SELECT * FROM live"
    q["health_alerts_live"] = w(*BASE, _LIVE) + _alerts("live", "phase")
    return q
