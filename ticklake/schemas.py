"""Schemas and the fixed configuration values of the tick engine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TRADES = T.StructType([
    T.StructField("trade_id", T.StringType()),
    T.StructField("instrument", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("side", T.StringType()),
    T.StructField("sequence_id", T.LongType()),
])

MESSAGES = T.StructType(TRADES.fields + [T.StructField("msg_type", T.StringType())])

WIRE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("position", T.LongType()),
])

CANDLE_COLUMNS = ["instrument", "window_size", "window_start", "window_end",
                  "open", "high", "low", "close", "volume", "trade_count",
                  "is_realtime"]


@dataclass(frozen=True)
class WindowConfig:
    name: str          # label used in the candle tables
    seconds: int       # tumbling window length
    watermark_ms: int  # configured watermark; the lateness test uses 2x this


# ---- Fixed values (must equal the reference's configuration) -------------
# Candle window sizes with their watermarks: 1s/200ms, 10s/1s, 1m/5s.
WINDOW_CONFIGS = (
    WindowConfig("1s", 1, 200),
    WindowConfig("10s", 10, 1000),
    WindowConfig("1m", 60, 5000),
)
# Gap detection levels: HFT > 500 ms, Fast > 5 s, Standard > 30 s.
GAP_LEVELS = (("HFT", 500.0), ("Fast", 5000.0), ("Standard", 30000.0))
# Outlier detection: mean of the previous 50 prices, flag deviation > 5%.
OUTLIER_WINDOW = 50
OUTLIER_THRESHOLD = 0.05
# Drift alert thresholds (strict >): missing 0.5%, close 1%, volume 5%.
DRIFT_THRESHOLDS = (("missing_pct", 0.5), ("close_drift_pct", 1.0),
                    ("volume_drift_pct", 5.0))
# Stream health alert thresholds: rate < 10 ticks/s, late share > 1%,
# lag > 10,000 (warning) / > 100,000 (critical), drift > 0.5%.
HEALTH_MIN_RATE = 10.0
HEALTH_MAX_LATE_SHARE = 0.01
HEALTH_LAG_WARN = 10000
HEALTH_LAG_CRIT = 100000
HEALTH_MAX_DRIFT_PCT = 0.5
# Validation: ticks after this instant (µs since epoch, 2026-01-01T00:00Z)
# are rejected as future_timestamp.
FUTURE_CUTOFF_MICROS = 1767225600000000
# Partitioned storage: zstd; CSV size estimate of 100 bytes per row.
STORAGE_CODEC = "zstd"
CSV_BYTES_PER_ROW = 100
# Snapshot: last 500 finished candles per window size.
SNAPSHOT_HISTORY = 500
# --------------------------------------------------------------------------


def window_label(seconds: int) -> str:
    """'Ns' below a minute, else 'Nm' (whole minutes)."""
    return f"{seconds}s" if seconds < 60 else f"{seconds // 60}m"
