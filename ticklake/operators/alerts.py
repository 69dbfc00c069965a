"""Threshold checks as table operators: a report row is unpivoted into
(alert, value, threshold) rows and only strict exceedances are kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.schemas import (
    DRIFT_THRESHOLDS, HEALTH_LAG_CRIT, HEALTH_LAG_WARN, HEALTH_MAX_DRIFT_PCT,
    HEALTH_MAX_LATE_SHARE, HEALTH_MIN_RATE,
)

# report column checked by each drift threshold
_DRIFT_SOURCES = {"missing_pct": "missing_in_realtime_pct",
                  "close_drift_pct": "close_drift_max_pct",
                  "volume_drift_pct": "volume_drift_max_pct"}


def _unpivot(report: DataFrame, checks: Sequence[tuple[str, str, float, str]], keep: Sequence[str] = ()) -> DataFrame:
    """checks: (alert name, column, threshold, 'gt' | 'lt')."""
    rows = F.array(*[F.struct(F.lit(n).alias("alert"), F.abs(F.col(c)).cast("double").alias("value")
                              if op == "gt_abs" else F.col(c).cast("double").alias("value"),
                              F.lit(float(t)).alias("threshold"), F.lit(op).alias("_op"))
                     for n, c, t, op in checks])
    u = report.select(*keep, F.inline(rows))
    hit = F.when(F.col("_op") == "lt", F.col("value") < F.col("threshold")) \
           .otherwise(F.col("value") > F.col("threshold"))
    return u.filter(hit).drop("_op")


def drift_alerts(report: DataFrame, thresholds: Sequence[tuple[str, float]] = DRIFT_THRESHOLDS) -> DataFrame:
    """Alerts from a drift report: missing% > 0.5, max |close drift| > 1,
    max |volume drift| > 5 (defaults; strict)."""
    checks = [(n, _DRIFT_SOURCES[n], t, "gt_abs") for n, t in thresholds]
    return _unpivot(report, checks)


def health_alerts(metrics: DataFrame) -> DataFrame:
    """Stream-health alerts per metrics row (``health_metrics``: one per time
    window; ``phase_metrics``: one per phase) with columns ``window_start`` or
    ``phase`` (if there is one), ``ticks_per_sec``, ``candles_emitted``, ``late_share``, ``lag``,
    ``drift_pct`` (any may be null; a null never raises)."""
    checks = [("low_throughput", "ticks_per_sec", HEALTH_MIN_RATE, "lt"),
              ("no_candles_emitted", "candles_emitted", 1.0, "lt"),
              ("high_late_arrivals", "late_share", HEALTH_MAX_LATE_SHARE, "gt"),
              ("high_lag", "lag", float(HEALTH_LAG_WARN), "gt"),
              ("critical_lag", "lag", float(HEALTH_LAG_CRIT), "gt"),
              ("high_drift", "drift_pct", HEALTH_MAX_DRIFT_PCT, "gt")]
    return _unpivot(metrics, checks, [c for c in ("window_start", "phase") if c in metrics.columns])
