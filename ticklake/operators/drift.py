"""Drift between real-time and batch candles: join, report, per size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DRIFT_KEYS = ["instrument", "window_start", "window_size"]
_VALUES = ["open", "high", "low", "close", "volume"]


def measure_drift(realtime: DataFrame, batch: DataFrame, how: str = "full_outer") -> DataFrame:
    """Full outer (or inner) join on (instrument, window_start, window_size); batch
    columns get the suffix ``_batch``; keys are coalesced (USING join).

    Adds missing_realtime / missing_batch (close is null on that side),
    ``<v>_drift_pct`` = (rt - batch) / batch * 100 (null when batch is 0)
    and trade_count_diff.
    """
    b = batch.select(*DRIFT_KEYS, *[F.col(c).alias(f"{c}_batch")
                                    for c in batch.columns if c not in DRIFT_KEYS])
    j = realtime.join(b, DRIFT_KEYS, how)
    # one projection (a chain of withColumn re-analyses the plan per column)
    return j.select(
        "*",
        F.col("close").isNull().alias("missing_realtime"),
        F.col("close_batch").isNull().alias("missing_batch"),
        *[(F.try_divide(F.col(v) - F.col(f"{v}_batch"), F.col(f"{v}_batch")) * 100.0).alias(f"{v}_drift_pct")
          for v in _VALUES],
        (F.col("trade_count") - F.col("trade_count_batch")).alias("trade_count_diff"))


def drift_report(drift: DataFrame) -> DataFrame:
    """One-row report.  Statistics use matched candles only; with no match
    they are null and ``error`` is ``no_matched_candles``.  The share of
    candles missing in real time is given either way (0 without candles):
    a total outage is the worst drift there is."""
    matched = ~F.col("missing_realtime") & ~F.col("missing_batch")
    m = lambda c: F.when(matched, F.col(c))
    a = drift.agg(
        F.count(F.lit(1)).alias("total_candles"),
        F.count_if(F.col("missing_realtime")).alias("missing_in_realtime"),
        F.count_if(F.col("missing_batch")).alias("missing_in_batch"),
        F.count_if(matched).alias("matched_candles"),
        F.avg(m("close_drift_pct")).alias("close_drift_mean_pct"),
        F.max(F.abs(m("close_drift_pct"))).alias("close_drift_max_pct"),
        F.stddev_samp(m("close_drift_pct")).alias("close_drift_std_pct"),
        F.avg(m("volume_drift_pct")).alias("volume_drift_mean_pct"),
        F.max(F.abs(m("volume_drift_pct"))).alias("volume_drift_max_pct"),
        F.count_if(matched & (F.col("trade_count_diff") != 0)).alias("candles_with_trade_diff"),
        F.avg(m("trade_count_diff")).alias("trade_count_diff_mean"),
    )
    has = F.col("matched_candles") > 0
    stats = ["close_drift_mean_pct", "close_drift_max_pct", "close_drift_std_pct",
             "volume_drift_mean_pct", "volume_drift_max_pct", "candles_with_trade_diff",
             "trade_count_diff_mean"]
    return a.select(
        "total_candles", "missing_in_realtime",
        F.coalesce(F.try_divide(F.col("missing_in_realtime") * 100.0, F.col("total_candles")),
                   F.lit(0.0)).alias("missing_in_realtime_pct"),
        "missing_in_batch", "matched_candles",
        *[F.when(has, F.col(c)).alias(c) for c in stats],
        F.when(~has, F.lit("no_matched_candles")).alias("error"))


def drift_by_window(drift: DataFrame) -> DataFrame:
    """Per window size: candles, missing in real-time, mean close drift,
    mean absolute trade-count difference."""
    return drift.groupBy("window_size").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("missing_realtime")).alias("missing_rt"),
        F.avg("close_drift_pct").alias("close_drift_mean"),
        F.avg(F.abs(F.col("trade_count_diff"))).alias("trade_diff_mean"))


def matched_by_size(realtime: dict, batch: dict) -> DataFrame:
    """The candles present on both sides: inner joins size by size, so no
    filter above a full outer join splits the shared shuffles in two."""
    parts = [measure_drift(realtime[s], batch[s], "inner") for s in sorted(set(realtime) & set(batch))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def matched(drift: DataFrame) -> DataFrame:
    return drift.filter(~F.col("missing_realtime") & ~F.col("missing_batch"))


def write_drift(drift: DataFrame, path: str) -> None:
    """Persist the detailed drift table (Parquet, replacing ``path``)."""
    drift.write.mode("overwrite").parquet(path)


def measure_drift_by_size(realtime: dict, batch: dict) -> DataFrame:
    """``measure_drift`` for candle tables given per window size
    (``{seconds: DataFrame}``, e.g. from ``candles.candles_by_size``).

    Joining size by size lets each join reuse the partitioning its two
    aggregates already have (hash of instrument, window_start), so the
    join adds no shuffle; the stacked form has to re-shuffle every candle
    of both sides.  Same rows: window_size is part of the key.
    """
    sizes = sorted(set(realtime) | set(batch))
    parts = []
    for s in sizes:
        if s in realtime and s in batch:
            parts.append(measure_drift(realtime[s], batch[s]))
        else:
            only = realtime[s] if s in realtime else batch[s]
            other = only.withColumn("is_realtime", ~F.col("is_realtime")).limit(0)
            parts.append(measure_drift(only, other) if s in realtime else measure_drift(other, only))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
