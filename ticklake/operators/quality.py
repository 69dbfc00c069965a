"""Data-quality profiling: gaps, fat-finger outliers, duplicates, clean set.

Ticks of one instrument are ordered by (timestamp, sequence_id).  All
per-instrument sequences go through ``ticklake.operators.sequence``, so a
hot instrument is spread over (instrument, time-slice) tasks instead of
one task per instrument; duplicate numbering is spread over
(fingerprint, sequence-slice) tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ticklake.functions.timefn import epoch_micros, millis_between, window_start
from ticklake.operators.sequence import (
    SLICE_TARGET_ROWS, lag_across_slices, ordered_position_hot, rolling_previous, sketch_slices, slice_by_bounds,
    slice_by_sketch,
)
from ticklake.schemas import GAP_LEVELS, OUTLIER_THRESHOLD, OUTLIER_WINDOW

FINGERPRINT = ["timestamp", "instrument", "price", "volume", "side"]
TRADE_ORDER = ["timestamp", "sequence_id"]


#: Coarse range of an instrument's ticks that has a sketch of its own.
SLICE_SECONDS = 86400
#: Sequence numbers per slice of a hot group of duplicates.
SEQUENCE_SLICE = 1 << 20


def slice_ticks(trades: DataFrame, target_rows: int = SLICE_TARGET_ROWS, stored: bool = False) -> DataFrame:
    """``trades`` with ``_slice``, the start (microseconds) of slices of about
    ``target_rows`` ticks of an instrument, however they lie in time.

    The source is scanned once: it is written to the shared checkpoint folder
    (``stored``: it lies in a table already), and a sketch per instrument and
    day is made from two columns of that copy.  Pass the result to several
    operators that need slices; each makes its own where it gets none."""
    from ticklake.session import materialize
    t = trades if stored else materialize(trades, "ticks")
    day = window_start(F.col("timestamp"), SLICE_SECONDS)
    start, at = epoch_micros(day), epoch_micros(F.col("timestamp"))
    bounds = materialize(sketch_slices(t, ["instrument"], start, at, target_rows), "slice_bounds")
    if bounds.isEmpty():                # no instrument's day is above the target
        return t.withColumn("_slice", start)
    return slice_by_sketch(t, ["instrument"], start, start, at, bounds, "_slice")


def _sliced(trades: DataFrame, slice_seconds: int | None, bounds: DataFrame | None) -> DataFrame:
    """Adds ``_slice``, unless it is there: by ``bounds`` (``sequence.row_slices``),
    by time buckets of a stated width, else by sketches."""
    if "_slice" in trades.columns:
        return trades
    if bounds is not None:
        return slice_by_bounds(trades, ["instrument"], "timestamp", bounds, "_slice")
    if slice_seconds is not None:
        return trades.withColumn("_slice", window_start(F.col("timestamp"), slice_seconds))
    return slice_ticks(trades)


def with_previous_time(trades: DataFrame, slice_seconds: int | None = None,
                       bounds: DataFrame | None = None) -> DataFrame:
    """Adds ``prev_time`` (previous tick of the instrument) and ``gap_ms``
    (whole milliseconds since it, truncated)."""
    # the lagged value is the timestamp that leads the order: max per slice
    out = lag_across_slices(_sliced(trades, slice_seconds, bounds), ["instrument"], TRADE_ORDER, None,
                            F.col("_slice"), "timestamp", "prev_time")
    return out.drop("_slice").withColumn("gap_ms", millis_between(F.col("prev_time"), F.col("timestamp")))


def gaps_by_level(trades: DataFrame, levels: Sequence[tuple[str, float]] = GAP_LEVELS,
                  slice_seconds: int | None = None, bounds: DataFrame | None = None) -> DataFrame:
    """One row per (gap, level) with gap_ms strictly above the level.

    The previous tick is found once; the levels are a literal array
    filtered per row (no join, no re-sort per level).
    """
    g = with_previous_time(trades, slice_seconds, bounds)
    lv = F.array(*[F.struct(F.lit(n).alias("threshold_name"), F.lit(float(t)).alias("threshold_ms"))
                   for n, t in levels])
    lowest = min(float(t) for _, t in levels)
    g = g.filter(F.col("gap_ms") > F.lit(lowest))
    g = g.select("instrument", F.col("prev_time").alias("gap_start"),
                 F.col("timestamp").alias("gap_end"), "gap_ms",
                 F.inline(F.filter(lv, lambda l: F.col("gap_ms") > l["threshold_ms"])))
    return g.select("instrument", "gap_start", "gap_end", "gap_ms",
                    (F.col("gap_ms") / 1000.0).alias("gap_seconds"),
                    "threshold_name", "threshold_ms")


def gaps(trades: DataFrame, threshold_ms: float, name: str, slice_seconds: int | None = None) -> DataFrame:
    """Gaps at one level."""
    return gaps_by_level(trades, [(name, threshold_ms)], slice_seconds)


def gap_counts(gaps_df: DataFrame, level: str = "HFT") -> DataFrame:
    """Gaps per instrument at one level, most first."""
    return (gaps_df.filter(F.col("threshold_name") == level)
                   .groupBy("instrument").agg(F.count(F.lit(1)).alias("gap_count"))
                   .orderBy(F.desc("gap_count"), "instrument"))


def gap_level_counts(trades: DataFrame, levels: Sequence[tuple[str, float]] = GAP_LEVELS,
                     slice_seconds: int | None = None, bounds: DataFrame | None = None) -> DataFrame:
    """Number of gaps per level in one pass (count_if per level, unpivoted)."""
    g = with_previous_time(trades, slice_seconds, bounds)
    aggs = [F.count_if(F.col("gap_ms") > F.lit(float(t))).alias(f"c{i}") for i, (_, t) in enumerate(levels)]
    one = g.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(n).alias("threshold_name"), F.lit(float(t)).alias("threshold_ms"),
                              F.col(f"c{i}").alias("gap_count"))
                     for i, (n, t) in enumerate(levels)])
    return one.select(F.inline(rows))


def outliers(trades: DataFrame, window: int = OUTLIER_WINDOW,
             threshold: float = OUTLIER_THRESHOLD, slice_seconds: int | None = None,
             bounds: DataFrame | None = None) -> DataFrame:
    """Ticks whose price deviates from the mean of the previous ``window``
    prices of the instrument by more than ``threshold`` (a fraction).

    The mean is null until ``window`` earlier non-null prices exist; the
    current tick is excluded.  A zero mean gives a null deviation.
    """
    aggs = {
        "rolling_avg": lambda w: F.avg("price").over(w.rowsBetween(-window, -1)),
        "_n_prev": lambda w: F.count("price").over(w.rowsBetween(-window, -1)),
    }
    r = rolling_previous(_sliced(trades, slice_seconds, bounds), ["instrument"], TRADE_ORDER,
                         F.col("_slice"), window, aggs)
    r = r.withColumn("rolling_avg", F.when(F.col("_n_prev") == window, F.col("rolling_avg")))
    r = r.withColumn("deviation_pct",
                     F.try_divide(F.abs(F.col("price") - F.col("rolling_avg")), F.col("rolling_avg")))
    r = r.filter(F.col("rolling_avg").isNotNull() & (F.col("deviation_pct") > F.lit(threshold)))
    return r.select("trade_id", "instrument", "timestamp", "price", "rolling_avg", "deviation_pct",
                    "volume", "side", F.lit("fat_finger").alias("outlier_type"),
                    F.lit(window).alias("window_size"), F.lit(float(threshold)).alias("threshold_pct"))


def top_outliers(outliers_df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest deviations (TakeOrderedAndProject; ties by id)."""
    return outliers_df.orderBy(F.desc("deviation_pct"), F.asc("trade_id")).limit(n)


def number_duplicates(trades: DataFrame, seq_slice: int = SEQUENCE_SLICE,
                      sample_fraction: float = 0.001, hot_min_sampled: int = 500) -> DataFrame:
    """Adds ``row_num``: occurrence number inside the fingerprint
    (timestamp, instrument, price, volume, side), ordered by
    (sequence_id, trade_id).

    Fingerprint groups found hot in a sample (by default ~500k+ copies) are
    spread over slices of ``seq_slice`` sequence numbers; all other groups
    are numbered by one plain window partition each."""
    out = ordered_position_hot(trades, FINGERPRINT, [F.col("sequence_id"), F.col("trade_id")],
                               F.floor(F.col("sequence_id") / F.lit(seq_slice)),
                               ["sequence_id", "trade_id"], name="_pos",
                               fraction=sample_fraction, min_sampled=hot_min_sampled)
    return out.withColumn("row_num", F.col("_pos") + 1).drop("_pos")


def duplicates(numbered: DataFrame) -> DataFrame:
    """Every later occurrence of a fingerprint, with its reason."""
    return (numbered.filter(F.col("row_num") > 1)
                    .select("trade_id", "instrument", "timestamp", "price", "volume", "side",
                            "sequence_id", "row_num", F.lit("duplicate").alias("exclusion_reason")))


def deduplicated(numbered: DataFrame) -> DataFrame:
    """The first occurrence of every fingerprint."""
    return numbered.filter(F.col("row_num") == 1).drop("row_num")


def clean_trades(dedup: DataFrame, outliers_df: DataFrame) -> DataFrame:
    """Deduplicated ticks minus outlier ids (an id-less tick is dropped too,
    as a membership test against the outlier ids cannot pass for it)."""
    ids = outliers_df.select("trade_id").distinct()
    return dedup.filter(F.col("trade_id").isNotNull()).join(ids, "trade_id", "left_anti")


def exclusions(numbered: DataFrame, outliers_df: DataFrame) -> DataFrame:
    """Every input tick that is not in the clean set, once, with the reason
    ('duplicate' before 'fat_finger'; 'missing_trade_id')."""
    ids = outliers_df.select("trade_id").distinct()
    cols = ["trade_id", "instrument", "timestamp", "price", "volume", "side", "sequence_id"]
    dups = numbered.filter(F.col("row_num") > 1).select(*cols, F.lit("duplicate").alias("exclusion_reason"))
    first = numbered.filter(F.col("row_num") == 1)
    fat = first.join(ids, "trade_id", "left_semi").select(*cols, F.lit("fat_finger").alias("exclusion_reason"))
    noid = first.filter(F.col("trade_id").isNull()).select(*cols, F.lit("missing_trade_id").alias("exclusion_reason"))
    return dups.unionByName(fat).unionByName(noid)


def quality_summary(trades: DataFrame, outliers_df: DataFrame, dups: DataFrame,
                    clean: DataFrame) -> DataFrame:
    """One row: totals, time range, instruments, outlier/duplicate/clean
    counts and percentages.  Built as one aggregate over a tagged union
    (no joins of one-row frames).  Percentages are null on empty input."""
    z = F.lit(0)
    t = trades.select(F.lit(1).alias("t"), z.alias("o"), z.alias("d"), z.alias("c"),
                      "timestamp", "instrument")
    nul_ts = F.lit(None).cast(trades.schema["timestamp"].dataType)
    nul_s = F.lit(None).cast("string")
    o = outliers_df.select(z.alias("t"), F.lit(1).alias("o"), z.alias("d"), z.alias("c"),
                           nul_ts.alias("timestamp"), nul_s.alias("instrument"))
    d = dups.select(z.alias("t"), z.alias("o"), F.lit(1).alias("d"), z.alias("c"),
                    nul_ts.alias("timestamp"), nul_s.alias("instrument"))
    c = clean.select(z.alias("t"), z.alias("o"), z.alias("d"), F.lit(1).alias("c"),
                     nul_ts.alias("timestamp"), nul_s.alias("instrument"))
    u = t.unionByName(o).unionByName(d).unionByName(c)
    a = u.agg(F.coalesce(F.sum("t"), F.lit(0)).cast("long").alias("total_trades"),
              F.min("timestamp").alias("first_timestamp"),
              F.max("timestamp").alias("last_timestamp"),
              F.count_distinct("instrument").alias("instrument_count"),
              F.coalesce(F.sum("o"), F.lit(0)).cast("long").alias("outlier_count"),
              F.coalesce(F.sum("d"), F.lit(0)).cast("long").alias("duplicate_count"),
              F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("clean_count"))
    return _with_shares(a)


def _with_shares(counts: DataFrame) -> DataFrame:
    pct = lambda col: F.try_divide(F.col(col) * 100.0, F.col("total_trades"))
    return counts.select("*", pct("outlier_count").alias("outlier_pct"),
                         pct("duplicate_count").alias("duplicate_pct"),
                         pct("clean_count").alias("clean_pct"),
                         (F.lit(100.0) - pct("outlier_count") - pct("duplicate_count")).alias("clean_pct_reference"))


SUMMARY = ("total_trades long, first_timestamp timestamp_ntz, last_timestamp timestamp_ntz, instrument_count long, "
           "outlier_count long, duplicate_count long, clean_count long")


def profile(trades: DataFrame, slice_seconds: int | None = None) -> dict[str, DataFrame]:
    """``ticks`` (with slices), ``outliers``, ``numbered`` ticks, the ``clean``
    set and the one-row ``summary``: the first three are written once, and the
    summary's figures are observed while they are, so it costs no scan.  The
    source is scanned once.

    The distinct instruments are observed as a set, which the driver merges:
    one entry an instrument."""
    from ticklake.session import materialize
    seen, found, kept = Observation(), Observation(), Observation()
    n = F.count(F.lit(1)).alias("n")
    ticks = materialize(trades.observe(seen, n, F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
                                       F.size(F.collect_set("instrument")).alias("instruments")), "ticks")
    sliced = slice_ticks(ticks, stored=True) if slice_seconds is None else _sliced(ticks, slice_seconds, None)
    o = materialize(outliers(sliced).observe(found, n), "outliers")
    fat = o.select("trade_id").filter(F.col("trade_id").isNotNull()).distinct().withColumn("fat_finger", F.lit(True))
    marked = number_duplicates(ticks).join(fat, "trade_id", "left")
    clean = (F.col("row_num") == 1) & F.col("trade_id").isNotNull() & F.col("fat_finger").isNull()
    marked = materialize(marked.observe(kept, F.count_if(F.col("row_num") > 1).alias("duplicates"), F.count_if(clean).alias("clean")),
                         "numbered")
    row = (seen.get["n"], seen.get["first"], seen.get["last"], seen.get["instruments"], found.get["n"],
           kept.get["duplicates"], kept.get["clean"])
    numbered = marked.drop("fat_finger").select(*trades.columns, "row_num")
    return {"ticks": sliced, "outliers": o, "numbered": numbered, "clean": marked.filter(clean).select(*trades.columns),
            "summary": _with_shares(trades.sparkSession.createDataFrame([row], SUMMARY))}


def fingerprint(trades: DataFrame) -> DataFrame:
    """Adds ``fingerprint``: xxhash64 of the five fingerprint columns (for
    display; grouping always uses the columns themselves, so a hash
    collision can never merge two different ticks)."""
    return trades.withColumn("fingerprint", F.xxhash64(*FINGERPRINT))


def quality_report(trades: DataFrame, slice_seconds: int | None = None) -> dict[str, DataFrame]:
    """The report's tables: summary, gaps per level, gaps per instrument
    at the finest level, top 10 outliers (text layout is left to callers).

    The ticks, the numbered ticks and the outliers feed several outputs: each
    is computed once and written to the shared checkpoint folder
    (``profile``)."""
    p = profile(trades, slice_seconds)
    t, n, o = p["ticks"], p["numbered"], p["outliers"]
    finest = min(GAP_LEVELS, key=lambda lv: lv[1])[0]
    return {"summary": p["summary"],
            "gap_levels": gap_level_counts(t),
            "gaps_by_instrument": gap_counts(gaps_by_level(t), finest),
            "gaps": gaps(t, dict(GAP_LEVELS)[finest], finest),
            "top_outliers": top_outliers(o, 10),
            "outliers": o, "duplicates": duplicates(n), "clean": p["clean"], "exclusions": exclusions(n, o)}


def write_audit_tables(trades: DataFrame, out_root: str, slice_seconds: int | None = None) -> dict[str, str]:
    """The audit sink: gaps at the finest level, outliers, duplicates, the
    clean set and every exclusion with its reason, as Parquet tables under
    ``out_root`` (replaced).  Returns the written paths."""
    rep = quality_report(trades, slice_seconds)
    tables = {
        "gaps": rep["gaps"],
        "outliers": rep["outliers"],
        "duplicates": rep["duplicates"],
        "clean_trades": rep["clean"],
        "exclusions": rep["exclusions"],
    }
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{out_root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    return paths
