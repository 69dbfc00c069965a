"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each runs over the whole driver tables (through the ``sources``
projections).  Computed doubles that are accumulated in a different order
by another engine (means, standard deviations) are rounded to 6 decimals
in the output only; filters use the unrounded values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake import sources as S
from ticklake.functions.wire import check_instruments, decode_wire, encode_wire, kafka_records, status_counts, to_ticks
from ticklake.operators import alerts as A
from ticklake.operators import candles as C
from ticklake.operators import drift as D
from ticklake.operators import quality as Q
from ticklake.operators import storage as ST
from ticklake.session import materialize, scratch_path
from ticklake.streaming import aggregator as SA
from ticklake.streaming import exact as X
from ticklake.streaming import snapshot as SN

REFERENCE_SIZES = (1, 10, 60)
SERIES_INSTRUMENT = "click"
SERIES_SIZE = "1m"


def _round(df: DataFrame, cols: list[str], places: int = 6) -> DataFrame:
    return df.select(*[F.round(c, places).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---- candles -------------------------------------------------------------

def _ohlcv(seconds: int, label: str | None = None):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return C.ohlcv(S.trades(spark, sf), seconds, label)
    return q


def ohlcv_all_sizes(spark, sf):
    return C.all_sizes(S.trades(spark, sf), REFERENCE_SIZES)


def candle_summary(spark, sf):
    return C.candle_summary(ohlcv_all_sizes(spark, sf))


def candle_series(spark, sf):
    return C.candle_series(ohlcv_all_sizes(spark, sf), SERIES_INSTRUMENT, SERIES_SIZE)


def latest_candle(spark, sf):
    return C.latest_candle(ohlcv_all_sizes(spark, sf))


def snapshot_candles(spark, sf):
    return C.newest_per_size(ohlcv_all_sizes(spark, sf), 500, ["1s", "10s", "1m"])


def distinct_instruments(spark, sf):
    return C.distinct_values(S.trades(spark, sf), "instrument")


def first_messages(spark, sf):
    return C.first_messages(S.messages(spark, sf), 1000)


# ---- quality -------------------------------------------------------------

def gaps_by_level(spark, sf):
    return Q.gaps_by_level(S.trades(spark, sf))


def gap_counts(spark, sf):
    return Q.gap_counts(gaps_by_level(spark, sf), "HFT")


#: Ticks of a slice in the two queries that cut these tables' days.
SLICED_ROWS = 256


def gaps_sliced(spark, sf):
    """Gaps when every busy day of an instrument is cut by its sketch."""
    return Q.gaps_by_level(Q.slice_ticks(S.trades(spark, sf), SLICED_ROWS))


def outliers_sliced(spark, sf):
    return _round(Q.outliers(Q.slice_ticks(S.trades(spark, sf), SLICED_ROWS)), ["rolling_avg", "deviation_pct"])


def gap_level_counts(spark, sf):
    return Q.gap_level_counts(S.trades(spark, sf))


def _outliers_raw(spark, sf, table=S.trades):
    return Q.outliers(table(spark, sf))


def outliers(spark, sf):
    return _round(_outliers_raw(spark, sf), ["rolling_avg", "deviation_pct"])


def top_outliers(spark, sf):
    return _round(Q.top_outliers(_outliers_raw(spark, sf), 10), ["rolling_avg", "deviation_pct"])


def _numbered(spark, sf):
    return Q.number_duplicates(S.trades_dup(spark, sf))


def duplicates(spark, sf):
    return Q.duplicates(_numbered(spark, sf))


def deduplicated(spark, sf):
    return Q.deduplicated(_numbered(spark, sf))


def _clean(spark, sf):
    """The clean set: the ticks are written once, for both exclusions."""
    t = Q.slice_ticks(S.trades_dup(spark, sf))
    return Q.clean_trades(Q.deduplicated(Q.number_duplicates(t.drop("_slice"))), Q.outliers(t))


def clean_trades(spark, sf):
    return _clean(spark, sf)


def exclusions(spark, sf):
    # the ticks feed both exclusions, the numbered ones three branches: each computed once
    t = Q.slice_ticks(S.trades_dup(spark, sf))
    return Q.exclusions(materialize(Q.number_duplicates(t.drop("_slice")), "numbered"), Q.outliers(t))


def quality_summary(spark, sf):
    """Observed while the profile's tables are written."""
    q = Q.profile(S.trades_dup(spark, sf))["summary"]
    return _round(q, ["outlier_pct", "duplicate_pct", "clean_pct", "clean_pct_reference"], 9)


# ---- wire ----------------------------------------------------------------

def wire_encode(spark, sf):
    e = encode_wire(S.messages(spark, sf))
    return e.select("sequence_id", F.col("instrument").alias("key"), "line")


def _decoded(spark, sf):
    return decode_wire(S.wire_lines(spark, sf).drop("key", "partition"))


def wire_decode(spark, sf):
    return _decoded(spark, sf)


def valid_ticks(spark, sf):
    return to_ticks(_decoded(spark, sf))


def dead_letters(spark, sf):
    return _decoded(spark, sf).filter(F.col("error").isNotNull()).select("raw", "error")


def dead_letters_known(spark, sf):
    """Dead letters when the instrument must be listed at the time."""
    known = materialize(S.instruments(spark, sf), "instruments")
    return check_instruments(_decoded(spark, sf), known).filter(F.col("error").isNotNull()).select("raw", "error")


def tick_status_counts(spark, sf):
    return status_counts(S.wire_lines(spark, sf))


def msg_type_counts(spark, sf):
    return S.messages(spark, sf).groupBy("msg_type").agg(F.count(F.lit(1)).alias("count"))


# ---- drift ---------------------------------------------------------------

def _drift(spark, sf):
    rt = C.candles_by_size(S.trades_rt(spark, sf), REFERENCE_SIZES, is_realtime=True)
    bt = C.candles_by_size(S.trades(spark, sf), REFERENCE_SIZES, is_realtime=False)
    return D.measure_drift_by_size(rt, bt)


def drift(spark, sf):
    return _drift(spark, sf)


def _drift_report(spark, sf):
    return D.drift_report(_drift(spark, sf))


def _stored_by_size(trades: DataFrame, is_realtime: bool) -> dict[int, DataFrame]:
    """Candles by size, the finest written once: a join's not-null filters
    cannot then reach the ticks and read them again for every size."""
    finest = materialize(C.ohlcv(trades, REFERENCE_SIZES[0], is_realtime=is_realtime), "finest_candles")
    return {s: C.rollup(finest, s) if s > REFERENCE_SIZES[0] else finest for s in REFERENCE_SIZES}


def drift_matched(spark, sf):
    return D.matched_by_size(_stored_by_size(S.trades_rt(spark, sf), True), _stored_by_size(S.trades(spark, sf), False))


def drift_stored(spark, sf):
    """The drift table written and read back."""
    path = scratch_path(spark, "drift")
    D.write_drift(_drift(spark, sf), path)
    return spark.read.parquet(path)


def drift_summary(spark, sf):
    return _round(_drift_report(spark, sf), ["close_drift_mean_pct", "close_drift_std_pct",
                                            "volume_drift_mean_pct", "trade_count_diff_mean",
                                            "missing_in_realtime_pct"])


def drift_by_window(spark, sf):
    return _round(D.drift_by_window(_drift(spark, sf)), ["close_drift_mean", "trade_diff_mean"])


def drift_alerts(spark, sf):
    return _round(A.drift_alerts(_drift_report(spark, sf)), ["value"])


# ---- storage -------------------------------------------------------------

def partition_counts(spark, sf):
    return ST.partition_counts(_clean(spark, sf))


def _store(spark, sf) -> str:
    root = scratch_path(spark, "trades_by_day")
    ST.write_partitioned(_clean(spark, sf), root)
    return root


def partition_day(spark, sf):
    root = _store(spark, sf)
    day = ST.first_day(spark, root)          # from folder names
    return ST.read_day(spark, root, *day) if day else ST.read_store(spark, root)


def first_partition(spark, sf):
    return ST.first_partition(spark, _store(spark, sf))


def store_stats(spark, sf):
    """Rows per day of the written store (bytes and files vary by run)."""
    return ST.write_stats(spark, _store(spark, sf)).select(*ST.PARTS, "rows", (F.col("bytes") > 0).alias("has_bytes"))


def store_totals(spark, sf):
    t = ST.storage_totals(ST.write_stats(spark, _store(spark, sf)))
    return t.select("partitions", "total_rows", (F.col("csv_ratio") > 0).alias("has_ratio"))


def pruning_check(spark, sf):
    """Both counts run; files differ by run, so their relation is given."""
    root = _store(spark, sf)
    c = ST.pruning_check(spark, root, *ST.first_day(spark, root))
    fewer = (F.col("files_read") < F.col("files_total")) | (F.col("partitions_total") == 1)
    return c.select("store_rows", "day_rows", "partitions_total", "partitions_read", fewer.alias("fewer_files"), "pruned", "checked_day")


def candle_sink(spark, sf):
    """Batch candles written and read back."""
    path = scratch_path(spark, "candles")
    C.write_candles(ohlcv_all_sizes(spark, sf), path)
    return C.load_candles(spark, path).select(*C.CANDLE_COLUMNS)


def candles_from_text(spark, sf):
    """A candle table whose times are ISO text, loaded leniently."""
    path = scratch_path(spark, "candles_text")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    c = ohlcv_all_sizes(spark, sf)
    c.select(*[F.date_format(x, iso).alias(x) if x in ("window_start", "window_end") else x for x in C.CANDLE_COLUMNS]).write.parquet(path)
    return C.load_candles(spark, path).select(*C.CANDLE_COLUMNS)


def audit_exclusions(spark, sf):
    """The audit sink's exclusions, read back."""
    root = scratch_path(spark, "audit")
    return spark.read.parquet(Q.write_audit_tables(S.trades_dup(spark, sf), root)["exclusions"])


def report_gap_levels(spark, sf):
    return Q.quality_report(S.trades(spark, sf))["gap_levels"]


def report_top_outliers(spark, sf):
    return _round(Q.quality_report(S.trades(spark, sf))["top_outliers"], ["rolling_avg", "deviation_pct"])


def fingerprint_groups(spark, sf):
    """Repeated ticks by their fingerprint: the smallest sequence number and
    the copies of each group."""
    f = Q.fingerprint(S.trades_dup(spark, sf))
    g = f.groupBy("fingerprint").agg(F.min("sequence_id").alias("first_sequence"), F.count(F.lit(1)).alias("copies"))
    return g.filter("copies > 1").select("first_sequence", "copies")


def kafka_messages(spark, sf):
    """Keyed records for the log: key and value as text."""
    k = kafka_records(S.messages(spark, sf))
    return k.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def partition_assignment(spark, sf):
    """Each key's messages, and whether they share one partition of six."""
    k = kafka_records(S.messages(spark, sf))
    one = (F.count_distinct("partition") == 1) & (F.min("partition") >= 0) & (F.max("partition") < 6)
    return k.groupBy(F.col("key").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("messages"), one.alias("one_partition"))


# ---- streaming -----------------------------------------------------------

def late_rate(spark, sf):
    return SA.late_rate(S.arrivals(spark, sf))


def _log(spark, sf) -> str:
    src = scratch_path(spark, "log")
    S.log_lines(spark, sf).select("key", "value", "position").write.parquet(src)
    return src


def _finish(queries) -> None:
    for q in queries:
        q.awaitTermination()


_SIZES = [c.name for c in SA.WINDOW_CONFIGS]


def stream_ohlcv(spark, sf):
    src = _log(spark, sf)
    out, ck = scratch_path(spark, "stream_candles"), scratch_path(spark, "stream_ckpt")
    _finish(SA.start_candle_queries(SA.file_source(spark, src), out, ck))
    return SA.read_upserted(spark, out, _SIZES)


def stream_restart(spark, sf):
    """Half of the log, a stop, then the rest from the checkpoint."""
    src = scratch_path(spark, "log")
    lines = S.log_lines(spark, sf)
    first = lines.filter("sequence_id % 2 = 0").select("key", "value", "position")
    rest = lines.filter("sequence_id % 2 = 1").select("key", "value", "position")
    configs = [SA.WindowConfig(c.name, c.seconds, 10 ** 10) for c in SA.WINDOW_CONFIGS]   # nothing is late
    out, ck = scratch_path(spark, "stream_candles"), scratch_path(spark, "stream_ckpt")
    for part in (first, rest):
        part.write.mode("append").parquet(src)
        _finish(SA.start_candle_queries(SA.file_source(spark, src), out, ck, configs))
    return SA.read_upserted(spark, out, _SIZES)


def _routed(spark, sf) -> str:
    table, ck = scratch_path(spark, "routed"), scratch_path(spark, "routed_ckpt")
    SA.start_router_query(SA.file_source(spark, _log(spark, sf)), table, ck).awaitTermination()
    return table


def stream_ohlcv_routed(spark, sf):
    table = _routed(spark, sf)
    out, ck = scratch_path(spark, "stream_candles"), scratch_path(spark, "stream_ckpt")
    _finish(SA.start_candle_queries_on_ticks(SA.routed_valid_ticks(spark, table), out, ck))
    return SA.read_upserted(spark, out, _SIZES)


def stream_dead_letters_routed(spark, sf):
    return SA.routed_dead_letters(spark, _routed(spark, sf))


def stream_dead_letters(spark, sf):
    out, ck = scratch_path(spark, "stream_dlq"), scratch_path(spark, "stream_dlq_ckpt")
    SA.start_dead_letter_query(SA.file_source(spark, _log(spark, sf)), out, ck).awaitTermination()
    return spark.read.schema("raw string, error string").json(out)


def stream_dead_letters_known(spark, sf):
    """The same rule in the stream, which joins the same table."""
    known = materialize(S.instruments(spark, sf), "instruments")
    out, ck = scratch_path(spark, "stream_dlq"), scratch_path(spark, "stream_dlq_ckpt")
    SA.start_dead_letter_query(SA.file_source(spark, _log(spark, sf)), out, ck, instruments=known).awaitTermination()
    return spark.read.schema("raw string, error string").json(out)


def stream_snapshot(spark, sf):
    """The live snapshot after the whole log."""
    root, ck = scratch_path(spark, "snapshot"), scratch_path(spark, "snapshot_ckpt")
    _finish(SN.start_snapshot_queries(SA.file_source(spark, _log(spark, sf)), root, ck, available_now=True))
    return SN.read_snapshots(spark, root, _SIZES)


def _late_parts(spark, sf) -> list[DataFrame]:
    """The on-time ticks, the newest tick again (the watermark now holds),
    then every 25th tick, late."""
    t = S.trades(spark, sf).withColumn("trade_id", F.concat(F.lit("POW-"), "trade_id"))
    late = F.col("sequence_id") % 25 == 2
    newest = t.filter(~late).orderBy(F.desc("timestamp"), F.desc("sequence_id")).limit(1)
    return [encode_wire(part).select(F.col("instrument").cast("binary").alias("key"), F.col("line").cast("binary").alias("value"),
                                     F.col("sequence_id").alias("position"))
            for part in (t.filter(~late), newest.withColumn("instrument", F.lit("spare")), t.filter(late))]


def _run_parts(spark, parts, start) -> None:
    """The parts of a log one after the other: ``start(source folder)`` runs
    its queries after each from their checkpoints.  A part keeps the files and
    partitions that it has."""
    src = scratch_path(spark, "log_parts")
    for part in parts:
        part.write.mode("append").parquet(src)
        _finish(start(src))


def _drop_spare(df: DataFrame) -> DataFrame:
    return df.filter("instrument <> 'spare'")


def stream_late_drop(spark, sf):
    """Candles when late micro-batches follow: ticks of closed windows are
    dropped, those of open windows still count."""
    out, ck = scratch_path(spark, "late_candles"), scratch_path(spark, "late_ckpt")
    _run_parts(spark, _late_parts(spark, sf), lambda src: SA.start_candle_queries(SA.file_source(spark, src), out, ck))
    return _drop_spare(SA.read_upserted(spark, out, _SIZES))


def stream_append(spark, sf):
    """Append mode: each closed candle once."""
    out, ck = scratch_path(spark, "append_candles"), scratch_path(spark, "append_ckpt")
    _run_parts(spark, _late_parts(spark, sf),
               lambda src: SA.start_candle_queries(SA.file_source(spark, src), out, ck, correct_late=False))
    parts = [spark.read.schema(SA.CANDLE_SCHEMA).parquet(f"{out}/{s}") for s in _SIZES]
    found = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return _drop_spare(found)


def stream_late_counts(spark, sf):
    """Late ticks of the same log, counted before aggregation."""
    out, ck = scratch_path(spark, "late_counts"), scratch_path(spark, "late_counts_ckpt")
    _run_parts(spark, _late_parts(spark, sf), lambda src: [SA.start_late_counter(
        SA.valid_ticks(decode_wire(SA.file_source(spark, src))), out, ck)])
    return spark.read.parquet(out).groupBy("window_size").agg(
        F.sum("ticks").alias("total_ticks"), F.sum("late_ticks").alias("late_ticks"))


def stream_open_state(spark, sf):
    """Windows still open after the log, read from the stopped queries'
    checkpoints."""
    out, ck = scratch_path(spark, "stream_candles"), scratch_path(spark, "stream_ckpt")
    _finish(SA.start_candle_queries(SA.file_source(spark, _log(spark, sf)), out, ck))
    return X.open_windows(spark, ck)


def _exact(spark, sf) -> tuple[str, str]:
    """The exact stream over a keyed log with late ticks, in three runs."""
    a = S.arrivals(spark, sf, keyed=True)
    ends = a.groupBy("kafka_partition").agg(F.max("offset_in_partition").alias("end"))
    third = F.floor((F.col("offset_in_partition") - 1) * 3 / F.col("end"))
    log = encode_wire(a.join(ends, "kafka_partition").withColumn("third", third)).select(
        F.col("instrument").cast("binary").alias("key"), F.col("line").cast("binary").alias("value"),
        F.col("offset_in_partition").cast("long").alias("position"), F.col("kafka_partition").cast("int").alias("partition"), "third")
    log = materialize(log, "keyed_log")
    out, ck = scratch_path(spark, "exact_candles"), scratch_path(spark, "exact_ckpt")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, X.ROCKSDB)
    try:
        _run_parts(spark, [log.filter(F.col("third") == k).drop("third") for k in range(3)],
                   lambda src: [X.start_exact_query(X.exact_source(spark, src), out, ck)])
    finally:
        spark.conf.set(provider, before)
    return out, ck


def stream_exact(spark, sf):
    """Candles by the per-tick lateness rule: the closed ones, and those open
    at the log's end from the checkpoint."""
    return X.all_candles(spark, *_exact(spark, sf))


def stream_exact_late(spark, sf):
    """The side table of ticks that were late for a size."""
    return X.late_ticks(spark, _exact(spark, sf)[0])


def _progress(spark, sf) -> tuple[DataFrame, DataFrame]:
    """A progress table as the listener records it: one report per
    instrument and hour, and the late counts of the same hours."""
    t = S.trades(spark, sf)
    hour = F.date_trunc("hour", "timestamp").alias("at")
    p = t.groupBy(F.col("instrument").alias("query"), hour).agg(
        F.count(F.lit(1)).alias("input_rows"), F.count_distinct("price").alias("rows_updated"),
        F.max(F.col("sequence_id") * 17 % 150000).alias("source_lag"))
    p = p.withColumn("batch_id", F.unix_micros(F.col("at").cast("timestamp")))
    late = t.groupBy(hour).agg(F.count(F.lit(1)).alias("ticks"), F.count_if(F.col("sequence_id") % 25 == 2).alias("late_ticks"))
    return p, late


def health_metrics(spark, sf):
    p, late = _progress(spark, sf)
    m = SA.health_metrics(p, late, drift_pct=0.4, window="6 hours")
    return m.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def health_live(spark, sf):
    """Health of a stream that is run here, as its listener recorded it: on
    time; stalled (the log grows, nothing reads it); then late ticks only."""
    src, out, ck = (scratch_path(spark, n) for n in ("health_log", "health_candles", "health_ckpt"))
    counts, reports = scratch_path(spark, "health_late"), scratch_path(spark, "health_reports")
    on_time, _, late = _late_parts(spark, sf)
    runs, produced = [], []
    log = SA.ProgressLog(spark, reports)
    spark.streams.addListener(log)
    try:
        for no, (phase, part, reads) in enumerate((("on_time", on_time, True), ("stalled", late, False), ("late", None, True))):
            if part is not None:
                part.write.mode("append").parquet(src)
            if reads:
                source = SA.file_source(spark, src)
                qs = SA.start_candle_queries(source, out, ck)
                runs += [(phase, "candles", q.runId) for q in qs]
                qs.append(SA.start_late_counter(SA.valid_ticks(decode_wire(source)), counts, f"{ck}/late"))
                runs.append((phase, "late", qs[-1].runId))
                _finish(qs)
            produced.append((no, phase, spark.read.parquet(src).count()))
        log.flush()
    finally:
        spark.streams.removeListener(log)
    late_counts = spark.read.option("basePath", counts).parquet(counts).select(F.col("batch_id").cast("long").alias("batch_id"), "ticks", "late_ticks")
    return SA.phase_metrics(SA.read_progress(spark, reports), spark.createDataFrame(runs, "phase string, role string, run string"),
                            late_counts, spark.createDataFrame(produced, "phase_no int, phase string, rows long"))


def health_alerts_live(spark, sf):
    return A.health_alerts(materialize(health_live(spark, sf), "health_live"))


def health_alerts(spark, sf):
    return A.health_alerts(health_metrics(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ohlcv_1s": _ohlcv(1),
    "ohlcv_10s": _ohlcv(10),
    "ohlcv_1m": _ohlcv(60),
    "ohlcv_1h": _ohlcv(3600, "1h"),
    "ohlcv_all_sizes": ohlcv_all_sizes,
    "candle_summary": candle_summary,
    "candle_series": candle_series,
    "latest_candle": latest_candle,
    "snapshot_candles": snapshot_candles,
    "distinct_instruments": distinct_instruments,
    "first_messages": first_messages,
    "gaps_by_level": gaps_by_level,
    "gaps_sliced": gaps_sliced,
    "outliers_sliced": outliers_sliced,
    "gap_counts": gap_counts,
    "gap_level_counts": gap_level_counts,
    "outliers": outliers,
    "top_outliers": top_outliers,
    "duplicates": duplicates,
    "deduplicated": deduplicated,
    "clean_trades": clean_trades,
    "exclusions": exclusions,
    "quality_summary": quality_summary,
    "wire_encode": wire_encode,
    "wire_decode": wire_decode,
    "valid_ticks": valid_ticks,
    "dead_letters": dead_letters,
    "dead_letters_known": dead_letters_known,
    "stream_dead_letters_known": stream_dead_letters_known,
    "tick_status_counts": tick_status_counts,
    "msg_type_counts": msg_type_counts,
    "drift": drift,
    "drift_matched": drift_matched,
    "drift_summary": drift_summary,
    "drift_by_window": drift_by_window,
    "drift_alerts": drift_alerts,
    "partition_counts": partition_counts,
    "partition_day": partition_day,
    "first_partition": first_partition,
    "drift_stored": drift_stored,
    "store_stats": store_stats,
    "store_totals": store_totals,
    "pruning_check": pruning_check,
    "candle_sink": candle_sink,
    "candles_from_text": candles_from_text,
    "audit_exclusions": audit_exclusions,
    "report_gap_levels": report_gap_levels,
    "report_top_outliers": report_top_outliers,
    "fingerprint_groups": fingerprint_groups,
    "kafka_messages": kafka_messages,
    "partition_assignment": partition_assignment,
    "stream_snapshot": stream_snapshot,
    "stream_restart": stream_restart,
    "stream_late_drop": stream_late_drop,
    "stream_append": stream_append,
    "stream_late_counts": stream_late_counts,
    "stream_open_state": stream_open_state,
    "stream_exact": stream_exact,
    "stream_exact_late": stream_exact_late,
    "health_metrics": health_metrics,
    "health_alerts": health_alerts,
    "health_live": health_live,
    "health_alerts_live": health_alerts_live,
    "late_rate": late_rate,
    "stream_ohlcv": stream_ohlcv,
    "stream_dead_letters": stream_dead_letters,
    "stream_ohlcv_routed": stream_ohlcv_routed,
    "stream_dead_letters_routed": stream_dead_letters_routed,
}
