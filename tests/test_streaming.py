import json
import os
import zlib
from datetime import datetime

from pyspark.sql import functions as F

from ticklake import sources as S
from ticklake.functions.wire import decode_wire
from ticklake.operators.alerts import health_alerts
from ticklake.session import scratch_path
from ticklake.streaming import aggregator as SA
from ticklake.schemas import WindowConfig


def _write_wire(spark, path, lines, first=0):
    spark.createDataFrame([(None, v, first + i) for i, v in enumerate(lines)], "key binary, value binary, position long").coalesce(1) \
        .write.mode("append").parquet(path)


def _us(sec):
    return int((datetime(2024, 1, 1) - datetime(1970, 1, 1)).total_seconds() * 1e6 + sec * 1e6)


def line(i, sec, price=1.0):
    return f"{i},X,{_us(sec)},{price:.2f},1.0,BUY,T".encode()


def test_tied_ticks_with_text_ids_follow_their_position(spark):
    """Three ticks on one timestamp: open and close by place in the log."""
    src, out, ck = scratch_path(spark, "wire"), scratch_path(spark, "out"), scratch_path(spark, "ck")
    lines = [f"POW-{i:09d},X,{_us(0.5)},{p:.2f},1.0,BUY,T".encode() for i, p in ((3, 10.0), (1, 20.0), (2, 30.0))]
    _write_wire(spark, src, lines, first=7)
    for q in SA.start_candle_queries(SA.file_source(spark, src), out, ck):
        q.awaitTermination()
    assert {(r.open, r.close) for r in SA.read_upserted(spark, out, ["1s", "10s", "1m"]).collect()} == {(10.0, 30.0)}


def test_candle_query_plans_no_sort_aggregate(spark):
    ticks = SA.valid_ticks(decode_wire(spark.createDataFrame([], "key binary, value binary, position long")))
    for cfg in SA.WINDOW_CONFIGS:
        plan = SA.candle_stream(ticks, cfg)._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_query_names_are_stable():
    assert SA.query_name("1s", "/x/out") == SA.query_name("1s", "/x/out") == "candles_1s_" + f"{zlib.crc32(b'/x/out'):08x}"


def _candle(base, i):
    ws = F.timestamp_add("SECOND", F.lit(i % 7), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"))
    return base.select("instrument", "window_size", ws.alias("window_start"), F.timestamp_add("SECOND", F.lit(1), ws).alias("window_end"),
                       *[F.lit(float(i)).alias(c) for c in ("open", "high", "low", "close", "volume")],
                       F.lit(i).cast("long").alias("trade_count"), F.lit(True).alias("is_realtime"))


def test_readers_lose_nothing_while_folders_are_merged(spark):
    """Frames made before a merge read the same rows during and after it."""
    from concurrent.futures import ThreadPoolExecutor

    from ticklake.streaming import upserts as U
    root = scratch_path(spark, "ups")
    base = spark.createDataFrame([("X", "1s")], "instrument string, window_size string")
    for i in range(8):
        _candle(base, i).write.parquet(f"{root}/1s/L0-{i}-{i}")
    held = U.read_upserted(spark, root, ["1s"])              # not read yet
    rows = lambda df: sorted((r.window_start.second, r.close) for r in df.collect())
    want = sorted((i % 7, float(i)) for i in range(1, 8))
    with ThreadPoolExecutor(2) as pool:
        merge = pool.submit(U.compact, spark, f"{root}/1s", 4)
        reads = [rows(held)]
        while not merge.done():
            reads += [rows(held), rows(U.read_upserted(spark, root, ["1s"]))]
        merge.result()
    assert all(r == want for r in reads) and rows(held) == want
    assert U.folders(spark, f"{root}/1s") == [(1, 0, 7)]
    assert U.sweep(spark, f"{root}/1s") == 0 and U.sweep(spark, f"{root}/1s", retain_seconds=0) == 8
    assert rows(U.read_upserted(spark, root, ["1s"])) == want


def test_folders_stay_few_and_half_written_ones_are_not_read(spark):
    from ticklake.streaming import upserts as U
    root = scratch_path(spark, "ups")
    base = spark.createDataFrame([("X", "1s")], "instrument string, window_size string")
    write = U.batch_writer(f"{root}/1s", fan=4, retain_seconds=0)
    batch = lambda i: _candle(base, i)
    most = 0
    for i in range(50):
        write(batch(i), i)
        most = max(most, len(U.folders(spark, f"{root}/1s")))
    assert most <= 12
    assert len(U._complete(spark, f"{root}/1s")) <= 12
    write(batch(49), 49)                                   # a replayed batch
    batch(6).withColumn("close", F.lit(-1.0)).write.parquet(f"{root}/1s/L0-99-99")
    os.remove(f"{(root[5:] if root.startswith('file:') else root)}/1s/L0-99-99/_SUCCESS")
    got = {r.window_start.second: r.close for r in U.read_upserted(spark, root, ["1s", "10s"]).collect()}
    assert got == {i % 7: float(i) for i in range(43, 50)}


def test_late_ticks_are_counted_one_by_one(spark):
    """Four late ticks of one window are four, not one group."""
    src, out, ck = scratch_path(spark, "wire"), scratch_path(spark, "late"), scratch_path(spark, "ck")
    _write_wire(spark, src, [line(1, 10.0), line(2, 10.2), line(3, 10.4)])
    _write_wire(spark, src, [line(i, 0.1 * i) for i in range(4, 8)])
    for _ in range(2):                                     # a restart changes nothing
        ticks = SA.valid_ticks(decode_wire(SA.file_source(spark, src, 1)))
        SA.start_late_counter(ticks, out, ck, [WindowConfig("1s", 1, 200)]).awaitTermination()
    r = spark.read.parquet(out).agg(F.sum("ticks").alias("t"), F.sum("late_ticks").alias("l")).first()
    assert (r.t, r.l) == (7, 4)


def test_health_takes_the_newest_lag_of_every_query(spark):
    rows = [("slow", 3, datetime(2024, 1, 1, 0, 1), 10, 0.0, 0, 0, 200_000), ("fast", 90, datetime(2024, 1, 1, 0, 2), 10, 0.0, 0, 5, 5),
            ("slow", 2, datetime(2024, 1, 1, 0, 0), 10, 0.0, 0, 0, 1), ("none", 99, datetime(2024, 1, 1, 0, 2), 0, 0.0, 0, 0, None)]
    rows = [(*r, "run") for r in rows]
    m = SA.health_metrics(spark.createDataFrame(rows, SA.PROGRESS)).first()
    assert m.lag == 200_005 and m.ticks_per_sec == 30 / 300 and m.candles_emitted == 5
    assert {r.alert for r in health_alerts(SA.health_metrics(spark.createDataFrame(rows, SA.PROGRESS), drift_pct=0.9)).collect()} == {
        "low_throughput", "high_lag", "critical_lag", "high_drift"}


def test_progress_log_keeps_every_report(spark):
    path = scratch_path(spark, "progress")
    log = SA.ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        src, out, ck = scratch_path(spark, "wire"), scratch_path(spark, "out"), scratch_path(spark, "ck")
        for i in range(3):
            _write_wire(spark, src, [line(i, i + 0.5)])
        q = SA.start_candle_queries(SA.file_source(spark, src, 1), out, ck, configs=[WindowConfig("1s", 1, 200)])[0]
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    finally:
        spark.streams.removeListener(log)
    got = SA.read_progress(spark, path).collect()
    assert sum(r.input_rows for r in got) == 3 and all(r.query.startswith("candles_1s_") for r in got)
    assert SA._offset_lag({"endOffset": '{"t": {"0": 5, "1": 7}}', "latestOffset": '{"t": {"0": 9, "1": 7}}'}) == 4


def _report(query, batch, at, rows, run):
    return {"query": query, "batch_id": batch, "at": f"2024-01-01T00:00:{at:02d}Z", "input_rows": rows, "processed_rows_per_sec": 1.0,
            "state_rows": 1, "rows_updated": rows, "source_lag": None, "run": run}


def test_progress_is_rolled_up_and_read_once(spark):
    path = scratch_path(spark, "progress")
    fs, root, jvm = SA._fs(spark, path)

    def keep(rows):
        for r in rows:
            out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{path}/{r['query']}-{r['batch_id']}.json"), True)
            out.write(bytearray((json.dumps(r) + "\n").encode()))
            out.close()

    assert SA.read_progress(spark, path).count() == 0 and SA.roll_up_progress(spark, path) == 0
    keep([_report("a", k, k, 10 + k, "r1") for k in range(5)])
    assert SA.roll_up_progress(spark, path, fan=6) == 0
    assert SA.roll_up_progress(spark, path, fan=5) == 5
    keep([_report("a", 4, 30, 99, "r2"), _report("b", 0, 31, 7, "r2")])      # batch 4 was run again
    got = {(r.query, r.batch_id): (r.input_rows, r.run) for r in SA.read_progress(spark, path).collect()}
    assert got == {**{("a", k): (10 + k, "r1") for k in range(4)}, ("a", 4): (99, "r2"), ("b", 0): (7, "r2")}
    assert SA.roll_up_progress(spark, path, fan=1) == 2
    assert {(r.query, r.batch_id): (r.input_rows, r.run) for r in SA.read_progress(spark, path).collect()} == got


def test_phase_metrics(spark):
    progress = spark.createDataFrame([tuple({**_report(q, b, b, n, run), "at": datetime(2024, 1, 1)}[c.split()[0]] for c in
                                            SA.PROGRESS.split(", ")) for q, b, n, run in (
        ("c1", 0, 100, "x"), ("c2", 0, 100, "y"), ("late", 0, 100, "z"), ("c1", 1, 20, "u"), ("late", 1, 20, "v"), ("other", 0, 5, "w"))], SA.PROGRESS)
    runs = spark.createDataFrame([("up", "candles", "x"), ("up", "candles", "y"), ("up", "late", "z"), ("again", "candles", "u"),
                                  ("again", "late", "v")], "phase string, role string, run string")
    late = spark.createDataFrame([(0, 100, 0), (1, 20, 5), (1, 20, 0)], "batch_id long, ticks long, late_ticks long")
    produced = spark.createDataFrame([(0, "up", 100), (1, "down", 150), (2, "again", 150)], "phase_no int, phase string, rows long")
    m = SA.phase_metrics(progress, runs, late, produced)
    assert {r.phase: (r.input_rows, r.candles_emitted, r.late_share, r.lag) for r in m.collect()} == {
        "up": (100, 200, 0.0, 0), "down": (0, 0, None, 50), "again": (20, 20, 0.125, 30)}
    assert {(r.phase, r.alert) for r in health_alerts(m).collect()} == {("down", "no_candles_emitted"), ("again", "high_late_arrivals")}


def test_late_tick_dropped_and_restart_continues(spark):
    src, out, ck = scratch_path(spark, "wire"), scratch_path(spark, "out"), scratch_path(spark, "ck")
    cfg = [WindowConfig("1s", 1, 200)]                       # delay = 2 x 200 ms
    _write_wire(spark, src, [line(1, 0.5), line(2, 1.2)])
    qs = SA.start_candle_queries(SA.file_source(spark, src, 1), out, ck, configs=cfg)
    qs[0].awaitTermination()
    _write_wire(spark, src, [line(3, 10.0)])                 # advances the watermark to 9.6 s
    _write_wire(spark, src, [line(4, 10.5)])                 # spare batch: watermark now applies
    _write_wire(spark, src, [line(5, 0.9, 99.0)])            # late for window [0,1): dropped
    q = SA.start_candle_queries(SA.file_source(spark, src, 1), out, ck, configs=cfg)[0]   # restart
    q.awaitTermination()
    got = {(r.window_start.second, r.trade_count, r.high) for r in SA.read_upserted(spark, out, ["1s"]).collect()}
    assert got == {(0, 1, 1.0), (1, 1, 1.0), (10, 2, 1.0)}


def test_dead_letter_stream(spark):
    src, out, ck = scratch_path(spark, "wire"), scratch_path(spark, "dlq"), scratch_path(spark, "ck")
    _write_wire(spark, src, [line(1, 0.5), b"abc", f"2,X,{_us(1)},-1.00,1.0,BUY,T".encode(), b"3,X,1,1.0,1.0,BUY,A"])
    SA.start_dead_letter_query(SA.file_source(spark, src), out, ck).awaitTermination()
    recs = []
    local = out[5:] if out.startswith("file:") else out
    for f in os.listdir(local):
        if f.endswith(".json"):
            recs += [json.loads(x) for x in open(os.path.join(local, f)) if x.strip()]
    assert sorted((r["raw"], r["error"]) for r in recs) == sorted(
        [("abc", "parse_error"), (f"2,X,{_us(1)},-1.00,1.0,BUY,T", "negative_price")])


def test_late_rate_counts(spark):
    r = {x.window_size: x for x in SA.late_rate(S.arrivals(spark, "/root/testdata/sf0.001")).collect()}
    assert set(r) == {"1s", "10s", "1m"}
    n = S.trades(spark, "/root/testdata/sf0.001").count()
    assert all(x.total_ticks == n and 0 <= x.late_ticks <= n for x in r.values())
    assert r["1m"].late_ticks > 0


def test_append_mode_emits_each_candle_once_when_closed(spark):
    src, out, ck = scratch_path(spark, "wire"), scratch_path(spark, "out"), scratch_path(spark, "ck")
    cfg = [WindowConfig("1s", 1, 200)]
    _write_wire(spark, src, [line(1, 0.5), line(2, 0.7)])
    _write_wire(spark, src, [line(3, 5.0)])            # closes [0,1) once the watermark moves
    _write_wire(spark, src, [line(4, 6.0)])
    q = SA.start_candle_queries(SA.file_source(spark, src, 1), out, ck, configs=cfg, correct_late=False)[0]
    q.awaitTermination()
    rows = spark.read.parquet(f"{out}/1s").collect()
    assert [(r.window_start.second, r.trade_count) for r in rows] == [(0, 2)]   # open windows not emitted


def test_audit_tables_written(spark):
    from ticklake.operators.quality import write_audit_tables
    root = scratch_path(spark, "audit")
    paths = write_audit_tables(S.trades_dup(spark, "/root/testdata/sf0.001"), root)
    assert set(paths) == {"gaps", "outliers", "duplicates", "clean_trades", "exclusions"}
    g = spark.read.parquet(paths["gaps"])
    assert g.select("threshold_name").distinct().collect()[0][0] == "HFT"


def test_routed_topology_equals_direct(spark):
    sf = "/root/testdata/sf0.001"
    src = scratch_path(spark, "wire")
    S.log_lines(spark, sf).select("key", "value", "position").write.parquet(src)
    table, rck = scratch_path(spark, "routed"), scratch_path(spark, "rck")
    SA.start_router_query(SA.file_source(spark, src), table, rck).awaitTermination()
    out1, ck1 = scratch_path(spark, "o1"), scratch_path(spark, "c1")
    for q in SA.start_candle_queries_on_ticks(SA.routed_valid_ticks(spark, table), out1, ck1):
        q.awaitTermination()
    out2, ck2 = scratch_path(spark, "o2"), scratch_path(spark, "c2")
    for q in SA.start_candle_queries(SA.file_source(spark, src), out2, ck2):
        q.awaitTermination()
    a = SA.read_upserted(spark, out1, ["1s", "10s", "1m"])
    b = SA.read_upserted(spark, out2, ["1s", "10s", "1m"])
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    dead = decode_wire(S.log_lines(spark, sf).select("value")).filter("error IS NOT NULL").select("raw", "error")
    r = SA.routed_dead_letters(spark, table)
    assert r.exceptAll(dead).count() == 0 and dead.exceptAll(r).count() == 0


def test_router_reports_status_counters(spark):
    src, table, ck = scratch_path(spark, "wire"), scratch_path(spark, "routed"), scratch_path(spark, "rck")
    _write_wire(spark, src, [line(1, 0.5), b"abc", f"2,X,{_us(1)},-1.00,1.0,BUY,T".encode(), line(3, 2.0)])
    q = SA.start_router_query(SA.file_source(spark, src), table, ck)
    q.awaitTermination()
    seen = [p["observedMetrics"]["tick_status"] for p in q.recentProgress
            if p.get("observedMetrics", {}).get("tick_status")]
    assert sum(int(m["valid"]) for m in seen) == 2 and sum(int(m["dlq"]) for m in seen) == 2


def test_empty_stream_yields_no_candles(spark):
    src, out, ck = scratch_path(spark, "wire"), scratch_path(spark, "out"), scratch_path(spark, "ck")
    _write_wire(spark, src, [b"abc"])                     # nothing valid
    for q in SA.start_candle_queries(SA.file_source(spark, src), out, ck):
        q.awaitTermination()
    got = SA.read_upserted(spark, out, ["1s", "10s", "1m"])
    assert got.count() == 0 and "window_start" in got.columns
