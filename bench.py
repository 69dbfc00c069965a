"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "headline_total", "value": sec, "unit": "sec", "queries": {...},
 "sf": ..., "ticks_per_sec": {...}}

Each query is run to completion with the ``noop`` sink (full execution,
nothing collected).  One untimed warm-up pass on the smallest fixture
loads the JVM code paths first.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPLAY (default 50: times the sf wire messages are
replayed, each cycle time-shifted, for the steady-state throughput).

``ticks_per_sec`` holds messages per second for wire -> validation ->
1s/10s/1m candles on the replay: in batch (steady state and first run),
streaming with one query per window size, streaming through the routed
decode-once topology, and batch and streaming on a replay with the
reference's mix of 98 order messages to 2 trades.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["ohlcv_all_sizes", "ohlcv_1s", "gaps_by_level", "outliers", "duplicates",
            "clean_trades", "quality_summary", "wire_decode", "tick_status_counts",
            "drift", "drift_summary", "late_rate", "partition_day", "stream_ohlcv"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from ticklake.session import get_spark, remove_scratch
    from ticklake.plans.queries import QUERIES
    from ticklake import sources as S
    from ticklake.functions.timefn import from_epoch_micros
    from ticklake.functions.wire import decode_wire, encode_wire
    from ticklake.operators import candles as C
    from pyspark.sql import functions as F

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": "16g"})
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        for name in HEADLINE:
            run(QUERIES[name](spark, warm))

    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)

    # throughput of the tick path: wire bytes -> validation -> 1s/10s/1m
    # candles, counted per message (order messages and rejects included,
    # as the reference counts them).  The messages are replayed REPLAY
    # times, each cycle shifted by the data's time span + 1 s; written once
    # (untimed), then read and aggregated.  "mix98": 98 of 100 messages are
    # order messages, the reference's own mix.
    from ticklake.session import scratch_path
    from ticklake.streaming import aggregator as SA
    replay = int(os.environ.get("BENCH_REPLAY", "50"))
    m = S.messages(spark, sf_dir)
    span = m.agg(F.max("timestamp").alias("hi"), F.min("timestamp").alias("lo")).first()
    shift_us = int((span.hi - span.lo).total_seconds() * 1e6) + 1_000_000
    cyc = m.select(F.explode(F.sequence(F.lit(0), F.lit(replay - 1))).alias("_c"), "*")
    position = F.col("_c").cast("long") * F.lit(10 ** 9) + F.col("sequence_id")
    cyc = cyc.withColumn("timestamp", F.timestamp_add("MICROSECOND", F.col("_c").cast("long") * F.lit(shift_us), F.col("timestamp"))) \
             .withColumn("position", position).withColumn("trade_id", F.concat(F.lit("POW-"), F.col("position"))).drop("_c")
    seq = F.col("sequence_id")
    mix = cyc.withColumn("msg_type", F.when(seq % 50 == 0, "T").when(seq % 2 == 0, "A").otherwise("C"))

    def written(messages):
        path = scratch_path(spark, "bench_replay")
        encoded = encode_wire(messages)
        encoded.select(F.col("instrument").cast("binary").alias("key"), F.col("line").cast("binary").alias("value"),
                       "position").write.parquet(path)
        return path

    def batch_sec(path):
        t = time.perf_counter()
        d = decode_wire(spark.read.parquet(path)).filter("error is null")
        run(C.all_sizes(d.select("instrument", from_epoch_micros(F.col("ts_micros")).alias("timestamp"), "price", "volume",
                                 F.col("position").alias("sequence_id")), packed=True))
        return time.perf_counter() - t

    def stream_sec(path):
        t = time.perf_counter()
        out, ck = scratch_path(spark, "bench_stream_out"), scratch_path(spark, "bench_stream_ck")
        for q in SA.start_candle_queries(SA.file_source(spark, path), out, ck):
            q.awaitTermination()
        return time.perf_counter() - t

    def routed_sec(path):
        # decode once into a status-partitioned table, then the per-size
        # candle queries read typed ticks
        t = time.perf_counter()
        table, rck = scratch_path(spark, "bench_routed"), scratch_path(spark, "bench_routed_ck")
        SA.start_router_query(SA.file_source(spark, path), table, rck).awaitTermination()
        out, ck = scratch_path(spark, "bench_routed_out"), scratch_path(spark, "bench_routed_ck2")
        for q in SA.start_candle_queries_on_ticks(SA.routed_valid_ticks(spark, table), out, ck):
            q.awaitTermination()
        return time.perf_counter() - t

    src = written(cyc)
    n_replay = spark.read.parquet(src).count()
    first_sec = batch_sec(src)      # the first run pays code generation; the second is steady state
    rates = {f"replay_x{replay}_batch": n_replay / batch_sec(src), f"replay_x{replay}_batch_first_run": n_replay / first_sec,
             f"replay_x{replay}_stream": n_replay / stream_sec(src), f"replay_x{replay}_stream_routed": n_replay / routed_sec(src)}
    src = written(mix)
    rates |= {f"mix98_x{replay}_batch": n_replay / batch_sec(src), f"mix98_x{replay}_stream": n_replay / stream_sec(src)}

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf.group(1)) if sf else sf_dir,
           "cpus": int(cpus),
           "ticks_per_sec": {k: round(v) for k, v in rates.items()} | {"replay_messages": n_replay}}
    print(json.dumps(out))
    remove_scratch(spark)


if __name__ == "__main__":
    main()
