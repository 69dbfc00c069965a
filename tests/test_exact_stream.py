"""The exact lateness rule against a plain loop, however the log is cut."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ticklake.schemas import WINDOW_CONFIGS
from ticklake.session import scratch_path
from ticklake.streaming import aggregator as SA
from ticklake.streaming import exact as X

T0 = 1_700_000_000_000_000
LOG = "key binary, value binary, position long, partition int"


def log_of(n=600, seed=1):
    """(partition, position, instrument, ts, price, volume) in log order: ties,
    jumps ahead and ticks up to 90 seconds late."""
    r = random.Random(seed)
    now, rows = [T0] * 2, []
    for i in range(n):
        p = r.randrange(2)
        now[p] += r.choice([0, 1000, 200_000, 900_000, 4_000_000])
        ts = now[p] - r.choice([0, 0, 0, 300_000, 1_500_000, 12_000_000, 90_000_000])
        rows.append((p, i, ["POWER", "GAS"][p] if r.random() < .8 else f"X{p}", ts, r.choice([10.0, 10.5, 11.25, 9.75]), float(r.randint(1, 9))))
    return rows


def by_rule(rows):
    """({(instrument, size, start): candle}, late ticks) of the loop."""
    newest, ticks, late = {}, {}, set()
    for p, pos, inst, ts, price, volume in rows:
        newest[p] = max(newest.get(p, ts), ts)
        for c in WINDOW_CONFIGS:
            size, mark = c.seconds * 1_000_000, c.watermark_ms * 1000
            start = ts // size * size
            if start + size + mark < newest[p] - mark:
                late.add((inst, c.name, pos))
            else:
                ticks.setdefault((inst, c.name, start), []).append((ts, pos, price, volume))
    return {k: (min(v)[2], max(x[2] for x in v), min(x[2] for x in v), max(v)[2], sum(x[3] for x in v), len(v))
            for k, v in ticks.items()}, late


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get(X._PROVIDER)
    spark.conf.set(X._PROVIDER, X.ROCKSDB)
    yield
    spark.conf.set(X._PROVIDER, before)


def wire(rows):
    out = []
    for p, pos, inst, ts, price, volume in rows:
        out.append((inst.encode(), f"m{pos},{inst},{ts},{price},{volume},BUY,T".encode(), pos, p))
        if pos % 7 == 0:      # neither moves the newest time
            out.append((inst.encode(), f"m{pos},{inst},{ts + 10 ** 9},-1,{volume},BUY,T".encode(), pos, p))
            out.append((inst.encode(), f"m{pos},{inst},{ts + 10 ** 9},1,{volume},BUY,A".encode(), pos, p))
    return out


def found(spark, out, ck):
    us = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("window_start"))
    rows = X.all_candles(spark, out, ck).withColumn("us", us).collect()
    assert len({(r.instrument, r.window_size, r.us) for r in rows}) == len(rows)
    late = {(r.instrument, r.window_size, r.position) for r in X.late_ticks(spark, out).collect()}
    return {(r.instrument, r.window_size, r.us): (r.open, r.high, r.low, r.close, r.volume, r.trade_count) for r in rows}, late


@pytest.mark.parametrize("cuts", [(), (1, 17, 300), (250, 251, 252, 253, 590)])
def test_equals_the_loop_however_the_log_is_cut(spark, rocksdb, cuts):
    rows = log_of()
    src, out, ck = (scratch_path(spark, x) for x in ("src", "out", "ck"))
    edges = [0, *cuts, len(rows)]
    for lo, hi in zip(edges, edges[1:]):
        spark.createDataFrame(wire(rows[lo:hi]), LOG).repartition(3).write.mode("append").parquet(src)
        X.start_exact_query(X.exact_source(spark, src), out, ck).awaitTermination()
    want = by_rule(rows)
    assert found(spark, out, ck) == want
    assert len(want[1]) > 50
    # what is open can still take ticks
    newest = {p: max(r[3] for r in rows if r[0] == p) for p in (0, 1)}
    assert 0 < X.open_candles(spark, ck).count() < 30 and len(newest) == 2


def test_open_windows_of_the_built_in_stream(spark):
    rows = [r for r in log_of(200, 2)]
    src, out, ck = (scratch_path(spark, x) for x in ("src", "out", "ck"))
    spark.createDataFrame(wire(rows), LOG).drop("partition").write.parquet(src)
    for q in SA.start_candle_queries(SA.file_source(spark, src), out, ck):
        q.awaitTermination()
    newest = max(r[3] for r in rows) // 1000
    open_now = X.open_windows(spark, ck)
    every = SA.read_upserted(spark, out, [c.name for c in WINDOW_CONFIGS])
    for c in WINDOW_CONFIGS:
        limit = datetime(1970, 1, 1) + timedelta(milliseconds=newest - 2 * c.watermark_ms)
        a = open_now.filter(F.col("window_size") == c.name)
        b = every.filter((F.col("window_size") == c.name) & (F.col("window_end") > F.lit(limit).cast("timestamp_ntz")))
        assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_needs_rocksdb_and_an_empty_log_gives_nothing(spark, rocksdb):
    src, out, ck = (scratch_path(spark, x) for x in ("src", "out", "ck"))
    spark.createDataFrame([], LOG).write.parquet(src)
    assert X.closed_candles(spark, out).count() == 0 and X.late_ticks(spark, out).count() == 0
    spark.conf.set(X._PROVIDER, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    with pytest.raises(ValueError):
        X.start_exact_query(X.exact_source(spark, src), out, ck)
