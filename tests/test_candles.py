from datetime import timedelta

from pyspark.sql import functions as F

from tests.conftest import T0, ts
from ticklake.operators import candles as C


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_window_edges_ties_and_empty_windows(trades_df):
    t = trades_df([
        ("a", "X", ts(0), 10.0, 1.0, "BUY", 1),
        ("b", "X", ts(999.999), 12.0, 2.0, "BUY", 2),
        ("c", "X", ts(1000), 11.0, 3.0, "SELL", 3),      # exactly on the edge -> later window
        ("d", "X", ts(1500), 15.0, 1.0, "SELL", 5),      # tie on timestamp: seq 4 first
        ("e", "X", ts(1500), 9.0, 1.0, "SELL", 4),
        ("f", "X", ts(5000), 20.0, 4.0, "BUY", 6),       # windows 2..4 are empty
        ("g", "Y", ts(250), 7.0, 1.0, "BUY", 7),         # single tick
    ])
    c = C.ohlcv(t, 1).orderBy("instrument", "window_start").collect()
    assert [(r.instrument, r.window_start) for r in c] == [
        ("X", T0), ("X", T0 + timedelta(seconds=1)), ("X", T0 + timedelta(seconds=5)), ("Y", T0)]
    x0, x1, x5, y0 = c
    assert (x0.open, x0.high, x0.low, x0.close, x0.volume, x0.trade_count) == (10.0, 12.0, 10.0, 12.0, 3.0, 2)
    # open = tick c (first), close = tick d (ts tie broken by seq: e(4) then d(5))
    assert (x1.open, x1.high, x1.low, x1.close, x1.trade_count) == (11.0, 15.0, 9.0, 15.0, 3)
    assert x1.window_end == T0 + timedelta(seconds=2)
    assert (y0.open, y0.close, y0.trade_count) == (7.0, 7.0, 1)
    assert all(r.window_size == "1s" and r.is_realtime is False for r in c)


def test_rollup_equals_direct(spark):
    from ticklake import sources as S
    t = S.trades(spark, "/root/testdata/sf0.001")
    cols = C.CANDLE_COLUMNS
    for s, base in ((10, 1), (60, 10), (3600, 60)):
        direct = C.ohlcv(t, s).select(*cols)
        rolled = C.rollup(C.ohlcv(t, base), s).select(*cols)
        assert direct.exceptAll(rolled).count() == 0
        assert rolled.exceptAll(direct).count() == 0


def test_all_sizes_summary_latest_series(spark):
    from ticklake import sources as S
    t = S.trades(spark, "/root/testdata/sf0.001")
    allc = C.all_sizes(t)
    summ = {r.window_size: (r.candle_count, r.total_trades) for r in C.candle_summary(allc).collect()}
    n = t.count()
    assert set(summ) == {"1s", "10s", "1m"}
    assert all(v[1] == n for v in summ.values())
    latest = C.latest_candle(allc)
    assert latest.count() == allc.select("instrument", "window_size").distinct().count()
    mx = allc.groupBy("instrument", "window_size").agg(F.max("window_start").alias("m"))
    assert latest.join(mx, ["instrument", "window_size"]).filter("window_start != m").count() == 0
    inst = t.first().instrument
    series = C.candle_series(allc, inst, "1m").collect()
    assert series and all(r.instrument == inst for r in series)
    assert [r.window_start for r in series] == sorted(r.window_start for r in series)


def test_candle_plan_is_partial_aggregate_and_prunes_columns(spark):
    from ticklake import sources as S
    from ticklake.operators.storage import plan_text
    t = S.trades(spark, "/root/testdata/sf0.001")
    p = plan_text(C.ohlcv(t, 1))
    assert "partial_min_by" in p and "partial_sum" in p
    assert "user_id" not in p.split("ReadSchema")[1].split("\n")[0]  # unused column not read


def test_packed_order_key_matches_struct_order(trades_df, spark):
    from pyspark.sql import functions as F
    rows = []
    for i in range(400):          # many ties on the timestamp, sequence decides
        rows.append((str(i), "X" if i % 3 else "Y", ts((i // 4) * 250), float(100 + (i * 37) % 11),
                     1.0, "BUY", 10_000_000 + (i * 7919) % 400))
    rows.append(("n", "X", ts(0), 55.0, 1.0, "BUY", None))     # null sequence sorts first
    t = trades_df(rows)
    from ticklake.functions.timefn import epoch_micros
    key = C.packed_order_key(epoch_micros(F.col("timestamp")), F.col("sequence_id"), 1)
    ws = C.window_start(F.col("timestamp"), 1)
    packed = t.groupBy("instrument", ws.alias("w")).agg(
        F.min_by("price", key).alias("o"), F.max_by("price", key).alias("c"))
    struct = t.groupBy("instrument", ws.alias("w")).agg(
        F.min_by("price", C.order_key()).alias("o"), F.max_by("price", C.order_key()).alias("c"))
    assert packed.exceptAll(struct).count() == 0 and struct.exceptAll(packed).count() == 0
    # ohlcv ordered by it equals the default
    a, b = C.ohlcv(t, 1, packed=True), C.ohlcv(t, 1)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
