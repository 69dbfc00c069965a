from datetime import datetime

from ticklake.operators import alerts as A
from ticklake.operators import drift as D

SCHEMA = ("instrument string, window_size string, window_start timestamp_ntz, window_end timestamp_ntz, "
          "open double, high double, low double, close double, volume double, trade_count long, is_realtime boolean")
W0, W1, W2 = datetime(2024, 1, 1, 0, 0, 0), datetime(2024, 1, 1, 0, 0, 1), datetime(2024, 1, 1, 0, 0, 2)


def c(w, close, vol=10.0, n=2, rt=True, inst="X"):
    return (inst, "1s", w, w, close, close, close, close, vol, n, rt)


def test_drift_join_and_report(spark):
    rt = spark.createDataFrame([c(W0, 101.0, rt=True), c(W1, 50.0, 11.0, 3), c(W2, 1.0)], SCHEMA)
    bt = spark.createDataFrame([c(W0, 100.0, rt=False), c(W1, 0.0, 10.0, 2, False),
                                c(W0, 5.0, inst="Y", rt=False)], SCHEMA)
    d = {(r.instrument, r.window_start): r for r in D.measure_drift(rt, bt).collect()}
    assert len(d) == 4
    assert abs(d[("X", W0)].close_drift_pct - 1.0) < 1e-12
    assert d[("X", W1)].close_drift_pct is None            # batch close 0 -> null percent
    assert d[("X", W1)].trade_count_diff == 1
    assert d[("X", W2)].missing_batch and not d[("X", W2)].missing_realtime
    assert d[("Y", W0)].missing_realtime and d[("Y", W0)].instrument == "Y"   # coalesced keys
    rep = D.drift_report(D.measure_drift(rt, bt)).first()
    assert (rep.total_candles, rep.missing_in_realtime, rep.missing_in_batch, rep.matched_candles) == (4, 1, 1, 2)
    assert rep.missing_in_realtime_pct == 25.0 and rep.error is None
    assert rep.close_drift_max_pct == 1.0 and rep.candles_with_trade_diff == 1
    alerts = {r.alert: r.value for r in A.drift_alerts(D.drift_report(D.measure_drift(rt, bt))).collect()}
    assert set(alerts) == {"missing_pct", "volume_drift_pct"}   # close 1.0 is not > 1.0


def test_no_match_short_report(spark):
    rt = spark.createDataFrame([c(W0, 1.0)], SCHEMA)
    bt = spark.createDataFrame([c(W1, 1.0, rt=False)], SCHEMA)
    rep = D.drift_report(D.measure_drift(rt, bt)).first()
    assert rep.matched_candles == 0 and rep.error == "no_matched_candles"
    assert rep.close_drift_mean_pct is None and rep.missing_in_realtime_pct == 50.0


def test_alert_thresholds_are_strict(spark):
    rep = spark.createDataFrame([(0.5, 1.0, 5.0)], "missing_in_realtime_pct double, close_drift_max_pct double, volume_drift_max_pct double")
    assert A.drift_alerts(rep).count() == 0
    rep = spark.createDataFrame([(0.51, -1.01, 5.0)], "missing_in_realtime_pct double, close_drift_max_pct double, volume_drift_max_pct double")
    assert {r.alert for r in A.drift_alerts(rep).collect()} == {"missing_pct", "close_drift_pct"}


def test_health_alerts(spark):
    m = spark.createDataFrame([(5.0, 0, 0.02, 20000, 0.5)],
                              "ticks_per_sec double, candles_emitted long, late_share double, lag long, drift_pct double")
    assert {r.alert for r in A.health_alerts(m).collect()} == {
        "low_throughput", "no_candles_emitted", "high_late_arrivals", "high_lag"}


def test_by_window(spark):
    rt = spark.createDataFrame([c(W0, 101.0)], SCHEMA)
    bt = spark.createDataFrame([c(W0, 100.0, rt=False), c(W1, 1.0, rt=False)], SCHEMA)
    r = D.drift_by_window(D.measure_drift(rt, bt)).first()
    assert (r.window_size, r.total, r.missing_rt) == ("1s", 2, 1)
    assert abs(r.close_drift_mean - 1.0) < 1e-12 and r.trade_diff_mean == 0.0


def test_write_drift_round_trip(spark):
    from ticklake.session import scratch_path
    rt = spark.createDataFrame([c(W0, 101.0)], SCHEMA)
    bt = spark.createDataFrame([c(W0, 100.0, rt=False)], SCHEMA)
    d = D.measure_drift(rt, bt)
    path = scratch_path(spark, "drift")
    D.write_drift(d, path)
    back = spark.read.parquet(path)
    assert back.count() == 1 and set(back.columns) == set(d.columns)


def test_equal_candles_have_zero_drift(spark):
    rt = spark.createDataFrame([c(W0, 100.0), c(W1, 50.0)], SCHEMA)
    bt = spark.createDataFrame([c(W0, 100.0, rt=False), c(W1, 50.0, rt=False)], SCHEMA)
    rep = D.drift_report(D.measure_drift(rt, bt)).first()
    assert (rep.matched_candles, rep.close_drift_max_pct, rep.close_drift_std_pct, rep.candles_with_trade_diff) == (2, 0.0, 0.0, 0)
    assert A.drift_alerts(D.drift_report(D.measure_drift(rt, bt))).count() == 0


def test_total_outage_raises_an_alert(spark):
    rt = spark.createDataFrame([], SCHEMA)
    bt = spark.createDataFrame([c(W0, 100.0, rt=False), c(W1, 50.0, rt=False)], SCHEMA)
    rep = D.drift_report(D.measure_drift(rt, bt))
    assert rep.first().missing_in_realtime_pct == 100.0
    assert [r.alert for r in A.drift_alerts(rep).collect()] == ["missing_pct"]


def test_sizes_on_one_side_only(spark):
    rt = {1: spark.createDataFrame([c(W0, 100.0)], SCHEMA), 10: spark.createDataFrame([c(W1, 100.0)], SCHEMA)}
    bt = {10: spark.createDataFrame([c(W1, 100.0, rt=False)], SCHEMA), 60: spark.createDataFrame([c(W0, 1.0, rt=False)], SCHEMA)}
    rows = D.measure_drift_by_size(rt, bt).collect()
    assert sorted((r.missing_realtime, r.missing_batch) for r in rows) == [(False, False), (False, True), (True, False)]
    assert D.matched_by_size(rt, bt).count() == 1
