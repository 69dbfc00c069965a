from tests.conftest import ts
from ticklake.operators import quality as Q


def test_gap_thresholds_are_strict_and_truncate(trades_df):
    t = trades_df([
        ("1", "X", ts(0), 1.0, 1.0, "BUY", 1),          # first row of the key: no gap
        ("2", "X", ts(500), 1.0, 1.0, "BUY", 2),        # exactly 500 ms: not flagged
        ("3", "X", ts(1001), 1.0, 1.0, "BUY", 3),       # 501 ms: flagged
        ("4", "X", ts(1501.9), 1.0, 1.0, "BUY", 4),     # 500.9 ms truncates to 500: not flagged
        ("5", "X", ts(7502), 1.0, 1.0, "BUY", 5),       # 6000.1 ms -> HFT and Fast
        ("6", "Y", ts(40000), 1.0, 1.0, "BUY", 6),      # other key starts fresh
    ])
    g = Q.gaps_by_level(t).collect()
    got = sorted((r.gap_end, r.gap_ms, r.threshold_name) for r in g)
    assert got == sorted([(ts(1001), 501, "HFT"), (ts(7502), 6000, "HFT"), (ts(7502), 6000, "Fast")])
    assert all(abs(r.gap_seconds - r.gap_ms / 1000.0) < 1e-12 for r in g)
    counts = {r.threshold_name: r.gap_count for r in Q.gap_level_counts(t).collect()}
    assert counts == {"HFT": 2, "Fast": 1, "Standard": 0}
    gc = Q.gap_counts(Q.gaps_by_level(t), "HFT").collect()
    assert [(r.instrument, r.gap_count) for r in gc] == [("X", 2)]


def test_duplicate_numbering_hot_and_cold_paths_agree(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from ticklake import sources as S
    t = S.trades_dup(spark, "/root/testdata/sf0.001")
    # one fingerprint made huge: 600 copies with spread sequence ids
    hot = t.limit(1).select("*", F.explode(F.sequence(F.lit(0), F.lit(599))).alias("_k")) \
        .withColumn("sequence_id", F.col("_k") * 7 + 5).withColumn("trade_id", F.concat(F.lit("H"), F.col("_k").cast("string"))) \
        .drop("_k")
    data = t.unionByName(hot)
    plain = data.withColumn("row_num", F.row_number().over(
        Window.partitionBy(*Q.FINGERPRINT).orderBy("sequence_id", "trade_id")).cast("long"))
    for kw in ({}, {"seq_slice": 50, "sample_fraction": 0.5, "hot_min_sampled": 100}):
        got = Q.number_duplicates(data, **kw).select(*plain.columns)
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_outliers_window_boundaries(trades_df):
    base = [(str(i), "X", ts(i * 10), 100.0, 1.0, "BUY", i) for i in range(50)]
    rows = base + [
        ("50", "X", ts(500), 105.0, 1.0, "BUY", 50),    # first eligible row; exactly 5%: not flagged
        ("51", "X", ts(510), 200.0, 1.0, "BUY", 51),    # far off: flagged
    ]
    o = Q.outliers(trades_df(rows)).collect()
    assert [r.trade_id for r in o] == ["51"]
    r = o[0]
    assert abs(r.rolling_avg - (49 * 100.0 + 105.0) / 50) < 1e-9
    assert r.outlier_type == "fat_finger" and r.window_size == 50 and r.threshold_pct == 0.05
    # row 50 has only 49 predecessors when the first one is missing
    o2 = Q.outliers(trades_df(base[1:] + [("50", "X", ts(500), 500.0, 1.0, "BUY", 50)]))
    assert o2.count() == 0


def test_outliers_zero_average_gives_no_error(trades_df):
    rows = [(str(i), "X", ts(i), 0.0, 1.0, "BUY", i) for i in range(50)] + [("z", "X", ts(60), 1.0, 1.0, "BUY", 60)]
    assert Q.outliers(trades_df(rows)).count() == 0


def test_duplicates_first_by_sequence_and_null_values(trades_df):
    t = trades_df([
        ("a", "X", ts(0), 1.0, 1.0, "BUY", 20),
        ("b", "X", ts(0), 1.0, 1.0, "BUY", 10),      # same fingerprint, earlier sequence: kept
        ("c", "X", ts(0), 1.0, None, "BUY", 30),
        ("d", "X", ts(0), 1.0, None, "BUY", 31),     # null volume twice: one group
        ("e", "X", ts(0), 1.0, 2.0, "BUY", 40),
    ])
    # every group sampled as hot, tiny slices: a group is split over several
    n = Q.number_duplicates(t, seq_slice=8, sample_fraction=1.0, hot_min_sampled=2)
    d = {r.trade_id: (r.row_num, r.exclusion_reason) for r in Q.duplicates(n).collect()}
    assert d == {"a": (2, "duplicate"), "d": (2, "duplicate")}
    assert sorted(r.trade_id for r in Q.deduplicated(n).collect()) == ["b", "c", "e"]


def test_clean_and_exclusions_partition_the_input(trades_df):
    rows = [(str(i), "X", ts(i * 10), 100.0, 1.0, "BUY", i) for i in range(60)]
    rows[55] = ("55", "X", ts(550), 110.0, 1.0, "BUY", 55)                # outlier (10%)
    rows.append(("55dup", "X", ts(550), 110.0, 1.0, "BUY", 99))           # its copy: duplicate and outlier
    rows.append((None, "Y", ts(5), 1.0, 1.0, "SELL", 100))                # no id
    t = trades_df(rows)
    n = Q.number_duplicates(t)
    o = Q.outliers(t)
    clean = Q.clean_trades(Q.deduplicated(n), o)
    exc = Q.exclusions(n, o)
    reasons = {r.trade_id: r.exclusion_reason for r in exc.collect()}
    assert reasons == {"55dup": "duplicate", "55": "fat_finger", None: "missing_trade_id"}
    assert clean.count() + exc.count() == t.count()
    s = Q.quality_summary(t, o, Q.duplicates(n), clean).first()
    assert (s.total_trades, s.duplicate_count, s.clean_count) == (62, 1, 59)
    assert s.outlier_count == o.count()
    assert abs(s.clean_pct - 100.0 * 59 / 62) < 1e-9


def test_quality_summary_empty_input(trades_df, spark):
    t = trades_df([])
    n = Q.number_duplicates(t)
    o = Q.outliers(t)
    s = Q.quality_summary(t, o, Q.duplicates(n), Q.clean_trades(Q.deduplicated(n), o)).first()
    assert (s.total_trades, s.outlier_count, s.duplicate_count, s.clean_count) == (0, 0, 0, 0)
    assert s.outlier_pct is None


def test_top_outliers_order(spark):
    from ticklake import sources as S
    o = Q.outliers(S.trades(spark, "/root/testdata/sf0.001"))
    top = Q.top_outliers(o, 5).collect()
    devs = [r.deviation_pct for r in top]
    assert devs == sorted(devs, reverse=True) and len(top) == min(5, o.count())
