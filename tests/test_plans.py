"""Plan-shape regression tests for the scale properties the design
relies on (checked on the executed, final adaptive plan)."""

import re

from ticklake.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_rollups_reuse_the_tick_shuffle(spark):
    p = final_plan(QUERIES["ohlcv_all_sizes"](spark, SF))
    assert "ReusedExchange" in p


def test_drift_joins_add_no_shuffle(spark):
    p = final_plan(QUERIES["drift"](spark, SF))
    # a join of stacked candle tables would shuffle on the 3-column key
    assert not re.search(r"Exchange hashpartitioning\(instrument#\d+, window_start#\d+, window_size#\d+", p)
    assert p.count("SortMergeJoin") + p.count("BroadcastHashJoin") >= 3


def test_instrument_windows_are_sliced(spark):
    for q in ("gaps_by_level", "outliers"):
        p = final_plan(QUERIES[q](spark, SF))
        specs = re.findall(r"Window \[.*?\], \[([^\]]*)\]", p)
        assert specs, q
        # every window is partitioned by the (key, slice) group or a block,
        # never by the instrument alone
        assert all("__seq" in s for s in specs), (q, specs)


def test_matched_drift_reads_ticks_once_a_side(spark):
    """The joins read the stored candles of each side, never the ticks."""
    files = QUERIES["drift_matched"](spark, SF).inputFiles()
    assert files and all("finest_candles" in f for f in files)


def test_outliers_read_ticks_once(spark):
    """Interior and boundary rows read the one table written on the way."""
    files = QUERIES["outliers"](spark, SF).inputFiles()
    assert files and all("rolling_local" in f for f in files)


def test_duplicate_numbering_is_one_shuffle_without_hot_groups(spark):
    p = final_plan(QUERIES["duplicates"](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
