"""Sketch slices: even slices of bursts, the same results as plain windows,
one scan of the source."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tests.conftest import TRADE_SCHEMA
from ticklake.operators import quality as Q
from ticklake.operators.sequence import SKETCH_GROUP
from ticklake.operators.storage import plan_text
from ticklake.session import scratch_path

START = datetime(2024, 1, 15, 9, 30)
TARGET = 500


@pytest.fixture(scope="module")
def burst(spark):
    """Five minutes of one instrument (40,000 ticks, half of them in four
    seconds, some on one microsecond), a sparse one and one without a name."""
    r = random.Random(3)
    rows = []
    for i in range(40_000):
        at = r.choice([r.uniform(0, 300), r.uniform(120, 124)])
        at = 200.0 if i % 400 == 0 else at
        rows.append((f"a{i}", "POWER", START + timedelta(microseconds=int(at * 1e6)), 100 + r.gauss(0, 3), 1.0, "BUY", i))
    rows += [(f"b{i}", "GAS", START + timedelta(days=i), 50.0 + 10 * (i % 9 == 0), 1.0, "SELL", i) for i in range(300)]
    rows += [(f"c{i}", None, START + timedelta(seconds=i % 50), 5.0, 1.0, "SELL", i) for i in range(900)]
    rows.append(("d", "GAS", None, 1.0, 1.0, "BUY", 5))
    path = scratch_path(spark, "burst")
    spark.createDataFrame(rows, TRADE_SCHEMA).repartition(6).write.parquet(path)
    return spark.read.parquet(path), path


def test_no_slice_over_twice_the_target(burst):
    sliced = Q.slice_ticks(burst[0], TARGET)
    sizes = [(r["instrument"], r["count"]) for r in sliced.groupBy("instrument", "_slice").count().collect()]
    assert max(n for _, n in sizes) <= 2 * TARGET
    assert len([n for i, n in sizes if i == "POWER"]) > 2 * SKETCH_GROUP
    assert sliced.count() == burst[0].count()
    # slices follow the order of time
    w = Window.partitionBy("instrument").orderBy("timestamp", "sequence_id")
    assert sliced.withColumn("before", F.lag("_slice").over(w)).filter("before > _slice").count() == 0


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_results_equal_plain_windows(burst):
    t, path = burst
    sliced = Q.slice_ticks(t, TARGET)
    w = Window.partitionBy("instrument").orderBy("timestamp", "sequence_id")
    same(Q.with_previous_time(sliced).drop("gap_ms"), t.withColumn("prev_time", F.lag("timestamp").over(w)))
    got = Q.outliers(sliced, window=20, threshold=0.05)
    prev = w.rowsBetween(-20, -1)
    want = t.withColumn("m", F.avg("price").over(prev)).withColumn("n", F.count("price").over(prev))
    want = want.filter((F.col("n") == 20) & (F.abs(F.col("price") - F.col("m")) / F.col("m") > 0.05))
    same(got.select("trade_id", F.round("rolling_avg", 6)), want.select("trade_id", F.round("m", 6)))
    assert got.count() > 100


def test_source_is_read_once(burst):
    """What follows reads the copy alone."""
    t, path = burst
    name = path.rsplit("/", 1)[1]
    for df in (Q.gaps_by_level(t), Q.gap_level_counts(t), *Q.quality_report(t).values()):
        assert name not in plan_text(df, "extended")


def test_equal_days_need_no_bounds(spark):
    empty = Q.slice_ticks(spark.createDataFrame([], TRADE_SCHEMA))
    assert empty.count() == 0 and "_slice" in empty.columns


def test_observed_summary_equals_the_counted_one(burst, spark):
    t = burst[0].unionByName(burst[0].limit(700)).unionByName(burst[0].limit(5).withColumn("trade_id", F.lit(None).cast("string")))
    for df in (t, t.limit(0)):
        p = Q.profile(df)
        n, o = Q.number_duplicates(df), Q.outliers(df)
        clean = Q.clean_trades(Q.deduplicated(n), o)
        assert p["summary"].collect() == Q.quality_summary(df, o, Q.duplicates(n), clean).collect()
        same(p["clean"], clean.select(*df.columns))
