"""The sliced sequence operators must equal plain windows exactly,
including empty slices, ties on the order key and null keys."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tests.conftest import T0
from ticklake.operators.sequence import (
    row_slices, slice_by_bounds,
    lag_across_slices, ordered_position, rolling_previous, running_max_across_slices,
)


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        k = rnd.choice(["A", "A", "A", "A", "B", "C", None])      # A is a hot key
        # bursts and long holes -> many empty slices; duplicates of t
        t = T0 + timedelta(seconds=rnd.choice([rnd.randint(0, 600), rnd.randint(5000, 5100),
                                               rnd.randint(20000, 20010)]))
        rows.append((k, t, float(rnd.randint(1, 50)), i))
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, v double, seq long")


def slice_of(width):
    us = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("t"))
    return F.floor(us / F.lit(width * 1_000_000))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("width", [7, 60, 100000])
def test_position(data, width):
    got = ordered_position(data, ["k"], ["t", "seq"], slice_of(width), "pos").select("seq", "pos")
    want = data.select("seq", (F.row_number().over(Window.partitionBy("k").orderBy("t", "seq")) - 1).alias("pos"))
    assert same(got, want.withColumn("pos", F.col("pos").cast("long")))


@pytest.mark.parametrize("width", [7, 600])
def test_lag(data, width):
    got = lag_across_slices(data, ["k"], ["t", "seq"], F.struct("t", "seq"), slice_of(width), "v", "p").select("seq", "p")
    want = data.select("seq", F.lag("v").over(Window.partitionBy("k").orderBy("t", "seq")).alias("p"))
    assert same(got, want)


@pytest.mark.parametrize("width", [7, 600])
def test_running_max(data, width):
    got = running_max_across_slices(data, ["k"], ["t", "seq"], slice_of(width), "v", "m").select("seq", "m")
    w = Window.partitionBy("k").orderBy("t", "seq").rowsBetween(Window.unboundedPreceding, 0)
    assert same(got, data.select("seq", F.max("v").over(w).alias("m")))


@pytest.mark.parametrize("width,k,block", [(7, 5, 16), (60, 50, 64), (100000, 3, 1 << 20)])
def test_rolling_previous(data, width, k, block):
    aggs = {"s": lambda w: F.sum("v").over(w.rowsBetween(-k, -1)),
            "n": lambda w: F.count("v").over(w.rowsBetween(-k, -1)),
            "l": lambda w: F.lag("v", 1).over(w)}
    got = rolling_previous(data, ["k"], ["t", "seq"], slice_of(width), k, aggs, block_rows=block)
    assert got.count() == data.count()
    w = Window.partitionBy("k").orderBy("t", "seq")
    want = data.select("k", "t", "v", "seq", F.sum("v").over(w.rowsBetween(-k, -1)).alias("s"),
                       F.count("v").over(w.rowsBetween(-k, -1)).alias("n"), F.lag("v", 1).over(w).alias("l"))
    assert same(got.select(*want.columns), want)


def test_row_slices_hold_a_burst(spark):
    """200 daily ticks and 50,000 within two minutes: slices of even rows."""
    daily = spark.range(200).select(F.lit("A").alias("k"), F.timestamp_add("DAY", F.col("id"), F.lit(T0)).alias("t"), F.col("id").alias("seq"))
    burst = spark.range(50_000).select(F.lit("A").alias("k"), F.timestamp_add("MILLISECOND", F.col("id") * 2 + 86_400_000 * 100, F.lit(T0)).alias("t"),
                                       (F.col("id") + 1000).alias("seq"))
    other = spark.range(30).select(F.lit("B").alias("k"), F.timestamp_add("DAY", F.col("id"), F.lit(T0)).alias("t"), (F.col("id") + 90_000).alias("seq"))
    df = daily.unionByName(burst).unionByName(other)
    bounds = row_slices(df, ["k"], "t", ["seq"], target_rows=1000)
    sliced = slice_by_bounds(df, ["k"], "t", bounds, "s")
    sizes = [r["count"] for r in sliced.groupBy("k", "s").count().collect()]
    assert sum(sizes) == 50_230 and max(sizes) <= 2000 and len(sizes) >= 26
    got = ordered_position(sliced, ["k"], ["t", "seq"], F.col("s"), "pos").select("seq", "pos")
    want = df.select("seq", (F.row_number().over(Window.partitionBy("k").orderBy("t", "seq")) - 1).cast("long").alias("pos"))
    assert same(got, want)
