"""Property test: on random data (ties, null keys, sparse and dense
stretches) the sliced operators equal plain windows for any slice width,
block size and hot-key setting."""

from datetime import timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tests.conftest import T0
from ticklake.operators.sequence import (
    lag_across_slices, ordered_position_hot, rolling_previous,
)

rows_st = st.lists(
    st.tuples(st.sampled_from(["A", "A", "A", "B", None]),
              st.integers(min_value=0, max_value=400),        # seconds: many ties
              st.integers(min_value=1, max_value=9)),
    min_size=1, max_size=120)


def _df(spark, rows):
    data = [(k, T0 + timedelta(seconds=s), float(v), i) for i, (k, s, v) in enumerate(rows)]
    return spark.createDataFrame(data, "k string, t timestamp_ntz, v double, seq long")


def _slice(width):
    us = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("t"))
    return F.floor(us / F.lit(width * 1_000_000))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, width=st.integers(min_value=1, max_value=500), k=st.integers(min_value=1, max_value=6),
       block=st.integers(min_value=8, max_value=40))
def test_rolling_and_lag_equal_plain_windows(spark, rows, width, k, block):
    df = _df(spark, rows)
    w = Window.partitionBy("k").orderBy("t", "seq")
    aggs = {"s": lambda spec: F.sum("v").over(spec.rowsBetween(-k, -1)),
            "n": lambda spec: F.count("v").over(spec.rowsBetween(-k, -1))}
    got = rolling_previous(df, ["k"], ["t", "seq"], _slice(width), k, aggs, block_rows=block)
    want = df.select("*", F.sum("v").over(w.rowsBetween(-k, -1)).alias("s"),
                     F.count("v").over(w.rowsBetween(-k, -1)).alias("n"))
    assert _same(got.select(*want.columns), want)
    lag = lag_across_slices(df, ["k"], ["t", "seq"], F.struct("t", "seq"), _slice(width), "v", "p")
    assert _same(lag.select("seq", "p"), df.select("seq", F.lag("v").over(w).alias("p")))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, width=st.integers(min_value=1, max_value=60))
def test_hot_position_equals_row_number(spark, rows, width):
    df = _df(spark, rows)
    # fingerprint-like key (k, v); every key sampled as hot, sequence slices
    got = ordered_position_hot(df, ["k", "v"], [F.col("seq")], F.floor(F.col("seq") / F.lit(width)), ["seq"],
                               "pos", fraction=1.0, min_sampled=1)
    want = df.select("seq", (F.row_number().over(Window.partitionBy("k", "v").orderBy("seq")) - 1)
                     .cast("long").alias("pos"))
    assert _same(got.select("seq", "pos"), want)
