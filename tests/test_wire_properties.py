"""Property test: decode(encode(trades)) == trades for random trades."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticklake.functions.wire import decode_wire, encode_wire, to_ticks

trade_st = st.tuples(
    st.one_of(st.none(), st.integers(min_value=0, max_value=10 ** 12).map(str)),
    st.sampled_from(["POWER_DE_SPOT", "GAS_TTF_SPOT", "CARBON_EUA_DEC", "X"]),
    st.integers(min_value=0, max_value=8 * 10 ** 14),             # µs after 2000-01-01 (before the 2026 cutoff)
    st.integers(min_value=1, max_value=10 ** 9),                  # price in cents (> 0)
    st.floats(min_value=1e-6, max_value=1e6, allow_nan=False, allow_infinity=False),
    st.sampled_from(["BUY", "SELL"]))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(trade_st, min_size=1, max_size=60))
def test_encode_decode_round_trip(spark, rows):
    base = datetime(2000, 1, 1)
    data = [(tid, inst, base + timedelta(microseconds=us), cents / 100.0, vol, side)
            for tid, inst, us, cents, vol, side in rows]
    t = spark.createDataFrame(data, "trade_id string, instrument string, timestamp timestamp_ntz, "
                                    "price double, volume double, side string")
    wire = encode_wire(t).select(F.col("line").cast("binary").alias("value"))
    back = to_ticks(decode_wire(wire)).withColumn(
        "trade_id", F.when(F.col("trade_id") == "", None).otherwise(F.col("trade_id")))
    assert back.exceptAll(t).count() == 0 and t.exceptAll(back).count() == 0
