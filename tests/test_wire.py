from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import ts
from ticklake.functions.wire import (
    INSTRUMENTS, check_instruments, decode_wire, encode_wire, parse_wire, partition_of, status_counts, to_ticks,
)
from ticklake.schemas import FUTURE_CUTOFF_MICROS


def decode_lines(spark, lines):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value binary")
    return {r.i: r for r in decode_wire(df).collect()}


def test_round_trip(spark, trades_df):
    t = trades_df([("7", "X", ts(123.456), 101.25, 3.0, "BUY", 7),
                   ("8", "Y", ts(999), 0.5, 0.25, "SELL", 8)])
    e = encode_wire(t)
    assert {r.line for r in e.collect()} == {
        "7,X,1709632800123456,101.25,3.0,BUY,T", "8,Y,1709632800999000,0.50,0.25,SELL,T"}
    back = to_ticks(decode_wire(e.select(F.col("line").cast("binary").alias("value"))))
    want = t.select("trade_id", "instrument", "timestamp", "price", "volume", "side")
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_every_rule_first_failure_wins(spark):
    cut = FUTURE_CUTOFF_MICROS
    lines = [
        b"abc",                                  # no comma
        b"1,X",                                  # too few fields
        b"1,X,notanint,1.0,1.0,BUY,T",
        b"1,X,100,0,1.0,BUY,T",                  # price 0
        b"1,X,100,1.0,0,BUY,T",                  # volume 0
        b"1,X,100,-1.0,0,BUY,T",                 # both bad -> price rule first
        f"1,X,{cut},1.0,1.0,BUY,T".encode(),     # exactly the cutoff: valid
        f"1,X,{cut + 1},1.0,1.0,BUY,T".encode(),
        b"1,X,100,nan,1.0,BUY,T",                # NaN <= 0 is false: a rule of its own
        b"1,X,100,1.0,1.0,BUY",                  # 6 fields: a trade
        b"1,X\xff\xfe,100,1.0,1.0,BUY,T",        # bad UTF-8 -> replacement, still valid
        b"1,X,100,1.5d,1.0,BUY,T",               # forms that only the JVM reads
        b"1,X,100,0x1p3,1.0,BUY,T",
        b"1,X,100,2f,1.0,BUY,T",
        b"1,X,100,1.0,Infinity,BUY,T",
        b"1,X,100, +1.5e2 ,.5,BUY,T",            # decimal with sign, exponent, blanks
        b"1,X,100,-inf,1.0,BUY,T",
    ]
    d = decode_lines(spark, lines)
    err = {i: d[i].error for i in d}
    assert err == {0: "parse_error", 1: "parse_error", 2: "parse_error", 3: "negative_price",
                   4: "zero_volume", 5: "negative_price", 6: None, 7: "future_timestamp",
                   8: "non_finite", 9: None, 10: None, 11: "parse_error", 12: "parse_error", 13: "parse_error",
                   14: "non_finite", 15: None, 16: "negative_price"}
    assert d[15].price == 150.0 and d[15].volume == 0.5
    loose = decode_wire(spark.createDataFrame([(lines[8],)], "value binary"), reject_non_finite=False).first()
    assert loose.error is None
    assert "�" in d[10].instrument and "�" in d[10].raw


def test_order_messages_are_skipped_not_dead(spark):
    lines = [b"1,X,100,-5,1.0,BUY,A", b"2,X,100,1.0,1.0,BUY,C", b"3,X,100,1.0,1.0,BUY,T", b"4,X"]
    df = spark.createDataFrame([(v,) for v in lines], "value binary")
    assert sorted(r.msg_id for r in decode_wire(df).collect()) == ["3", "4"]
    st = {r.status: r.n for r in status_counts(df).collect()}
    assert st == {"skipped": 2, "valid": 1, "parse_error": 1}
    p = parse_wire(df).filter("skipped").count()
    assert p == 2


def test_partition_assignment_is_deterministic(spark):
    df = spark.createDataFrame([("A",), ("B",), ("A",)], "instrument string")
    r = df.select(partition_of(F.col("instrument"), 6).alias("p")).collect()
    assert r[0].p == r[2].p and all(0 <= x.p < 6 for x in r)


def test_dead_letter_json_records(spark):
    import json
    from ticklake.functions.wire import dead_letter_json
    df = spark.createDataFrame([(b"abc",), (b"1,X,100,1.0,1.0,BUY,T",), (b"2,X,100,-1,1.0,BUY,T",)], "value binary")
    recs = sorted(json.loads(r.json)["error"] for r in dead_letter_json(decode_wire(df)).collect())
    assert recs == ["negative_price", "parse_error"]


def test_unknown_instruments(spark):
    """Off unless asked for; by time; rows that overlap double nothing."""
    day = 86_400_000_000
    wire = spark.createDataFrame([(f"{i},{inst},{ts},{price},1.0,BUY,T".encode(),) for i, (inst, ts, price) in enumerate(
        [("A", day, 1.0), ("A", 5 * day, 1.0), ("A", 9 * day - 1, 1.0), ("A", 9 * day, 1.0), ("B", 0, 1.0), ("C", day, 1.0), ("C", day, -1.0),
         ("D", 0, 1.0)])] + [(b"9,,1,1.0,1.0,BUY,T",)], "value binary")
    t = lambda d: datetime(1970, 1, 1) + timedelta(days=d)
    known = spark.createDataFrame([("A", t(0), t(2)), ("A", t(1), t(2)), ("A", t(8), t(9)), ("B", None, None), ("D", t(1), None),
                                   (None, None, None)], INSTRUMENTS)
    d = decode_wire(wire)
    got = check_instruments(d, known)
    assert got.columns == d.columns and d.filter("error = 'unknown_instrument'").count() == 0
    assert {r.msg_id: r.error for r in got.collect()} == {
        "0": None, "1": "unknown_instrument", "2": None, "3": "unknown_instrument", "4": None, "5": "unknown_instrument",
        "6": "negative_price", "7": "unknown_instrument", "9": "unknown_instrument"}
    assert check_instruments(d, known.limit(0)).filter("error is null").count() == 0
