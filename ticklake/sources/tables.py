"""Table sources.

``read_trades`` reads a real trade table with a declared schema.  The other
functions derive the tick tables from the driver's ``events`` table (the
projections of FIXTURES.md): instrument = event_type, price = value,
sequence_id = event_id.  Every projection reads the whole table; the
modulo rules only *assign* attributes (message type, injected faults) the
way the reference's simulator does, they never thin the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.timefn import add_interval, epoch_micros, from_epoch_micros
from ticklake.functions.wire import encode_wire
from ticklake.schemas import MESSAGES, TRADES
from ticklake.operators.sequence import ordered_position

TRADE_COLS = [f.name for f in TRADES.fields]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_trades(spark: SparkSession, path: str, with_msg_type: bool = False) -> DataFrame:
    """A stored trade/message table with the declared schema (no inference)."""
    return spark.read.schema(MESSAGES if with_msg_type else TRADES).parquet(path)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades plus order messages: 80% 'T', 10% 'A', 10% 'C' by event id."""
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        eid.cast("string").alias("trade_id"),
        F.col("event_type").alias("instrument"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("price"),
        (F.lit(1) + eid % 97).cast("double").alias("volume"),
        F.when(eid % 2 == 0, "BUY").otherwise("SELL").alias("side"),
        eid.alias("sequence_id"),
        F.when(eid % 10 == 0, "A").when(eid % 10 == 1, "C").otherwise("T").alias("msg_type"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).filter(F.col("msg_type") == "T").select(*TRADE_COLS)


def trades_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades plus a replayed copy (new id, new sequence) of every 20th."""
    t = trades(spark, sf_dir)
    copies = t.filter(F.col("sequence_id") % 20 == 2).select(
        F.concat(F.lit("D"), "trade_id").alias("trade_id"), "instrument", "timestamp",
        "price", "volume", "side", (F.col("sequence_id") + 1000000000).alias("sequence_id"))
    return t.unionByName(copies)


def messages_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with injected faults: future time, negative price, zero volume."""
    m = messages(spark, sf_dir)
    r = F.col("sequence_id") % 50
    return m.select(
        "trade_id", "instrument",
        F.when(r == 2, add_interval(F.col("timestamp"), days=1000)).otherwise(F.col("timestamp")).alias("timestamp"),
        F.when(r == 3, F.lit(-10.5)).otherwise(F.col("price")).alias("price"),
        F.when(r == 4, F.lit(0.0)).otherwise(F.col("volume")).alias("volume"),
        "side", "sequence_id", "msg_type")


def trades_rt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The real-time side for drift: some ticks lost, some prices off."""
    t = trades(spark, sf_dir)
    return t.filter(F.col("sequence_id") % 40 != 2).select(
        "trade_id", "instrument", "timestamp",
        F.when(F.col("sequence_id") % 41 == 0, F.col("price") * 1.5).otherwise(F.col("price")).alias("price"),
        "volume", "side", "sequence_id")


def arrivals(spark: SparkSession, sf_dir: str, slice_seconds: int = 86400, keyed: bool = False) -> DataFrame:
    """Trades as read from a 3-partition log: some arrive one hour late.
    ``keyed``: an instrument is one key, so it lies in one partition (by its
    first letter); else ticks are dealt out by sequence number.

    ``offset_in_partition`` is the 1-based arrival position inside a log
    partition, computed with the skew-proof ``ordered_position`` (a log
    partition is a hot key: it holds a third of all rows).
    """
    t = trades(spark, sf_dir)
    arrival = F.when(F.col("sequence_id") % 25 == 2,
                     add_interval(F.col("timestamp"), hours=1)).otherwise(F.col("timestamp"))
    partition = (F.ascii("instrument") if keyed else F.col("sequence_id")) % 3
    t = t.withColumn("kafka_partition", partition).withColumn("_arrival", arrival)
    out = ordered_position(
        t, keys=["kafka_partition"], order=[F.col("_arrival"), F.col("sequence_id")],
        slice_expr=F.window("_arrival", f"{slice_seconds} seconds").start, name="_pos")
    return out.withColumn("offset_in_partition", F.col("_pos") + 1).drop("_pos", "_arrival")


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference table of the instruments: each is listed at its first
    trade; those with an even first letter go halfway through their trades'
    time."""
    us = epoch_micros(F.col("timestamp"))
    t = trades(spark, sf_dir).groupBy("instrument").agg(F.min(us).alias("lo"), F.max(us).alias("hi"))
    half = F.when(F.ascii("instrument") % 2 == 0, F.col("lo") + F.floor((F.col("hi") - F.col("lo")) / 2))
    return t.select("instrument", from_epoch_micros(F.col("lo")).alias("valid_from"), from_epoch_micros(half).alias("valid_to"))


def _faulty_line(residue: Column) -> Column:
    """The encoded line with a fault by residue: number forms that only the
    JVM reads (12, 13), non-finite numbers (14, 15)."""
    f = [F.get(F.split("line", ","), i) for i in range(7)]
    price = F.when(residue == 12, "1.5d").when(residue == 13, "0x1p3").when(residue == 14, "NaN").otherwise(f[3])
    volume = F.when(residue == 15, "inf").otherwise(f[4])
    return F.concat_ws(",", f[0], f[1], f[2], price, volume, f[5], f[6])


def _wire(m: DataFrame) -> DataFrame:
    """Encoded messages; of every 50, one (5) is cut after the instrument,
    one (16) has a byte that is not UTF-8, four hold odd numbers."""
    w = encode_wire(m, partitions=6)
    r = F.col("sequence_id") % 50
    start = F.concat_ws(",", F.col("_id"), F.col("instrument"))
    value = (F.when(r == 5, start.cast("binary"))
              .when(r == 16, F.concat(start.cast("binary"), F.unhex(F.lit("FF"))))
              .when(r.between(12, 15), _faulty_line(r).cast("binary"))
              .otherwise(F.col("line").cast("binary")))
    return w.select("sequence_id", F.col("instrument").cast("binary").alias("key"), value.alias("value"), "partition")


def wire_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded wire messages of ``messages_bad`` with their faults."""
    return _wire(messages_bad(spark, sf_dir))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as a log would hold them: text ids (POW-000000001),
    many ticks on one timestamp (whole hours), and a ``position`` in the log
    that runs against the ids, so only it can order tied ticks."""
    m = messages_bad(spark, sf_dir)
    m = m.withColumn("trade_id", F.concat(F.lit("POW-"), F.lpad(F.col("sequence_id").cast("string"), 9, "0")))
    m = m.withColumn("timestamp", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
    return _wire(m).withColumn("position", F.lit(10 ** 9).cast("long") - F.col("sequence_id"))
