"""Wire protocol: ``msg_id,instrument,ts_micros,price,volume,side,msg_type``.

Encoding, keyed partition assignment, decoding and validation are all
built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.timefn import epoch_micros
from ticklake.schemas import FUTURE_CUTOFF_MICROS


def partition_of(key: Column, partitions: int) -> Column:
    """Deterministic partition of a key: pmod(xxhash64(key), n)."""
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


def encode_wire(df: DataFrame, partitions: int = 6) -> DataFrame:
    """Adds ``line`` (the CSV text), ``_id`` and ``partition``.

    id = msg_id, else trade_id, else ''; msg_type defaults to 'T';
    price is printed with two decimals.
    """
    cols = set(df.columns)
    ids = [F.col(c) for c in ("msg_id", "trade_id") if c in cols] + [F.lit("")]
    mtype = F.coalesce(F.col("msg_type"), F.lit("T")) if "msg_type" in cols else F.lit("T")
    fields = [F.coalesce(*ids),
              F.coalesce(F.col("instrument"), F.lit("")),
              F.coalesce(epoch_micros(F.col("timestamp")).cast("string"), F.lit("")),
              F.coalesce(F.format_string("%.2f", F.col("price")), F.lit("")),
              F.coalesce(F.col("volume").cast("string"), F.lit("")),
              F.coalesce(F.col("side"), F.lit("")),
              mtype]
    return (df.withColumn("_id", fields[0])
              .withColumn("line", F.concat_ws(",", *fields))
              .withColumn("partition", partition_of(F.col("instrument"), partitions)))


NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|(?i:nan|inf|infinity))\s*$"


def _number(field: Column) -> Column:
    """A decimal number as DOUBLE; null for anything else."""
    return F.when(field.rlike(NUMBER), field.try_cast("double"))


def parse_wire(df: DataFrame, value_col: str = "value",
               cutoff_micros: int = FUTURE_CUTOFF_MICROS,
               reject_non_finite: bool = True) -> DataFrame:
    """Parse wire bytes and attach ``skipped`` and the validation verdict.

    Output: the input's other columns, raw, msg_id, instrument, ts_micros,
    price, volume, side, msg_type, skipped, error (null = valid).
    ``skipped``: 7+ fields and a type other than 'T' (an order message,
    neither valid nor dead; its error is null).  Rules, first failure
    wins: parse_error, negative_price (<= 0), zero_volume (<= 0),
    future_timestamp (> cutoff); non_finite (NaN/inf) unless
    ``reject_non_finite`` is false.  Numbers are decimal, with an optional
    sign and exponent, or nan/inf/infinity in any case; the JVM's suffixed
    and hexadecimal forms are parse errors.
    """
    raw = F.make_valid_utf8(F.col(value_col).cast("string"))
    # The fields are split once per message.  explode(array(x)) yields x
    # once; filters on the derived columns cannot be pushed below it, so
    # the optimizer does not substitute split(...) into every predicate
    # (it would re-split the line per reference).
    out = df.withColumn("raw", raw).select(
        "*", F.explode(F.array(F.split(F.col("raw"), ","))).alias("_p"))
    p = F.col("_p")
    out = out.select(
        *[c for c in df.columns if c != value_col], "raw",
        F.get(p, 0).alias("msg_id"), F.get(p, 1).alias("instrument"),
        F.expr("try_cast(get(_p, 2) AS BIGINT)").alias("ts_micros"),
        _number(F.get(p, 3)).alias("price"),
        _number(F.get(p, 4)).alias("volume"),
        F.get(p, 5).alias("side"),
        F.coalesce(F.get(p, 6), F.lit("T")).alias("msg_type"),
        ((F.size(p) >= 7) & F.coalesce(F.get(p, 6) != "T", F.lit(True))).alias("skipped"))
    err = (F.when(F.col("skipped"), F.lit(None).cast("string"))
            .when(F.col("ts_micros").isNull() | F.col("price").isNull() | F.col("volume").isNull(),
                  F.lit("parse_error"))
            .when(F.col("price") <= 0, F.lit("negative_price"))
            .when(F.col("volume") <= 0, F.lit("zero_volume"))
            .when(F.col("ts_micros") > F.lit(cutoff_micros), F.lit("future_timestamp")))
    if reject_non_finite:
        bad = F.isnan("price") | F.isnan("volume") | (F.col("price") == float("inf")) | (F.col("volume") == float("inf"))
        err = err.when(bad, F.lit("non_finite"))
    return out.withColumn("error", err)


def decode_wire(df: DataFrame, value_col: str = "value",
                cutoff_micros: int = FUTURE_CUTOFF_MICROS,
                reject_non_finite: bool = True) -> DataFrame:
    """``parse_wire`` without the skipped order messages."""
    return parse_wire(df, value_col, cutoff_micros, reject_non_finite) \
        .filter(~F.col("skipped")).drop("skipped")


#: An instrument reference table: when an instrument is traded (``valid_to``
#: exclusive; null: no limit).  An instrument may have several rows.
INSTRUMENTS = "instrument string, valid_from timestamp_ntz, valid_to timestamp_ntz"


def check_instruments(decoded: DataFrame, instruments: DataFrame) -> DataFrame:
    """``decoded`` with ``unknown_instrument`` as the error of otherwise valid
    messages whose instrument is not in the table at their time.  Off by
    default: it is a rule of its own.

    The table is brought to one row an instrument, so no message is doubled by
    rows that overlap, and joined by instrument; Spark broadcasts it where its
    size allows.  In a stream it is read anew by every micro-batch, so changes
    take effect."""
    limits = instruments.filter(F.col("instrument").isNotNull()).groupBy(F.col("instrument").alias("__known")).agg(
        F.collect_list(F.struct(epoch_micros(F.col("valid_from")).alias("lo"), epoch_micros(F.col("valid_to")).alias("hi"))).alias("__limits"))
    d = decoded.join(limits, F.col("instrument") == F.col("__known"), "left")
    ts = F.col("ts_micros")
    traded = F.exists("__limits", lambda x: F.coalesce(ts >= x["lo"], F.lit(True)) & F.coalesce(ts < x["hi"], F.lit(True)))
    error = F.when(F.col("error").isNull() & ~F.coalesce(traded, F.lit(False)), "unknown_instrument").otherwise(F.col("error"))
    return d.select(*[(error.alias(c) if c == "error" else F.col(f"`{c}`")) for c in decoded.columns])


def status_counts(wire: DataFrame, value_col: str = "value") -> DataFrame:
    """Messages per status: valid, skipped, or the dead-letter reason."""
    s = parse_wire(wire, value_col)
    st = F.when(F.col("skipped"), F.lit("skipped")).otherwise(F.coalesce(F.col("error"), F.lit("valid")))
    return s.groupBy(st.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def to_ticks(decoded: DataFrame) -> DataFrame:
    """Valid decoded rows as a trade table (timestamp as TIMESTAMP_NTZ)."""
    from ticklake.functions.timefn import from_epoch_micros
    return (decoded.filter(F.col("error").isNull())
            .select(F.col("msg_id").alias("trade_id"), "instrument",
                    from_epoch_micros(F.col("ts_micros")).alias("timestamp"),
                    "price", "volume", "side"))


def dead_letter_json(decoded: DataFrame) -> DataFrame:
    """The dead-letter record: JSON {raw, error} per rejected message."""
    bad = decoded.filter(F.col("error").isNotNull())
    return bad.select("raw", "error", F.to_json(F.struct("raw", "error")).alias("json"))


def kafka_records(df: DataFrame, partitions: int = 6) -> DataFrame:
    """Rows for the Kafka sink: key = instrument bytes, value = wire line
    bytes, explicit partition (keyed, deterministic)."""
    e = encode_wire(df, partitions)
    return e.select(F.col("instrument").cast("binary").alias("key"),
                    F.col("line").cast("binary").alias("value"), "partition")


def write_kafka(records: DataFrame, servers: str, topic: str,
                compression: str = "lz4", acks: str = "all") -> None:
    """Publish records (needs the Kafka connector on the classpath)."""
    (records.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).option("kafka.compression.type", compression)
     .option("kafka.acks", acks).save())
