"""Candles by the exact lateness rule, tick by tick.

The watermark of a built-in aggregation moves once a micro-batch.  Here every
tick is tested against the newest event time of its log partition *as of that
tick*, in log order: a tick is late for a size when ``window_end + watermark <
newest - watermark``, so what is late does not depend on how the log is cut
into micro-batches.

One ``transformWithState`` query decodes each message once and keeps, per log
partition, the newest event time (value state) and the open candles of all
window sizes (map state).  A window is closed when the newest time has passed
it by the allowed delay; no later tick can belong to it, so every closed candle
is written once.  Ticks that are late for a size go to a side table.  Windows
that are open when the query stops are read from the checkpoint with the
state data source; nothing else has to be written for them.

Scale: as many tasks as log partitions, like the log itself.  A task holds one
partition's share of a micro-batch (bounded by ``maxOffsetsPerTrigger`` or
``maxFilesPerTrigger``) and its open windows.  Where the built-in rule is good
enough, ``aggregator.start_candle_queries`` spreads a partition over tasks.

Micro-batches must come in log order, as Kafka offsets do; positions order the
ticks inside one.  Needs the RocksDB state store (``ROCKSDB``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ticklake.functions.timefn import add_interval, from_epoch_micros
from ticklake.functions.wire import decode_wire
from ticklake.schemas import CANDLE_COLUMNS, WINDOW_CONFIGS, WIRE, WindowConfig
from ticklake.streaming.upserts import CANDLE_SCHEMA, complete_batches

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"

WINDOW_KEY = "instrument string, window_size string, window_start long"
#: ``first_*``/``last_*``: time and log position of the ticks that open and close the candle.
WINDOW_VALUE = ("open double, high double, low double, close double, volume double, trade_count long, "
                "first_us long, first_at long, last_us long, last_at long")
OUTPUT = ("kind string, instrument string, window_size string, window_start long, open double, high double, low double, "
          "close double, volume double, trade_count long, ts_micros long, position long")
_COLS = [c.split()[0] for c in OUTPUT.split(", ")]


def _merged(a: tuple | None, b: tuple) -> tuple:
    """Two parts of one candle."""
    if a is None:
        return b
    first, last = (a if a[6:8] <= b[6:8] else b), (a if a[8:10] >= b[8:10] else b)
    return (first[0], max(a[1], b[1]), min(a[2], b[2]), last[3], a[4] + b[4], a[5] + b[5], *first[6:8], *last[8:10])


class ExactCandles(StatefulProcessor):
    """State and rule of one log partition."""

    def __init__(self, configs: Sequence[WindowConfig]):
        self.configs = [(c.name, c.seconds * 1_000_000, c.watermark_ms * 1000) for c in configs]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "ts_micros long")
        self.open = handle.getMapState("open", WINDOW_KEY, WINDOW_VALUE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ticks = pd.concat(list(rows), ignore_index=True).sort_values("position", kind="stable", ignore_index=True)
        ts = ticks["ts_micros"].to_numpy(np.int64)
        before = self.newest.get()
        newest = np.maximum.accumulate(ts if before is None else np.maximum(ts, before[0]))
        self.newest.update((int(newest[-1]),))
        held = dict(self.open.iterator())
        done = []
        for name, size, mark in self.configs:
            start = ts - ts % size
            late = start + size + mark < newest - mark
            if late.any():
                out = ticks.loc[late, ["instrument", "ts_micros", "position", "volume"]].assign(
                    kind="late", window_size=name, window_start=start[late], open=ticks.loc[late, "price"])
                yield out.reindex(columns=_COLS)
            for ident, part in self._parts(ticks[~late], start[~late], name):
                held[ident] = _merged(held.get(ident), part)
                if ident[2] + size + 2 * mark >= newest[-1]:
                    self.open.updateValue(ident, held[ident])
        sizes = {name: size + 2 * mark for name, size, mark in self.configs}
        for ident, value in held.items():
            if ident[2] + sizes[ident[1]] < newest[-1]:
                done.append(("candle", *ident, *value[:6], None, None))
                if self.open.containsKey(ident):
                    self.open.removeKey(ident)
        if done:
            yield pd.DataFrame(done, columns=_COLS)

    @staticmethod
    def _parts(ticks: pd.DataFrame, start: np.ndarray, name: str) -> Iterator[tuple[tuple, tuple]]:
        t = ticks.assign(start=start).sort_values(["instrument", "start", "ts_micros", "position"], kind="stable")
        g = t.groupby(["instrument", "start"], sort=False).agg(
            open=("price", "first"), high=("price", "max"), low=("price", "min"), close=("price", "last"), volume=("volume", "sum"),
            n=("price", "size"), first_us=("ts_micros", "first"), first_at=("position", "first"),
            last_us=("ts_micros", "last"), last_at=("position", "last"))
        for (instrument, at), r in zip(g.index, g.itertuples(index=False)):
            yield (instrument, name, int(at)), (r.open, r.high, r.low, r.close, r.volume, int(r.n), int(r.first_us), int(r.first_at),
                                                int(r.last_us), int(r.last_at))

    def close(self) -> None:
        pass


def exact_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files with ``key``, ``value``, ``position`` and ``partition``
    (of the log) as a stream; Kafka has the same under its own names."""
    r = spark.readStream.schema(WIRE.simpleString()[7:-1].replace(":", " ") + ", partition int").format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def exact_stream(source: DataFrame, configs: Sequence[WindowConfig] = WINDOW_CONFIGS,
                 log: Column | str = "partition") -> DataFrame:
    """Closed candles and late ticks (``kind``) of a source with
    ``position`` and ``partition``; ``log``: what has one newest time."""
    ticks = decode_wire(source.withColumn("log", (F.col(log) if isinstance(log, str) else log).cast("string")))
    ticks = ticks.filter(F.col("error").isNull()).select("log", "instrument", "ts_micros", "price", "volume", "position")
    return ticks.groupBy("log").transformWithStateInPandas(
        ExactCandles(configs), outputStructType=OUTPUT, outputMode="append", timeMode="none")


def start_exact_query(source: DataFrame, out_root: str, ckpt_dir: str, configs: Sequence[WindowConfig] = WINDOW_CONFIGS,
                      log: Column | str = "partition", available_now: bool = True,
                      processing_time: str = "1 second") -> StreamingQuery:
    """Writes ``<out_root>/batch=N/kind=candle|late`` (overwritten when a
    batch is replayed).  The session's state store must be RocksDB."""
    spark = source.sparkSession
    if spark.conf.get(_PROVIDER) != ROCKSDB:
        raise ValueError(f"set {_PROVIDER} to {ROCKSDB}")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("kind").parquet(f"{out_root}/batch={batch_id}")

    w = (exact_stream(source, configs, log).writeStream.outputMode("append")
         .option("checkpointLocation", ckpt_dir).foreachBatch(write))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def _written(spark: SparkSession, out_root: str, kind: str) -> DataFrame:
    schema = ", ".join(OUTPUT.split(", ")[1:])
    paths = complete_batches(spark, out_root)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{OUTPUT}, batch long").option("basePath", out_root).parquet(*paths).filter(
        F.col("kind") == kind).drop("kind", "batch")


def _as_candles(windows: DataFrame, configs: Sequence[WindowConfig]) -> DataFrame:
    start = from_epoch_micros(F.col("window_start"))
    end = F.coalesce(*[F.when(F.col("window_size") == c.name, add_interval(start, seconds=c.seconds)) for c in configs])
    d = windows.withColumn("window_end", end).withColumn("window_start", start).withColumn("is_realtime", F.lit(True))
    return d.select(*CANDLE_COLUMNS)


def closed_candles(spark: SparkSession, out_root: str, configs: Sequence[WindowConfig] = WINDOW_CONFIGS) -> DataFrame:
    return _as_candles(_written(spark, out_root, "candle"), configs)


def late_ticks(spark: SparkSession, out_root: str) -> DataFrame:
    """One row per tick and size that it was late for."""
    d = _written(spark, out_root, "late")
    return d.select("instrument", "window_size", from_epoch_micros(F.col("window_start")).alias("window_start"), "ts_micros", "position",
                    F.col("open").alias("price"), "volume")


def open_candles(spark: SparkSession, ckpt_dir: str, configs: Sequence[WindowConfig] = WINDOW_CONFIGS) -> DataFrame:
    """Windows that were open after the last committed micro-batch, from the
    query's checkpoint."""
    s = spark.read.format("statestore").option("stateVarName", "open").load(ckpt_dir)
    return _as_candles(s.select("user_map_key.*", "user_map_value.*"), configs)


def all_candles(spark: SparkSession, out_root: str, ckpt_dir: str, configs: Sequence[WindowConfig] = WINDOW_CONFIGS) -> DataFrame:
    """Closed candles, and the open ones as of the last batch (the flush
    at the end of a log)."""
    return closed_candles(spark, out_root, configs).unionByName(open_candles(spark, ckpt_dir, configs))


#: The value of ``aggregator.candle_stream``'s state, in the order of its aggregates.
_BUFFERS = ("struct<open:double,open_key:bigint,high:double,low:double,close:double,close_key:bigint,"
            "volume:double,trade_count:bigint>")


def open_windows(spark: SparkSession, ckpt_root: str, configs: Sequence[WindowConfig] = WINDOW_CONFIGS) -> DataFrame:
    """Open candles of ``aggregator.start_candle_queries`` (update mode or
    append) from its checkpoints: the built-in aggregation keeps a window until
    the watermark has passed its end."""
    out = spark.createDataFrame([], CANDLE_SCHEMA)
    for cfg in configs:
        s = spark.read.format("statestore").load(f"{ckpt_root}/candles_{cfg.name}")
        start = from_epoch_micros(F.unix_micros("key.window.start"))
        v = s.select("key.instrument", start.alias("window_start"), F.col("value").cast(_BUFFERS).alias("v"))
        v = v.select("instrument", F.lit(cfg.name).alias("window_size"), "window_start",
                     add_interval(F.col("window_start"), seconds=cfg.seconds).alias("window_end"), "v.*", F.lit(True).alias("is_realtime"))
        out = out.unionByName(v.select(*CANDLE_COLUMNS))
    return out
