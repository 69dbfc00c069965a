"""Live snapshot of candles for viewers (dashboard feed).

Each micro-batch of an update-mode candle query is merged into the
previous snapshot (newest version of every candle wins), trimmed to the
newest ``history`` finished candles per window size and all open ones, and written to a new version
folder ``<root>/v=<batch_id>``; readers take the highest complete version.
A replayed batch rewrites the same version, so the sink is idempotent.
The snapshot is bounded by the history and the instruments with open
candles, so the merge stays small no matter how long the stream runs.
A version that a newer one has replaced stays for ``RETAIN_SECONDS``, so that
a frame that a viewer holds can still be read.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators.candles import newest_per_size
from ticklake.schemas import CANDLE_COLUMNS, SNAPSHOT_HISTORY, WINDOW_CONFIGS
from ticklake.streaming.upserts import RETAIN_SECONDS

_KEY = ["instrument", "window_size", "window_start"]


def _jvm_fs(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path, jvm


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, path, jvm = _jvm_fs(spark, root)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        done = jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
        if name.startswith("v=") and fs.exists(done):
            out.append(int(name[2:]))
    return sorted(out)


def read_snapshot(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """Newest complete snapshot version (of those before a batch), or None
    before the first one."""
    v = [x for x in _versions(spark, root) if before is None or x < before]
    return spark.read.parquet(f"{root}/v={v[-1]}") if v else None


def merge_snapshot(previous: DataFrame | None, updates: DataFrame, history: int,
                   sizes: Sequence[str]) -> DataFrame:
    """Previous snapshot + updated candles -> newest version per key, all
    open candles and the newest ``history`` finished ones per window size."""
    u = updates.select(*CANDLE_COLUMNS).withColumn("_v", F.lit(1))
    if previous is not None:
        u = previous.select(*CANDLE_COLUMNS).withColumn("_v", F.lit(0)).unionByName(u)
    cols = [c for c in CANDLE_COLUMNS if c not in _KEY]
    latest = u.groupBy(*_KEY).agg(*[F.max_by(c, "_v").alias(c) for c in cols]).select(*CANDLE_COLUMNS)
    return newest_per_size(latest, history, sizes)


def snapshot_writer(spark: SparkSession, root: str, history: int = SNAPSHOT_HISTORY,
                    sizes: Sequence[str] = tuple(c.name for c in WINDOW_CONFIGS), keep: int = 3,
                    retain_seconds: float = RETAIN_SECONDS):
    """A ``foreachBatch`` function maintaining the versioned snapshot."""
    def write(batch: DataFrame, batch_id: int) -> None:
        prev = read_snapshot(spark, root, before=batch_id)
        snap = merge_snapshot(prev, batch, history, sizes)
        snap.write.mode("overwrite").parquet(f"{root}/v={batch_id}")
        fs, _, jvm = _jvm_fs(spark, root)
        until = time.time() * 1000 - retain_seconds * 1000
        versions = _versions(spark, root)
        # a version's successor says since when nobody finds it any more
        for old, new in zip(versions[:-keep], versions[1:]):
            if fs.getFileStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/v={new}/_SUCCESS")).getModificationTime() <= until:
                fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/v={old}"), True)
    return write


def start_snapshot_queries(source: DataFrame, root: str, ckpt_root: str,
                           configs=WINDOW_CONFIGS, history: int = SNAPSHOT_HISTORY,
                           interval: str = "200 milliseconds", available_now: bool = False):
    """One snapshot feed per window size (each has its own watermark):
    ``<root>/<size>/v=<batch>``; ``read_snapshots`` unions the newest."""
    from ticklake.functions.wire import decode_wire
    from ticklake.streaming.aggregator import candle_stream, valid_ticks
    spark = source.sparkSession
    ticks = valid_ticks(decode_wire(source))
    qs = []
    for cfg in configs:
        w = (candle_stream(ticks, cfg).writeStream.outputMode("update")
             .option("checkpointLocation", f"{ckpt_root}/snapshot_{cfg.name}")
             .foreachBatch(snapshot_writer(spark, f"{root}/{cfg.name}", history, [cfg.name])))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
        qs.append(w.start())
    return qs


def read_snapshots(spark: SparkSession, root: str, sizes: Sequence[str]) -> DataFrame | None:
    parts = [d for d in (read_snapshot(spark, f"{root}/{s}") for s in sizes) if d is not None]
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
