"""Candle versions of an update-mode stream, merged as they grow.

Every micro-batch writes the candles that it changed to a folder of its own
(``L0-<batch>-<batch>``, overwritten when a batch is replayed).  When
``fan`` folders of a level are complete they are merged into one folder of
the next level, newest version of each candle first.  So at most ``fan``
folders per level and log(batches) levels are live, and a candle
is rewritten once per level.  Readers take folders with ``_SUCCESS`` only,
and none that a merged folder covers: they never see half a batch.

A merge commits by the ``_SUCCESS`` of its folder and deletes nothing: what it
covers stays for ``RETAIN_SECONDS``, so that a frame that was made before the
merge can still be read, and goes with a later merge (``sweep``).
"""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.schemas import CANDLE_COLUMNS

FAN = 16
RETAIN_SECONDS = 600
KEY = ["instrument", "window_size", "window_start"]
_NAME = re.compile(r"L(\d+)-(\d+)-(\d+)$")
CANDLE_SCHEMA = ("instrument string, window_size string, window_start timestamp_ntz, "
                 "window_end timestamp_ntz, open double, high double, low double, close double, "
                 "volume double, trade_count bigint, is_realtime boolean")


def _fs(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path, jvm


def _complete(spark: SparkSession, root: str) -> dict[tuple[int, int, int], int]:
    """(level, first batch, last batch) of the complete folders, and when
    each was committed (milliseconds)."""
    fs, path, jvm = _fs(spark, root)
    if not fs.exists(path):
        return {}
    found = {}
    for s in fs.listStatus(path):
        m = _NAME.match(s.getPath().getName())
        done = jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")
        if m and fs.exists(done):
            found[tuple(int(x) for x in m.groups())] = fs.getFileStatus(done).getModificationTime()
    return found


def _covers(g: tuple[int, int, int], f: tuple[int, int, int]) -> bool:
    return g[0] > f[0] and g[1] <= f[1] and f[2] <= g[2]


def folders(spark: SparkSession, root: str) -> list[tuple[int, int, int]]:
    """The live folders: complete, and covered by no other complete folder of
    a higher level."""
    found = _complete(spark, root)
    return sorted(f for f in found if not any(_covers(g, f) for g in found))


def sweep(spark: SparkSession, root: str, retain_seconds: float = RETAIN_SECONDS) -> int:
    """Deletes folders that have been covered for ``retain_seconds``."""
    fs, _, jvm = _fs(spark, root)
    found, until = _complete(spark, root), time.time() * 1000 - retain_seconds * 1000
    old = [f for f in found if any(_covers(g, f) and at <= until for g, at in found.items())]
    for n, lo, hi in old:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/L{n}-{lo}-{hi}"), True)
    return len(old)


def complete_batches(spark: SparkSession, root: str) -> list[str]:
    """Paths of the complete ``batch=N`` folders in ``root``."""
    fs, path, jvm = _fs(spark, root)
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("batch=")]
    return sorted(str(f) for f in found if fs.exists(jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS")))


def _newest(spark: SparkSession, root: str, parts: list[tuple[int, int, int]]) -> DataFrame:
    paths = [f"{root}/L{n}-{lo}-{hi}" for n, lo, hi in parts]
    d = spark.read.schema(CANDLE_SCHEMA).parquet(*paths)
    last = F.regexp_extract(F.col("_metadata.file_path"), r"/L\d+-\d+-(\d+)/", 1).cast("long")
    d = d.select(*CANDLE_COLUMNS, last.alias("_v"))
    cols = [c for c in CANDLE_COLUMNS if c not in KEY]
    return d.groupBy(*KEY).agg(*[F.max_by(c, "_v").alias(c) for c in cols]).select(*CANDLE_COLUMNS)


def compact(spark: SparkSession, root: str, fan: int = FAN, retain_seconds: float = RETAIN_SECONDS) -> None:
    """Merges every level that has ``fan`` live folders, then sweeps."""
    level, merged = 0, False
    while True:
        now = folders(spark, root)
        same = [f for f in now if f[0] == level]
        if len(same) >= fan:
            lo, hi = min(f[1] for f in same), max(f[2] for f in same)
            _newest(spark, root, same).write.mode("overwrite").parquet(f"{root}/L{level + 1}-{lo}-{hi}")
            merged = True
        elif not any(f[0] > level for f in now):
            break
        level += 1
    if merged:
        sweep(spark, root, retain_seconds)


def batch_writer(root: str, fan: int = FAN, retain_seconds: float = RETAIN_SECONDS):
    """A ``foreachBatch`` function: one folder per batch, merged as due."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/L0-{batch_id}-{batch_id}")
        compact(batch.sparkSession, root, fan, retain_seconds)
    return write


def read_upserted(spark: SparkSession, root: str, sizes) -> DataFrame:
    """Newest complete version of every candle under ``<root>/<size>`` (a
    size whose query never emitted anything has none)."""
    out = spark.createDataFrame([], CANDLE_SCHEMA)
    for s in sizes:
        parts = folders(spark, f"{root}/{s}")
        if parts:
            out = out.unionByName(_newest(spark, f"{root}/{s}", parts))
    return out
