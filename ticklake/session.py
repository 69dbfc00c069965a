"""Spark session defaults and the shared checkpoint/storage folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: UTC session clock (timestamps compare
# equal to the DuckDB oracle), AQE for runtime coalescing / skew splits /
# broadcast conversion backed by real sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(total_cores: int) -> dict[str, str]:
    """Sizing for a large cluster (e.g. 1000 executors over 100 TB).

    * Shuffle partitions at ~3x the cores, so the first wave is balanced;
      AQE then coalesces small partitions toward the 256 MB advisory size
      and splits skewed ones (joins and rebalance).
    * Input splits of 256 MB: fewer, fuller map tasks over wide Parquet.
    * Streaming state in RocksDB (off-heap, incremental checkpoints), so
      the candle state of many instruments x windows does not sit on the
      JVM heap.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 << 20),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
    }


def get_spark(master: str | None = None, app: str = "ticklake",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None,
              cluster_cores: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster ``master`` is left to spark-submit and ``cluster_cores``
    applies ``cluster_conf``; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster_cores:
        conf.update(cluster_conf(cluster_cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, conf[k])
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must set it (a file system that all executors share); without
    it this raises.  Only a local master, whose one machine is the whole
    cluster, gets a folder of its own when it is unset, as in tests.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="ticklake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


#: Scratch folders named in this process, by application.
_SCRATCH: dict[str, list[str]] = {}
#: The folder of each frame that ``materialize`` has returned.
_FOLDER: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one job's output."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Deletes the scratch folders that this application has named so far,
    and returns how many there were.  The caller decides when: frames that
    read them cannot be evaluated afterwards."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)


def materialize(df, name: str = "stage"):
    """Write ``df`` once to the shared checkpoint folder (Parquet) and
    return a DataFrame reading it back.

    Cuts the lineage where a heavy intermediate feeds several outputs: it
    is computed once, survives executor loss (the files are on the shared
    filesystem, not on an executor), and later reads are column-pruned.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.parquet(path)
    _FOLDER[out] = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes what ``materialize`` has written for ``frames``, which nothing
    may read any more, and has the driver collect its garbage: Spark's
    cleaner drops shuffle files once no plan refers to them, which on a
    driver with memory to spare may be never."""
    spark = frames[0].sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    named = _SCRATCH.get(spark.sparkContext.applicationId, [])
    for frame in frames:
        if path := _FOLDER.pop(frame, None):
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
            if path in named:
                named.remove(path)
    gc.collect()
    jvm.System.gc()
