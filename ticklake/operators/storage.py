"""Day-partitioned Parquet store: write, statistics, pruned reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.timefn import partition_columns
from ticklake.schemas import CSV_BYTES_PER_ROW, STORAGE_CODEC

PARTS = ["year", "month", "day"]


def add_partition_columns(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.select("*", *partition_columns(F.col(ts)))


def write_partitioned(df: DataFrame, root: str, ts: str = "timestamp",
                      codec: str = STORAGE_CODEC) -> None:
    """Hive-style ``year=/month=/day=`` folders (values unpadded), partition
    columns only in the path, zstd, replacing ``root``.

    ``rebalance`` clusters rows by day without forcing a whole day into one
    task: AQE splits a hot day into several files of the advisory size.
    """
    d = add_partition_columns(df, ts) if "year" not in df.columns else df
    (d.hint("rebalance", *PARTS)
      .write.mode("overwrite").partitionBy(*PARTS)
      .option("compression", codec).parquet(root))


def read_store(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root)


def read_day(spark: SparkSession, root: str, year: int, month: int, day: int) -> DataFrame:
    """One day: only that day's folder is listed (``basePath`` keeps the
    partition columns); no rows if there is no such folder."""
    folder = f"{root.rstrip('/')}/year={year}/month={month}/day={day}"
    if not _folders(spark, folder, exists=True):
        return read_store(spark, root).limit(0)
    return spark.read.option("basePath", root).parquet(folder)


def _folders(spark: SparkSession, path: str, exists: bool = False):
    """Names of the folders in ``path``, or whether it exists."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if exists:
        return fs.exists(p)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def _files(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()] if fs.exists(p) else []


def partition_counts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Rows per (year, month, day) in day order."""
    d = add_partition_columns(df, ts) if "year" not in df.columns else df
    return d.groupBy(*PARTS).agg(F.count(F.lit(1)).alias("count")).orderBy(*PARTS)


def first_day(spark: SparkSession, root: str) -> tuple[int, int, int] | None:
    """The earliest day of a written store, from its folder names: three
    listings, no file is opened."""
    found, path = [], root.rstrip("/")
    for part in PARTS:
        values = [int(n.split("=", 1)[1]) for n in _folders(spark, path) if n.startswith(f"{part}=")]
        if not values:
            return None
        found.append(min(values))
        path = f"{path}/{part}={found[-1]}"
    return tuple(found)


def first_partition(spark: SparkSession, root: str) -> DataFrame:
    """``first_day`` as a table of one row (none for an empty store)."""
    day = first_day(spark, root)
    made = spark.range(1 if day else 0)
    return made.select(*[F.lit(v).cast("int").alias(c) for c, v in zip(PARTS, day or (0, 0, 0))])


def write_stats(spark: SparkSession, root: str) -> DataFrame:
    """Rows, bytes and files of each partition of a written store.  Rows
    are counted from Parquet footers (a count reads no data pages); one row
    per file enters the second aggregate."""
    m = "_metadata"
    files = read_store(spark, root).groupBy(*PARTS, F.col(f"{m}.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(f"{m}.file_size").alias("bytes"))
    return (files.groupBy(*PARTS).agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"),
                                      F.count(F.lit(1)).alias("files"))
            .withColumn("kb", F.col("bytes") / 1024.0).orderBy(*PARTS))


def storage_totals(stats: DataFrame) -> DataFrame:
    """Partitions, rows, bytes and the ratio to an estimated CSV size."""
    return stats.agg(F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("total_rows"),
                     F.sum("bytes").alias("total_bytes")).withColumn(
        "csv_ratio", F.try_divide(F.col("total_rows") * CSV_BYTES_PER_ROW, F.col("total_bytes")))


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text (what ``explain(mode)`` prints)."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def measured_count(df: DataFrame) -> tuple[int, int, int]:
    """Counts ``df`` and returns its rows, and the files and partitions that
    the scans of the plan that ran have read (by their metrics)."""
    one = df.agg(F.count(F.lit(1)).alias("n"))
    rows = one.collect()[0]["n"]
    files = partitions = 0
    todo = [one._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
        if name == "FileSourceScanExec":
            m = node.metrics()
            files += m.apply("numFiles").value()
            partitions += m.apply("numPartitions").value() if m.contains("numPartitions") else 0
    return rows, files, partitions


def pruning_check(spark: SparkSession, root: str, year: int, month: int, day: int) -> DataFrame:
    """One row: rows, files and partitions read by a count of the whole
    store and by a count of one day (both are run, and say what their scans
    read), and whether the day's read only what its folder holds."""
    full = read_store(spark, root)
    one = full.filter((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))
    rows, files, partitions = measured_count(full)
    day_rows, day_files, day_partitions = measured_count(one)
    held = [f for f in _files(spark, f"{root.rstrip('/')}/year={year}/month={month}/day={day}") if f.endswith(".parquet")]
    pruned = day_partitions == 1 and day_files == len(held) and (partitions == 1 or day_files < files)
    return spark.createDataFrame(
        [(rows, day_rows, files, day_files, partitions, day_partitions, pruned, f"{year}-{month}-{day}")],
        "store_rows long, day_rows long, files_total long, files_read long, partitions_total long, partitions_read long, "
        "pruned boolean, checked_day string")
