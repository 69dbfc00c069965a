import os

from pyspark.sql import functions as F

from ticklake import sources as S
from ticklake.operators import storage as ST
from ticklake.session import scratch_path


def test_partitioned_write_read_and_pruning(spark):
    t = S.trades(spark, "/root/testdata/sf0.001")
    root = scratch_path(spark, "store_test")
    ST.write_partitioned(t, root)
    local = root[5:] if root.startswith("file:") else root
    months = [d for d in os.listdir(os.path.join(local, "year=2024"))]
    assert "month=1" in months                      # values are not zero-padded
    files = [f for dp, _, fs in os.walk(local) for f in fs if f.endswith(".parquet")]
    assert files and all(".zstd." in f for f in files)
    store = ST.read_store(spark, root)
    assert store.count() == t.count()
    assert "timestamp" in store.columns and {"year", "month", "day"} <= set(store.columns)
    first = ST.first_partition(spark, root).first()
    day = ST.read_day(spark, root, first.year, first.month, first.day)
    counts = {(r.year, r.month, r.day): r["count"] for r in ST.partition_counts(t).collect()}
    assert day.count() == counts[(first.year, first.month, first.day)]
    # only that day's folder is read
    assert {tuple(r) for r in day.select("year", "month", "day").distinct().collect()} == {(first.year, first.month, first.day)}
    assert all(f"day={first.day}/" in f for f in day.inputFiles())
    assert ST.read_day(spark, root, 1999, 1, 1).count() == 0
    chk = ST.pruning_check(spark, root, first.year, first.month, first.day).first()
    assert chk.pruned and chk.store_rows == t.count() and chk.day_rows == day.count()
    assert chk.partitions_read == 1 < chk.partitions_total == len(counts)
    assert chk.files_read == len(day.inputFiles()) < chk.files_total == len(files)
    # a filter that cannot prune reads every file: the figures are measured
    assert ST.measured_count(store.filter(F.dayofmonth("timestamp") == first.day))[1:] == (len(files), len(counts))
    gone = ST.pruning_check(spark, root, 1999, 1, 1).first()
    assert (gone.day_rows, gone.files_read, gone.pruned) == (0, 0, False)
    stats = ST.write_stats(spark, root)
    tot = ST.storage_totals(stats).first()
    assert tot.total_rows == t.count() and tot.partitions == len(counts) and tot.total_bytes > 0
