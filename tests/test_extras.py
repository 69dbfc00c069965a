from datetime import datetime

from pyspark.sql import functions as F

from ticklake import sources as S
from ticklake.functions.timefn import parse_iso
from ticklake.functions.wire import kafka_records
from ticklake.operators import candles as C
from ticklake.operators import quality as Q
from ticklake.session import scratch_path
from ticklake.streaming import snapshot as SN

SF = "/root/testdata/sf0.001"


def test_parse_iso_strict_and_lenient(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.123456+00:00",), ("2024-01-02 03:04:05",), ("junk",)], "s string")
    r = df.select(parse_iso(F.col("s"), strict=False).alias("t")).collect()
    assert r[0].t == datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert r[1].t == datetime(2024, 1, 2, 3, 4, 5)
    assert r[2].t is None


def test_load_candles_with_text_times(spark):
    c = C.all_sizes(S.trades(spark, SF))
    path = scratch_path(spark, "candles_text")
    c.select(*[F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(x) if x in ("window_start", "window_end")
               else F.col(x) for x in c.columns]).write.parquet(path)
    back = C.load_candles(spark, path).select(*c.columns)
    assert back.exceptAll(c).count() == 0 and c.exceptAll(back).count() == 0


def test_kafka_records_and_first_messages(spark):
    m = S.messages(spark, SF)
    k = kafka_records(m).first()
    assert isinstance(k.value, (bytes, bytearray)) and 0 <= k.partition < 6
    first = C.first_messages(m, 5).collect()
    assert [r.timestamp for r in first] == sorted(r.timestamp for r in m.collect())[:5]


def test_snapshot_merge_keeps_newest_versions(spark):
    cols = C.CANDLE_COLUMNS
    t = S.trades(spark, SF)
    allc = C.all_sizes(t)
    snap = SN.merge_snapshot(None, allc, 3, ["1s", "10s", "1m"])
    # three finished candles of each size and those of its newest window
    assert snap.groupBy("window_size").count().filter("count < 4").count() == 0
    newest = snap.filter("window_size = '1s'").orderBy(F.desc("window_start")).first()
    changed = allc.filter("window_size = '1s'").filter(F.col("window_start") == newest.window_start) \
        .withColumn("close", F.lit(-1.0)).select(*cols)
    snap2 = SN.merge_snapshot(snap, changed, 3, ["1s", "10s", "1m"])
    assert snap2.filter(F.col("window_start") == newest.window_start).filter("window_size = '1s'").first().close == -1.0
    assert snap2.count() == snap.count()


def test_snapshot_keeps_every_open_candle(spark):
    """600 instruments with one open candle each, and 700 finished ones."""
    def rows(n, minute):
        return spark.range(n).select(
            F.concat(F.lit("I"), "id").alias("instrument"), F.lit("1m").alias("window_size"),
            F.lit(datetime(2024, 1, 1, 0, minute)).cast("timestamp_ntz").alias("window_start"),
            F.lit(datetime(2024, 1, 1, 0, minute + 1)).cast("timestamp_ntz").alias("window_end"),
            *[F.lit(1.0).alias(x) for x in ("open", "high", "low", "close", "volume")],
            F.lit(1).cast("long").alias("trade_count"), F.lit(True).alias("is_realtime"))
    snap = SN.merge_snapshot(None, rows(600, 30).unionByName(rows(700, 10)), 500, ["1m"])
    got = {r.window_start.minute: r["count"] for r in snap.groupBy("window_start").count().collect()}
    assert got == {30: 600, 10: 500}


def test_snapshot_stream_versions(spark):
    src = scratch_path(spark, "wire")
    S.log_lines(spark, SF).select("key", "value", "position").write.parquet(src)
    from ticklake.streaming.aggregator import file_source
    root, ck = scratch_path(spark, "snap"), scratch_path(spark, "snap_ck")
    for q in SN.start_snapshot_queries(file_source(spark, src), root, ck, available_now=True):
        q.awaitTermination()
    snap = SN.read_snapshots(spark, root, ["1s", "10s", "1m"])
    assert snap is not None and snap.count() > 0


def test_quality_report_tables_and_fingerprint(spark):
    t = S.trades_dup(spark, SF)
    rep = Q.quality_report(t)
    assert set(rep) >= {"summary", "gap_levels", "gaps_by_instrument", "top_outliers"}
    assert rep["summary"].first().duplicate_count == rep["duplicates"].count()
    fp = Q.fingerprint(t)
    dup = fp.groupBy("fingerprint").count().filter("count > 1").count()
    assert dup == rep["duplicates"].select(*Q.FINGERPRINT).distinct().count()
