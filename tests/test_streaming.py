"""Structured Streaming ingest: incremental, keep-last, idempotent."""

from pyspark.sql import functions as F

from conftest import SF001


def test_stream_ingest_keep_last(spark, scratch):
    from barwright.plans.common import bars
    from barwright.sources.klines import raw_from_bars
    from barwright.sources.tables import read_bars
    from barwright.streaming.ingest import start_ingest

    b = bars(spark, SF001, "1h")
    raw_dir, out = f"{scratch}/raw", f"{scratch}/bars"
    raw_from_bars(b, 1).drop("date").write.mode("append").json(raw_dir)
    start_ingest(spark, raw_dir, "1h", out, name="t1", checkpoint=f"{scratch}/ckpt").awaitTermination()
    first = read_bars(spark, out)
    n = first.count()
    assert n == b.count()

    # a re-fetch of every bar with a revised close arrives later
    raw_from_bars(b.withColumn("close", F.col("high")), 2).drop("date").write.mode("append").json(raw_dir)
    start_ingest(spark, raw_dir, "1h", out, name="t1", checkpoint=f"{scratch}/ckpt").awaitTermination()
    after = read_bars(spark, out)
    assert after.count() == n
    assert after.where(F.col("close") != F.col("high")).count() == 0


def test_closed_bars_stream(spark):
    from barwright.plans.queries import q_stream_closed_bars

    got = q_stream_closed_bars(spark, SF001)
    total = bars_count = spark.read.parquet(f"{SF001}/events.parquet").count()
    assert 0 < got.count() <= total
    assert bars_count > 0
