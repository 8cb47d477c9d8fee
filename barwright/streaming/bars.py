"""Closed bars from an event stream (S3 + P8 as watermark semantics).

A tumbling event-time window per symbol with a watermark: in append mode a bar
is emitted once the watermark passes its end, i.e. only closed bars are ever
written, which is the streaming form of "never ingest the running day/bar".
State per open bar is one row of partial aggregates, bounded by
(symbols × open buckets), not by the event count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.schema import DEFAULT_EXCHANGE, interval_to_ms, ms_to_date
from barwright.sources.events import trade_order
from barwright.session import checkpoint_dir, ensure_conf

EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def stream_trades(spark: SparkSession, events_dir: str, file_glob: str = "events*.parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    ensure_conf(spark)  # event times are read in UTC
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    ev = reader.parquet(events_dir)
    return ev.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("trade_id"),
        (F.col("value") + F.lit(1.0)).alias("price"),
        (F.col("event_id") % 7 + 1).cast("double").alias("qty"),
        (F.col("event_id") % 2 == 0).alias("is_buy"),
    )


def closed_bars(trades: DataFrame, interval: str, delay: str,
                exchange: str = DEFAULT_EXCHANGE) -> DataFrame:
    """Streaming bars; a bar is final when the watermark (max event time − delay) passes its end.

    Events that come later than `delay` after a newer one are dropped by the
    watermark, so the caller has to say how late events can be.
    """
    iv = interval_to_ms(interval)
    key = trade_order(F.unix_micros("event_time"), F.col("trade_id"))
    buy_qty = F.when(F.col("is_buy"), F.col("qty"))
    buy_quote = F.when(F.col("is_buy"), F.col("price") * F.col("qty"))
    agg = (trades.withWatermark("event_time", delay)
           .groupBy("symbol", F.window("event_time", f"{iv // 1000} seconds"))
           .agg(F.min_by("price", key).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
                F.max_by("price", key).alias("close"), F.sum("qty").alias("volume"),
                F.sum(F.col("price") * F.col("qty")).alias("quote_volume"), F.count(F.lit(1)).alias("num_trades"),
                F.coalesce(F.sum(buy_qty), F.lit(0.0)).alias("taker_buy_base"),
                F.coalesce(F.sum(buy_quote), F.lit(0.0)).alias("taker_buy_quote")))
    open_time = F.unix_millis(F.col("window.start"))
    return agg.select(
        open_time.alias("open_time"), "open", "high", "low", "close", "volume",
        (open_time + F.lit(iv - 1)).alias("close_time"),
        "quote_volume", "num_trades", "taker_buy_base", "taker_buy_quote",
        F.lit(exchange).alias("exchange"), "symbol", F.lit(interval).alias("interval"),
        ms_to_date(open_time).alias("date"),
    )


def run_closed_bars_once(spark: SparkSession, events_dir: str, interval: str, name: str,
                         delay: str, file_glob: str = "events*.parquet",
                         checkpoint: str | None = None) -> DataFrame:
    """Process everything available (availableNow) into a parquet table; return it.

    The file sink keeps results on the executors' storage (never on the
    driver); table and stream checkpoint live under the session's shared
    checkpoint folder, so a restarted driver resumes instead of re-emitting.
    """
    base = checkpoint or f"{checkpoint_dir(spark)}/stream-{name}"
    out = f"{base}/bars"
    q = (closed_bars(stream_trades(spark, events_dir, file_glob), interval, delay)
         .writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", f"{base}/state")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)
