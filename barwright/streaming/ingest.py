"""Incremental kline ingest with Structured Streaming.

Raw kline pages arrive as files; each micro-batch is typed, clipped and merged
into the bar table: for every (symbol, interval, date) the batch touches, the
stored rows and the new rows are deduplicated keep-last and that partition is
rewritten (dynamic overwrite). Stored rows carry `ingest_seq`, so the latest
fetch wins whatever the order in which files arrive. Replaying a batch after a failure rewrites the
same partitions with the same content, so the sink is idempotent; the
checkpoint records which files were consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.operators.clean import BAR_NAMES, clip_to_day, dedup_keep_last
from barwright.schema import BAR_TABLE_SCHEMA, PARTITION_COLUMNS
from barwright.session import checkpoint_dir, ensure_conf
from barwright.sources.klines import RAW_SCHEMA, klines_from_raw
from barwright.sources.tables import path_exists, write_partitioned

STORED_SCHEMA = T.StructType([*BAR_TABLE_SCHEMA.fields, T.StructField("ingest_seq", T.LongType(), True)])


def merge_batch(batch: DataFrame, batch_id: int, interval: str, out_root: str) -> None:
    spark = batch.sparkSession
    ensure_conf(spark)
    typed = clip_to_day(klines_from_raw(batch, interval))
    touched = typed.select(*PARTITION_COLUMNS).distinct()
    new = typed.withColumn("page_pos", F.col("page_pos").cast("int"))
    if path_exists(spark, out_root):
        stored = spark.read.schema(STORED_SCHEMA).option("basePath", out_root).parquet(out_root)
        old = stored.join(touched, PARTITION_COLUMNS, "left_semi").withColumn("page_pos", F.lit(-1))
        new = new.unionByName(old)
    # The fetch number stays with the bar: a late, older fetch does not replace a newer one.
    last = dedup_keep_last(new.withColumn("__seq", F.coalesce("ingest_seq", F.lit(-1))), order=("__seq", "page_pos"))
    merged = last.select(*BAR_NAMES, "ingest_seq", "interval", "date")
    # Cut the lineage to the stored partitions before overwriting them.
    merged = merged.checkpoint(eager=True)
    write_partitioned(merged, out_root, overwrite=True)


def start_ingest(spark: SparkSession, raw_dir: str, interval: str, out_root: str, name: str = "kline-ingest",
                 available_now: bool = True, raw_format: str = "json", checkpoint: str | None = None):
    """Start the streaming ingest from `raw_dir` (files with RAW_SCHEMA rows).

    The stream checkpoint defaults to `<spark.checkpoint.dir>/stream-<name>`;
    one checkpoint belongs to one (source, sink) pair.
    """
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/stream-{name}"
    raw = spark.readStream.schema(RAW_SCHEMA).format(raw_format).load(raw_dir)
    w = (raw.writeStream.foreachBatch(lambda b, i: merge_batch(b, i, interval, out_root))
         .option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
