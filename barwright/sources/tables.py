"""Bar and feature tables on storage: scans (S4-S8) and sinks.

Our own tables are Hive-partitioned by (symbol, interval, date); filters on
those columns prune directories before any file is opened. A foreign layout
`root/SYMBOL/GRAN/YYYY-MM-DD.parquet` is read recursively, with the keys
parsed from each row's file path.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.schema import BAR_TABLE_SCHEMA, PARTITION_COLUMNS

# The bar file codec of the original tool.
COMPRESSION = "zstd"
ZSTD_LEVEL = 5


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_bars(spark: SparkSession, root: str, symbols: Sequence[str] | None = None,
              start: _dt.date | None = None, end: _dt.date | None = None) -> DataFrame:
    """Scan a bar table (S4) with partition pruning on symbol and date."""
    df = spark.read.schema(BAR_TABLE_SCHEMA).option("basePath", root).parquet(root)
    return prune(df, symbols, start, end)


def prune(df: DataFrame, symbols=None, start=None, end=None) -> DataFrame:
    if symbols:
        df = df.where(F.col("symbol").isin(list(symbols)))
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("date") <= F.lit(end))
    return df


def _path_keys(path, granularity: str | None) -> dict:
    """symbol, interval and date that a file's path names."""
    pattern = r"/([^/]+)/([^/]+)/(\d{4}-\d{2}-\d{2})\.parquet$" if granularity else r"/([^/]+)()/(\d{4}-\d{2}-\d{2})\.parquet$"
    symbol, interval, day = (F.regexp_extract(path, pattern, i) for i in (1, 2, 3))
    return {"symbol": symbol, "interval": F.nullif(interval, F.lit("")), "date": F.to_date(F.nullif(day, F.lit("")))}


def read_foreign_layout(spark: SparkSession, root: str, granularity: str | None = "1s", schema: T.StructType | None = None) -> DataFrame:
    """Scan `root/SYMBOL/[GRAN/]YYYY-MM-DD.parquet` files.

    Filters on symbol, interval and date act on the path, which Spark knows before it opens a file.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(root)
    return df.withColumns(_path_keys(F.col("_metadata.file_path"), granularity))


def foreign_keys(spark: SparkSession, root: str, granularity: str | None = "1s") -> DataFrame:
    """(symbol, interval, date) of the files of a foreign layout, by listing; files of other names are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    keys = files.select(F.col("_metadata.file_path").alias("path")).withColumns(_path_keys(F.col("path"), granularity))
    return keys.where("date IS NOT NULL").select(*PARTITION_COLUMNS).distinct()


def list_symbols(bars: DataFrame) -> DataFrame:
    """Symbols present."""
    return bars.select("symbol").distinct().orderBy("symbol")


def list_days(bars: DataFrame) -> DataFrame:
    """(symbol, interval, date) keys present."""
    return bars.select(*PARTITION_COLUMNS).distinct()


def existing_keys(spark: SparkSession, root: str) -> DataFrame | None:
    """Partition keys already written under `root` (S7, S8, S11), or None when nothing is there.

    The keys are those of the folders that hold parquet files: files are listed, none is opened
    (the binary source reads a file only where its content is asked for).
    """
    if not path_exists(spark, root):
        return None
    inference = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(inference)
    spark.conf.set(inference, "false")  # a symbol may look like a number
    try:
        files = spark.read.format("binaryFile").option("basePath", root).option("pathGlobFilter", "*.parquet").load(root)
    finally:
        spark.conf.set(inference, before)
    if not set(PARTITION_COLUMNS) <= set(files.columns):
        return None
    types = {f.name: f.dataType for f in BAR_TABLE_SCHEMA.fields}
    return files.select(*[F.col(c).cast(types[c]).alias(c) for c in PARTITION_COLUMNS]).distinct()


def keys_in_range(spark: SparkSession, root: str, symbols: Sequence[str] | None = None, start: _dt.date | None = None,
                  end: _dt.date | None = None, interval: str | None = None) -> DataFrame:
    """(symbol, interval, date) of a bar table's days within the range, by listing."""
    keys = existing_keys(spark, root)
    if keys is None:
        fields = [f for c in PARTITION_COLUMNS for f in BAR_TABLE_SCHEMA.fields if f.name == c]
        keys = spark.createDataFrame([], T.StructType(fields))
    keys = prune(keys, symbols, start, end)
    return keys.where(F.col("interval") == interval) if interval else keys


def write_partitioned(df: DataFrame, root: str, overwrite: bool = False,
                      compression: str = COMPRESSION, level: int = ZSTD_LEVEL, clustered: bool = False) -> None:
    """One file per (symbol, interval, date), rows in open_time order.

    The hash repartition on the partition keys sends each symbol-day to one
    task (a day is bounded, so no key is hot). `clustered=True` skips it when
    every symbol-day already sits in one task (feature chunks), saving a full
    shuffle of the widest table. Overwrite is dynamic, so a forced rerun
    replaces only the partitions it writes; Spark's commit protocol gives the
    atomic replace the original did with temp files.
    """
    if not clustered:
        df = df.repartition(*PARTITION_COLUMNS)
    (df.sortWithinPartitions(*PARTITION_COLUMNS, "open_time")
       .write.mode("overwrite" if overwrite else "append")
       .option("partitionOverwriteMode", "dynamic")
       .option("compression", compression)
       .option("parquet.compression.codec.zstd.level", str(level))
       .partitionBy(*PARTITION_COLUMNS)
       .parquet(root))
    # Drop cached listings of the rewritten directories (later reads in this
    # session must see the new files, not the replaced ones).
    df.sparkSession.catalog.refreshByPath(root)


def write_reports(reports: DataFrame, path: str) -> None:
    """JSON lines, one report per file."""
    reports.select("report").write.mode("overwrite").text(path)
