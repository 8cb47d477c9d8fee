"""Published tables: readers see a write whole or not at all.

A dynamic partition overwrite replaces its partitions one after the other, so a reader may meet some new and
some old days, and a driver that dies in between leaves them so. Here every write goes to a folder of its own,
and a small manifest says which folder holds each day:

    root/data/batch=<id>/symbol=/interval=/date=/   files of one write, never changed afterwards
    root/manifest/<batch>/                          (symbol, interval, date, batch): the table after that write
    root/commits/<version>                          one line: the batch whose manifest is that version

A write counts from the moment its commit file exists; Hadoop creates it only where none is, so of two writers
of one version the second fails and leaves the table as the first made it. Days that a write holds
replace those days, all others stay. Lost executors and retried tasks are left to Spark's own commit protocol within the
new folder. Folders that the last manifest does not name are no longer read by new readers and may be removed when
older readers have ended; nothing is removed here.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.schema import BAR_TABLE_SCHEMA, PARTITION_COLUMNS
from barwright.sources.tables import existing_keys, path_exists, prune, write_partitioned

KEY_FIELDS = [f for c in PARTITION_COLUMNS for f in BAR_TABLE_SCHEMA.fields if f.name == c]
MANIFEST = T.StructType([*KEY_FIELDS, T.StructField("batch", T.StringType())])


class PublishConflict(RuntimeError):
    """Another writer published this version first."""


def _commits(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/commits")
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _commit(spark: SparkSession, root: str, version: int, batch: str) -> None:
    folder, fs = _commits(spark, root)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"{version:012d}")
    try:
        out = fs.create(target, False)
    except Exception as e:
        if fs.exists(target):
            raise PublishConflict(f"{root}: version {version} was published by another writer") from e
        raise
    out.write(bytearray(f"{batch}\n".encode()))
    out.close()


def published_version(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """Number and batch of the last whole commit; (0, None) for a table that has none."""
    folder, fs = _commits(spark, root)
    if not fs.exists(folder):
        return 0, None
    names = sorted((s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().isdigit()), reverse=True)
    for name in names:
        line = "".join(r.value + "\n" for r in spark.read.option("wholetext", "true").text(f"{root}/commits/{name}").collect())
        if line.strip():  # a commit whose line is not written yet is not one
            return int(name), line.strip()
    return 0, None


def _manifest(spark: SparkSession, root: str, batch: str | None) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest/{batch}") if batch else spark.createDataFrame([], MANIFEST)


def published_keys(spark: SparkSession, root: str) -> DataFrame:
    """(symbol, interval, date) of the published days."""
    return _manifest(spark, root, published_version(spark, root)[1]).select(*PARTITION_COLUMNS)


def publish(df: DataFrame, root: str, clustered: bool = False) -> int:
    """Write the days of `df` and make them the table's, all at once. Returns the table's version.

    Empty input publishes nothing.
    """
    spark = df.sparkSession
    version, last = published_version(spark, root)
    batch = uuid.uuid4().hex
    folder = f"{root}/data/batch={batch}"
    write_partitioned(df, folder, clustered=clustered)
    new = existing_keys(spark, folder)
    if new is None:
        return version
    new = new.select(*PARTITION_COLUMNS, F.lit(batch).alias("batch"))
    kept = _manifest(spark, root, last).join(new.select(*PARTITION_COLUMNS), PARTITION_COLUMNS, "left_anti")
    kept.unionByName(new).coalesce(1).write.parquet(f"{root}/manifest/{batch}")  # one small row for each day
    _commit(spark, root, version + 1, batch)
    return version + 1


def read_published(spark: SparkSession, root: str, schema: T.StructType | None = None, symbols: Sequence[str] | None = None,
                   start: _dt.date | None = None, end: _dt.date | None = None) -> DataFrame:
    """The published days within the range, from the last manifest at the time of the call.

    `schema`: of the files, without symbol, interval and date; where none is given, columns that only some writes have are
    NULL in the others. Spark prunes folders by the manifest's days (a join on partition columns).
    """
    batch = published_version(spark, root)[1]
    if batch is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    days = prune(_manifest(spark, root, batch), symbols, start, end)
    folders = [f"{root}/data/batch={r.batch}" for r in days.select("batch").distinct().collect()]  # one for each write that still counts
    if not folders:  # no day in the range: the table's columns, no rows
        folders = [f"{root}/data/batch={batch}"]
    inference = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(inference)
    spark.conf.set(inference, "false")  # a symbol may look like a number
    try:
        reader = spark.read.option("basePath", f"{root}/data")
        if schema is not None:
            own = [f for f in schema.fields if f.name not in PARTITION_COLUMNS]
            reader = reader.schema(T.StructType(own + [T.StructField(c, T.StringType()) for c in (*PARTITION_COLUMNS, "batch")]))
        else:
            reader = reader.option("mergeSchema", "true")
        data = reader.parquet(*folders)
    finally:
        spark.conf.set(inference, before)
    data = prune(data.withColumn("date", F.col("date").cast("date")), symbols, start, end)
    return data.join(days, [*PARTITION_COLUMNS, "batch"], "left_semi").drop("batch")


def stale_batches(spark: SparkSession, root: str) -> list[str]:
    """Names of writes that the last manifest no longer (or never) names: what a cleaner may remove."""
    if not path_exists(spark, f"{root}/data"):
        return []
    _, fs = _commits(spark, root)
    found = fs.listStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/data"))
    live = {r.batch for r in _manifest(spark, root, published_version(spark, root)[1]).select("batch").distinct().collect()}
    return sorted(n for n in (s.getPath().getName().removeprefix("batch=") for s in found) if n not in live)
