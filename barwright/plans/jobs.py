"""Jobs: ingest, features, validate and presets.

Each job is one Spark plan over all requested (symbol, day) keys at once; the
per-key loops of a single-process tool become joins on small key tables.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.operators.clean import bar_table, clip_to_day, data_day_grid, day_completeness, dedup_keep_last
from barwright.operators.quality import quality_report, report_json
from barwright.functions.registry import _ship_by_value
from barwright.plans.features import build_features
from barwright.schema import BAR_SCHEMA, PARTITION_COLUMNS, day_grid, effective_end, pair_symbol
from barwright.session import checkpoint_dir, ensure_conf
from barwright.sources.klines import klines_from_raw
from barwright.sources.publish import publish, published_keys, read_published
from barwright.sources.tables import (
    existing_keys, foreign_keys, keys_in_range, prune, read_bars, read_foreign_layout, write_partitioned, write_reports,
)

# The preset symbol list (base coins, quoted in USDT) and its range.
FAVORITES = ["btc", "eth", "xrp", "sol", "bnb", "doge", "trx", "ada", "link",
             "avax", "xlm", "bch", "ltc", "dot"]
PRESET_START = _dt.date(2023, 2, 1)
PRESET_END = _dt.date(2025, 9, 30)
INGEST_START = _dt.date(2023, 1, 1)

ERROR_COLUMN = "feature_errors"


@dataclass
class FeatureJob:
    in_root: str
    out_root: str
    symbols: Sequence[str] | None = None
    start: _dt.date | None = None
    end: _dt.date | None = None
    specs: Sequence[dict] | None = None
    with_custom: bool = True
    custom_windows: Sequence[int] = (60, 300, 900)
    warmup: int | str = "auto"
    force: bool = False
    interval: str | None = None  # a root with several granularities needs one named
    layout: str = "partitions"  # of the input: our own, "files" (SYMBOL/GRAN/DATE.parquet) or "flat" (SYMBOL/DATE.parquet)
    published: bool = False  # the output is a published table (`sources.publish`): its days change all at once
    error_column: str | None = ERROR_COLUMN  # None: failures leave no trace in the output
    warnings: list[str] = field(default_factory=list)


def _input_keys(spark: SparkSession, job: FeatureJob, start: _dt.date | None) -> DataFrame:
    """(symbol, interval, date) of the job's input days from `start` on, by listing."""
    if job.layout == "partitions":
        return keys_in_range(spark, job.in_root, job.symbols, start, job.end, job.interval)
    return _of_job(foreign_keys(spark, job.in_root, _granularity(job)), job, start)


def _input_bars(spark: SparkSession, job: FeatureJob, start: _dt.date | None) -> DataFrame:
    """The job's input bars from `start` on; only files of its symbols and days are opened."""
    if job.layout == "partitions":
        bars = read_bars(spark, job.in_root, job.symbols, start, job.end)
        return bars.where(F.col("interval") == job.interval) if job.interval else bars
    return _of_job(read_foreign_layout(spark, job.in_root, _granularity(job), BAR_SCHEMA), job, start)


def _granularity(job: FeatureJob) -> str | None:
    if job.layout not in ("files", "flat"):
        raise ValueError(f"unknown layout {job.layout!r}; use 'partitions', 'files' or 'flat'")
    if job.layout == "flat" and not job.interval:
        raise ValueError("layout 'flat' names no interval; give the job's")
    return job.interval or "1s" if job.layout == "files" else None


def _of_job(df: DataFrame, job: FeatureJob, start: _dt.date | None) -> DataFrame:
    if job.layout == "flat":
        df = df.withColumn("interval", F.lit(job.interval))
    return prune(df.where(F.col("interval") == (job.interval or "1s")), job.symbols, start, job.end)


def _output_keys(spark: SparkSession, job: FeatureJob) -> DataFrame | None:
    return published_keys(spark, job.out_root) if job.published else existing_keys(spark, job.out_root)


def todo_keys(spark: SparkSession, wanted: DataFrame, job: FeatureJob) -> DataFrame:
    """Wanted keys minus those already written (S11), unless forced."""
    if job.force:
        return wanted
    done = _output_keys(spark, job)
    return wanted if done is None else wanted.join(done, PARTITION_COLUMNS, "left_anti")


def run_features(spark: SparkSession, job: FeatureJob) -> DataFrame:
    """Features for every input day in range that has no output yet.

    Returns the processed keys; `feature_status` tells how each of them ended. Inputs are scanned from start − 1 day so the
    first day gets its warm-up; only the wanted days are written.
    """
    from barwright.functions.specs import default_specs

    ensure_conf(spark)
    specs = list(job.specs) if job.specs is not None else default_specs()[1]
    scan_start = job.start - _dt.timedelta(days=1) if job.start else None
    bars = _input_bars(spark, job, scan_start)
    wanted = _input_keys(spark, job, job.start)
    checkpoint_dir(spark)
    todo = todo_keys(spark, wanted, job).checkpoint()  # a small table of keys; the write below changes what it was made from
    need = todo.unionByName(todo.withColumn("date", F.date_sub("date", 1))).distinct()
    src = bars.join(need, PARTITION_COLUMNS, "left_semi")
    feats = build_features(src, specs=specs, orderflow_windows=job.custom_windows if job.with_custom else None,
                           warmup=job.warmup, mode="daily", warnings=job.warnings, only_days=todo, error_column=job.error_column)
    # Chunks were hash-partitioned by (symbol, interval, chunk_date) and a
    # chunk keeps only its own day, so each output day lives in one task.
    if job.published:
        publish(feats, job.out_root, clustered=True)
    else:
        write_partitioned(feats, job.out_root, overwrite=job.force, clustered=True)
    return todo


def missing_inputs(bars: DataFrame, symbols: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """Wanted (symbol, date) with no input bars, as status rows."""
    present = bars.select("symbol", "date").distinct()
    return (day_grid(symbols, start, end).join(present, ["symbol", "date"], "left_anti")
            .withColumn("status", F.lit("missing")))


def run_ingest(spark: SparkSession, raw: DataFrame, interval: str, out_root: str,
               now: _dt.datetime | None = None, allow_today: bool = False, force: bool = False,
               symbols: Sequence[str] | None = None, start: _dt.date | None = None,
               end: _dt.date | None = None) -> DataFrame:
    """Raw kline pages -> typed, clipped, deduplicated daily bars (3.1).

    Only closed days are written (P8); days already on disk are skipped unless
    forced (S11). `symbols`, `start` and `end` limit the job (P9, P10). Returns the
    completeness report (A2) of what was written; `klines_rejects` reports pages
    and bars that could not be typed.
    """
    ensure_conf(spark)
    now = now or _dt.datetime.now(_dt.timezone.utc)
    last = effective_end(end, now, allow_today)
    if start is not None and start > last:
        raise ValueError(f"the range is empty: {start} is after {last}")
    wanted = raw.where(F.col("symbol").isin(list(symbols))) if symbols else raw
    typed = prune(klines_from_raw(wanted, interval), start=start, end=last)
    clean = bar_table(dedup_keep_last(clip_to_day(typed)))
    done = None if force else existing_keys(spark, out_root)
    if done is not None:
        # one pass over the raw pages: days already on disk are dropped here
        clean = clean.join(done, PARTITION_COLUMNS, "left_anti")
    write_partitioned(clean, out_root, overwrite=force)
    written = read_bars(spark, out_root)
    return day_completeness(written, data_day_grid(written))


def read_feature_files(spark: SparkSession, root: str, layout: str = "partitions") -> DataFrame:
    """Feature files with their path and row order (S5); columns that only some files have are NULL in the others."""
    reader = spark.read.option("mergeSchema", "true")
    if layout != "partitions":
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return reader.parquet(root).select(
        "*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index"))


def file_columns(spark: SparkSession, root: str) -> DataFrame:
    """(file_path, columns) of each parquet file, from its own footer.

    Files are only listed by Spark; the tasks open them through Arrow's file systems and read the footer's
    range, whatever a file's size. Schemes that Arrow does not know (see `open_file`) must be mapped.
    """
    _ship_by_value()
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(root)

    def names(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for b in batches:
            found = []
            for path in b.column("path").to_pylist():
                with open_file(path) as f:
                    found.append(pq.read_schema(f).names)
            yield pa.RecordBatch.from_arrays([b.column("file_path"), pa.array(found, pa.list_(pa.string()))], names=["file_path", "columns"])

    return files.select(F.col("_metadata.file_path").alias("file_path"), "path").mapInArrow(names, "file_path string, columns array<string>")


# Hadoop's scheme names of file systems that Arrow knows under another name.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfs", "abfss": "abfs"}


def open_file(path: str):
    """A file of a Spark listing, opened for reading in ranges."""
    from urllib.parse import quote

    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        return fs.LocalFileSystem().open_input_file("/" + (rest or path).lstrip("/"))
    system, inner = fs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}:{quote(rest, safe='/@:')}")
    return system.open_input_file(inner)


def job_status(spark: SparkSession, job: FeatureJob) -> DataFrame:
    """(symbol, interval, date, status) of every day of the job's range before it runs: `missing` has no
    input (S13), `skipped` is written already (S11), `wanted` will be computed. Days come from the
    data, and with symbols, start and end from their full grid."""
    present = _input_keys(spark, job, job.start).withColumn("present", F.lit(True))
    every = present
    if job.symbols and job.start and job.end:
        symbols = spark.createDataFrame([(s,) for s in job.symbols], "symbol string")
        grid = day_grid(symbols, job.start, job.end).select("symbol", "date")
        intervals = present.select("interval").distinct() if not job.interval else spark.range(1).select(F.lit(job.interval).alias("interval"))
        every = grid.crossJoin(intervals).join(present, PARTITION_COLUMNS, "left")
    done = _output_keys(spark, job)
    if done is None or job.force:
        every = every.withColumn("done", F.lit(None).cast("boolean"))
    else:
        every = every.join(done.withColumn("done", F.lit(True)), PARTITION_COLUMNS, "left")
    status = F.when(F.col("present").isNull(), "missing").when(F.col("done"), "skipped").otherwise("wanted")
    return every.select(*PARTITION_COLUMNS, status.alias("status"))


def feature_status(spark: SparkSession, job: FeatureJob, processed: DataFrame) -> DataFrame:
    """(symbol, interval, date, status, error) of every wanted day after `run_features` returned `processed`.

    `missing` has no input (S13), `skipped` was there before (S11), `ok` and `failed` were computed now; a
    failed day has its rows, without the columns of the specs that `error` names (S14). Errors stand in a column of
    the output itself, so they are written with the rows they speak of; only that column is read back.
    """
    out = read_published(spark, job.out_root) if job.published else spark.read.option("basePath", job.out_root).parquet(job.out_root)
    error = F.max(F.col(job.error_column)) if job.error_column else F.lit(None).cast("string")
    ended = out.join(processed, PARTITION_COLUMNS, "left_semi").groupBy(*PARTITION_COLUMNS).agg(error.alias("error"))
    ended = ended.withColumn("ended", F.when(F.col("error").isNull(), "ok").otherwise("failed"))
    before = job_status(spark, replace(job, force=True)).withColumnRenamed("status", "input")
    status = F.when(F.col("input") == "missing", "missing").otherwise(F.coalesce("ended", F.lit("skipped")))
    return before.join(ended, PARTITION_COLUMNS, "left").select(*PARTITION_COLUMNS, status.alias("status"), "error")


def run_validate(spark: SparkSession, root: str, out: str | None = None, step_ms: int = 1000,
                 first_n: int = 200, layout: str = "partitions") -> DataFrame:
    """Quality report per feature file, in file order.

    A file's columns are those of its own footer, so partition columns that come from
    the path are not among them.
    """
    ensure_conf(spark)
    df = read_feature_files(spark, root, layout)
    # What failed is told by `feature_status`; the column that says so is no feature.
    columns = file_columns(spark, root).withColumn("columns", F.array_remove("columns", ERROR_COLUMN))
    summary, _ = quality_report(df, ["file_path"], "row_index", step_ms=step_ms, first_n=first_n,
                                exclude=["row_index", ERROR_COLUMN], file_columns=columns)
    reports = report_json(summary, ["file_path"], step_ms)
    if out:
        write_reports(reports, out)
    return reports


def preset_symbols(spark: SparkSession, coins: Sequence[str] = FAVORITES) -> DataFrame:
    """The preset symbol list as a one-column DataFrame."""
    return spark.createDataFrame([(c,) for c in coins], "coin STRING").select(pair_symbol("coin").alias("symbol"))


def preset_ingest(spark: SparkSession, raw: DataFrame, out_root: str, now: _dt.datetime | None = None,
                  force: bool = False) -> DataFrame:
    """One-second bars of the preset symbols from the preset's first day on."""
    return run_ingest(spark, raw, "1s", out_root, now=now, force=force,
                      symbols=[c.upper() + "USDT" for c in FAVORITES], start=INGEST_START)


def preset_feature_job(in_root: str, out_root: str, with_custom: bool = True, force: bool = False,
                       warmup: int | str = "auto") -> FeatureJob:
    """The 14-symbol preset over its fixed range."""
    return FeatureJob(in_root=in_root, out_root=out_root, symbols=[c.upper() + "USDT" for c in FAVORITES],
                      start=PRESET_START, end=PRESET_END, with_custom=with_custom, force=force, warmup=warmup)
