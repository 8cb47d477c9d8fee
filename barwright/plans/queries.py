"""Registered queries: one per inventory item, each reading the given tables.

Every query derives its bars from the whole `events` table (fixture F1) and
returns rounded doubles so that it can be compared with its DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.operators.orderflow import orderflow_columns
from barwright.plans.common import bars, dense_bars, rounded
from barwright.plans.features import build_features

KEYS = ["symbol", "interval", "date", "open_time"]


def q_bars_30m(spark: SparkSession, sf: str) -> DataFrame:
    """S3: 30-minute OHLCV bars aggregated from the event stream."""
    return rounded(bars(spark, sf, "30m"))


def q_orderflow_continuous(spark: SparkSession, sf: str) -> DataFrame:
    """C1-C10 at windows 60/300/900 with whole-series values (day chunks + multi-day halo)."""
    f = build_features(bars(spark, sf), specs=[], orderflow_windows=(60, 300, 900), mode="continuous")
    return rounded(f.select(*KEYS, *orderflow_columns((60, 300, 900))))


def q_orderflow_daily(spark: SparkSession, sf: str) -> DataFrame:
    """C1-C10 at windows 6/12/24 per day chunk with the previous day's tail as warm-up."""
    f = build_features(bars(spark, sf), specs=[], orderflow_windows=(6, 12, 24), mode="daily")
    return rounded(f.select(*KEYS, *orderflow_columns((6, 12, 24))))


def indicator_query(spec: dict, mode: str, warmup: int | str = "auto"):
    """Query: bars -> one indicator spec -> keys + its output columns."""
    from barwright.functions.registry import plan_specs

    def q(spark: SparkSession, sf: str) -> DataFrame:
        plan = plan_specs([spec])
        f = build_features(bars(spark, sf), specs=[spec], orderflow_windows=None, mode=mode, warmup=warmup)
        return rounded(f.select(*KEYS, *[F.col(f"`{n}`") for n in plan.outputs]))

    q.__doc__ = f"Indicator {spec['kind']} ({mode} mode)."
    return q


def _native_indicator_queries() -> dict:
    from barwright.functions.registry import CUMULATIVE_KINDS
    from barwright.plans.oracle_ind import native_cases

    return {f"ind_{k}": indicator_query(spec, "daily" if k in CUMULATIVE_KINDS else "continuous")
            for k, (spec, _, _) in native_cases().items()}


def _dense_queries() -> dict:
    """Window kinds on daily chunks of tens of thousands of one-second bars."""
    from barwright.functions.registry import plan_specs
    from barwright.plans.oracle_ind import DENSE_KINDS, native_cases

    def query(spec: dict):
        def q(spark: SparkSession, sf: str) -> DataFrame:
            f = build_features(dense_bars(spark, sf), specs=[spec], orderflow_windows=None, mode="daily")
            return rounded(f.select(*KEYS, *[F.col(f"`{n}`") for n in plan_specs([spec]).outputs]))

        return q

    return {f"dense_{k.removesuffix('_continuous')}": query(native_cases()[k][0]) for k in DENSE_KINDS}


def _kernel_indicator_queries() -> dict:
    from barwright.plans.oracle_ind import kernel_cases

    from barwright.plans.oracle_ind import short_kernel_cases

    out = {f"ind_{k}": indicator_query(spec, "daily") for k, spec in kernel_cases().items()}
    # Short-parameter variants whose values fill a 30-minute daily chunk.
    out.update({f"ind_{k}": indicator_query(spec, "daily") for k, spec in short_kernel_cases().items()})
    return out


def _continuous_queries() -> dict:
    """Cumulative and recursive kinds over the unbroken series."""
    from barwright.plans.oracle_ind import continuous_cases

    return {f"ind_{k}_continuous": indicator_query(spec, "continuous") for k, (spec, _) in continuous_cases().items()}


def _raw_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Raw kline pages from 7-hour bars (fixture F2): every bar fetched twice,
    the second fetch (ingest_seq 2) carrying a revised close; days of the
    series without bars get an empty page; some bars cross midnight."""
    from barwright.operators.clean import data_day_grid
    from barwright.sources.klines import raw_from_bars

    b = bars(spark, sf, "7h")
    v1 = raw_from_bars(b, 1)
    v2 = raw_from_bars(b.withColumn("close", F.col("high")), 2)
    empty = (data_day_grid(b).join(b.select("symbol", "date").distinct(), ["symbol", "date"], "left_anti")
             .select("symbol", F.lit(3).cast("long").alias("ingest_seq"), F.lit("[]").alias("payload"), "date"))
    return v1.unionByName(v2).unionByName(empty).drop("date")


def q_klines_typed(spark: SparkSession, sf: str) -> DataFrame:
    """JSON kline pages -> typed rows (both fetches, empty pages vanish)."""
    from barwright.sources.klines import klines_from_raw

    return rounded(klines_from_raw(_raw_pages(spark, sf), "7h"))


def q_klines_clean(spark: SparkSession, sf: str) -> DataFrame:
    """P1 + A1: clip bars crossing midnight, keep the last fetch of each bar."""
    from barwright.operators.clean import bar_table, clip_to_day, dedup_keep_last
    from barwright.sources.klines import klines_from_raw

    typed = klines_from_raw(_raw_pages(spark, sf), "7h")
    return rounded(bar_table(dedup_keep_last(clip_to_day(typed))))


def q_day_completeness(spark: SparkSession, sf: str) -> DataFrame:
    """A2 + P15: bars per day against 48 expected 30-minute bars, empty days included."""
    from barwright.operators.clean import data_day_grid, day_completeness

    b = bars(spark, sf, "30m")
    return day_completeness(b, data_day_grid(b))


QUALITY_SPECS = [{"kind": "log_return", "cumulative": False}, {"kind": "obv"}]
QUALITY_FIRST_N = 12


def _quality(spark: SparkSession, sf: str):
    """Quality report over one feature file per (symbol, day): bars + order flow
    (6/12/24) + LOGRET_1 and OBV, daily chunks. Rows are in open_time order."""
    from barwright.operators.clean import BAR_NAMES
    from barwright.operators.quality import quality_report
    from barwright.plans.features import build_features

    f = build_features(bars(spark, sf), specs=QUALITY_SPECS, orderflow_windows=(6, 12, 24), mode="daily")
    feats = [c for c in f.columns if c not in BAR_NAMES and c not in ("interval", "date")]
    files = f.select(F.col("symbol").alias("file_symbol"), F.col("date").alias("file_date"), *BAR_NAMES, *feats)
    return quality_report(files, ["file_symbol", "file_date"], "open_time", step_ms=1_800_000,
                          first_n=QUALITY_FIRST_N)


def q_quality_summary(spark: SparkSession, sf: str) -> DataFrame:
    """One report row per file; arrays shown as comma lists."""
    summary, _ = _quality(spark, sf)
    flat = summary.select(
        "*",
        F.col("shape")[0].alias("n_rows"), F.col("shape")[1].alias("n_cols"),
        *[F.array_join(F.col(c).cast("array<string>"), ",").alias(f"{c}_list")
          for c in ("missing_base_cols", "right_cols", "open_time_unique_diffs", "all_null_cols")],
    ).drop("shape", "missing_base_cols", "right_cols", "open_time_unique_diffs", "all_null_cols",
           "top_null_cols_all", "top_null_cols_head")
    return rounded(flat)


def q_quality_top_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """The fifteen columns with the highest NULL rate per file, all rows and head."""
    _, top = _quality(spark, sf)
    return rounded(top)


def q_stream_closed_bars(spark: SparkSession, sf: str) -> DataFrame:
    """S3 + P8 in Structured Streaming: the events file as a stream, 30-minute
    event-time windows with a watermark; only closed bars are emitted."""
    import uuid

    from barwright.session import checkpoint_dir
    from barwright.streaming.bars import run_closed_bars_once

    run = uuid.uuid4().hex[:12]
    out = run_closed_bars_once(spark, sf, "30m", f"closed_bars_{run}", delay="0 seconds",  # the file is in time order
                               checkpoint=f"{checkpoint_dir(spark)}/closed-bars-{run}")
    return rounded(out)


def q_warmup_stitch(spark: SparkSession, sf: str) -> DataFrame:
    """Each day's 30-minute bars plus the previous calendar day's last 5 bars."""
    from barwright.operators.chunks import stitch_warmup

    b = bars(spark, sf).select("symbol", "interval", "date", "open_time", "close")
    return rounded(stitch_warmup(b, 5))


def q_halo_stitch(spark: SparkSession, sf: str) -> DataFrame:
    """Continuous-mode chunks: each day's bars plus the 70 bars before its first bar,
    reaching back over as many days as needed."""
    from barwright.operators.chunks import stitch_halo

    b = bars(spark, sf).select("symbol", "interval", "date", "open_time", "close")
    return rounded(stitch_halo(b, 70))


def q_halo_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Continuous-mode chunks of several days: stretches of 350 rows with the 70 bars before them."""
    from barwright.operators.chunks import stitch_halo

    b = bars(spark, sf).select("symbol", "interval", "date", "open_time", "close")
    return rounded(stitch_halo(b, 70, chunk_rows=350))


def q_merge_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    """A1 over separate ingests: the newer fetch is merged first, the older one comes late and must not win."""
    import uuid

    from barwright.schema import BAR_TABLE_SCHEMA
    from barwright.session import checkpoint_dir
    from barwright.streaming.ingest import merge_batch

    raw = _raw_pages(spark, sf)
    root = f"{checkpoint_dir(spark)}/merge-{uuid.uuid4().hex[:12]}"
    for i, seq in enumerate((2, 1)):
        merge_batch(raw.where(F.col("ingest_seq") == seq), i, "7h", root)
    return rounded(spark.read.schema(BAR_TABLE_SCHEMA).option("basePath", root).parquet(root))


def q_klines_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Pages and bars that cannot be typed, counted per symbol: every third page is cut short, and
    bars whose close is above 50 lose their open_time."""
    from barwright.sources.klines import klines_rejects, raw_from_bars

    b = bars(spark, sf, "7h")
    opened = F.when(F.col("close") <= 50, F.col("open_time"))
    pages = raw_from_bars(b.withColumn("open_time", F.coalesce(opened, F.lit(-1))))
    broken = F.regexp_replace("payload", '"-1"', '"?"')
    cut = F.when(F.dayofmonth("date") % 3 == 0, F.expr("substring(payload, 1, length(payload) - 3)")).otherwise(broken)
    return klines_rejects(pages.withColumn("payload", cut), "7h")


def q_bars_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """S3 at 30m, 1h and 7h from one scan: each coarser interval from the finer one."""
    from barwright.plans.common import table
    from barwright.session import ensure_conf
    from barwright.sources.events import bars_at, trades_from_events

    ensure_conf(spark)
    return rounded(bars_at(trades_from_events(table(spark, sf, "events")), ("30m", "1h", "7h")))


def q_quality_file_order(spark: SparkSession, sf: str) -> DataFrame:
    """A4-A6 on files whose rows do not stand in time order: half of the files are dealt out by a multiple of open_time."""
    from barwright.operators.quality import quality_report

    b = bars(spark, sf, "30m")
    slot = F.col("open_time") / 1_800_000
    place = F.when(F.dayofmonth("date") % 2 == 0, (slot * 29) % 48).otherwise(slot % 48).cast("long")
    files = b.select(F.col("symbol").alias("file_symbol"), F.col("date").alias("file_date"), "open_time", "close", place.alias("place"))
    summary, _ = quality_report(files, ["file_symbol", "file_date"], "place", step_ms=1_800_000, exclude=["place"], probes=())
    return rounded(summary.select("file_symbol", "file_date", "open_time_monotonic", "open_time_step_rate",
                                  F.array_join(F.col("open_time_unique_diffs").cast("array<string>"), ",").alias("diffs")))


def _fails_above(a, limit=50.0):
    """A kernel kind that fails on a chunk whose last close is above the limit."""
    if a["close"][-1] > limit:
        raise ValueError(f"last close is above {limit:g}")
    return {"FAILS_ABOVE": a["close"]}


def q_feature_status(spark: SparkSession, sf: str) -> DataFrame:
    """A feature job over 7-hour bars with a spec that fails on some days, after a job that wrote
    days 5 to 8 without it; one status row for each wanted day."""
    import datetime as dt
    import uuid

    from barwright.functions.registry import register_indicator
    from barwright.plans.jobs import FeatureJob, feature_status, run_features
    from barwright.session import checkpoint_dir
    from barwright.sources.tables import write_partitioned

    b = bars(spark, sf, "7h")
    root = f"{checkpoint_dir(spark)}/feature-job-{uuid.uuid4().hex[:12]}"
    write_partitioned(b, f"{root}/bars")
    register_indicator("fails_above", _fails_above, kernel=True)
    common = dict(in_root=f"{root}/bars", out_root=f"{root}/features", with_custom=False, interval="7h")
    sma = {"kind": "sma", "length": 3}
    run_features(spark, FeatureJob(specs=[sma], start=dt.date(2024, 1, 5), end=dt.date(2024, 1, 8), **common))
    symbols = [r.symbol for r in b.select("symbol").distinct().collect()] + ["NONE"]
    job = FeatureJob(specs=[sma, {"kind": "fails_above"}], symbols=symbols, start=dt.date(2024, 1, 1), end=dt.date(2024, 2, 15), **common)
    return feature_status(spark, job, run_features(spark, job))


def q_published_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Days published in two writes, a third that fails half-way, and one that replaces days; all days as read."""
    import uuid

    from barwright.session import checkpoint_dir
    from barwright.sources.publish import publish, read_published

    b = bars(spark, sf, "7h")
    root = f"{checkpoint_dir(spark)}/published-{uuid.uuid4().hex[:12]}"
    publish(b.where("date <= '2024-01-15'"), root)
    publish(b.where("date > '2024-01-15'"), root)
    try:
        lost = F.expr("CASE WHEN date = '2024-01-20' THEN raise_error('lost') ELSE 0D END").cast("double")
        publish(b.repartition("symbol", "interval", "date").withColumn("close", lost), root, clustered=True)  # tasks of other days write
    except Exception as e:
        if "lost" not in str(e):
            raise
    publish(b.where("date BETWEEN '2024-01-10' AND '2024-01-20'").withColumn("close", F.col("high")), root)
    return rounded(read_published(spark, root).select(*b.columns))


def q_dedup_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    """A1 alone: two fetches of every 7-hour bar; the later fetch wins."""
    from barwright.operators.clean import bar_table, dedup_keep_last
    from barwright.sources.klines import klines_from_raw

    return rounded(bar_table(dedup_keep_last(klines_from_raw(_raw_pages(spark, sf), "7h"))))


QUERIES = {
    "bars_30m": q_bars_30m,
    "orderflow_continuous": q_orderflow_continuous,
    "orderflow_daily": q_orderflow_daily,
    "klines_typed": q_klines_typed,
    "klines_clean": q_klines_clean,
    "day_completeness": q_day_completeness,
    "quality_summary": q_quality_summary,
    "quality_top_nulls": q_quality_top_nulls,
    "stream_closed_bars": q_stream_closed_bars,
    "warmup_stitch": q_warmup_stitch,
    "halo_stitch": q_halo_stitch,
    "halo_chunks": q_halo_chunks,
    "merge_keep_last": q_merge_keep_last,
    "klines_rejects": q_klines_rejects,
    "dedup_keep_last": q_dedup_keep_last,
    "feature_status": q_feature_status,
    "bars_rollup": q_bars_rollup,
    "published_bars": q_published_bars,
    "quality_file_order": q_quality_file_order,
}
QUERIES.update(_native_indicator_queries())
QUERIES.update(_dense_queries())
QUERIES.update(_kernel_indicator_queries())
QUERIES.update(_continuous_queries())


DENSE_SPECS = [
    {"kind": "sma", "length": 50}, {"kind": "wma", "length": 21}, {"kind": "bbands", "length": 20, "std": 2.0},
    {"kind": "zscore", "length": 60}, {"kind": "kurtosis", "length": 60}, {"kind": "ema", "length": 26}, {"kind": "rsi", "length": 14},
    {"kind": "macd", "fast": 12, "slow": 26, "signal": 9}, {"kind": "atr", "length": 14}, {"kind": "psar"},
]


def q_features_dense(spark: SparkSession, sf: str) -> DataFrame:
    """Day-long chunks of one-second bars: ten indicators of all classes and order flow at 60/300/900."""
    return build_features(dense_bars(spark, sf), specs=DENSE_SPECS, orderflow_windows=(60, 300, 900), mode="daily")


def q_flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: 30-minute bars -> full default indicator set + order flow, daily chunks."""
    from barwright.functions.specs import default_specs

    _, specs = default_specs()
    return build_features(bars(spark, sf), specs=specs, orderflow_windows=(6, 12, 24), mode="daily")
