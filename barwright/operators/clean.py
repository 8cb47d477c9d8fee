"""Cleaning: day clip (P1), dedup keep-last (A1), completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.schema import BAR_COLUMNS, DAY_MS, day_end_ms, day_start_ms, interval_ms_col

BAR_NAMES = [n for n, _ in BAR_COLUMNS]


def clip_to_day(bars: DataFrame) -> DataFrame:
    """Keep bars inside their UTC day: open_time >= midnight and close_time <= 23:59:59.999.

    Bars crossing midnight are dropped, as a per-day fetch clipped to the day does.
    """
    return bars.where(
        (F.col("open_time") >= day_start_ms(F.col("date"))) & (F.col("close_time") <= day_end_ms(F.col("date")))
    )


def dedup_keep_last(bars: DataFrame, order: tuple[str, ...] = ("ingest_seq", "page_pos")) -> DataFrame:
    """One row per (symbol, interval, open_time): the one with the largest `order` key.

    Written as a grouped max_by, which Spark aggregates partially before the
    shuffle, so repeated fetches of a hot symbol collapse map-side.
    """
    cols = [c for c in bars.columns if c not in ("symbol", "interval", "open_time", *order)]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order]))
    out = bars.groupBy("symbol", "interval", "open_time").agg(best.alias("__b"))
    return out.select("symbol", "interval", "open_time", *[F.col("__b")[c].alias(c) for c in cols])


def day_completeness(bars: DataFrame, grid: DataFrame) -> DataFrame:
    """Bars per (symbol, interval, date) against the expected count (A2).

    `grid` lists every wanted (symbol, interval, date) (P15), so empty days show
    got = 0. Expected = whole intervals in a UTC day.
    """
    got = bars.groupBy("symbol", "interval", "date").agg(F.count(F.lit(1)).alias("got"))
    out = grid.join(got, ["symbol", "interval", "date"], "left")
    expected = F.floor(F.lit(DAY_MS) / interval_ms_col(F.col("interval"))).cast("long")
    return out.select(
        "symbol", "interval", "date",
        expected.alias("expected"),
        F.coalesce(F.col("got"), F.lit(0)).cast("long").alias("got"),
    ).withColumn("complete", F.col("got") == F.col("expected"))


def bar_table(bars: DataFrame) -> DataFrame:
    """Project to the fixed bar contract plus partition columns."""
    return bars.select(*BAR_NAMES, "interval", "date")


def data_day_grid(bars: DataFrame) -> DataFrame:
    """(symbol, interval, date) for every day between each series' first and last bar.

    One small aggregate per series, expanded by `sequence`: no join, and its
    size is the number of series-days, not the number of bars.
    """
    span = bars.groupBy("symbol", "interval").agg(F.min("date").alias("d0"), F.max("date").alias("d1"))
    return span.select("symbol", "interval",
                       F.explode(F.sequence("d0", "d1", F.expr("interval 1 day"))).alias("date"))
