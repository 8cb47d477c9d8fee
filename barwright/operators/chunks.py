"""Chunks and warm-up.

A chunk is one (symbol, interval, UTC day) plus, in daily mode, the last W bars
of the previous calendar day. Every row is tagged with `chunk_date`; windows
partition by (symbol, interval, chunk_date), so chunks are independent and
their size is bounded by one day plus W rows whatever the history length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright.operators.windows import CHUNK_KEYS


def stitch_warmup(bars: DataFrame, warmup_rows: int) -> DataFrame:
    """Body rows of each day plus the tail(W) of the previous calendar day.

    The tail is ranked per (symbol, interval, date) by open_time descending;
    Spark plans `row_number() <= W` as a group limit that already trims each
    input partition before the shuffle. Only one previous day is consulted;
    a missing previous day means a cold start. Tail rows whose next day has no
    bars form chunks without body rows, which the day slice removes, so no
    lookup of present days is needed.
    """
    body = bars.withColumn("chunk_date", F.col("date")).withColumn("is_warmup", F.lit(False))
    if warmup_rows <= 0:
        return body
    w = Window.partitionBy("symbol", "interval", "date").orderBy(F.col("open_time").desc())
    tail = (
        bars.withColumn("__rk", F.row_number().over(w))
        .where(F.col("__rk") <= warmup_rows)
        .drop("__rk")
        .withColumn("chunk_date", F.date_add(F.col("date"), 1))
        .withColumn("is_warmup", F.lit(True))
    )
    return body.unionByName(tail)


def stitch_halo(bars: DataFrame, halo: int, chunk_rows: int = 1) -> DataFrame:
    """Chunks of whole days plus the `halo` rows that precede their first bar in the
    whole series, however many earlier chunks they span (continuous mode).

    Days whose first bars lie in one stretch of `chunk_rows` rows of the series form
    one chunk, named by its first day (chunk_rows=1: each day is a chunk). With chunks
    several halos long only a small share of the rows is copied. A finite window of
    length <= halo + 1 sees exactly what it would see over the unbroken series. No
    step ranks a whole series:
    - per-day counts (one row per day) give each day's start index in its
      series through a running sum over days, and from these the chunks;
    - only each chunk's last `halo` rows can precede a later chunk closely
      enough, so only they are ranked (a group limit trims them before the
      shuffle) and given their series index g;
    - a later chunk starting at s needs g in [s - halo, s); with buckets of
      width `halo` that is at most two buckets, so candidates meet the chunks
      that need them through an equi-join on (symbol, interval, bucket).
    """
    if halo <= 0:
        return bars.withColumn("chunk_date", F.col("date")).withColumn("is_warmup", F.lit(False))
    keys = ["symbol", "interval"]
    per_day = bars.groupBy(*keys, "date").agg(F.count(F.lit(1)).alias("__n"))
    wd = Window.partitionBy(*keys).orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    per_day = per_day.withColumn("__day_start", F.coalesce(F.sum("__n").over(wd), F.lit(0)))
    part = F.floor(F.col("__day_start") / max(1, chunk_rows))
    wp = Window.partitionBy(*keys, part)
    per_day = (per_day.withColumn("chunk_date", F.min("date").over(wp))
               .withColumn("__start", F.min("__day_start").over(wp)).withColumn("__rows", F.sum("__n").over(wp)))
    days = per_day.select(*keys, "date", "chunk_date", "__start", "__rows")
    body = bars.join(days, [*keys, "date"])
    wt = Window.partitionBy(*keys, "chunk_date").orderBy(F.col("open_time").desc())
    tail = (body.withColumn("__rk", F.row_number().over(wt)).where(F.col("__rk") <= halo)
            .withColumn("__g", F.col("__start") + F.col("__rows") - F.col("__rk"))
            .withColumn("__bucket", F.floor(F.col("__g") / halo))
            .drop("__rk", "__rows", "__start", "chunk_date"))
    lo = F.greatest(F.col("__start") - halo, F.lit(0))
    need = (days.where((F.col("__start") > 0) & (F.col("date") == F.col("chunk_date")))
            .select(*keys, "chunk_date", F.col("__start").alias("__s"),
                    F.explode(F.array_distinct(F.array(F.floor(lo / halo), F.floor((F.col("__start") - 1) / halo))))
                    .alias("__bucket")))
    halo_rows = (tail.join(need, [*keys, "__bucket"])
                 .where((F.col("__g") >= F.col("__s") - halo) & (F.col("__g") < F.col("__s")))
                 .drop("__g", "__bucket", "__s")
                 .withColumn("is_warmup", F.lit(True)))
    own = body.drop("__start", "__rows").withColumn("is_warmup", F.lit(False)).select(*bars.columns, "chunk_date", "is_warmup")
    return own.unionByName(halo_rows)


def slice_to_day(df: DataFrame) -> DataFrame:
    """Keep the chunk's own days (P2): what was stitched on before them goes."""
    return df.where(~F.col("is_warmup"))


def previous_day(date_col) -> F.Column:
    return F.date_sub(date_col, 1)


def chunk_keys(mode: str) -> tuple[str, ...]:
    if mode in ("daily", "continuous"):
        return CHUNK_KEYS
    raise ValueError(f"unknown mode {mode!r}; use 'daily' or 'continuous'")
