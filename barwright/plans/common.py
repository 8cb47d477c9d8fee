"""Shared plumbing for registered queries: table loading and output rounding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.schema import ms_to_date
from barwright.session import ensure_conf
from barwright.sources.events import bars_from_events

# Comparison precision: 8 significant digits, at most 5 decimals. Doubles
# summed in a different order (Spark vs DuckDB) agree to ~1e-15 relative;
# scaling the decimals by magnitude keeps large cumulative values (price
# indices reach 1e29 on the fixtures) comparable. Scale factors are powers of
# ten up to 1e22, which are exact doubles, so both engines round identically.
SIG_DIGITS = 8
MAX_DECIMALS = 5
MAX_POW = 22
# Exact decimal ties (x.xxxxx5) are common in this data (two-decimal prices,
# integer volumes) and two engines may land one ulp either side of them; a
# relative nudge far above ulp noise and far below the quantum sends both the
# same way.
NUDGE = 1e-11


def round_sql(x: str) -> str:
    """Comparison rounding as SQL text valid in Spark and DuckDB."""
    y = f"(({x}) + abs({x}) * {NUDGE!r})"
    d = (f"(CASE WHEN abs({y}) >= 100 THEN greatest(-{MAX_POW}, {SIG_DIGITS - 1} - "
         f"CAST(floor(log10(abs({y}))) AS INTEGER)) ELSE {MAX_DECIMALS} END)")
    m = f"power(10.0, abs({d}))"
    return (f"(CASE WHEN {y} IS NULL OR isnan({y}) THEN {y} WHEN {d} >= 0 THEN round({y} * {m}) / {m} "
            f"ELSE round({y} / {m}) * {m} END + 0.0)")


def round_sig(c_name: str):
    return F.expr(round_sql(f"`{c_name}`"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str, interval: str = "30m") -> DataFrame:
    """Bars derived from the `events` table (fixture F1)."""
    ensure_conf(spark)
    return bars_from_events(table(spark, sf_dir, "events"), interval)


def dense_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-second bars, one per `lineitem` row (fixture F6): long days with flat and moving stretches."""
    ensure_conf(spark)
    line = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_extendedprice").cast("double").alias("px"), F.max("l_quantity").cast("double").alias("qty"))
    key = F.col("l_orderkey")
    moving = F.col("px") / 1000.0 + 1.0
    close = F.when(F.floor(key / 256) % 2 == 0, moving).otherwise(100.0 + F.floor(key / 64) % 7)
    t = line.select((F.lit(1704067200000) + (key * 7 + F.col("l_linenumber")) * 1000).cast("long").alias("open_time"),
                    close.alias("close"), F.col("qty").alias("volume"), (F.col("px") * F.col("qty")).alias("quote_volume"))
    zero = F.lit(0.0)
    return t.select(
        "open_time", (F.col("close") + 0.25).alias("open"), (F.col("close") + 0.5).alias("high"),
        (F.col("close") - 0.5).alias("low"), "close", "volume", (F.col("open_time") + 999).alias("close_time"),
        "quote_volume", F.lit(1).cast("long").alias("num_trades"), zero.alias("taker_buy_base"),
        zero.alias("taker_buy_quote"), F.lit("fixture").alias("exchange"), F.lit("LINE").alias("symbol"),
        F.lit("1s").alias("interval"), ms_to_date(F.col("open_time")).alias("date"))


def rounded(df: DataFrame) -> DataFrame:
    """Round every DOUBLE for comparison (see SIG_DIGITS) and add 0.0 (folds -0.0 into 0.0)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(round_sig(f.name).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)
