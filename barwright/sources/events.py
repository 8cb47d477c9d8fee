"""Bars at a requested interval from a trade/event table (S3).

The exchange aggregates trades into klines; here the same tumbling-bucket
aggregation runs on Spark: one groupBy on (symbol, bucket) with map-side
partial aggregation, so a hot symbol is pre-aggregated before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.schema import DEFAULT_EXCHANGE, interval_to_ms, ms_to_date
from barwright.session import checkpoint_dir


def trades_from_events(events: DataFrame) -> DataFrame:
    """Map the generic `events` table to trades (FIXTURES F1 derivation).

    symbol = event_type; price = value + 1; qty = event_id % 7 + 1;
    a taker buy when event_id is even.
    """
    return events.select(
        F.col("event_type").alias("symbol"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        F.col("event_id").alias("trade_id"),
        (F.col("value") + F.lit(1.0)).alias("price"),
        (F.col("event_id") % 7 + 1).cast("double").alias("qty"),
        (F.col("event_id") % 2 == 0).alias("is_buy"),
    )


def trade_order(ts_ms: Column, trade_id: Column) -> Column:
    """(ts_ms, trade_id) as one number: ids take twenty digits, moved to be positive."""
    number = F.coalesce(trade_id.cast("decimal(20,0)"), F.lit(Decimal(-(1 << 63)))) + F.lit(Decimal(1 << 63))
    return ts_ms.cast("decimal(16,0)") * F.lit(Decimal(10**20)) + number


def bars_from_trades(trades: DataFrame, interval: str, exchange: str = DEFAULT_EXCHANGE) -> DataFrame:
    """Tumbling-window OHLCV bars from (symbol, ts_ms, trade_id, price, qty, is_buy).

    open/close are the prices at the smallest/largest (ts_ms, trade_id); all
    aggregates are decomposable, so Spark runs them as partial + final. The order
    key is one decimal, which hash aggregation can hold (a struct would make it
    sort all trades); a NULL trade_id comes first.
    """
    iv = interval_to_ms(interval)
    order_key = trade_order(F.col("ts_ms"), F.col("trade_id"))
    bucket = (F.col("ts_ms") - F.pmod(F.col("ts_ms"), F.lit(iv))).alias("open_time")
    buy_qty = F.when(F.col("is_buy"), F.col("qty"))
    buy_quote = F.when(F.col("is_buy"), F.col("price") * F.col("qty"))
    bars = trades.groupBy("symbol", bucket).agg(
        F.min_by("price", order_key).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order_key).alias("close"),
        F.sum("qty").alias("volume"),
        F.sum(F.col("price") * F.col("qty")).alias("quote_volume"),
        F.count(F.lit(1)).alias("num_trades"),
        F.coalesce(F.sum(buy_qty), F.lit(0.0)).alias("taker_buy_base"),
        F.coalesce(F.sum(buy_quote), F.lit(0.0)).alias("taker_buy_quote"),
    )
    return bars.select(
        "open_time", "open", "high", "low", "close", "volume",
        (F.col("open_time") + F.lit(iv - 1)).alias("close_time"),
        "quote_volume", "num_trades", "taker_buy_base", "taker_buy_quote",
        F.lit(exchange).alias("exchange"),
        "symbol",
        F.lit(interval).alias("interval"),
        ms_to_date(F.col("open_time")).alias("date"),
    )


def rolled_up(bars: DataFrame, interval: str) -> DataFrame:
    """Bars of a coarser interval from finer ones, without their trades: all aggregates of a bar merge.

    The finer intervals must divide the coarser one, so that each bar lies in one bucket.
    """
    iv = interval_to_ms(interval)
    bucket = (F.col("open_time") - F.pmod(F.col("open_time"), F.lit(iv))).alias("open_time")
    merged = bars.groupBy("exchange", "symbol", bucket).agg(
        F.min_by("open", "open_time").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "open_time").alias("close"),
        *[F.sum(c).alias(c) for c in ("volume", "quote_volume", "num_trades", "taker_buy_base", "taker_buy_quote")])
    return merged.withColumns({
        "close_time": F.col("open_time") + F.lit(iv - 1), "interval": F.lit(interval), "date": ms_to_date(F.col("open_time"))}).select(*bars.columns)


def bars_at(trades: DataFrame, intervals: Sequence[str], exchange: str = DEFAULT_EXCHANGE) -> DataFrame:
    """Bars of several intervals from one scan of the trades: the finest from them, each other from the one before.

    Intervals are given from fine to coarse, each a multiple of the one before. The finest bars are
    checkpointed, so the trades are read and shuffled once whatever the number of intervals.
    """
    sizes = [interval_to_ms(i) for i in intervals]
    if any(coarse % fine or coarse <= fine for fine, coarse in pairwise(sizes)):
        raise ValueError(f"each interval must be a multiple of the one before: {list(intervals)}")
    checkpoint_dir(trades.sparkSession)
    made = [bars_from_trades(trades, intervals[0], exchange).checkpoint()]
    for interval in intervals[1:]:
        made.append(rolled_up(made[-1], interval))
    return reduce(DataFrame.unionByName, made)


def bars_from_events(events: DataFrame, interval: str = "30m", exchange: str = DEFAULT_EXCHANGE) -> DataFrame:
    """Events table -> typed bar table with partition columns (symbol, interval, date)."""
    return bars_from_trades(trades_from_events(events), interval, exchange)
