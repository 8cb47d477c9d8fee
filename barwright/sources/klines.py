"""Raw klines -> typed bars.

Raw layout: one row per fetched page, `symbol STRING, ingest_seq BIGINT,
payload STRING` where payload is a JSON array of positional arrays
[open_time, open, high, low, close, volume, close_time, quote_volume,
num_trades, taker_buy_base, taker_buy_quote, ...]; numbers may be strings.
Pages accumulate as rows (O6); typing is one explode + positional casts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.schema import BAR_COLUMNS, DEFAULT_EXCHANGE, ms_to_date

# Positional slots of the kline array, in order.
SLOTS = ["open_time", "open", "high", "low", "close", "volume", "close_time",
         "quote_volume", "num_trades", "taker_buy_base", "taker_buy_quote"]

RAW_SCHEMA = "symbol STRING, ingest_seq BIGINT, payload STRING"


def klines_from_raw(raw: DataFrame, interval: str, exchange: str = DEFAULT_EXCHANGE) -> DataFrame:
    """Type raw kline pages (S1). An empty page yields no rows (S2 keeps the schema).

    Keeps `ingest_seq` and the position inside the page (`page_pos`) so that a
    later fetch of the same bar can win the keep-last dedup.
    """
    types = dict(BAR_COLUMNS)
    arr = F.from_json(F.col("payload"), "array<array<string>>")
    k = raw.select("symbol", "ingest_seq", F.posexplode(arr).alias("page_pos", "r"))
    slots = [F.element_at("r", i + 1).try_cast(types[name]).alias(name) for i, name in enumerate(SLOTS)]
    typed = k.select(*slots, F.lit(exchange).alias("exchange"), "symbol", "ingest_seq", "page_pos")
    return typed.withColumn("interval", F.lit(interval)).withColumn("date", ms_to_date(F.col("open_time")))


def klines_rejects(raw: DataFrame, interval: str) -> DataFrame:
    """(symbol, bad_pages, bad_bars): pages that are no JSON array of arrays, and bars without a readable
    open_time, per symbol. Neither can be typed; ingest reports them instead of losing them silently."""
    pages = F.from_json(F.col("payload"), "array<array<string>>")
    opens = F.transform(F.coalesce(pages, F.array().cast("array<array<string>>")), lambda r: F.get(r, 0).try_cast("bigint"))
    bad_bars = F.size(F.filter(opens, lambda x: x.isNull()))
    counts = raw.select("symbol", pages.isNull().cast("long").alias("p"), bad_bars.cast("long").alias("b"))
    return counts.groupBy("symbol").agg(F.sum("p").alias("bad_pages"), F.sum("b").alias("bad_bars"))


def raw_from_bars(bars: DataFrame, ingest_seq: int = 1) -> DataFrame:
    """Inverse of S1 (fixture F2): one JSON page per (symbol, date) via to_json."""
    row = F.array(
        F.col("open_time").cast("string"),
        *[F.col(c).cast("string") for c in SLOTS[1:6]],
        F.col("close_time").cast("string"),
        F.col("quote_volume").cast("string"),
        F.col("num_trades").cast("string"),
        F.col("taker_buy_base").cast("string"),
        F.col("taker_buy_quote").cast("string"),
    )
    pages = bars.groupBy("symbol", "date").agg(
        F.sort_array(F.collect_list(F.struct(F.col("open_time"), row.alias("r")))).alias("rows")
    )
    return pages.select(
        "symbol",
        F.lit(ingest_seq).cast("long").alias("ingest_seq"),
        F.to_json(F.transform("rows", lambda x: x["r"])).alias("payload"),
        "date",
    )
