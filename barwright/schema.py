"""Bar schema, interval grammar and UTC calendar helpers."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the bar contract: column order and types of a bar row.
BAR_COLUMNS = [
    ("open_time", T.LongType()),
    ("open", T.DoubleType()),
    ("high", T.DoubleType()),
    ("low", T.DoubleType()),
    ("close", T.DoubleType()),
    ("volume", T.DoubleType()),
    ("close_time", T.LongType()),
    ("quote_volume", T.DoubleType()),
    ("num_trades", T.LongType()),
    ("taker_buy_base", T.DoubleType()),
    ("taker_buy_quote", T.DoubleType()),
    ("exchange", T.StringType()),
    ("symbol", T.StringType()),
]
BAR_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in BAR_COLUMNS])

# Partition columns we add to the bar table.
PARTITION_COLUMNS = ["symbol", "interval", "date"]
BAR_TABLE_SCHEMA = T.StructType(
    list(BAR_SCHEMA.fields)
    + [T.StructField("interval", T.StringType(), True), T.StructField("date", T.DateType(), True)]
)

# The base columns the validator expects, and the exchange literal.
BASE_COLUMNS = [
    "open_time", "open", "high", "low", "close", "volume",
    "quote_volume", "num_trades", "taker_buy_base", "taker_buy_quote",
]
DEFAULT_EXCHANGE = "binance-spot"

DAY_MS = 86_400_000
# Milliseconds per interval unit (s, m, h, d, w).
UNIT_MS = {"s": 1_000, "m": 60_000, "h": 3_600_000, "d": 86_400_000, "w": 604_800_000}

_INTERVAL_RE = re.compile(r"^\s*(\d+)\s*([smhdw])\s*$")


def interval_to_ms(interval: str) -> int:
    """`<int><s|m|h|d|w>` -> milliseconds (P7). `M` (month) is rejected, not read as minutes."""
    m = _INTERVAL_RE.match(interval)
    if not m or int(m.group(1)) <= 0:
        raise ValueError(f"unsupported interval: {interval!r}")
    return int(m.group(1)) * UNIT_MS[m.group(2)]


def interval_ms_col(c: Column) -> Column:
    """Column form of the interval grammar; NULL for anything outside it."""
    num = F.regexp_extract(c, r"^(\d+)([smhdw])$", 1)
    unit = F.regexp_extract(c, r"^(\d+)([smhdw])$", 2)
    mult = F.create_map(*[x for k, v in UNIT_MS.items() for x in (F.lit(k), F.lit(v))])
    return F.when(num != "", num.cast("long") * mult[unit])


def parse_utc_date(s: str, now: _dt.datetime | None = None) -> _dt.date:
    """UTC date of an ISO date or timestamp, or of `yesterday` (P6). Without an offset it is UTC."""
    utc = _dt.timezone.utc
    text = s.strip()
    if text.lower() == "yesterday":
        instant = (now or _dt.datetime.now(utc)) - _dt.timedelta(days=1)
    else:
        instant = _dt.datetime.fromisoformat(text)
    return (instant if instant.tzinfo else instant.replace(tzinfo=utc)).astimezone(utc).date()


def effective_end(end: _dt.date | None, now: _dt.datetime, allow_today: bool = False) -> _dt.date:
    """End-date cap to yesterday UTC unless allowed (P8): only closed days are ingested."""
    yesterday = now.astimezone(_dt.timezone.utc).date() - _dt.timedelta(days=1)
    end = end or yesterday
    return end if allow_today else min(end, yesterday)


def day_start_ms(date_col: Column) -> Column:
    """UTC midnight of a DATE column in epoch ms."""
    return F.unix_date(date_col).cast("long") * F.lit(DAY_MS)


def day_end_ms(date_col: Column) -> Column:
    """Last millisecond of the UTC day."""
    return day_start_ms(date_col) + F.lit(DAY_MS - 1)


def ms_to_date(ms: Column) -> Column:
    """UTC calendar day of an epoch-ms column."""
    return F.date_from_unix_date(((ms - F.pmod(ms, F.lit(DAY_MS))) / F.lit(DAY_MS)).cast("int"))


def parse_symbols(s: str) -> list[str]:
    """Comma list -> trimmed, upper-cased, blanks dropped (P10)."""
    return [x.strip().upper() for x in s.split(",") if x.strip()]


def symbols_col(c: Column) -> Column:
    """Column form of P10 over a comma-separated string."""
    return F.filter(F.transform(F.split(c, ","), lambda x: F.upper(F.trim(x))), lambda x: x != "")


def pair_symbol(coin: Column | str, quote: str = "USDT") -> Column:
    """`{COIN}USDT` naming."""
    c = F.col(coin) if isinstance(coin, str) else coin
    return F.concat(F.upper(c), F.lit(quote))


def day_grid(symbols: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """(symbol, date) for every day of [start, end] (P15). `symbols` has a `symbol` column.

    Each symbol row expands to its own day sequence, so the grid is exactly the
    requested output, built without a join.
    """
    return symbols.select("symbol").distinct().select(
        "symbol",
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("date"),
    )


def empty_bars(spark: SparkSession) -> DataFrame:
    """Typed empty bar table."""
    return spark.createDataFrame([], BAR_SCHEMA)
