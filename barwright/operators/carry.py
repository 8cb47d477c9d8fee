"""Cumulative columns over an unbroken series, from chunks that restart (continuous mode).

Two passes: every chunk's own total (one row per chunk), a running sum of these totals over
the chunks of a series, and that carry joined back to the chunk's rows by the chunk
keys, on which they are partitioned already. What the chunk's stitched-on rows added
before its own first row is taken off. No step sees more than a chunk's rows or a
series' chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Columns that grow by addition or by factors; values that follow the running volume move with it.
ADDED, MULTIPLIED = ("AD", "OBV", "PVT"), ("PVI", "NVI")
FOLLOWERS = {"OBV_min_": "OBV", "OBV_max_": "OBV", "OBVe_": "OBV"}


def carried_by(name: str) -> str | None:
    """The cumulative column whose carry a column takes, if any."""
    if name in ADDED or name in MULTIPLIED:
        return name
    return next((to for start, to in FOLLOWERS.items() if name.startswith(start)), None)


def carry_forward(df: DataFrame, where: dict[str, str], keys: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """`df` with the carries of its chunks, and the expressions of `where` with the carry put in."""
    sources = sorted({carried_by(n) for n in where} - {None})
    if not sources:
        return df, where
    level = {c: f"ln({where[c]} / 1000D)" if c in MULTIPLIED else where[c] for c in sources}
    aggs = []
    for c in sources:
        aggs += [F.expr(f"coalesce(max_by({level[c]}, open_time), 0D)").alias(f"end_{c}"),
                 F.expr(f"coalesce(max_by({level[c]}, open_time) FILTER (WHERE is_warmup), 0D)").alias(f"halo_{c}")]
    chunks = df.groupBy(*keys).agg(*aggs)
    before = Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    carries = [(F.coalesce(F.sum(F.col(f"end_{c}") - F.col(f"halo_{c}")).over(before), F.lit(0.0)) - F.col(f"halo_{c}")).alias(f"carry_{c}") for c in sources]
    df = df.join(chunks.select(*keys, *carries), list(keys))
    out = dict(where)
    for n, e in where.items():
        c = carried_by(n)
        if c:
            out[n] = f"({e} * exp(`carry_{c}`))" if c in MULTIPLIED else f"({e} + `carry_{c}`)"
    return df, out
