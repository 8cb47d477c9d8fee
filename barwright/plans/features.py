"""Feature build for many (symbol, day) chunks in one plan.

Physical shape in daily mode: scan -> warm-up tail rank (group limit before the
shuffle) -> union -> one hash exchange on (symbol, interval, chunk_date) ->
WindowExec stages for the native indicators and order flow -> grouped Arrow
kernel for recursive indicators (same partitioning, no further exchange) -> day
slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.operators.chunks import chunk_keys, slice_to_day, stitch_halo, stitch_warmup
from barwright.operators.orderflow import DEFAULT_WINDOWS, add_orderflow
from barwright.operators.windows import Frames


# A continuous chunk is at least so many halos long, so about a fifth of the rows is copied at most.
HALOS_PER_CHUNK = 5


def build_features(
    bars: DataFrame,
    specs: Sequence[dict] | None = None,
    orderflow_windows: Sequence[int] | None = DEFAULT_WINDOWS,
    warmup: int | str = "auto",
    mode: str = "daily",
    warnings: list[str] | None = None,
    only_days: DataFrame | None = None,
    error_column: str | None = None,
) -> DataFrame:
    """Bars (with symbol, interval, date) -> bars + indicator columns + order-flow columns.

    `error_column` adds a text column that names the specs which failed on a row's chunk (NULL: none);
    their own columns are NULL there, the others are not touched (S14).

    `only_days` (symbol, interval, date) limits the output to those days: in daily
    mode other chunks are dropped before the chunk exchange (days they feed as
    warm-up are still read).

    mode="daily" restarts every cumulative or recursive state at the chunk start
    (a day plus the previous day's last `warmup` bars), as the per-day tool does.
    mode="continuous" gives finite-window and elementwise kinds their values
    over the unbroken series: chunks are runs of whole days several look-backs
    long, with a halo of as many preceding rows as the longest window needs, so
    few rows are copied. Smoothings forget their start within their look-back, so they equal
    the whole series' to the last digits; cumulative kinds get the sum of all chunks before as a
    carry. State machines keep the daily restart rule and are NULL in this mode (a warning says so).
    """
    from barwright.functions.registry import apply_indicators, halo_rows, plan_specs, warmup_rows

    keys = chunk_keys(mode)
    frames = Frames(keys)
    plan = plan_specs(specs or [])
    if mode == "daily":
        if warmup == "auto":  # longest window parameter + 5, as the per-day tool computes it
            w = warmup_rows(specs or [], orderflow_windows or ())
        elif warmup == "exact":  # also covers nested windows and parameter-free kinds
            w = halo_rows(specs or [], orderflow_windows or ())
        else:
            w = int(warmup)
        df = stitch_warmup(bars, w)
    else:
        h = halo_rows(specs or [], orderflow_windows or ()) if warmup in ("auto", "exact") else int(warmup)
        df = stitch_halo(bars, h, chunk_rows=HALOS_PER_CHUNK * h)
    if only_days is not None and mode == "daily":
        df = df.join(only_days.select("symbol", "interval", F.col("date").alias("chunk_date")),
                     ["symbol", "interval", "chunk_date"], "left_semi")
    # The one exchange of the chunk stage; every window stage and the kernel
    # reuse it. Its width is spark.sql.shuffle.partitions, which adaptive
    # execution narrows by the data's size, down to the cluster's parallelism.
    df = df.repartition(*keys)

    def flow(d: DataFrame) -> DataFrame:
        return add_orderflow(d, frames, orderflow_windows) if orderflow_windows else d

    df = apply_indicators(df, plan, frames, before_kernel=flow, mode=mode)
    if warnings is not None:
        warnings.extend(plan.warnings)
    df = slice_to_day(df)
    if only_days is not None and mode != "daily":
        df = df.join(only_days.select("symbol", "interval", "date"), ["symbol", "interval", "date"], "left_semi")
    if error_column:
        found = F.col("__kernel_errors") if "__kernel_errors" in df.columns else F.lit(None).cast("string")
        df = df.withColumn(error_column, found)
    return df.drop("chunk_date", "is_warmup", "__kernel_errors")
