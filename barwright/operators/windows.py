"""Window partitioning shared by the feature stages.

Every window names its partition and order (Spark has no row order). A
rolling result is NULL until the frame holds `n` non-NULL values, like a
rolling call whose minimum count equals the window size.

Cost model: a sliding ROWS frame re-aggregates its whole buffer for every row
(O(n) per row). Sums, means and power sums over frames longer than
PREFIX_THRESHOLD rows are therefore taken as the difference of two running
frames, `UNBOUNDED PRECEDING..CURRENT` minus `UNBOUNDED PRECEDING..n
PRECEDING`, which Spark evaluates incrementally (O(1) per row) in the same
WindowExec. min/max over more than SLIDING rows are put together from lagged spans
of half the length (O(log n) per row). The
expressions themselves are written by `barwright.functions.native.Sql`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, Window
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction

# Frames longer than this use the running-difference form for sums.
PREFIX_THRESHOLD = 8
# Frames longer than this use lagged spans for min and max.
SLIDING = 16

CHUNK_KEYS = ("symbol", "interval", "chunk_date")


# Marks a call of `smoothed_mean` among SQL window calls: EWM, alpha, "|", the values.
EWM = "ewm:"


def smoothed_mean(values: str, alpha: float, keys: Sequence[str], order: str) -> Column:
    """Exponentially weighted mean of all values so far, weights (1 - alpha)^age, NULLs without an age.

    This is the window function behind pandas-on-Spark's `ewm(alpha, ignore_na=True).mean()`; it keeps two
    running sums, so a row costs O(1) on the ordering that the other windows use. SQL text cannot name it.
    """
    return InternalFunction.ewm(F.expr(values), alpha, True).over(Window.partitionBy(*keys).orderBy(order))


@dataclass(frozen=True)
class Frames:
    """One partitioning of the feature stages: partition keys, order column, threshold."""

    keys: Sequence[str] = CHUNK_KEYS
    order: str = "open_time"
    threshold: int = PREFIX_THRESHOLD
