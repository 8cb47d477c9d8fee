"""Mean absolute deviation over sliding frames (mad, cci): an order-statistics tree for each chunk.

The deviation of a frame from its own mean m needs, for every row, how many of the frame's values lie
below m and what they add up to; no running sum gives that, and SQL can only read the whole frame
again. Here each level k of a tree holds the chunk in aligned blocks of 2^k rows, every block sorted and
with its running sums. A frame is cut into at most two blocks of each level, and a block answers by a
bisection: O(log^2 n) steps for a row, all rows at once in numpy, O(rows) memory for a level (only one is
held at a time).

Values are measured from the chunk's first one, and means come from halves (exact where all values are
equal), so that levels of 50,000 with a spread of 0.01 keep their digits; a frame of equal values has
deviation 0 exactly. A frame with a missing or infinite value gives NULL, and so does one that is not full.
These kinds look back a fixed number of rows, so they have values in both modes.
"""

from __future__ import annotations

import numpy as np

NAN = np.nan


def frame_means(x: np.ndarray, n: int) -> np.ndarray:
    """Mean of the last n values of each row from n - 1 on (earlier rows are not meaningful).

    Means of 2k rows are put together from those of the last k and of the k before.
    """
    def before(v: np.ndarray, k: int) -> np.ndarray:
        return np.concatenate((np.repeat(v[:1], min(k, len(v))), v[: len(v) - k]))

    spans, size = {1: x}, 1
    while 2 * size <= n:
        older = before(spans[size], size)
        spans[2 * size] = spans[size] + (older - spans[size]) / 2
        size *= 2
    mean, have = spans[size], size
    while have < n:
        size = 1 << ((n - have).bit_length() - 1)
        mean = mean + (before(spans[size], have) - mean) * (size / (have + size))
        have += size
    return mean


def _block_parts(blocks: np.ndarray, sums: np.ndarray, at: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Sum of |v - m| over the sorted block `at[i]`, for each i."""
    size = blocks.shape[1]
    flat, base = blocks.ravel(), at * size
    below = np.zeros(len(at), dtype=np.int64)  # values of the block that are at most m
    step = size
    while step:
        reach = below + step
        ok = reach <= size
        ok[ok] = flat[base[ok] + reach[ok] - 1] <= m[ok]
        below[ok] = reach[ok]
        step //= 2
    low = sums[at, below]
    return (2 * below - size) * m + sums[at, size] - 2 * low


def mean_deviation(x: np.ndarray, n: int) -> np.ndarray:
    """Mean absolute deviation of the last n values from their own mean; NaN where the frame is not whole."""
    rows = len(x)
    out = np.full(rows, NAN)
    if n > rows:
        return out
    good = np.isfinite(x)
    first = x[good][0] if good.any() else 0.0
    y = np.where(good, x - first, 0.0)
    mean = frame_means(y, n)
    ends = np.arange(n - 1, rows)
    m, total = mean[n - 1 :], np.zeros(rows - n + 1)
    # frames [left, right) in blocks of the level; odd ends are taken off before the level doubles
    left, right, level = ends - n + 1, ends + 1, 0
    while (left < right).any():
        size = 1 << level
        padded = np.full(-(-rows // size) * size, np.inf)
        padded[:rows] = y
        blocks = np.sort(padded.reshape(-1, size), axis=1)
        sums = np.zeros((len(blocks), size + 1))
        np.cumsum(np.where(np.isinf(blocks), 0.0, blocks), axis=1, out=sums[:, 1:])
        for bound, blocks_at in ((left, left), (right, right - 1)):
            odd = np.flatnonzero((left < right) & (bound & 1 == 1))
            total[odd] += _block_parts(blocks, sums, blocks_at[odd], m[odd])
            if bound is left:
                left = left + (left & 1) * (left < right)
        right = right - (right & 1) * (left < right)
        left, right, level = left >> 1, right >> 1, level + 1
    same = np.concatenate(([False], y[1:] == y[:-1]))
    last_change = np.maximum.accumulate(np.where(same, 0, np.arange(rows)))
    total[ends - last_change[ends] >= n - 1] = 0.0
    holes = np.concatenate(([0], np.cumsum(~good)))
    whole = holes[ends + 1] - holes[ends + 1 - n] == 0
    out[n - 1 :] = np.where(whole, np.maximum(total, 0.0) / n, NAN)
    return out


def mad(a, length=30):
    return {f"MAD_{length}": mean_deviation(a["close"], length)}


def cci(a, length=14, c=0.015):
    tp = (a["high"] + a["low"] + a["close"]) / 3.0
    spread = c * mean_deviation(tp, length)
    first = tp[np.isfinite(tp)][0] if np.isfinite(tp).any() else 0.0
    y = np.where(np.isfinite(tp), tp - first, 0.0)
    off = y - frame_means(y, length) if len(y) else y
    return {f"CCI_{length}": np.where(spread > 0, off / np.where(spread > 0, spread, 1.0), NAN)}


FINITE = {"mad": mad, "cci": cci}
