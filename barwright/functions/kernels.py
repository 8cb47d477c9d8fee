"""Arrow kernels for the state machines (class N): qqe, stc, fisher, psar, supertrend.

A kernel reads one chunk (<= one day plus warm-up) as numpy arrays sorted by
open_time and returns named float arrays. Spark runs all kernel specs of a
chunk in a single grouped Arrow call (`applyInArrow`) on the same
partitioning as the window stages. Smoothings that feed a machine use pandas' compiled
code; the machines step row by row, over Python floats. All other recurrences are
window expressions (`native`), with the same seeds:

- EMA(n): alpha = 2/(n+1), seeded with the mean of the first n consecutive
  valid values, NULL before that.
- RMA(n): alpha = 1/n, seeded with the first valid value, NULL until n valid
  values have been seen.
- A NULL input inside a running series holds the state and emits NULL.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd

NAN = np.nan


def _series(x):
    return pd.Series(np.asarray(x, dtype="float64"))


def shift(x, k=1):
    y = np.empty_like(x)
    y[:k] = NAN
    y[k:] = x[:-k] if k else x
    return y


def sma(x, n):
    return _series(x).rolling(n, min_periods=n).mean().to_numpy()


def rmax(x, n):
    return _series(x).rolling(n, min_periods=n).max().to_numpy()


def rmin(x, n):
    return _series(x).rolling(n, min_periods=n).min().to_numpy()


def recur(x, alpha, start, seed):
    """y[start] = seed; y[t] = (1 - alpha)·y[t-1] + alpha·x[t] after it.

    pandas' compiled smoothing; a NULL or infinite x holds the state and emits NULL.
    """
    y = np.full(len(x), NAN)
    if start is None or start >= len(x):
        return y
    tail = np.concatenate(([seed], np.asarray(x[start + 1:], dtype="float64")))
    smooth = pd.Series(tail).ewm(alpha=alpha, adjust=False, ignore_na=True).mean().to_numpy()
    y[start:] = np.where(np.isfinite(tail), smooth, NAN)
    return y


def ema(x, n):
    m = sma(x, n)
    idx = np.flatnonzero(~np.isnan(m))
    if not len(idx):
        return np.full(len(x), NAN)
    return recur(x, 2.0 / (n + 1), idx[0], m[idx[0]])


def rma(x, n):
    valid = ~np.isnan(x)
    idx = np.flatnonzero(valid)
    if not len(idx):
        return np.full(len(x), NAN)
    y = recur(x, 1.0 / n, idx[0], x[idx[0]])
    y[np.cumsum(valid) < n] = NAN
    return y


def _memo(a, key, fn):
    """Per-chunk cache for series shared by several specs (true range, RSI)."""
    cache = a.setdefault("__cache", {})
    if key not in cache:
        cache[key] = fn()
    return cache[key]


def true_range(a):
    return _memo(a, "tr", lambda: _true_range(a))


def _true_range(a):
    c1 = shift(a["close"])
    tr = np.fmax(a["high"] - a["low"], np.fmax(np.abs(a["high"] - c1), np.abs(a["low"] - c1)))
    tr[np.isnan(c1)] = NAN
    return tr


def ffill_within(x, hold):
    """Replace positions flagged `hold` by the previous value (used for a zero range)."""
    s = pd.Series(np.where(hold, NAN, x))
    filled = s.ffill().to_numpy()
    return np.where(hold, filled, x)


def _p(*vals):
    return "_".join(str(v) for v in vals)


# ---------------------------------------------------------------- momentum

def rsi_of_close(a, n):
    return _memo(a, ("rsi", n), lambda: _rsi(a["close"], n))


def _rsi(c, n):
    d = c - shift(c)
    g, lo = rma(np.fmax(d, 0.0) + 0 * d, n), rma(np.fmax(-d, 0.0) + 0 * d, n)
    with np.errstate(divide="ignore", invalid="ignore"):  # no move at all: 0/0 -> NULL
        return 100.0 * g / (g + lo)


def k_qqe(a, length=14, smooth=5, factor=4.236):
    rsi_ma = ema(rsi_of_close(a, length), smooth)
    wl = 2 * length - 1
    dar = factor * ema(ema(np.abs(rsi_ma - shift(rsi_ma)), wl), wl)
    lower, upper = rsi_ma - dar, rsi_ma + dar
    n = len(rsi_ma)
    # The state machine steps over Python floats (much cheaper than numpy scalars).
    rl, lo_l, up_l = rsi_ma.tolist(), lower.tolist(), upper.tolist()
    line, longs, shorts = [NAN] * n, [NAN] * n, [NAN] * n
    long_l = short_l = NAN
    trend = 1
    for i in range(n):
        r, lb, ub = rl[i], lo_l[i], up_l[i]
        if r != r or lb != lb:  # NaN
            continue
        r0 = rl[i - 1] if i > 0 else NAN
        prev_long, prev_short = long_l, short_l
        # Trailing lines ratchet while the smoothed RSI stays on their side.
        long_l = max(prev_long, lb) if (r0 > prev_long and r > prev_long) else lb
        short_l = min(prev_short, ub) if (r0 < prev_short and r < prev_short) else ub
        if prev_short == prev_short and r > prev_short and r0 <= prev_short:
            trend = 1
        elif prev_long == prev_long and r < prev_long and r0 >= prev_long:
            trend = -1
        if trend == 1:
            line[i] = longs[i] = long_l
        else:
            line[i] = shorts[i] = short_l
    return {f"QQE_{length}": np.array(line), f"QQEma_{length}": rsi_ma,
            f"QQEl_{length}": np.array(longs), f"QQEs_{length}": np.array(shorts)}


# A range below this fraction of the series level is zero up to rounding;
# dividing by it would turn floating-point noise into a 0..100 reading.
FLAT_RANGE = 1e-9


def _stoch_hold(x, n):
    lo, hi = rmin(x, n), rmax(x, n)
    rng = hi - lo
    flat = rng <= FLAT_RANGE * np.fmax(np.abs(hi), np.abs(lo))
    raw = 100.0 * (x - lo) / np.where(flat, NAN, rng)
    return ffill_within(raw, flat & ~np.isnan(rng))


def _smooth_from_first(x, factor):
    idx = np.flatnonzero(~np.isnan(x))
    if not len(idx):
        return np.full(len(x), NAN)
    return recur(x, factor, idx[0], x[idx[0]])


def k_stc(a, tclength=10, fast=23, slow=50, factor=0.5):
    c = a["close"]
    m = ema(c, fast) - ema(c, slow)
    pf = _smooth_from_first(_stoch_hold(m, tclength), factor)
    stc = _smooth_from_first(_stoch_hold(pf, tclength), factor)
    return {"STC": stc}


def k_fisher(a, length=9, signal=1):
    hl2 = (a["high"] + a["low"]) / 2.0
    lo, hi = rmin(hl2, length), rmax(hl2, length)
    rng = hi - lo
    pos = np.where(rng > 0, (hl2 - lo) / np.where(rng > 0, rng, 1.0) - 0.5, 0.0)
    pos[np.isnan(rng)] = NAN
    n = len(hl2)
    pl = pos.tolist()
    out = [NAN] * n
    w_prev = f_prev = 0.0
    log = math.log
    for i in range(n):
        p = pl[i]
        if p != p:  # NaN
            continue
        w = min(max(0.66 * p + 0.67 * w_prev, -0.999), 0.999)
        f_prev = 0.5 * log((1.0 + w) / (1.0 - w)) + 0.5 * f_prev
        w_prev = w
        out[i] = f_prev
    fish = np.array(out)
    return {f"FISHERT_{length}": fish, f"FISHERTs_{length}": shift(fish, signal)}


# ------------------------------------------------------------------- trend

def k_psar(a, af=0.02, max_af=0.2, af0=None):
    """Wilder's parabolic SAR; the first move (close up or down) sets the start side."""
    n = len(a["close"])
    h, l, c = a["high"].tolist(), a["low"].tolist(), a["close"].tolist()
    step = af
    start = af if af0 is None else af0
    longs, shorts, afs, rev = [NAN] * n, [NAN] * n, [NAN] * n, [NAN] * n
    p = _p(af, max_af)

    def out():
        return {f"PSARl_{p}": np.array(longs), f"PSARs_{p}": np.array(shorts),
                f"PSARaf_{p}": np.array(afs), f"PSARr_{p}": np.array(rev)}
    if n < 2:
        return out()
    falling = c[1] < c[0]
    sar = h[0] if falling else l[0]
    ep = l[0] if falling else h[0]
    acc = start
    afs[0], rev[0] = acc, 0.0
    for i in range(1, n):
        if h[i] != h[i] or l[i] != l[i]:  # NaN
            continue
        sar = sar + acc * (ep - sar)
        lo2 = min(l[i - 1], l[i - 2]) if i >= 2 else l[i - 1]
        hi2 = max(h[i - 1], h[i - 2]) if i >= 2 else h[i - 1]
        if falling:
            sar = max(sar, hi2)
            reverse = h[i] > sar
            if l[i] < ep:
                ep, acc = l[i], min(acc + step, max_af)
        else:
            sar = min(sar, lo2)
            reverse = l[i] < sar
            if h[i] > ep:
                ep, acc = h[i], min(acc + step, max_af)
        if reverse:
            sar, acc, falling = ep, start, not falling
            ep = l[i] if falling else h[i]
        if falling:
            shorts[i] = sar
        else:
            longs[i] = sar
        afs[i], rev[i] = acc, float(reverse)
    return out()


# ----------------------------------------------------------------- overlap


def k_supertrend(a, length=7, multiplier=3.0):
    h, l, c = a["high"], a["low"], a["close"]
    hl2 = (h + l) / 2.0
    atr = rma(true_range(a), length)
    ub, lb = hl2 + multiplier * atr, hl2 - multiplier * atr
    n = len(c)
    line, dirs, longs, shorts = [NAN] * n, [NAN] * n, [NAN] * n, [NAN] * n
    cl, ul, ll, al = c.tolist(), ub.tolist(), lb.tolist(), atr.tolist()
    d = 1
    fu = fl = NAN
    for i in range(n):
        if al[i] != al[i]:  # NaN
            continue
        u, lo = ul[i], ll[i]
        if fu == fu:
            ci = cl[i]
            if ci > fu:
                d = 1
            elif ci < fl:
                d = -1
            else:
                # Bands only tighten while the trend holds.
                if d > 0 and lo < fl:
                    lo = fl
                if d < 0 and u > fu:
                    u = fu
        fu, fl = u, lo
        dirs[i] = d
        if d > 0:
            line[i] = longs[i] = lo
        else:
            line[i] = shorts[i] = u
    p = _p(length, multiplier)
    return {f"SUPERT_{p}": np.array(line), f"SUPERTd_{p}": np.array(dirs, dtype="float64"),
            f"SUPERTl_{p}": np.array(longs), f"SUPERTs_{p}": np.array(shorts)}


KERNELS = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("k_") and callable(fn)}
