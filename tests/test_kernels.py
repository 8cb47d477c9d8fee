"""Hand-made cases for the recursive kernels (no Spark needed)."""

import numpy as np

from barwright.functions import kernels as K


def arrays(close, high=None, low=None, open_=None, volume=None):
    c = np.asarray(close, dtype=float)
    return {"close": c, "high": np.asarray(high if high is not None else c + 1, dtype=float),
            "low": np.asarray(low if low is not None else c - 1, dtype=float),
            "open": np.asarray(open_ if open_ is not None else c, dtype=float),
            "volume": np.asarray(volume if volume is not None else np.ones(len(c)), dtype=float)}


def test_ema_seed_and_recursion():
    x = np.arange(1.0, 11.0)
    y = K.ema(x, 3)
    assert np.isnan(y[:2]).all()
    assert y[2] == 2.0  # mean of the first three
    a = 0.5
    assert abs(y[3] - (a * 4 + (1 - a) * 2.0)) < 1e-12


def test_rma_null_until_n_and_hold_on_null():
    x = np.array([1.0, 2.0, np.nan, 4.0, 5.0, 6.0])
    y = K.rma(x, 3)
    assert np.isnan(y[:3]).all()  # only two valid values before index 3
    assert np.isnan(y[2])
    assert not np.isnan(y[3])


def test_rsi_bounds_and_constant():
    rng = np.random.default_rng(3)
    c = 100 + np.cumsum(rng.normal(size=300))
    r = K._rsi(c, 14)
    v = r[~np.isnan(r)]
    assert (v >= 0).all() and (v <= 100).all()
    flat = K._rsi(np.full(50, 7.0), 14)
    assert np.isnan(flat).all()  # 0/0: no moves at all -> NULL


def test_psar_flip():
    # rising for five bars then falling: one reversal to the short side
    c = np.array([10, 11, 12, 13, 14, 12, 10, 8, 6, 4], dtype=float)
    out = K.k_psar(arrays(c, c + 0.5, c - 0.5))
    longs, shorts, rev = out["PSARl_0.02_0.2"], out["PSARs_0.02_0.2"], out["PSARr_0.02_0.2"]
    assert not np.isnan(longs[1:5]).any() and np.isnan(shorts[1:5]).all()
    assert np.nansum(rev) == 1.0
    k = int(np.nanargmax(rev))
    assert not np.isnan(shorts[k:]).any()
    # after the flip the SAR sits above price
    assert (shorts[k:] > c[k:]).all()


def test_supertrend_flip():
    c = np.array([10, 10.5, 11, 11.5, 12, 12.5, 13, 9, 8, 7], dtype=float)
    out = K.k_supertrend(arrays(c, c + 0.2, c - 0.2), length=3, multiplier=1.0)
    d = out["SUPERTd_3_1.0"]
    v = d[~np.isnan(d)]
    assert v[0] == 1 and v[-1] == -1
    assert np.nansum(np.abs(np.diff(v))) == 2  # exactly one flip


def test_smoothing_on_a_whole_day_of_seconds():
    """The recursion written out, over 86,400 values with gaps."""
    rng = np.random.default_rng(3)
    x = 100 + np.cumsum(rng.normal(size=86_400)) / 50
    x[rng.integers(100, 86_400, 300)] = np.nan
    for alpha in (2 / 13, 1 / 14, 1.0):
        y, state = np.full(len(x), np.nan), 7.0
        y[5] = state
        for i in range(6, len(x)):
            if not np.isnan(x[i]):
                state += alpha * (x[i] - state)
                y[i] = state
        got = K.recur(x, alpha, 5, 7.0)
        assert np.array_equal(np.isnan(got), np.isnan(y)) and np.nanmax(np.abs(got - y)) < 1e-9


def test_an_infinite_value_does_not_stay():
    x = np.arange(100, dtype=float)
    x[40] = np.inf
    got = K.recur(x, 0.5, 0, 0.0)
    assert np.isnan(got[40]) and np.isfinite(got[41:]).all()
