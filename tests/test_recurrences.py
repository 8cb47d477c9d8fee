"""Recurrences, moments and carries on long series, against written-out versions."""

import numpy as np
import pandas as pd
import pytest

from barwright.functions import kernels

N = 86_400
DAY = 1_704_067_200_000


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(7)
    close = 50_000 + np.cumsum(rng.normal(size=N)) * 0.01
    close[20_000:21_500] = close[20_000]  # a quiet stretch
    holes = rng.random(N) < 0.001
    return pd.DataFrame({"open_time": DAY + 1000 * np.arange(N), "close": close, "high": close + rng.random(N), "low": close - rng.random(N),
                         "open": close, "volume": rng.integers(1, 9, N).astype(float)}), holes


def chunk(spark, pdf, days=1):
    pdf = pdf.assign(symbol="X", interval="1s")
    df = spark.createDataFrame(pdf).selectExpr("*", "CAST(timestamp_millis(open_time) AS DATE) AS date")
    return df.selectExpr("*", "CAST(0 AS DOUBLE) quote_volume", "1L num_trades", "CAST(0 AS DOUBLE) taker_buy_base", "CAST(0 AS DOUBLE) taker_buy_quote")


def features(spark, pdf, specs, mode="daily"):
    from barwright.plans.features import build_features

    return build_features(chunk(spark, pdf), specs=specs, orderflow_windows=None, mode=mode).toPandas().sort_values("open_time").reset_index(drop=True)


def close_to(got, want):
    got, want = got.to_numpy(dtype=float), np.asarray(want)
    assert (np.isnan(got) == ~np.isfinite(want)).all()
    at = np.isfinite(want)
    assert np.max(np.abs(got[at] - want[at]) / np.maximum(np.abs(want[at]), 1e-12)) < 1e-9


def test_smoothing_equals_the_recursion_with_holes(spark, series):
    pdf, holes = series
    pdf = pdf.assign(close=np.where(holes, np.nan, pdf.close))
    specs = [{"kind": "ema", "length": n} for n in (3, 50, 900)] + [{"kind": "rma", "length": n} for n in (2, 14, 900)] + [{"kind": "dema", "length": 30}]
    out = features(spark, pdf, specs)
    c = pdf.close.to_numpy()
    for n in (3, 50, 900):
        close_to(out[f"EMA_{n}"], kernels.ema(c, n))
    for n in (2, 14, 900):
        close_to(out[f"RMA_{n}"], kernels.rma(c, n))
    e = kernels.ema(c, 30)
    close_to(out["DEMA_30"], 2 * e - kernels.ema(e, 30))


def test_rsi_and_atr_of_a_whole_day(spark, series):
    pdf, _ = series
    out = features(spark, pdf, [{"kind": "rsi", "length": 14}, {"kind": "atr", "length": 100}])
    a = {k: pdf[k].to_numpy() for k in ("open", "high", "low", "close", "volume")}
    close_to(out["RSI_14"], kernels.rsi_of_close(a, 14))
    close_to(out["ATR_100"], kernels.rma(kernels.true_range(a), 100))


@pytest.mark.parametrize("n", [2, 7, 300, 900])
def test_moments_of_a_high_level(spark, series, n):
    pdf, _ = series
    pdf = pdf.iloc[18_000:24_000]
    out = features(spark, pdf, [{"kind": k, "length": n} for k in ("variance", "skew", "kurtosis")])
    win = np.lib.stride_tricks.sliding_window_view(pdf.close.to_numpy(), n)
    win = win - win[:, :1]  # exact, so the level costs the comparison no digits
    d = win - win.mean(axis=1, keepdims=True)
    m2, m3, m4 = (np.mean(d**k, axis=1) for k in (2, 3, 4))
    var = out[f"VAR_{n}"].to_numpy()[n - 1 :]
    flat = win.max(axis=1) == win.min(axis=1)
    assert (var[flat] == 0).all() and np.allclose(var[~flat], (m2 * n / max(n - 1, 1))[~flat], rtol=1e-9)
    wide = m2 > 1e-6
    if n > 3:
        g1 = m3[wide] / m2[wide] ** 1.5 * np.sqrt(n * (n - 1)) / (n - 2)
        g2 = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (m4[wide] / m2[wide] ** 2 - 3) + 6)
        assert np.allclose(out[f"SKEW_{n}"].to_numpy()[n - 1 :][wide], g1, rtol=1e-6, atol=1e-6)
        assert np.allclose(out[f"KURT_{n}"].to_numpy()[n - 1 :][wide], g2, rtol=1e-6, atol=1e-6)


def test_unbroken_series_over_many_days(spark):
    """Continuous mode equals one pass over the whole series: sums carried, smoothings settled."""
    rng = np.random.default_rng(9)
    n = 3_000
    close = 100 + np.cumsum(rng.normal(size=n)) * 0.1
    pdf = pd.DataFrame({"open_time": DAY + 1_800_000 * np.arange(n), "close": close, "high": close + 0.2, "low": close - 0.3, "open": close,
                        "volume": rng.integers(1, 9, n).astype(float)})
    out = features(spark, pdf, [{"kind": k} for k in ("ad", "obv", "pvt", "pvi", "nvi")] + [{"kind": "ema", "length": 12}, {"kind": "aobv"}], "continuous")
    c, v, h, lo = (pdf[k].to_numpy() for k in ("close", "volume", "high", "low"))
    obv = np.cumsum(np.concatenate([[v[0]], np.sign(np.diff(c)) * v[1:]]))
    close_to(out["AD"], np.cumsum(((c - lo) - (h - c)) / (h - lo) * v))
    close_to(out["OBV"], obv)
    close_to(out["PVT"], np.concatenate([[np.nan], np.cumsum(v[1:] * np.diff(c) / c[:-1])]))
    for name, hit in (("PVI", v[1:] > v[:-1]), ("NVI", v[1:] < v[:-1])):
        close_to(out[name], 1000 * np.concatenate([[1], np.cumprod(np.where(hit, c[1:] / c[:-1], 1.0))]))
    close_to(out["EMA_12"], kernels.ema(c, 12))
    close_to(out["OBVe_12"], kernels.ema(obv, 12))


def test_zero_volume_zero_range_and_an_infinite_value(spark):
    flat = np.full(30, 5.0)
    pdf = pd.DataFrame({"open_time": DAY + 1000 * np.arange(30), "close": flat, "high": flat, "low": flat, "open": flat, "volume": 0 * flat})
    out = features(spark, pdf, [{"kind": "adosc", "fast": 3, "slow": 10}, {"kind": "ha"}])
    assert np.allclose(out["ADOSC_3_10"].fillna(0), 0) and np.allclose(out["HA_close"], 5) and np.allclose(out["HA_open"], 5)
    x = np.arange(100, dtype=float)
    x[40] = np.inf
    pdf = pd.DataFrame({"open_time": DAY + 1000 * np.arange(100), "close": x, "high": x, "low": x, "open": x, "volume": 1.0 + 0 * x})
    got = features(spark, pdf, [{"kind": "rma", "length": 2}])["RMA_2"].to_numpy(dtype=float)
    assert np.isnan(got[40]) and np.isfinite(got[41:]).all()


def test_failed_spec_is_told_and_harms_no_other(spark):
    from barwright.functions import registry
    from barwright.plans.features import build_features

    def long_only(a):
        if len(a["close"]) > 20:
            raise ValueError("too long")
        return {"SHORT": a["close"]}

    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"open_time": DAY + 1000 * np.arange(50), **{k: rng.random(50) + 1 for k in ("close", "high", "low", "open", "volume")}})
    registry.register_indicator("short_chunks", long_only, kernel=True)
    try:
        specs = [{"kind": "sma", "length": 3}, {"kind": "psar"}, {"kind": "short_chunks"}]
        rows = build_features(chunk(spark, pdf), specs=specs, orderflow_windows=None, error_column="told").collect()
    finally:
        registry._KERNEL.pop("short_chunks")
    assert {r.told for r in rows} == {"short_chunks: too long"} and {r.SHORT for r in rows} == {None}
    assert sum(r["SMA_3"] is not None for r in rows) == 48 and any(r["PSARl_0.02_0.2"] is not None for r in rows)


def test_long_extremes_with_holes_and_ties(spark, series):
    pdf, holes = series
    pdf = pdf.assign(high=np.where(holes, np.nan, pdf.high.round(1)), low=pdf.low.round(1))
    specs = [{"kind": "donchian", "lower_length": 17, "upper_length": 300}, {"kind": "aroon", "length": 50}, {"kind": "willr", "length": 31}]
    out = features(spark, pdf, specs)
    close_to(out["DCU_17_300"], pdf.high.rolling(300, min_periods=300).max())
    close_to(out["DCL_17_300"], pdf.low.rolling(17, min_periods=17).min())
    hh, ll = pdf.high.rolling(31, min_periods=31).max(), pdf.low.rolling(31, min_periods=31).min()
    close_to(out["WILLR_31"], -100 * (hh - pdf.close) / (hh - ll))
    frames = np.lib.stride_tricks.sliding_window_view(pdf.low.to_numpy(), 51)[:, ::-1]  # newest first: the latest of equal ones
    down = np.full(N, np.nan)
    down[50:] = 100 * (1 - frames.argmin(axis=1) / 50)
    down[np.isnan(pdf.high.rolling(51, min_periods=51).max())] = np.nan  # both columns wait for whole frames
    close_to(out["AROOND_50"], down)


def brute_deviation(x, n):
    out = np.full(len(x), np.nan)
    frames = np.lib.stride_tricks.sliding_window_view(x - x[0], n)
    for at in range(0, len(frames), 4096):
        part = frames[at : at + 4096]
        out[at + n - 1 : at + n - 1 + len(part)] = np.abs(part - part.mean(axis=1, keepdims=True)).mean(axis=1)
    return out


def test_mean_deviation_equals_brute_force(series):
    from barwright.functions.deviation import mean_deviation

    pdf, holes = series
    c = pdf.close.to_numpy()
    for n in (1, 2, 7, 64, 100, 900):
        got, want = mean_deviation(c, n), brute_deviation(c, n)
        assert (np.isnan(got) == np.isnan(want)).all()
        assert np.nanmax(np.abs(got - want)) < 1e-11
    assert (mean_deviation(c, 60)[20_060:21_500] == 0).all()  # equal values: exactly 0
    got = mean_deviation(np.where(holes, np.nan, c), 60)
    whole = pd.Series(np.where(holes, np.nan, c)).rolling(60, min_periods=60).count() == 60
    assert (np.isfinite(got) == whole.to_numpy()).all()
    assert len(mean_deviation(np.array([]), 3)) == 0 and np.isnan(mean_deviation(np.array([1.0, 2.0]), 3)).all()


def test_mean_deviation_is_whole_in_continuous_mode(spark):
    rng = np.random.default_rng(5)
    n = 4000
    c = 100 + np.cumsum(rng.normal(size=n))
    pdf = pd.DataFrame({"open_time": DAY + 60_000 * np.arange(n), "close": c, "high": c + 1, "low": c - 1, "open": c, "volume": 1.0})
    out = features(spark, pdf, [{"kind": "mad", "length": 900}, {"kind": "cci", "length": 100}, {"kind": "psar"}], mode="continuous")
    want = brute_deviation(c, 900)
    assert np.nanmax(np.abs(out["MAD_900"].to_numpy() - want)) < 1e-9 and out["MAD_900"].isna().sum() == 899
    m = pd.Series(c).rolling(100).mean().to_numpy()
    assert np.nanmax(np.abs(out["CCI_100"].to_numpy() - (c - m) / (0.015 * brute_deviation(c, 100)))) < 1e-6
    assert out[[x for x in out if x.startswith("PSAR")]].isna().all().all()
