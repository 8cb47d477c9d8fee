"""The default indicator spec set (U4): 207 specs of 81 kinds.

Fixed values: the kinds and parameter grids of the default set, listed in the
order the original tool applies them.
"""

from __future__ import annotations


def default_specs() -> tuple[str, list[dict]]:
    s: list[dict] = []
    # momentum
    s += [{"kind": "rsi", "length": n} for n in (7, 14, 21)]
    s += [{"kind": "stoch", "k": k, "d": 3, "smooth_k": 3} for k in (9, 14, 21)]
    s += [{"kind": "stochrsi", "length": n} for n in (14, 21, 42)]
    for f, sl, g in ((12, 26, 9), (24, 52, 18), (36, 78, 27)):
        s += [{"kind": "macd", "fast": f, "slow": sl, "signal": g},
              {"kind": "ppo", "fast": f, "slow": sl, "signal": g}]
    s += [{"kind": "apo", "fast": f, "slow": sl} for f, sl in ((12, 26), (24, 52), (36, 78))]
    s += [{"kind": "roc", "length": n} for n in (6, 12, 24)]
    s += [{"kind": "mom", "length": n} for n in (5, 10, 20)]
    s += [{"kind": "cmo", "length": n} for n in (14, 42, 100)]
    s += [{"kind": "cci", "length": n} for n in (20, 50, 100)]
    s += [{"kind": "er", "length": n} for n in (10, 20, 40)]
    s += [{"kind": "kst"}]
    s += [{"kind": "pgo", "length": n} for n in (14, 21, 42)]
    s += [{"kind": "qqe", "length": n} for n in (14, 21, 42)]
    s += [{"kind": "rvgi", "length": n} for n in (14, 21, 42)]
    s += [{"kind": "smi", "length": n} for n in (14, 20, 40)]
    s += [{"kind": "stc"}]
    s += [{"kind": "trix", "length": n} for n in (9, 18, 36)]
    s += [{"kind": "tsi", "long": a, "short": b} for a, b in ((25, 13), (50, 25), (100, 50))]
    s += [{"kind": "uo", "fast": f, "middle": m, "slow": sl} for f, m, sl in ((7, 14, 28), (14, 28, 56), (21, 42, 84))]
    s += [{"kind": "willr", "length": n} for n in (14, 42, 100)]
    s += [{"kind": "bop"}]
    s += [{"kind": "cfo", "length": n} for n in (9, 20, 40)]
    s += [{"kind": "cg", "length": n} for n in (10, 20, 40)]
    s += [{"kind": "cti", "length": n} for n in (12, 24, 48)]
    s += [{"kind": "fisher", "length": n} for n in (5, 9, 13)]
    s += [{"kind": "inertia", "length": n} for n in (14, 20, 40)]
    # trend
    s += [{"kind": "adx", "length": n} for n in (14, 28, 56)]
    s += [{"kind": "aroon", "length": n} for n in (14, 25, 50)]
    s += [{"kind": "chop", "length": n} for n in (14, 30, 56)]
    s += [{"kind": "dpo", "length": n, "lookahead": False} for n in (20, 60, 120)]
    s += [{"kind": "qstick", "length": n} for n in (14, 28, 56)]
    s += [{"kind": "vhf", "length": n} for n in (14, 28, 56)]
    s += [{"kind": "vortex", "length": n} for n in (14, 21, 28)]
    s += [{"kind": "psar", "af": 0.02, "max_af": 0.2}]
    # overlap
    s += [{"kind": "ema", "length": n} for n in (12, 26, 50)]
    s += [{"kind": "sma", "length": n} for n in (20, 50, 100)]
    s += [{"kind": "wma", "length": n} for n in (21, 50, 100)]
    s += [{"kind": "rma", "length": n} for n in (14, 50, 100)]
    s += [{"kind": "hma", "length": n} for n in (21, 55, 89)]
    s += [{"kind": "t3", "length": n} for n in (5, 10, 20)]
    s += [{"kind": "tema", "length": n} for n in (9, 30, 50)]
    s += [{"kind": "dema", "length": n} for n in (9, 30, 50)]
    s += [{"kind": "vwma", "length": n} for n in (20, 50, 100)]
    s += [{"kind": "vwap"}]
    s += [{"kind": "bbands", "length": n, "std": 2.0} for n in (20, 50, 100)]
    s += [{"kind": "kc", "length": n} for n in (20, 40, 60)]
    s += [{"kind": "donchian", "lower_length": n, "upper_length": n} for n in (20, 55, 100)]
    s += [{"kind": "supertrend", "length": n, "multiplier": m} for n, m in ((10, 3), (20, 2), (7, 4))]
    s += [{"kind": "linreg", "length": n} for n in (20, 60, 120)]
    s += [{"kind": "midpoint", "length": n} for n in (14, 42, 100)]
    s += [{"kind": "midprice", "length": n} for n in (14, 42, 100)]
    s += [{"kind": "ichimoku", "lookahead": False}]
    # volatility
    s += [{"kind": "atr", "length": n} for n in (14, 42, 100)]
    s += [{"kind": "true_range"}]
    s += [{"kind": "stdev", "length": n} for n in (20, 60, 120)]
    s += [{"kind": "natr", "length": n} for n in (14, 42, 100)]
    s += [{"kind": "accbands", "length": n} for n in (20, 50, 100)]
    s += [{"kind": "aberration", "length": n} for n in (20, 50, 100)]
    # volume
    s += [{"kind": "ad"}]
    s += [{"kind": "adosc", "fast": f, "slow": sl} for f, sl in ((3, 10), (5, 20), (8, 34))]
    s += [{"kind": "obv"}]
    s += [{"kind": "mfi", "length": n} for n in (14, 28, 56)]
    s += [{"kind": "cmf", "length": n} for n in (20, 50, 100)]
    s += [{"kind": "kvo", "fast": f, "slow": sl, "signal": g} for f, sl, g in ((34, 55, 13), (55, 89, 13), (21, 34, 8))]
    s += [{"kind": "aobv", "length": n} for n in (7, 14, 28)]
    s += [{"kind": "pvi"}, {"kind": "nvi"}, {"kind": "pvt"}]
    # returns
    s += [{"kind": "log_return", "cumulative": False}, {"kind": "percent_return", "cumulative": False}]
    # statistics
    for k in ("entropy", "kurtosis", "skew", "zscore", "mad", "variance"):
        s += [{"kind": k, "length": n} for n in (60, 300, 900)]
    # candles
    s += [{"kind": "ha"}, {"kind": "ohlc4"}, {"kind": "hl2"}, {"kind": "hlc3"}]
    return "FULL_SET_SIMPLE", s
