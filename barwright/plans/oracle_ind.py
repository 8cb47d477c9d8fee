"""DuckDB oracles for indicator queries.

Written independently of the Spark builders: plain sliding frames (no
running-difference form), DuckDB's own regr_*/corr/kurtosis/arg_max, and
recursive CTEs for the recurrences. Each oracle returns
symbol, interval, date, open_time and the indicator columns, rounded.
"""

from __future__ import annotations

import math

from barwright.plans.oracle import bars_cte, dense_bars_cte, chunks_cte, r, series_cte

WIN = "PARTITION BY symbol, interval, chunk_date ORDER BY open_time"


def ov(frame: str = "") -> str:
    return f"OVER ({WIN}{' ' + frame if frame else ''})"


def rows(n: int) -> str:
    return ov(f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")


CUM = ov("ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")


def lag(x: str, k: int = 1) -> str:
    return f"lag({x}, {k}) {ov()}"


def dv(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) <> 0 THEN ({a}) / ({b}) END)"


def g(x: str, n: int, e: str) -> str:
    return f"(CASE WHEN count({x}) {rows(n)} = {n} THEN {e} END)"


def sm(x, n):
    return g(x, n, f"avg({x}) {rows(n)}")


def ssum(x, n):
    return g(x, n, f"sum({x}) {rows(n)}")


def mx(x, n):
    return g(x, n, f"max({x}) {rows(n)}")


def mn(x, n):
    return g(x, n, f"min({x}) {rows(n)}")


def sd(x, n):
    return g(x, n, f"stddev_samp({x}) {rows(n)}")


def lr(y, n):
    return g(y, n, f"(regr_intercept({y}, rn) {rows(n)} + regr_slope({y}, rn) {rows(n)} * rn)")


def wm(x, n):
    return g(x, n, f"((sum(rn * {x}) {rows(n)} - (rn - {n}) * sum({x}) {rows(n)}) / {n * (n + 1) / 2.0})")


HI, LO, CL = "high", "low", "close"
CLV = "(CASE WHEN high <> low THEN ((close - low) - (high - close)) / (high - low) ELSE 0.0 END)"


def swma(x):
    return f"(({lag(x, 3)} + 2 * {lag(x, 2)} + 2 * {lag(x, 1)} + {x}) / 6.0)"


def prelude(mode: str, warmup: int) -> str:
    pre = chunks_cte(warmup) if mode == "daily" else series_cte()
    return f"""{bars_cte()},{pre},
b AS (
  SELECT *, row_number() OVER w AS rn, lag(close) OVER w AS c1, lag(high) OVER w AS h1,
         lag(low) OVER w AS l1, lag(volume) OVER w AS v1,
         CASE WHEN lag(close) OVER w IS NOT NULL THEN greatest(high - low, abs(high - lag(close) OVER w),
              abs(low - lag(close) OVER w)) END AS tr,
         (high + low + close) / 3.0 AS tp
  FROM chunks WINDOW w AS ({WIN})
)"""


def staged(mode: str, warmup: int, stages: list[list[tuple[str, str]]], outputs: list[str]) -> str:
    ctes, prev = [], "b"
    for i, st in enumerate(stages, 1):
        ctes.append(f"s{i} AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in st)} FROM {prev})")
        prev = f"s{i}"
    keep = "date = chunk_date" if mode == "daily" else "TRUE"
    sel = ", ".join(f"{r(_n(o))} AS {_n(o)}" for o in outputs)
    return (f"WITH {prelude(mode, warmup)},\n" + ",\n".join(ctes)
            + f"\nSELECT symbol, interval, date, open_time, {sel} FROM {prev} WHERE {keep}")


def _n(name: str) -> str:
    return f'"{name}"'


# Native kinds, continuous mode; (spec, stages, outputs)
def native_cases() -> dict[str, tuple[dict, list, list[str]]]:
    up = "(CASE WHEN c1 IS NOT NULL THEN greatest(close - c1, 0.0) END)"
    dn = "(CASE WHEN c1 IS NOT NULL THEN greatest(c1 - close, 0.0) END)"
    lo = "least(low, c1)"
    a = {n: dv(ssum(f"(close - {lo})", n), ssum(f"(greatest(high, c1) - {lo})", n)) for n in (7, 14, 28)}
    kst_r = [(10, 10), (15, 10), (20, 10), (30, 15)]
    kst_total = " + ".join(f"{i} * {sm(f'kr{rr}', n)}" for i, (rr, n) in enumerate(kst_r, 1))
    kst_name = "KST_10_15_20_30_10_10_10_15"
    up_age = f"(rn - arg_max(rn, row(high, rn)) {rows(15)})"
    dn_age = f"(rn - arg_min(rn, row(low, -rn)) {rows(15)})"
    a_full = f"count(high) {rows(15)} = 15 AND count(low) {rows(15)} = 15"
    chop_ratio = dv(ssum("tr", 14), f"{mx('high', 14)} - {mn('low', 14)}")
    bb = "20_2.0_2.0"
    mid52 = f"(({mx('high', 52)} + {mn('low', 52)}) / 2.0)"
    pvx = "1000.0 * exp(sum(CASE WHEN c1 IS NULL THEN 0.0 WHEN volume {op} v1 THEN ln(close / c1) ELSE 0.0 END) " + CUM + ")"
    ratio = dv("4.0 * (high - low)", "(high + low)")
    mid520 = f"(({mx('high', 520)} + {mn('low', 520)}) / 2.0)"
    return {
        "kurtosis_continuous": ({"kind": "kurtosis", "length": 60}, [[("KURT_60", g("close", 60, f"kurtosis(close) {rows(60)}"))]], ["KURT_60"]),
        "kurtosis_300": ({"kind": "kurtosis", "length": 300}, [[("KURT_300", g("close", 300, f"kurtosis(close) {rows(300)}"))]], ["KURT_300"]),
        "skew_continuous": ({"kind": "skew", "length": 60}, [[("SKEW_60", g("close", 60, f"skewness(close) {rows(60)}"))]], ["SKEW_60"]),
        "mad_continuous": ({"kind": "mad", "length": 60}, [[("MAD_60", _mad("close", 60))]], ["MAD_60"]),
        "cci_continuous": ({"kind": "cci", "length": 20},
                           [[("CCI_20", dv(f"tp - {sm('tp', 20)}", f"0.015 * {_mad('tp', 20)}"))]], ["CCI_20"]),
        "mad_900": ({"kind": "mad", "length": 900}, [[("m_", g("close", 900, f"avg(close) {rows(900)}")), ("l_", f"list(close) {rows(900)}")],
                    [("MAD_900", "(CASE WHEN m_ IS NOT NULL THEN list_avg(list_transform(l_, lambda e: abs(e - m_))) END)")]], ["MAD_900"]),
        "cci_100": ({"kind": "cci", "length": 100},
                    [[("m_", sm("tp", 100)), ("l_", f"list(tp) {rows(100)}")],
                     [("CCI_100", dv("tp - m_", "0.015 * list_avg(list_transform(l_, lambda e: abs(e - m_)))"))]], ["CCI_100"]),
        "donchian_100": ({"kind": "donchian", "lower_length": 100, "upper_length": 100},
                         [[("DCL_100_100", mn("low", 100)), ("DCU_100_100", mx("high", 100))],
                          [("DCM_100_100", "(DCL_100_100 + DCU_100_100) / 2.0")]], ["DCL_100_100", "DCM_100_100", "DCU_100_100"]),
        "willr_100": ({"kind": "willr", "length": 100},
                      [[("WILLR_100", f"-100.0 * {dv(f'{mx(HI, 100)} - close', f'{mx(HI, 100)} - {mn(LO, 100)}')}")]], ["WILLR_100"]),
        "stoch_21": ({"kind": "stoch", "k": 21, "d": 3, "smooth_k": 3},
                     [[("raw", f"100.0 * {dv(f'close - {mn(LO, 21)}', f'{mx(HI, 21)} - {mn(LO, 21)}')}")],
                      [(_n("STOCHk_21_3_3"), sm("raw", 3))], [(_n("STOCHd_21_3_3"), sm('"STOCHk_21_3_3"', 3))]],
                     ["STOCHk_21_3_3", "STOCHd_21_3_3"]),
        "midpoint_100": ({"kind": "midpoint", "length": 100},
                         [[("MIDPOINT_100", f"({mx('close', 100)} + {mn('close', 100)}) / 2.0")]], ["MIDPOINT_100"]),
        "midprice_100": ({"kind": "midprice", "length": 100},
                         [[("MIDPRICE_100", f"({mx('high', 100)} + {mn('low', 100)}) / 2.0")]], ["MIDPRICE_100"]),
        "aroon_50": ({"kind": "aroon", "length": 50},
                     [[("AROOND_50", f"CASE WHEN count(low) {rows(51)} = 51 THEN 100.0 * (1 - (rn - arg_min(rn, row(low, -rn)) {rows(51)}) / 50.0) END"),
                       ("AROONU_50", f"CASE WHEN count(high) {rows(51)} = 51 THEN 100.0 * (1 - (rn - arg_max(rn, row(high, rn)) {rows(51)}) / 50.0) END")],
                      [("AROONOSC_50", "AROONU_50 - AROOND_50")]], ["AROOND_50", "AROONU_50", "AROONOSC_50"]),
        "chop_56": ({"kind": "chop", "length": 56},
                    [[("c_", dv(ssum("tr", 56), f"{mx('high', 56)} - {mn('low', 56)}"))],
                     [("CHOP_56", f"CASE WHEN c_ > 0 THEN 100.0 * log10(c_) / {math.log10(56)!r} END")]], ["CHOP_56"]),
        "vhf_56": ({"kind": "vhf", "length": 56},
                   [[("VHF_56", dv(f"{mx('close', 56)} - {mn('close', 56)}", ssum("abs(close - c1)", 56)))]], ["VHF_56"]),
        "ichimoku_520": ({"kind": "ichimoku", "senkou": 520},
                         [[("ITS_9", f"({mx('high', 9)} + {mn('low', 9)}) / 2.0"),
                           ("IKS_26", f"({mx('high', 26)} + {mn('low', 26)}) / 2.0"), ("sb520", mid520)],
                          [("ISA_9", lag("((ITS_9 + IKS_26) / 2.0)", 25)), ("ISB_26", lag("sb520", 25))]],
                         ["ITS_9", "IKS_26", "ISA_9", "ISB_26"]),
        "stoch": ({"kind": "stoch", "k": 14, "d": 3, "smooth_k": 3},
                  [[("raw", f"100.0 * {dv(f'close - {mn(LO, 14)}', f'{mx(HI, 14)} - {mn(LO, 14)}')}")],
                   [(_n("STOCHk_14_3_3"), sm("raw", 3))], [(_n("STOCHd_14_3_3"), sm('"STOCHk_14_3_3"', 3))]],
                  ["STOCHk_14_3_3", "STOCHd_14_3_3"]),
        "roc": ({"kind": "roc", "length": 6}, [[("ROC_6", f"100.0 * ({dv('close', lag('close', 6))} - 1.0)")]], ["ROC_6"]),
        "mom": ({"kind": "mom", "length": 5}, [[("MOM_5", f"close - {lag('close', 5)}")]], ["MOM_5"]),
        "bop": ({"kind": "bop"}, [[("BOP", dv("close - open", "high - low"))]], ["BOP"]),
        "cmo": ({"kind": "cmo", "length": 14},
                [[("CMO_14", f"100.0 * {dv(f'{ssum(up, 14)} - {ssum(dn, 14)}', f'{ssum(up, 14)} + {ssum(dn, 14)}')}")]], ["CMO_14"]),
        "er": ({"kind": "er", "length": 10},
               [[("ER_10", dv(f"abs(close - {lag('close', 10)})", ssum("abs(close - c1)", 10)))]], ["ER_10"]),
        "kst": ({"kind": "kst"},
                [[(f"kr{rr}", f"100.0 * ({dv('close', lag('close', rr))} - 1.0)") for rr, _ in kst_r],
                 [(_n(kst_name), kst_total)], [(_n("KSTs_9"), sm(_n(kst_name), 9))]],
                [kst_name, "KSTs_9"]),
        "rvgi": ({"kind": "rvgi", "length": 14},
                 [[("rn_", swma("(close - open)")), ("rd_", swma("(high - low)"))],
                  [("RVGI_14", dv(ssum("rn_", 14), ssum("rd_", 14)))], [("RVGIs_14", swma("RVGI_14"))]],
                 ["RVGI_14", "RVGIs_14"]),
        "uo": ({"kind": "uo", "fast": 7, "middle": 14, "slow": 28},
               [[("UO_7_14_28", f"100.0 * (4 * {a[7]} + 2 * {a[14]} + {a[28]}) / 7.0")]], ["UO_7_14_28"]),
        "willr": ({"kind": "willr", "length": 14},
                  [[("WILLR_14", f"-100.0 * {dv(f'{mx(HI, 14)} - close', f'{mx(HI, 14)} - {mn(LO, 14)}')}")]],
                  ["WILLR_14"]),
        "cfo": ({"kind": "cfo", "length": 9}, [[("CFO_9", f"100.0 * {dv(f'close - {lr(CL, 9)}', 'close')}")]], ["CFO_9"]),
        "cg": ({"kind": "cg", "length": 10},
               [[("CG_10", g("close", 10, f"-{dv(f'(rn + 1) * sum(close) {rows(10)} - sum(rn * close) {rows(10)}', f'sum(close) {rows(10)}')}"))]],
               ["CG_10"]),
        "cti": ({"kind": "cti", "length": 12}, [[("CTI_12", g("close", 12, f"corr(close, rn) {rows(12)}"))]], ["CTI_12"]),
        "aroon": ({"kind": "aroon", "length": 14},
                  [[("AROOND_14", f"CASE WHEN {a_full} THEN 100.0 * (1 - {dn_age} / 14.0) END"),
                    ("AROONU_14", f"CASE WHEN {a_full} THEN 100.0 * (1 - {up_age} / 14.0) END")],
                   [("AROONOSC_14", "AROONU_14 - AROOND_14")]],
                  ["AROOND_14", "AROONU_14", "AROONOSC_14"]),
        "chop": ({"kind": "chop", "length": 14},
                 [[("CHOP_14", f"CASE WHEN {chop_ratio} > 0 THEN 100.0 * log10({chop_ratio}) / {math.log10(14)!r} END")]],
                 ["CHOP_14"]),
        "dpo": ({"kind": "dpo", "length": 20, "lookahead": False},
                [[("m20", sm("close", 20))], [("DPO_20", f"close - {lag('m20', 11)}")]], ["DPO_20"]),
        "qstick": ({"kind": "qstick", "length": 14}, [[("QS_14", sm("(close - open)", 14))]], ["QS_14"]),
        "vhf": ({"kind": "vhf", "length": 14},
                [[("VHF_14", dv(f"{mx('close', 14)} - {mn('close', 14)}", ssum("abs(close - c1)", 14)))]], ["VHF_14"]),
        "vortex": ({"kind": "vortex", "length": 14},
                   [[("VTXP_14", dv(ssum("abs(high - l1)", 14), ssum("tr", 14))),
                     ("VTXM_14", dv(ssum("abs(low - h1)", 14), ssum("tr", 14)))]], ["VTXP_14", "VTXM_14"]),
        "sma": ({"kind": "sma", "length": 20}, [[("SMA_20", sm("close", 20))]], ["SMA_20"]),
        "wma": ({"kind": "wma", "length": 21}, [[("WMA_21", wm("close", 21))]], ["WMA_21"]),
        "hma": ({"kind": "hma", "length": 21},
                [[("ha_", wm("close", 10)), ("hb_", wm("close", 21))], [("hd_", "2 * ha_ - hb_")],
                 [("HMA_21", wm("hd_", 4))]], ["HMA_21"]),
        "vwma": ({"kind": "vwma", "length": 20},
                 [[("VWMA_20", g("(close * volume)", 20, dv(f"sum(close * volume) {rows(20)}", f"sum(volume) {rows(20)}")))]],
                 ["VWMA_20"]),
        "vwap": ({"kind": "vwap"},
                 [[("VWAP_D", dv("sum(tp * volume) OVER (PARTITION BY symbol, interval, date ORDER BY open_time ROWS UNBOUNDED PRECEDING)",
                                 "sum(volume) OVER (PARTITION BY symbol, interval, date ORDER BY open_time ROWS UNBOUNDED PRECEDING)"))]],
                 ["VWAP_D"]),
        "bbands": ({"kind": "bbands", "length": 20, "std": 2.0},
                   [[(_n(f"BBL_{bb}"), f"{sm('close', 20)} - 2.0 * {sd('close', 20)}"), (_n(f"BBM_{bb}"), sm("close", 20)),
                     (_n(f"BBU_{bb}"), f"{sm('close', 20)} + 2.0 * {sd('close', 20)}")],
                    [(_n(f"BBB_{bb}"), f"100.0 * {dv(_n(f'BBU_{bb}') + ' - ' + _n(f'BBL_{bb}'), _n(f'BBM_{bb}'))}"),
                     (_n(f"BBP_{bb}"), dv("close - " + _n(f"BBL_{bb}"), _n(f"BBU_{bb}") + " - " + _n(f"BBL_{bb}")))]],
                   [f"BBL_{bb}", f"BBM_{bb}", f"BBU_{bb}", f"BBB_{bb}", f"BBP_{bb}"]),
        "donchian": ({"kind": "donchian", "lower_length": 20, "upper_length": 20},
                     [[("DCL_20_20", mn("low", 20)), ("DCU_20_20", mx("high", 20))],
                      [("DCM_20_20", "(DCL_20_20 + DCU_20_20) / 2.0")]], ["DCL_20_20", "DCM_20_20", "DCU_20_20"]),
        "linreg": ({"kind": "linreg", "length": 20}, [[("LR_20", lr("close", 20))]], ["LR_20"]),
        "midpoint": ({"kind": "midpoint", "length": 14},
                     [[("MIDPOINT_14", f"({mx('close', 14)} + {mn('close', 14)}) / 2.0")]], ["MIDPOINT_14"]),
        "midprice": ({"kind": "midprice", "length": 14},
                     [[("MIDPRICE_14", f"({mx('high', 14)} + {mn('low', 14)}) / 2.0")]], ["MIDPRICE_14"]),
        "ichimoku": ({"kind": "ichimoku", "lookahead": False},
                     [[("ITS_9", f"({mx('high', 9)} + {mn('low', 9)}) / 2.0"),
                       ("IKS_26", f"({mx('high', 26)} + {mn('low', 26)}) / 2.0"), ("m52", mid52)],
                      [("ISA_9", lag("((ITS_9 + IKS_26) / 2.0)", 25)), ("ISB_26", lag("m52", 25))]],
                     ["ITS_9", "IKS_26", "ISA_9", "ISB_26"]),
        "true_range": ({"kind": "true_range"}, [[("TRUERANGE_1", "tr")]], ["TRUERANGE_1"]),
        "stdev": ({"kind": "stdev", "length": 20}, [[("STDEV_20", sd("close", 20))]], ["STDEV_20"]),
        "accbands": ({"kind": "accbands", "length": 20},
                     [[("ACCBL_20", sm(f"(low * (1 - {ratio}))", 20)), ("ACCBM_20", sm("close", 20)),
                       ("ACCBU_20", sm(f"(high * (1 + {ratio}))", 20))]], ["ACCBL_20", "ACCBM_20", "ACCBU_20"]),
        "ad": ({"kind": "ad"}, [[("AD", f"sum({CLV} * volume) {CUM}")]], ["AD"]),
        "obv": ({"kind": "obv"}, [[("OBV", f"sum(CASE WHEN c1 IS NULL THEN volume ELSE sign(close - c1) * volume END) {CUM}")]], ["OBV"]),
        "mfi": ({"kind": "mfi", "length": 14},
                [[("tp1", lag("tp"))],
                 [("mp", "CASE WHEN tp1 IS NOT NULL THEN CASE WHEN tp > tp1 THEN tp * volume ELSE 0.0 END END"),
                  ("mn_", "CASE WHEN tp1 IS NOT NULL THEN CASE WHEN tp < tp1 THEN tp * volume ELSE 0.0 END END")],
                 [("MFI_14", f"100.0 * {dv(ssum('mp', 14), ssum('mp', 14) + ' + ' + ssum('mn_', 14))}")]], ["MFI_14"]),
        "cmf": ({"kind": "cmf", "length": 20},
                [[("CMF_20", g("close", 20, dv(f"sum({CLV} * volume) {rows(20)}", f"sum(volume) {rows(20)}")))]], ["CMF_20"]),
        "pvi": ({"kind": "pvi"}, [[("PVI", pvx.format(op=">"))]], ["PVI"]),
        "nvi": ({"kind": "nvi"}, [[("NVI", pvx.format(op="<"))]], ["NVI"]),
        "pvt": ({"kind": "pvt"}, [[("PVT", f"sum(volume * {dv('close - c1', 'c1')}) {CUM}")]], ["PVT"]),
        "log_return": ({"kind": "log_return", "cumulative": False}, [[("LOGRET_1", "ln(close / c1)")]], ["LOGRET_1"]),
        "percent_return": ({"kind": "percent_return", "cumulative": False}, [[("PCTRET_1", "close / c1 - 1.0")]], ["PCTRET_1"]),
        "entropy": ({"kind": "entropy", "length": 60},
                    [[("p_", dv("close", ssum("close", 60)))], [("ENTP_60", ssum("(-p_ * log2(p_))", 60))]], ["ENTP_60"]),
        "zscore": ({"kind": "zscore", "length": 60}, [[("ZS_60", dv(f"close - {sm('close', 60)}", sd("close", 60)))]], ["ZS_60"]),
        **{f"{k}_900": ({"kind": k, "length": 900}, [[(f"{out}_900", g("close", 900, f"{fn}(close) {rows(900)}"))]], [f"{out}_900"])
           for k, out, fn in (("kurtosis", "KURT", "kurtosis"), ("skew", "SKEW", "skewness"), ("variance", "VAR", "var_samp"))},
        "zscore_300": ({"kind": "zscore", "length": 300}, [[("ZS_300", dv(f"close - {sm('close', 300)}", sd("close", 300)))]], ["ZS_300"]),
        "variance": ({"kind": "variance", "length": 60}, [[("VAR_60", g("close", 60, f"var_samp(close) {rows(60)}"))]], ["VAR_60"]),
        "ohlc4": ({"kind": "ohlc4"}, [[("OHLC4", "(open + high + low + close) / 4.0")]], ["OHLC4"]),
        "hl2": ({"kind": "hl2"}, [[("HL2", "(high + low) / 2.0")]], ["HL2"]),
        "hlc3": ({"kind": "hlc3"}, [[("HLC3", "(high + low + close) / 3.0")]], ["HLC3"]),
    }


# Kinds whose windows are checked on day-long chunks of one-second bars as well (fixture F6).
DENSE_KINDS = ("sma", "wma", "hma", "cfo", "linreg", "zscore", "bbands", "variance", "kurtosis_continuous",
               "skew_continuous", "mad_continuous", "cci_continuous", "variance_900", "zscore_300", "kurtosis_900", "skew_900",
               "mad_900", "cci_100", "donchian_100", "willr_100", "stoch_21", "midpoint_100", "midprice_100", "aroon_50", "chop_56", "vhf_56",
               "ichimoku")


def dense_sql(kind: str) -> str:
    """A finite-window kind over daily chunks of the one-second bars."""
    from barwright.functions.registry import warmup_rows

    spec, stages, outputs = native_cases()[kind]
    return staged("daily", warmup_rows([spec]), stages, outputs).replace(bars_cte(), dense_bars_cte())


def native_sql(kind: str) -> str:
    """Finite-window kinds over the whole series; cumulative kinds per daily chunk."""
    from barwright.functions.registry import CUMULATIVE_KINDS, warmup_rows

    spec, stages, outputs = native_cases()[kind]
    if kind in CUMULATIVE_KINDS:
        return staged("daily", warmup_rows([spec]), stages, outputs)
    return staged("continuous", 0, stages, outputs)


def indicator_oracles() -> dict[str, str]:
    dense = {f"dense_{k.removesuffix('_continuous')}": dense_sql(k) for k in DENSE_KINDS}
    return {**{f"ind_{k}": native_sql(k) for k in native_cases()}, **dense, **kernel_oracles(), **continuous_oracles()}


# ----------------------------------------------------------- recursive kinds
KEYS4 = "symbol, interval, chunk_date, rn"
ON4 = "s.symbol = r.symbol AND s.interval = r.interval AND s.chunk_date = r.chunk_date"


class Rec:
    """Builds CTEs of (symbol, interval, chunk_date, rn, y) series, including
    EMA/RMA by recursive CTE (one row per chunk per recursion step)."""

    mode = "daily"  # "continuous": one chunk for each series

    def __init__(self):
        self.ctes: list[str] = []

    def series(self, name: str, expr: str, deps: tuple[str, ...] = ()) -> str:
        joins = " ".join(f"LEFT JOIN {d} USING ({KEYS4})" for d in deps)
        self.ctes.append(f"{name} AS (SELECT {KEYS4}, {expr} AS y FROM b {joins})")
        return name

    def smooth(self, name: str, src: str, n: int, alpha: float, seed: str, seed_expr: str = "") -> str:
        w = f"PARTITION BY symbol, interval, chunk_date ORDER BY rn"
        if seed == "custom":  # seed row rn = 1 with its own value, x from row 2 on
            cond, first, guard = "rn = 1", seed_expr, "TRUE"
        else:
            cond, first = ("cnt = %d" % n, "s.m") if seed == "sma" else ("x IS NOT NULL", "s.x")
            guard = "s.x IS NOT NULL" + (f" AND s.seen >= {n}" if seed == "first" else "")
        self.ctes += [
            f"""{name}_s AS (SELECT {KEYS4}, y AS x,
  avg(y) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS m,
  count(y) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS cnt,
  count(y) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen FROM {src})""",
            f"{name}_0 AS (SELECT symbol, interval, chunk_date, min(rn) AS rn0 FROM {name}_s WHERE {cond} GROUP BY ALL)",
            f"""{name}_r(symbol, interval, chunk_date, rn, y) AS (
  SELECT s.symbol, s.interval, s.chunk_date, s.rn, {first} FROM {name}_s s JOIN {name}_0 r
    ON {ON4} AND s.rn = r.rn0
  UNION ALL
  SELECT r.symbol, r.interval, r.chunk_date, r.rn + 1,
    CASE WHEN s.x IS NULL THEN r.y ELSE {alpha!r} * s.x + (1 - {alpha!r}) * r.y END
  FROM {name}_r r JOIN {name}_s s ON {ON4} AND s.rn = r.rn + 1)""",
            f"""{name} AS (SELECT s.symbol, s.interval, s.chunk_date, s.rn, CASE WHEN {guard} THEN r.y END AS y
  FROM {name}_s s LEFT JOIN {name}_r r ON {ON4} AND s.rn = r.rn)""",
        ]
        return name

    def ema(self, name, src, n):
        return self.smooth(name, src, n, 2.0 / (n + 1), "sma")

    def rma(self, name, src, n):
        return self.smooth(name, src, n, 1.0 / n, "first")

    def sql(self, out: dict[str, str], deps: tuple[str, ...], warmup: int,
            stages: list[dict[str, str]] = (), outputs: list[str] | None = None) -> str:
        """`out` is computed over b joined with `deps`; each dict of `stages` is a
        further window stage over the previous one; `outputs` are returned."""
        joins = " ".join(f"LEFT JOIN {d} USING ({KEYS4})" for d in deps)
        comp = ", ".join(f"{e} AS {_n(k)}" for k, e in out.items())
        # Windows are evaluated before the day filter (SQL filters first).
        ctes = self.ctes + [f"o0 AS (SELECT b.*, {comp} FROM b {joins})"]
        for i, st in enumerate(stages, 1):
            ctes.append(f"o{i} AS (SELECT *, {', '.join(f'{e} AS {_n(k)}' for k, e in st.items())} FROM o{i - 1})")
        outputs = outputs or list(out)
        sel = ", ".join(f"{r(_n(k))} AS {_n(k)}" for k in outputs)
        own = "date = chunk_date" if self.mode == "daily" else "TRUE"
        return (f"WITH RECURSIVE {prelude(self.mode, warmup)},\n" + ",\n".join(ctes)
                + f"\nSELECT symbol, interval, date, open_time, {sel} FROM o{len(stages)} WHERE {own}")


def _k_ema():
    q_ = Rec(); q_.series("x", "close"); q_.ema("e", "x", 12)
    return {"kind": "ema", "length": 12}, q_.sql({"EMA_12": "e.y"}, ("e",), 17)


def _k_rma():
    q_ = Rec(); q_.series("x", "close"); q_.rma("e", "x", 14)
    return {"kind": "rma", "length": 14}, q_.sql({"RMA_14": "e.y"}, ("e",), 19)


def _k_rsi():
    q_ = Rec()
    q_.series("up", "CASE WHEN c1 IS NOT NULL THEN greatest(close - c1, 0.0) END")
    q_.series("dn", "CASE WHEN c1 IS NOT NULL THEN greatest(c1 - close, 0.0) END")
    q_.rma("gu", "up", 14); q_.rma("gd", "dn", 14)
    return {"kind": "rsi", "length": 14}, q_.sql({"RSI_14": f"100.0 * {dv('gu.y', 'gu.y + gd.y')}"}, ("gu", "gd"), 19)


def _k_atr():
    q_ = Rec(); q_.series("x", "tr"); q_.rma("a", "x", 14)
    return {"kind": "atr", "length": 14}, q_.sql({"ATR_14": "a.y"}, ("a",), 19)


def _k_natr():
    q_ = Rec(); q_.series("x", "tr"); q_.rma("a", "x", 14)
    return {"kind": "natr", "length": 14}, q_.sql({"NATR_14": "100.0 * a.y / close"}, ("a",), 19)


def _k_macd():
    q_ = Rec(); q_.series("x", "close"); q_.ema("ef", "x", 12); q_.ema("es", "x", 26)
    q_.series("m", "ef.y - es.y", ("ef", "es")); q_.ema("sg", "m", 9)
    p = "12_26_9"
    return ({"kind": "macd", "fast": 12, "slow": 26, "signal": 9},
            q_.sql({f"MACD_{p}": "m.y", f"MACDh_{p}": "m.y - sg.y", f"MACDs_{p}": "sg.y"}, ("m", "sg"), 31))


def _k_dema():
    q_ = Rec(); q_.series("x", "close"); q_.ema("e1", "x", 9); q_.ema("e2", "e1", 9)
    return {"kind": "dema", "length": 9}, q_.sql({"DEMA_9": "2 * e1.y - e2.y"}, ("e1", "e2"), 14)


def _k_kurtosis():
    q_ = Rec()
    return ({"kind": "kurtosis", "length": 60},
            q_.sql({"KURT_60": g("close", 60, f"kurtosis(close) {rows(60)}")}, (), 65))


def _k_skew():
    q_ = Rec()
    return {"kind": "skew", "length": 60}, q_.sql({"SKEW_60": g("close", 60, f"skewness(close) {rows(60)}")}, (), 65)


def _mad(x: str, n: int) -> str:
    lst = f"list({x}) {rows(n)}"
    return g(x, n, f"list_avg(list_transform({lst}, lambda e: abs(e - list_avg({lst}))))")


def _k_mad():
    return {"kind": "mad", "length": 60}, Rec().sql({"MAD_60": _mad("close", 60)}, (), 65)


def _k_cci():
    return ({"kind": "cci", "length": 20},
            Rec().sql({"CCI_20": dv(f"tp - {sm('tp', 20)}", f"0.015 * {_mad('tp', 20)}")}, (), 25))


def _emas(q_, src, n, depth, prefix):
    names, cur = [], src
    for i in range(1, depth + 1):
        cur = q_.ema(f"{prefix}{i}", cur, n)
        names.append(cur)
    return names


def _k_apo():
    q_ = Rec(); q_.series("x", "close"); q_.ema("ef", "x", 12); q_.ema("es", "x", 26)
    return {"kind": "apo", "fast": 12, "slow": 26}, q_.sql({"APO_12_26": "ef.y - es.y"}, ("ef", "es"), 31)


def _k_ppo():
    q_ = Rec(); q_.series("x", "close"); q_.ema("ef", "x", 12); q_.ema("es", "x", 26)
    q_.series("m", f"100.0 * {dv('ef.y - es.y', 'es.y')}", ("ef", "es")); q_.ema("sg", "m", 9)
    p = "12_26_9"
    return ({"kind": "ppo", "fast": 12, "slow": 26, "signal": 9},
            q_.sql({f"PPO_{p}": "m.y", f"PPOh_{p}": "m.y - sg.y", f"PPOs_{p}": "sg.y"}, ("m", "sg"), 31))


def _k_pgo():
    q_ = Rec(); q_.series("x", "tr"); q_.ema("et", "x", 14)
    return {"kind": "pgo", "length": 14}, q_.sql({"PGO_14": dv(f"close - {sm('close', 14)}", "et.y")}, ("et",), 19)


def _k_trix():
    q_ = Rec(); q_.series("x", "close"); e = _emas(q_, "x", 9, 3, "e")
    q_.series("tx", f"100.0 * ({dv('e3.y', 'lag(e3.y) OVER (PARTITION BY symbol, interval, chunk_date ORDER BY rn)')} - 1.0)",
              ("e3",))
    return ({"kind": "trix", "length": 9},
            q_.sql({"TRIX_9": "tx.y"}, ("tx",), 14, [{"TRIXs_9": sm('"TRIX_9"', 9)}], ["TRIX_9", "TRIXs_9"]))


def _k_tsi():
    q_ = Rec()
    q_.series("d", "close - c1"); q_.series("ad", "abs(close - c1)")
    q_.ema("n1", "d", 25); q_.ema("n2", "n1", 13); q_.ema("d1", "ad", 25); q_.ema("d2", "d1", 13)
    q_.series("t", f"100.0 * {dv('n2.y', 'd2.y')}", ("n2", "d2")); q_.ema("ts", "t", 13)
    return ({"kind": "tsi", "long": 25, "short": 13},
            q_.sql({"TSI_25_13": "t.y", "TSIs_25_13": "ts.y"}, ("t", "ts"), 30))


def _k_t3():
    q_ = Rec(); q_.series("x", "close"); e = _emas(q_, "x", 5, 6, "e")
    a = 0.7
    c1, c2 = -a ** 3, 3 * a ** 2 + 3 * a ** 3
    c3, c4 = -6 * a ** 2 - 3 * a - 3 * a ** 3, 1 + 3 * a + a ** 3 + 3 * a ** 2
    expr = f"{c1!r} * e6.y + {c2!r} * e5.y + {c3!r} * e4.y + {c4!r} * e3.y"
    return {"kind": "t3", "length": 5}, q_.sql({"T3_5": expr}, tuple(e), 10)


def _k_tema():
    q_ = Rec(); q_.series("x", "close"); e = _emas(q_, "x", 9, 3, "e")
    return {"kind": "tema", "length": 9}, q_.sql({"TEMA_9": "3 * e1.y - 3 * e2.y + e3.y"}, tuple(e), 14)


def _k_kc():
    q_ = Rec(); q_.series("x", "close"); q_.series("t", "tr"); q_.ema("m", "x", 20); q_.ema("rg", "t", 20)
    return ({"kind": "kc", "length": 20},
            q_.sql({"KCL_20": "m.y - 2.0 * rg.y", "KCM_20": "m.y", "KCU_20": "m.y + 2.0 * rg.y"}, ("m", "rg"), 25))


def _k_aberration():
    q_ = Rec(); q_.series("t", "tr"); q_.rma("a", "t", 15)
    zg = sm("tp", 20)
    return ({"kind": "aberration", "length": 20},
            q_.sql({"ABER_ZG_20": zg, "ABER_SG_20": f"{zg} + a.y", "ABER_XG_20": f"{zg} - a.y", "ABER_ATR_20": "a.y"},
                   ("a",), 25))


def _k_adosc():
    q_ = Rec(); q_.series("x", f"sum({CLV} * volume) {CUM}"); q_.ema("f", "x", 3); q_.ema("s_", "x", 10)
    return {"kind": "adosc", "fast": 3, "slow": 10}, q_.sql({"ADOSC_3_10": "f.y - s_.y"}, ("f", "s_"), 15)


def _k_kvo():
    q_ = Rec()
    q_.series("x", f"volume * sign(tp - {lag('tp')})")
    q_.ema("f", "x", 21); q_.ema("s_", "x", 34)
    q_.series("k", "f.y - s_.y", ("f", "s_")); q_.ema("g", "k", 8)
    return ({"kind": "kvo", "fast": 21, "slow": 34, "signal": 8},
            q_.sql({"KVO_21_34_8": "k.y", "KVOs_21_34_8": "g.y"}, ("k", "g"), 39))


def _k_adx():
    q_ = Rec()
    up, dn = "(high - h1)", "(l1 - low)"
    q_.series("pdm", f"CASE WHEN {up} IS NULL THEN NULL WHEN {up} > {dn} AND {up} > 0 THEN {up} ELSE 0.0 END")
    q_.series("mdm", f"CASE WHEN {dn} IS NULL THEN NULL WHEN {dn} > {up} AND {dn} > 0 THEN {dn} ELSE 0.0 END")
    q_.series("t", "tr")
    q_.rma("atr_", "t", 14); q_.rma("rp", "pdm", 14); q_.rma("rm", "mdm", 14)
    q_.series("dmp", f"100.0 * {dv('rp.y', 'atr_.y')}", ("rp", "atr_"))
    q_.series("dmn", f"100.0 * {dv('rm.y', 'atr_.y')}", ("rm", "atr_"))
    q_.series("dx", f"100.0 * {dv('abs(dmp.y - dmn.y)', 'dmp.y + dmn.y')}", ("dmp", "dmn"))
    q_.rma("ax", "dx", 14)
    return ({"kind": "adx", "length": 14},
            q_.sql({"ADX_14": "ax.y", "DMP_14": "dmp.y", "DMN_14": "dmn.y"}, ("ax", "dmp", "dmn"), 19))


def _k_stochrsi():
    q_ = Rec()
    q_.series("up", "CASE WHEN c1 IS NOT NULL THEN greatest(close - c1, 0.0) END")
    q_.series("dn", "CASE WHEN c1 IS NOT NULL THEN greatest(c1 - close, 0.0) END")
    q_.rma("gu", "up", 14); q_.rma("gd", "dn", 14)
    rsi = f"100.0 * {dv('gu.y', 'gu.y + gd.y')}"
    lo, hi = mn('"rsi_"', 14), mx('"rsi_"', 14)
    return ({"kind": "stochrsi", "length": 14},
            q_.sql({"rsi_": rsi}, ("gu", "gd"), 19,
                   [{"st_": f"100.0 * {dv(f'rsi_ - {lo}', f'{hi} - {lo}')}"},
                    {"STOCHRSIk_14": sm('"st_"', 3)}, {"STOCHRSId_14": sm('"STOCHRSIk_14"', 3)}],
                   ["STOCHRSIk_14", "STOCHRSId_14"]))


def _k_smi():
    q_ = Rec()
    hh, ll = mx("high", 14), mn("low", 14)
    q_.series("m", f"close - ({hh} + {ll}) / 2.0"); q_.series("rg", f"{hh} - {ll}")
    q_.ema("m1", "m", 3); q_.ema("m2", "m1", 3); q_.ema("r1", "rg", 3); q_.ema("r2", "r1", 3)
    q_.series("smi", f"100.0 * {dv('m2.y', '0.5 * r2.y')}", ("m2", "r2")); q_.ema("sg", "smi", 3)
    return {"kind": "smi", "length": 14}, q_.sql({"SMI_14": "smi.y", "SMIs_14": "sg.y"}, ("smi", "sg"), 19)


def _k_inertia():
    q_ = Rec()
    q_.series("sd", sd("close", 14))
    q_.series("pos", "CASE WHEN sd.y IS NULL THEN NULL WHEN close - c1 > 0 THEN sd.y ELSE 0.0 END", ("sd",))
    q_.ema("ep", "pos", 14); q_.ema("es", "sd", 14)
    q_.series("rvi", f"100.0 * {dv('ep.y', 'es.y')}", ("ep", "es"))
    return ({"kind": "inertia", "length": 14},
            q_.sql({"rvi_": "rvi.y"}, ("rvi",), 19, [{"INERTIA_14": lr('"rvi_"', 14)}], ["INERTIA_14"]))


def _k_ha():
    q_ = Rec()
    q_.series("hc", "(open + high + low + close) / 4.0")
    q_.series("xp", f"lag((open + high + low + close) / 4.0) {ov()}")
    q_.smooth("ho", "xp", 1, 0.5, "custom", "(SELECT (b.open + b.close) / 2.0 FROM b WHERE b.symbol = s.symbol "
              "AND b.interval = s.interval AND b.chunk_date = s.chunk_date AND b.rn = 1)")
    return ({"kind": "ha"},
            q_.sql({"HA_open": "ho.y", "HA_high": "greatest(high, ho.y, hc.y)", "HA_low": "least(low, ho.y, hc.y)",
                    "HA_close": "hc.y"}, ("ho", "hc"), 6))


def _k_aobv():
    q_ = Rec()
    q_.series("ob", f"sum(CASE WHEN c1 IS NULL THEN volume ELSE sign(close - c1) * volume END) {CUM}")
    q_.ema("e4", "ob", 4); q_.ema("e12", "ob", 12)
    valid = "e4_ IS NOT NULL AND e12_ IS NOT NULL"

    def flag(op):
        return (f"CASE WHEN {valid} THEN CASE WHEN count(*) {rows(7)} = 7 AND sum(CASE WHEN {valid} AND e4_ {op} e12_ "
                f"THEN 1 ELSE 0 END) {rows(7)} = 7 THEN 1.0 ELSE 0.0 END END")
    return ({"kind": "aobv", "length": 7},
            q_.sql({"OBV": "ob.y", "e4_": "e4.y", "e12_": "e12.y"}, ("ob", "e4", "e12"), 12,
                   [{"OBV_min_2": mn('"OBV"', 2), "OBV_max_2": mx('"OBV"', 2), "OBVe_4": "e4_", "OBVe_12": "e12_",
                     "AOBV_LR_7": flag(">"), "AOBV_SR_7": flag("<")}],
                   ["OBV", "OBV_min_2", "OBV_max_2", "OBVe_4", "OBVe_12", "AOBV_LR_7", "AOBV_SR_7"]))


KERNEL_ORACLES = {f.__name__[3:]: f for f in (
    _k_ema, _k_rma, _k_rsi, _k_atr, _k_natr, _k_macd, _k_dema, _k_kurtosis, _k_skew, _k_mad, _k_cci,
    _k_apo, _k_ppo, _k_pgo, _k_trix, _k_tsi, _k_t3, _k_tema, _k_kc, _k_aberration, _k_adosc, _k_kvo, _k_adx,
    _k_stochrsi, _k_smi, _k_inertia, _k_ha, _k_aobv)}


def kernel_cases() -> dict[str, dict]:
    """Recursive kinds registered as daily-mode queries (smallest default grid entry)."""
    from barwright.functions.specs import default_specs

    first: dict[str, dict] = {}
    for s in default_specs()[1]:
        first.setdefault(s["kind"], s)
    from barwright.functions.kernels import KERNELS

    cases = {k: first[k] for k in KERNELS if k in first}
    for k, f in KERNEL_ORACLES.items():
        cases[k] = f()[0]
    return cases


def kernel_oracles() -> dict[str, str]:
    out = {f"ind_{k}": f()[1] for k, f in KERNEL_ORACLES.items()}
    out.update({f"ind_{k}": f()[1] for k, f in SHORT_KERNEL_ORACLES.items()})
    return out


def continuous_cases() -> dict[str, tuple[dict, str]]:
    """Cumulative kinds and linear recurrences over the unbroken series: (spec, SQL)."""
    from barwright.functions.kernels import KERNELS
    from barwright.functions.registry import CUMULATIVE_KINDS

    out = {}
    for k, (spec, stages, outputs) in native_cases().items():
        if k in CUMULATIVE_KINDS:
            out[k] = spec, staged("continuous", 0, stages, outputs)
    Rec.mode = "continuous"
    try:
        for k, f in KERNEL_ORACLES.items():
            if k not in KERNELS and k not in native_cases():
                out[k] = f()
    finally:
        Rec.mode = "daily"
    return out


def continuous_oracles() -> dict[str, str]:
    return {f"ind_{k}_continuous": sql for k, (_, sql) in continuous_cases().items()}


# ------------------------------------------------------- state machines (N)
STEP = ("s.symbol = r.symbol AND s.interval = r.interval AND s.chunk_date = r.chunk_date "
        "AND s.rn = r.rn + 1")


def _state_sql(rec: Rec, warmup: int, src_cols: str, anchor: str, step: str, cols: str, out: dict[str, str]) -> str:
    """A recursive CTE `st` stepping one row at a time with explicit state columns."""
    rec.ctes.append(f"src AS (SELECT {KEYS4}, {src_cols} FROM b)")
    rec.ctes.append(f"st({cols}) AS ({anchor}\n  UNION ALL\n  {step})")
    return rec.sql(out, ("st",), warmup)


def _k_fisher():
    n = 9
    hl2 = "((high + low) / 2.0)"
    lo, hi = mn(hl2, n), mx(hl2, n)
    pos = f"CASE WHEN ({hi}) - ({lo}) > 0 THEN ({hl2} - ({lo})) / (({hi}) - ({lo})) - 0.5 ELSE 0.0 END"
    src = f"CASE WHEN count({hl2}) {rows(n)} = {n} THEN {pos} END AS p"
    clip = "greatest(least(0.66 * {p} + 0.67 * {w}, 0.999), -0.999)"
    w0 = clip.format(p="s.p", w="0.0")
    anchor = (f"SELECT s.symbol, s.interval, s.chunk_date, s.rn, {w0}, 0.5 * ln((1 + {w0}) / (1 - {w0})) "
              f"FROM src s WHERE s.p IS NOT NULL AND s.rn = (SELECT min(x.rn) FROM src x WHERE x.symbol = s.symbol "
              f"AND x.interval = s.interval AND x.chunk_date = s.chunk_date AND x.p IS NOT NULL)")
    w1 = clip.format(p="s.p", w="r.w")
    step = (f"SELECT s.symbol, s.interval, s.chunk_date, s.rn, {w1}, 0.5 * ln((1 + {w1}) / (1 - {w1})) + 0.5 * r.f "
            f"FROM st r JOIN src s ON {STEP}")
    return ({"kind": "fisher", "length": n},
            _state_sql(Rec(), 14, src, anchor, step, "symbol, interval, chunk_date, rn, w, f",
                       {"FISHERT_9": "st.f", "FISHERTs_9": f"lag(st.f) {ov()}"}))


def _k_supertrend():
    n, m = 7, 4
    q_ = Rec(); q_.series("t", "tr"); q_.rma("a", "t", n)
    q_.ctes.append(f"""src AS (SELECT b.symbol, b.interval, b.chunk_date, b.rn, b.close AS c,
  (b.high + b.low) / 2.0 + {m} * a.y AS u, (b.high + b.low) / 2.0 - {m} * a.y AS lo
  FROM b JOIN a USING ({KEYS4}) WHERE a.y IS NOT NULL)""")
    anchor = ("SELECT s.symbol, s.interval, s.chunk_date, s.rn, 1, s.u, s.lo FROM src s WHERE s.rn = "
              "(SELECT min(x.rn) FROM src x WHERE x.symbol = s.symbol AND x.interval = s.interval "
              "AND x.chunk_date = s.chunk_date)")
    d = "CASE WHEN s.c > r.fu THEN 1 WHEN s.c < r.fl THEN -1 ELSE r.d END"
    hold = "s.c <= r.fu AND s.c >= r.fl"
    u = f"CASE WHEN {hold} AND r.d < 0 AND s.u > r.fu THEN r.fu ELSE s.u END"
    lo = f"CASE WHEN {hold} AND r.d > 0 AND s.lo < r.fl THEN r.fl ELSE s.lo END"
    step = f"SELECT s.symbol, s.interval, s.chunk_date, s.rn, {d}, {u}, {lo} FROM st r JOIN src s ON {STEP}"
    q_.ctes.append(f"st(symbol, interval, chunk_date, rn, d, fu, fl) AS ({anchor}\n  UNION ALL\n  {step})")
    p = f"{n}_{m}"
    return ({"kind": "supertrend", "length": n, "multiplier": m},
            q_.sql({f"SUPERT_{p}": "CASE WHEN st.d > 0 THEN st.fl ELSE st.fu END", f"SUPERTd_{p}": "CAST(st.d AS DOUBLE)",
                    f"SUPERTl_{p}": "CASE WHEN st.d > 0 THEN st.fl END", f"SUPERTs_{p}": "CASE WHEN st.d < 0 THEN st.fu END"},
                   ("st",), 12))


def _k_psar():
    q_ = Rec()
    q_.ctes.append(f"""src AS (SELECT {KEYS4}, high AS h, low AS l, close AS c,
  lag(high) {ov()} AS h1, lag(low) {ov()} AS l1, lag(high, 2) {ov()} AS h2, lag(low, 2) {ov()} AS l2,
  lead(close) {ov()} AS cn FROM b)""")
    # row 1 seeds the state; the start side comes from the first move (row 2 close vs row 1 close)
    anchor = ("SELECT symbol, interval, chunk_date, rn, cn < c, CASE WHEN cn < c THEN h ELSE l END, "
              "CASE WHEN cn < c THEN l ELSE h END, 0.02, NULL::DOUBLE, NULL::DOUBLE FROM src WHERE rn = 1 AND cn IS NOT NULL")
    sar0 = "(r.sar + r.af * (r.ep - r.sar))"
    lim = (f"CASE WHEN r.falling THEN greatest({sar0}, CASE WHEN s.h2 IS NULL THEN s.h1 ELSE greatest(s.h1, s.h2) END) "
           f"ELSE least({sar0}, CASE WHEN s.l2 IS NULL THEN s.l1 ELSE least(s.l1, s.l2) END) END")
    rev = f"(CASE WHEN r.falling THEN s.h > ({lim}) ELSE s.l < ({lim}) END)"
    new_ep = "CASE WHEN r.falling THEN least(r.ep, s.l) ELSE greatest(r.ep, s.h) END"
    ext = "CASE WHEN r.falling THEN s.l < r.ep ELSE s.h > r.ep END"
    af1 = f"CASE WHEN {ext} THEN least(r.af + 0.02, 0.2) ELSE r.af END"
    step = (f"SELECT s.symbol, s.interval, s.chunk_date, s.rn, "
            f"CASE WHEN {rev} THEN NOT r.falling ELSE r.falling END, "
            f"CASE WHEN {rev} THEN {new_ep} ELSE {lim} END, "
            f"CASE WHEN {rev} THEN CASE WHEN r.falling THEN s.h ELSE s.l END ELSE {new_ep} END, "
            f"CASE WHEN {rev} THEN 0.02 ELSE {af1} END, "
            f"CASE WHEN {rev} THEN 1.0 ELSE 0.0 END, 0.0 FROM st r JOIN src s ON {STEP}")
    q_.ctes.append(f"st(symbol, interval, chunk_date, rn, falling, sar, ep, af, rv, z) AS ({anchor}\n  UNION ALL\n  {step})")
    p = "0.02_0.2"
    return ({"kind": "psar", "af": 0.02, "max_af": 0.2},
            q_.sql({f"PSARl_{p}": "CASE WHEN st.rn > 1 AND NOT st.falling THEN st.sar END",
                    f"PSARs_{p}": "CASE WHEN st.rn > 1 AND st.falling THEN st.sar END",
                    f"PSARaf_{p}": "st.af",
                    f"PSARr_{p}": "CASE WHEN st.rn = 1 THEN 0.0 ELSE st.rv END"}, ("st",), 6))


KERNEL_ORACLES.update({f.__name__[3:]: f for f in (_k_fisher, _k_supertrend, _k_psar)})


def _rsi_series(q_: Rec, n: int, name: str) -> str:
    q_.series(f"{name}_u", "CASE WHEN c1 IS NOT NULL THEN greatest(close - c1, 0.0) END")
    q_.series(f"{name}_d", "CASE WHEN c1 IS NOT NULL THEN greatest(c1 - close, 0.0) END")
    q_.rma(f"{name}_gu", f"{name}_u", n); q_.rma(f"{name}_gd", f"{name}_d", n)
    return q_.series(name, f"100.0 * {dv(f'{name}_gu.y', f'{name}_gu.y + {name}_gd.y')}", (f"{name}_gu", f"{name}_gd"))


def _k_qqe_5():
    return _qqe(5)


def _k_qqe():
    return _qqe(14)


def _qqe(n: int):
    smooth, factor = 5, 4.236
    q_ = Rec()
    _rsi_series(q_, n, "rs")
    q_.ema("rm", "rs", smooth)
    q_.series("ad", f"abs(rm.y - lag(rm.y) OVER (PARTITION BY symbol, interval, chunk_date ORDER BY rn))", ("rm",))
    q_.ema("e1", "ad", 2 * n - 1); q_.ema("e2", "e1", 2 * n - 1)
    q_.ctes.append(f"""src AS (SELECT {KEYS4}, rm.y AS r, lag(rm.y) OVER (PARTITION BY symbol, interval, chunk_date ORDER BY rn) AS r0,
  rm.y - {factor} * e2.y AS lb, rm.y + {factor} * e2.y AS ub
  FROM b LEFT JOIN rm USING ({KEYS4}) LEFT JOIN e2 USING ({KEYS4}))""")
    q_.ctes.append(f"v AS (SELECT * FROM src WHERE r IS NOT NULL AND lb IS NOT NULL)")
    anchor = ("SELECT s.symbol, s.interval, s.chunk_date, s.rn, s.lb, s.ub, 1 FROM v s WHERE s.rn = (SELECT min(x.rn) FROM v x "
              "WHERE x.symbol = s.symbol AND x.interval = s.interval AND x.chunk_date = s.chunk_date)")
    lng = "CASE WHEN s.r0 > r.lo AND s.r > r.lo THEN greatest(r.lo, s.lb) ELSE s.lb END"
    sht = "CASE WHEN s.r0 < r.sh AND s.r < r.sh THEN least(r.sh, s.ub) ELSE s.ub END"
    trend = ("CASE WHEN s.r > r.sh AND s.r0 <= r.sh THEN 1 WHEN s.r < r.lo AND s.r0 >= r.lo THEN -1 ELSE r.tr END")
    step = f"SELECT s.symbol, s.interval, s.chunk_date, s.rn, {lng}, {sht}, {trend} FROM st r JOIN v s ON {STEP}"
    q_.ctes.append(f"st(symbol, interval, chunk_date, rn, lo, sh, tr) AS ({anchor}\n  UNION ALL\n  {step})")
    return ({"kind": "qqe", "length": n},
            q_.sql({f"QQE_{n}": "CASE WHEN st.tr = 1 THEN st.lo ELSE st.sh END", f"QQEma_{n}": "rm.y",
                    f"QQEl_{n}": "CASE WHEN st.tr = 1 THEN st.lo END", f"QQEs_{n}": "CASE WHEN st.tr = -1 THEN st.sh END"},
                   ("st", "rm"), n + 5))


def _stoch_hold_sql(q_: Rec, name: str, src: str, n: int) -> str:
    """100·(x − min)/(max − min) over n rows; a zero range repeats the last defined value."""
    lo, hi = f"min(x.y) {rows(n)}", f"max(x.y) {rows(n)}"
    full = f"count(x.y) {rows(n)} = {n}"
    flat = f"({hi} - {lo} <= 1e-9 * greatest(abs({hi}), abs({lo})))"
    q_.ctes.append(f"""{name}_raw AS (SELECT b.symbol, b.interval, b.chunk_date, b.rn, b.open_time,
  CASE WHEN {full} THEN {flat} END AS flat,
  CASE WHEN {full} AND NOT {flat} THEN 100.0 * (x.y - {lo}) / ({hi} - {lo}) END AS v
  FROM b LEFT JOIN {src} x USING ({KEYS4}))""")
    q_.ctes.append(f"""{name} AS (SELECT symbol, interval, chunk_date, rn,
  CASE WHEN flat IS NULL THEN NULL WHEN NOT flat THEN v
       ELSE last_value(v IGNORE NULLS) OVER (PARTITION BY symbol, interval, chunk_date ORDER BY rn
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS y
  FROM {name}_raw)""")
    return name


def _k_stc_short():
    return _stc(3, 5, 10, 0.5, short=True)


def _k_stc():
    return _stc(10, 23, 50, 0.5, short=False)


def _stc(tc: int, fast: int, slow: int, factor: float, short: bool):
    from barwright.functions.registry import warmup_rows

    q_ = Rec(); q_.series("x", "close"); q_.ema("ef", "x", fast); q_.ema("es", "x", slow)
    q_.series("m", "ef.y - es.y", ("ef", "es"))
    _stoch_hold_sql(q_, "k1", "m", tc)
    q_.smooth("pf", "k1", 1, factor, "first")
    _stoch_hold_sql(q_, "k2", "pf", tc)
    q_.smooth("st_", "k2", 1, factor, "first")
    spec = ({"kind": "stc", "tclength": tc, "fast": fast, "slow": slow, "factor": factor} if short
            else {"kind": "stc"})
    return spec, q_.sql({"STC": "st_.y"}, ("st_",), warmup_rows([spec]))


SHORT_KERNEL_ORACLES = {"qqe_5": _k_qqe_5, "stc_short": _k_stc_short}
KERNEL_ORACLES.update({"qqe": _k_qqe, "stc": _k_stc})


def short_kernel_cases() -> dict[str, dict]:
    return {k: f()[0] for k, f in SHORT_KERNEL_ORACLES.items()}
