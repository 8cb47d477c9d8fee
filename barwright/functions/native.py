"""Native indicator builders: Spark window expressions (classes E, F, C, L).

Builders emit Spark SQL expression text. A builder returns stages: lists of
(name, expression). Stage i may use columns made by stages < i (Spark forbids a
window function inside another); all stages share one partitioning and
ordering, so they plan as consecutive WindowExecs with no exchange or sort in
between. Each stage is applied with one `selectExpr`, which keeps plan
construction cheap even for hundreds of columns. Names starting with `__` are
helpers and are dropped at the end.

Guard rule: a rolling result is NULL until its frame holds n non-NULL values.
Sums over long frames are a difference of two running frames (O(1) per row),
see `barwright.operators.windows`.

Linear recurrences (class L: y = (1 - a) y' + a x) run in a running frame as well, through
Spark's exponentially weighted mean; seeds enter by linearity, see `Sql.ema` and `Sql.rma`.

Base columns (stage 0, shared): __c1/__h1/__l1/__v1 (values one bar back),
__rn (row number), __c0 (first close of the chunk: a level that centres long
power sums), __tr (true range, NULL on the first row), __tp (typical price).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import zip_longest

from barwright.operators.windows import EWM, PREFIX_THRESHOLD, SLIDING


def q(name: str) -> str:
    """Quoted column name (indicator names may contain dots)."""
    return f"`{name}`"


O, H, L, C, V = "`open`", "`high`", "`low`", "`close`", "`volume`"
C1, H1, L1, V1 = "`__c1`", "`__h1`", "`__l1`", "`__v1`"
RN, C0, TR, TP = "`__rn`", "`__c0`", "`__tr`", "`__tp`"


def div(a: str, b: str) -> str:
    """a / b, NULL when b is 0 or NULL (safe under ANSI mode)."""
    return f"try_divide({a}, {b})"


def num(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


class Sql:
    """Window expression factory for one partitioning, as SQL text."""

    def __init__(self, keys: Sequence[str], order: str = "open_time", threshold: int = PREFIX_THRESHOLD,
                 day_chunks: bool = False):
        self.keys = tuple(keys)
        self.order = order
        self.spec = f"PARTITION BY {', '.join(q(k) for k in self.keys)} ORDER BY {q(order)}"
        self.threshold = threshold
        self.day_chunks = day_chunks  # a chunk's own rows are those of chunk_date
        # Window calls by text -> helper column name. Spark evaluates every
        # window expression it is given, duplicates included, and specs share
        # many (guards, sums of close); each distinct call is computed once.
        self.calls: dict[str, str] = {}
        self.values: dict[str, str] = {}  # arguments of several calls, by text -> helper column name

    def call(self, text: str) -> str:
        """One window call as a reference to its (shared) helper column."""
        name = self.calls.get(text)
        if name is None:
            name = f"__w{len(self.calls)}"
            self.calls[text] = name
        return q(name)

    def over(self, frame: str = "") -> str:
        return f"OVER ({self.spec}{' ' + frame if frame else ''})"

    def rows(self, n: int) -> str:
        return self.over(f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")

    def cum(self) -> str:
        return self.over("ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")

    def upto(self, n: int) -> str:
        return self.over(f"ROWS BETWEEN UNBOUNDED PRECEDING AND {n} PRECEDING")

    def lag(self, x: str, k: int = 1) -> str:
        return self.call(f"lag({x}, {k}) {self.over()}")

    def value(self, text: str) -> str:
        """An expression that several calls read, as a reference to its (shared) helper column."""
        return q(self.values.setdefault(text, f"__x{len(self.values)}"))

    def finite(self, x: str) -> str:
        """x, NULL where it is NaN or infinite: such a value must not stay in a running sum. One helper column for all calls."""
        return self.value(f"CASE WHEN abs({x}) < double('infinity') THEN {x} END")

    def count(self, x: str, n: int) -> str:
        x = self.finite(x)
        if n > self.threshold:
            return f"({self.call(f'count({x}) {self.cum()}')} - {self.call(f'count({x}) {self.upto(n)}')})"
        return self.call(f"count({x}) {self.rows(n)}")

    def raw_sum(self, x: str, n: int) -> str:
        x = self.finite(x)
        if n > self.threshold:
            return f"({self.call(f'sum({x}) {self.cum()}')} - coalesce({self.call(f'sum({x}) {self.upto(n)}')}, 0D))"
        return self.call(f"sum({x}) {self.rows(n)}")

    def full(self, x: str, n: int) -> str:
        return f"{self.count(x, n)} = {n}"

    def guard(self, x: str, n: int, expr: str) -> str:
        return f"CASE WHEN {self.full(x, n)} THEN {expr} END"

    def sum(self, x: str, n: int) -> str:
        return self.guard(x, n, self.raw_sum(x, n))

    def mean(self, x: str, n: int) -> str:
        return self.guard(x, n, f"{self.raw_sum(x, n)} / {n}D")

    def max(self, x: str, n: int) -> str:
        return self.guard(x, n, self.extreme("max", x, n))

    def min(self, x: str, n: int) -> str:
        return self.guard(x, n, self.extreme("min", x, n))

    def extreme(self, of: str, x: str, n: int) -> str:
        """`of` (max or min) over the last n rows, NULLs left out.

        A sliding frame reads all its rows for each row, so only short frames slide. A longer one is the extreme
        of two shorter ones that may overlap, the second one by a lag; spans of falling halves are shared by
        all lengths, so a row costs O(log n). Every span is a helper column of its own (`value`).
        """
        if n <= SLIDING:
            return self.call(f"{of}({x}) {self.rows(n)}")
        pick = "greatest" if of == "max" else "least"
        size = SLIDING
        span = self.call(f"{of}({x}) {self.rows(size)}")
        while size < n:
            step = min(size, n - size)
            span = self.value(f"{pick}({span}, {self.lag(span, step)})")
            size += step
        return span

    def moments(self, x: str, tag: str, n: int) -> tuple[list[list[tuple[str, str]]], str]:
        """Stages of the mean and the sums of 2nd to 4th powers about it (m, a, b, c) over n rows, and their column.

        The moments of 2k rows are those of the last k and, by a lag, of the k before, put together by the
        pairwise update formulas; n rows are put together from such windows of falling powers of two. One
        formula at all lengths, no power sums of raw values, and 0 exactly where all values are equal; NULL
        while a value is NULL or not finite. Specs on the same series share the windows by their tag.
        """
        name = f"__mom_{tag}_"
        stages = [[(f"{name}1", f"CASE WHEN {self.finite(x)} IS NOT NULL THEN named_struct('m', {self.finite(x)}, 'a', 0D, 'b', 0D, 'c', 0D) END")]]
        size = 1
        while 2 * size <= n:
            stages.append([(f"{name}{2 * size}", _merged(q(f"{name}{size}"), self.lag(q(f"{name}{size}"), size), size, size))])
            size *= 2
        have = size
        while have < n:
            size = 1 << ((n - have).bit_length() - 1)
            stages.append([(f"{name}{have + size}_of{n}", _merged(q(f"{name}{have}" + (f"_of{n}" if have & (have - 1) else "")),
                                                                  self.lag(q(f"{name}{size}"), have), have, size))])
            have += size
        return stages, q(f"{name}{n}" + (f"_of{n}" if n & (n - 1) else ""))

    def weighted(self, x: str, n: int) -> tuple[str, str]:
        """Σ y and Σ i·y over the frame, y = x − first close, i = 1..n from the oldest row.

        Weights grow along the series, so these sums use a sliding frame and centred
        values: differences of running sums would lose the digits on long chunks.
        """
        y = f"({x} - {C0})"
        sy = self.call(f"sum({y}) {self.rows(n)}")
        sry = self.call(f"sum({RN} * {y}) {self.rows(n)}")
        return sy, f"({sry} - ({RN} - {n}D) * {sy})"

    def wma(self, x: str, n: int) -> str:
        """Linear weights 1..n, newest heaviest."""
        _, sxy = self.weighted(x, n)
        return self.guard(x, n, f"{C0} + {sxy} / {n * (n + 1) / 2.0!r}D")

    def linreg(self, y: str, n: int) -> str:
        """OLS fit of y on x = 1..n over the last n rows, evaluated at the newest row."""
        sy, sxy = self.weighted(y, n)
        sx, sxx = n * (n + 1) / 2.0, n * (n + 1) * (2 * n + 1) / 6.0
        slope = f"(({n}D * {sxy} - {sx!r}D * {sy}) / {n * sxx - sx * sx!r}D)"
        return self.guard(y, n, f"({C0} + ({sy} - {slope} * {sx!r}D) / {n}D + {slope} * {n}D)")

    def smoothed(self, x: str, alpha: float) -> tuple[str, str]:
        """Sum of alpha * (1 - alpha)^age * x over all values so far, and their number; age counts values, not rows."""
        n = self.call(f"count({self.finite(x)}) {self.cum()}")
        return f"({self.call(f'{EWM}{alpha!r}|{self.finite(x)}')} * (1D - power({1 - alpha!r}D, {n})))", n

    def rma(self, x: str, name: str, n: int, alpha: float | None = None) -> list[list[tuple[str, str]]]:
        """Stages of `name`: smoothing by 1/n from the first value on, NULL before the n-th and where x is."""
        alpha = 1.0 / n if alpha is None else alpha
        a, k = self.smoothed(x, alpha)
        first = self.call(f"first({self.finite(x)}, true) {self.cum()}")
        return [[(name, f"CASE WHEN {self.finite(x)} IS NOT NULL AND {k} >= {n} THEN {a} + power({1 - alpha!r}D, {k}) * {first} END")]]

    def ema(self, x: str, name: str, n: int) -> list[list[tuple[str, str]]]:
        """Stages of `name`: smoothing by 2/(n + 1) from the first full window's mean on, NULL before it and where x is.

        Values before the seed are in the running sum as well; what they add is known at the seed row
        and fades from there like the seed itself, so one correction puts both right.
        """
        alpha = 2.0 / (n + 1)
        a, k = self.smoothed(x, alpha)
        sa, sk, sm = (f"__s{c}_{name}" for c in "akm")
        seed = f"CASE WHEN {q(sm)} IS NOT NULL THEN named_struct('d', {q(sm)} - {q(sa)}, 'k', {q(sk)}) END"
        seed = self.call(f"first({seed}, true) {self.cum()}")
        return [[(sa, a), (sk, k), (sm, self.mean(x, n))],
                [(name, f"CASE WHEN {self.finite(x)} IS NOT NULL THEN {q(sa)} + power({1 - alpha!r}D, {q(sk)} - {seed}.k) * {seed}.d END")]]


def _merged(x: str, y: str, nx: int, ny: int) -> str:
    """Moments of two neighbouring windows of nx and ny rows as those of both together."""
    n, d = float(nx + ny), f"({y}.m - {x}.m)"
    parts = {
        "m": f"{x}.m + {d} * {ny / n!r}D",
        "a": f"{x}.a + {y}.a + {d} * {d} * {nx * ny / n!r}D",
        "b": f"{x}.b + {y}.b + {d} * {d} * {d} * {nx * ny * (nx - ny) / n**2!r}D + 3D * {d} * ({nx / n!r}D * {y}.a - {ny / n!r}D * {x}.a)",
        "c": f"{x}.c + {y}.c + {d} * {d} * {d} * {d} * {nx * ny * (nx**2 - nx * ny + ny**2) / n**3!r}D"
             f" + 6D * {d} * {d} * ({nx**2 / n**2!r}D * {y}.a + {ny**2 / n**2!r}D * {x}.a) + 4D * {d} * ({nx / n!r}D * {y}.b - {ny / n!r}D * {x}.b)",
    }
    fields = ", ".join(f"'{k}', {e}" for k, e in parts.items())
    return f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN named_struct({fields}) END"


def _std(stages_and_moments, n: int) -> tuple[list[list[tuple[str, str]]], str]:
    stages, m = stages_and_moments
    return stages, f"sqrt({m}.a / {n - 1}D)" if n > 1 else "CAST(NULL AS DOUBLE)"


def beside(*parts: list[list[tuple[str, str]]]) -> list[list[tuple[str, str]]]:
    """Stages of parts that do not use each other."""
    return [[pair for stage in stages for pair in stage] for stages in zip_longest(*parts, fillvalue=[])]


def base_stage(w: Sql) -> list[tuple[str, str]]:
    c1 = w.lag(C)
    return [
        ("__c1", c1),
        ("__h1", w.lag(H)),
        ("__l1", w.lag(L)),
        ("__v1", w.lag(V)),
        ("__rn", f"CAST(row_number() {w.over()} AS DOUBLE)"),
        ("__c0", f"first({C}, true) {w.cum()}"),
        ("__tr", f"CASE WHEN {c1} IS NOT NULL THEN greatest({H} - {L}, abs({H} - {c1}), abs({L} - {c1})) END"),
        ("__tp", f"({H} + {L} + {C}) / 3D"),
    ]


def _p(*vals) -> str:
    return "_".join(str(x) for x in vals)


CLV = f"CASE WHEN {H} != {L} THEN (({C} - {L}) - ({H} - {C})) / ({H} - {L}) ELSE 0D END"


# ---------------------------------------------------------------- momentum
def stoch(w, k=14, d=3, smooth_k=3):
    p = _p(k, d, smooth_k)
    ll, hh = w.min(L, k), w.max(H, k)
    raw = f"__stoch_raw{k}"
    return [[(raw, f"100D * {div(f'{C} - {ll}', f'{hh} - {ll}')}")],
            [(f"STOCHk_{p}", w.mean(q(raw), smooth_k))],
            [(f"STOCHd_{p}", w.mean(q(f"STOCHk_{p}"), d))]]


def roc(w, length=10):
    return [[(f"ROC_{length}", f"100D * ({div(C, w.lag(C, length))} - 1D)")]]


def mom(w, length=10):
    return [[(f"MOM_{length}", f"{C} - {w.lag(C, length)}")]]


def bop(w):
    return [[("BOP", div(f"{C} - {O}", f"{H} - {L}"))]]


def cmo(w, length=14):
    # NULL on the first row (no previous close), so a window needs n real moves.
    up = f"CASE WHEN {C1} IS NOT NULL THEN greatest({C} - {C1}, 0D) END"
    dn = f"CASE WHEN {C1} IS NOT NULL THEN greatest({C1} - {C}, 0D) END"
    su, sd = w.sum(up, length), w.sum(dn, length)
    return [[(f"CMO_{length}", f"100D * {div(f'{su} - {sd}', f'{su} + {sd}')}")]]


def er(w, length=10):
    return [[(f"ER_{length}", div(f"abs({C} - {w.lag(C, length)})", w.sum(f"abs({C} - {C1})", length)))]]


def kst(w, roc1=10, roc2=15, roc3=20, roc4=30, sma1=10, sma2=10, sma3=10, sma4=15, signal=9):
    rocs, smas = (roc1, roc2, roc3, roc4), (sma1, sma2, sma3, sma4)
    p = _p(*rocs, *smas)
    s1 = [(f"__kst_r{r}", f"100D * ({div(C, w.lag(C, r))} - 1D)") for r in rocs]
    total = " + ".join(f"{i}D * {w.mean(q(f'__kst_r{r}'), n)}" for i, (r, n) in enumerate(zip(rocs, smas), 1))
    return [s1, [(f"KST_{p}", total)], [(f"KSTs_{signal}", w.mean(q(f"KST_{p}"), signal))]]


def _swma4(w, x: str) -> str:
    """Symmetric weighted mean of the last 4 values, weights 1, 2, 2, 1 over 6."""
    return f"({w.lag(x, 3)} + 2D * {w.lag(x, 2)} + 2D * {w.lag(x, 1)} + {x}) / 6D"


def rvgi(w, length=14, swma_length=4):
    name, n_, d_ = f"RVGI_{length}", f"__rvgi_n{length}", f"__rvgi_d{length}"
    return [
        [(n_, _swma4(w, f"({C} - {O})")), (d_, _swma4(w, f"({H} - {L})"))],
        [(name, div(w.sum(q(n_), length), w.sum(q(d_), length)))],
        [(f"RVGIs_{length}", _swma4(w, q(name)))],
    ]


def uo(w, fast=7, middle=14, slow=28):
    lo = f"least({L}, {C1})"  # least() skips NULL: the first row uses low
    bp, rng = f"({C} - {lo})", f"(greatest({H}, {C1}) - {lo})"
    a = [div(w.sum(bp, n), w.sum(rng, n)) for n in (fast, middle, slow)]
    return [[(f"UO_{_p(fast, middle, slow)}", f"100D * (4D * {a[0]} + 2D * {a[1]} + {a[2]}) / 7D")]]


def willr(w, length=14):
    hh, ll = w.max(H, length), w.min(L, length)
    return [[(f"WILLR_{length}", f"-100D * {div(f'{hh} - {C}', f'{hh} - {ll}')}")]]


def cfo(w, length=9):
    return [[(f"CFO_{length}", f"100D * {div(f'{C} - {w.linreg(C, length)}', C)}")]]


def cg(w, length=10):
    # Σ (age + 1)·c with age 0 at the newest row; Σ i·c and Σ c are put back from their centred sums
    n = length
    sy, sxy = w.weighted(C, n)
    sc = f"({sy} + {n}D * {C0})"
    numer = f"({n + 1}D * {sc} - ({sxy} + {n * (n + 1) / 2.0!r}D * {C0}))"
    return [[(f"CG_{length}", w.guard(C, length, f"-{div(numer, sc)}"))]]


def cti(w, length=12):
    return [[(f"CTI_{length}", w.guard(C, length, f"corr({C}, {RN}) {w.rows(length)}"))]]


# ------------------------------------------------------------------- trend
def aroon(w, length=14):
    n = length + 1
    # The latest extreme wins ties: max over (value, rn), min over (value, -rn).
    up_age = f"({RN} - {w.extreme('max', w.value(f"named_struct('v', {H}, 'r', {RN})"), n)}.r)"
    dn_age = f"({RN} + {w.extreme('min', w.value(f"named_struct('v', {L}, 'r', -{RN})"), n)}.r)"
    full = f"{w.full(H, n)} AND {w.full(L, n)}"
    return [[(f"AROOND_{length}", f"CASE WHEN {full} THEN 100D * (1D - {dn_age} / {length}D) END"),
             (f"AROONU_{length}", f"CASE WHEN {full} THEN 100D * (1D - {up_age} / {length}D) END")],
            [(f"AROONOSC_{length}", f"{q(f'AROONU_{length}')} - {q(f'AROOND_{length}')}")]]


def chop(w, length=14):
    ratio = div(w.sum(TR, length), f"({w.max(H, length)} - {w.min(L, length)})")
    return [[(f"CHOP_{length}",
              f"CASE WHEN {ratio} > 0 THEN 100D * log10({ratio}) / {math.log10(length)!r}D END")]]


def dpo(w, length=20, lookahead=False):
    t = length // 2 + 1
    s = f"__dpo_sma{length}"
    return [[(s, w.mean(C, length))], [(f"DPO_{length}", f"{C} - {w.lag(q(s), t)}")]]


def qstick(w, length=10):
    return [[(f"QS_{length}", w.mean(f"({C} - {O})", length))]]


def vhf(w, length=28):
    return [[(f"VHF_{length}", div(f"{w.max(C, length)} - {w.min(C, length)}",
                                   w.sum(f"abs({C} - {C1})", length)))]]


def vortex(w, length=14):
    s_tr = w.sum(TR, length)
    return [[(f"VTXP_{length}", div(w.sum(f"abs({H} - {L1})", length), s_tr)),
             (f"VTXM_{length}", div(w.sum(f"abs({L} - {H1})", length), s_tr))]]


# ----------------------------------------------------------------- overlap
def sma(w, length=10):
    return [[(f"SMA_{length}", w.mean(C, length))]]


def wma(w, length=10):
    return [[(f"WMA_{length}", w.wma(C, length))]]


def hma(w, length=10):
    half, root = length // 2, int(math.isqrt(length))
    a, b = f"__hma_a{length}", f"__hma_b{length}"
    return [[(a, w.wma(C, half)), (b, w.wma(C, length))],
            [(f"HMA_{length}", w.wma(f"(2D * {q(a)} - {q(b)})", root))]]


def vwma(w, length=10):
    return [[(f"VWMA_{length}", w.guard(f"({C} * {V})", length,
                                        div(w.raw_sum(f"{C} * {V}", length), w.raw_sum(V, length))))]]


def vwap(w):
    """Σ tp·v / Σ v since UTC midnight (anchor D)."""
    if w.day_chunks:
        # A chunk's own rows all lie on chunk_date and follow its warm-up rows,
        # so summing only same-day rows over the running frame is the
        # since-midnight sum, without a second partitioning.
        today = "`date` = `chunk_date`"
        num_ = f"sum(CASE WHEN {today} THEN {TP} * {V} END) {w.cum()}"
        den = f"sum(CASE WHEN {today} THEN {V} END) {w.cum()}"
        return [[("VWAP_D", f"CASE WHEN {today} THEN {div(num_, den)} END")]]
    spec = (f"OVER (PARTITION BY {', '.join(q(k) for k in w.keys)}, `date` ORDER BY {q(w.order)} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    return [[("VWAP_D", div(f"sum({TP} * {V}) {spec}", f"sum({V}) {spec}"))]]


def bbands(w, length=5, std=2.0):
    p = _p(length, float(std), float(std))
    lo, mid, hi = q(f"BBL_{p}"), q(f"BBM_{p}"), q(f"BBU_{p}")
    stages, sd = _std(w.moments(C, "c", length), length)
    m = w.mean(C, length)
    return [*stages, [(f"BBL_{p}", f"{m} - {float(std)!r}D * {sd}"), (f"BBM_{p}", m),
             (f"BBU_{p}", f"{m} + {float(std)!r}D * {sd}")],
            [(f"BBB_{p}", f"100D * {div(f'{hi} - {lo}', mid)}"),
             (f"BBP_{p}", div(f"{C} - {lo}", f"{hi} - {lo}"))]]


def donchian(w, lower_length=20, upper_length=20):
    p = _p(lower_length, upper_length)
    lo, hi = w.min(L, lower_length), w.max(H, upper_length)
    return [[(f"DCL_{p}", lo), (f"DCM_{p}", f"({lo} + {hi}) / 2D"), (f"DCU_{p}", hi)]]


def linreg(w, length=14):
    return [[(f"LR_{length}", w.linreg(C, length))]]


def midpoint(w, length=2):
    return [[(f"MIDPOINT_{length}", f"({w.max(C, length)} + {w.min(C, length)}) / 2D")]]


def midprice(w, length=2):
    return [[(f"MIDPRICE_{length}", f"({w.max(H, length)} + {w.min(L, length)}) / 2D")]]


def ichimoku(w, tenkan=9, kijun=26, senkou=52, lookahead=False):
    def mid(n):
        return f"({w.max(H, n)} + {w.min(L, n)}) / 2D"
    ts, ks, sb = f"ITS_{tenkan}", f"IKS_{kijun}", f"__isb_{senkou}"
    shift = kijun - 1
    return [[(ts, mid(tenkan)), (ks, mid(kijun)), (sb, mid(senkou))],
            [(f"ISA_{tenkan}", w.lag(f"(({q(ts)} + {q(ks)}) / 2D)", shift)),
             (f"ISB_{kijun}", w.lag(q(sb), shift))]]


# -------------------------------------------------------------- volatility
def true_range(w):
    return [[("TRUERANGE_1", TR)]]


def stdev(w, length=30):
    stages, sd = _std(w.moments(C, "c", length), length)
    return [*stages, [(f"STDEV_{length}", sd)]]


def accbands(w, length=20):
    ratio = div(f"4D * ({H} - {L})", f"({H} + {L})")
    return [[(f"ACCBL_{length}", w.mean(f"({L} * (1D - {ratio}))", length)),
             (f"ACCBM_{length}", w.mean(C, length)),
             (f"ACCBU_{length}", w.mean(f"({H} * (1D + {ratio}))", length))]]


# ------------------------------------------------------------------ volume
def ad(w):
    return [[("AD", f"sum(({CLV}) * {V}) {w.cum()}")]]


def obv(w):
    step = f"CASE WHEN {RN} = 1 THEN {V} ELSE signum({C} - {C1}) * {V} END"
    return [[("OBV", f"sum({step}) {w.cum()}")]]


def mfi(w, length=14):
    tp1 = w.lag(TP)
    raw = f"({TP} * {V})"
    pos = f"CASE WHEN {tp1} IS NOT NULL THEN CASE WHEN {TP} > {tp1} THEN {raw} ELSE 0D END END"
    neg = f"CASE WHEN {tp1} IS NOT NULL THEN CASE WHEN {TP} < {tp1} THEN {raw} ELSE 0D END END"
    p_, n_ = f"__mfi_p{length}", f"__mfi_n{length}"
    sp, sn = w.sum(q(p_), length), w.sum(q(n_), length)
    return [[(p_, pos), (n_, neg)], [(f"MFI_{length}", f"100D * {div(sp, f'{sp} + {sn}')}")]]


def cmf(w, length=20):
    return [[(f"CMF_{length}", w.guard(C, length,
                                       div(w.raw_sum(f"({CLV}) * {V}", length), w.raw_sum(V, length))))]]


def _ratio_index(w, cond: str, name: str):
    """1000 × product of c/c₁ over rows where cond holds, as 1000·exp(Σ ln)."""
    step = f"CASE WHEN {C1} IS NULL THEN 0D WHEN {cond} THEN ln({div(C, C1)}) ELSE 0D END"
    return [[(name, f"1000D * exp(sum({step}) {w.cum()})")]]


def pvi(w):
    return _ratio_index(w, f"{V} > {V1}", "PVI")


def nvi(w):
    return _ratio_index(w, f"{V} < {V1}", "NVI")


def pvt(w):
    return [[("PVT", f"sum({V} * {div(f'{C} - {C1}', C1)}) {w.cum()}")]]


# ----------------------------------------------------------------- returns
def _growth(w, length, cumulative):
    """c over the close `length` rows back, or over the chunk's first close."""
    return div(C, C0 if cumulative else (C1 if length == 1 else w.lag(C, length)))


def log_return(w, length=1, cumulative=False):
    return [[(f"{'CUM' if cumulative else ''}LOGRET_{length}", f"ln({_growth(w, length, cumulative)})")]]


def percent_return(w, length=1, cumulative=False):
    return [[(f"{'CUM' if cumulative else ''}PCTRET_{length}", f"{_growth(w, length, cumulative)} - 1D")]]


# -------------------------------------------------------------- statistics
def entropy(w, length=10, base=2.0):
    p = q(f"__entp_p{length}")
    return [[(f"__entp_p{length}", div(C, w.sum(C, length)))],
            [(f"ENTP_{length}", w.sum(f"(-{p} * log({float(base)!r}D, {p}))", length))]]


def zscore(w, length=30):
    moments, m = w.moments(C, "c", length)
    stages, sd = _std((moments, m), length)
    return [*stages, [(f"ZS_{length}", div(f"{C} - {m}.m", sd))]]


def skew(w, length=30):
    """Sample skewness."""
    n = length
    stages, m = w.moments(C, "c", n)
    k = math.sqrt(n) * math.sqrt(n * (n - 1)) / (n - 2) if n > 2 else None
    return [*stages, [(f"SKEW_{n}", f"{k!r}D * {div(f'{m}.b', f'({m}.a * sqrt({m}.a))')}" if k else "CAST(NULL AS DOUBLE)")]]


def kurtosis(w, length=30):
    """Sample excess kurtosis."""
    n = length
    stages, m = w.moments(C, "c", n)
    g2 = f"({n}D * {div(f'{m}.c', f'({m}.a * {m}.a)')} - 3D)"
    value = f"{(n - 1) / ((n - 2) * (n - 3))!r}D * ({n + 1}D * {g2} + 6D)" if n > 3 else "CAST(NULL AS DOUBLE)"
    return [*stages, [(f"KURT_{n}", value)]]


def variance(w, length=30):
    stages, m = w.moments(C, "c", length)
    return [*stages, [(f"VAR_{length}", f"{m}.a / {length - 1}D" if length > 1 else "CAST(NULL AS DOUBLE)")]]


# ----------------------------------------------------------------- candles
def ohlc4(w):
    return [[("OHLC4", f"({O} + {H} + {L} + {C}) / 4D")]]


def hl2(w):
    return [[("HL2", f"({H} + {L}) / 2D")]]


def hlc3(w):
    return [[("HLC3", f"({H} + {L} + {C}) / 3D")]]


# ------------------------------------------------------ linear recurrences
MOVE = f"({C} - {C1})"


def _ema_of(w, x, tag, n):
    """(stages, column) of an EMA; specs that smooth the same series share it by its tag."""
    name = f"__ema{n}_{tag}"
    return w.ema(x, name, n), q(name)


def _emas_of(w, x, tag, n, depth):
    """(stages, columns) of an EMA, the EMA of that, and so on."""
    stages, out = [], []
    for _ in range(depth):
        made, x = _ema_of(w, x, tag, n)
        stages, tag = stages + made, f"{n}_{tag}"
        out.append(x)
    return stages, out


def _rma_of(w, x, tag, n):
    name = f"__rma{n}_{tag}"
    return w.rma(x, name, n), q(name)


def _rsi_of(w, n):
    """Stages of the RSI of close, and its column."""
    up = f"CASE WHEN {C1} IS NOT NULL THEN greatest({MOVE}, 0D) END"
    dn = f"CASE WHEN {C1} IS NOT NULL THEN greatest(-{MOVE}, 0D) END"
    (su, u), (sd, d) = _rma_of(w, up, "up", n), _rma_of(w, dn, "down", n)
    return [*beside(su, sd), [(f"__rsi{n}", f"100D * {div(u, f'{u} + {d}')}")]], q(f"__rsi{n}")


def rsi(w, length=14):
    stages, r = _rsi_of(w, length)
    return [*stages, [(f"RSI_{length}", r)]]


def stochrsi(w, length=14, rsi_length=14, k=3, d=3):
    stages, r = _rsi_of(w, rsi_length)
    lo, hi = w.min(r, length), w.max(r, length)
    raw, kk = f"__srsi_{_p(length, rsi_length)}", f"STOCHRSIk_{length}"
    return [*stages, [(raw, f"100D * {div(f'{r} - {lo}', f'{hi} - {lo}')}")], [(kk, w.mean(q(raw), k))],
            [(f"STOCHRSId_{length}", w.mean(q(kk), d))]]


def _two_emas(w, x, tag, fast, slow):
    (sf, f), (ss, s) = _ema_of(w, x, tag, fast), _ema_of(w, x, tag, slow)
    return beside(sf, ss), f, s


def _signal(w, line, name, signal_name, signal, hist_name=None):
    """Stages after those of `line`: the line, its EMA, and the difference of both."""
    out = [[(name, line)], *w.ema(q(name), signal_name, signal)]
    return out + ([[(hist_name, f"{q(name)} - {q(signal_name)}")]] if hist_name else [])


def macd(w, fast=12, slow=26, signal=9):
    p = _p(fast, slow, signal)
    stages, f, s = _two_emas(w, C, "c", fast, slow)
    return stages + _signal(w, f"{f} - {s}", f"MACD_{p}", f"MACDs_{p}", signal, f"MACDh_{p}")


def ppo(w, fast=12, slow=26, signal=9):
    p = _p(fast, slow, signal)
    stages, f, s = _two_emas(w, C, "c", fast, slow)
    return stages + _signal(w, f"100D * {div(f'{f} - {s}', s)}", f"PPO_{p}", f"PPOs_{p}", signal, f"PPOh_{p}")


def apo(w, fast=12, slow=26):
    stages, f, s = _two_emas(w, C, "c", fast, slow)
    return [*stages, [(f"APO_{_p(fast, slow)}", f"{f} - {s}")]]


def pgo(w, length=14):
    stages, e = _ema_of(w, TR, "tr", length)
    return [*stages, [(f"PGO_{length}", div(f"{C} - {w.mean(C, length)}", e))]]


def smi(w, length=14, smooth=3):
    hh, ll = w.max(H, length), w.min(L, length)
    m, r = f"__smi_m{length}", f"__smi_r{length}"
    (sn, n), (sd, d) = _emas_of(w, q(m), f"smi_m{length}", smooth, 2), _emas_of(w, q(r), f"smi_r{length}", smooth, 2)
    line = f"100D * {div(n[1], f'(0.5D * {d[1]})')}"
    return [[(m, f"{C} - ({hh} + {ll}) / 2D"), (r, f"{hh} - {ll}")], *beside(sn, sd), *_signal(w, line, f"SMI_{length}", f"SMIs_{length}", smooth)]


def trix(w, length=18, signal=9):
    stages, e = _emas_of(w, C, "c", length, 3)
    name = f"TRIX_{length}"
    return [*stages, [(name, f"100D * ({div(e[2], w.lag(e[2]))} - 1D)")], [(f"TRIXs_{length}", w.mean(q(name), signal))]]


def tsi(w, long=25, short=13, signal=13):
    def twice(x, tag):
        first, e = _ema_of(w, x, tag, long)
        second, y = _ema_of(w, e, f"{long}_{tag}", short)
        return first + second, y

    p = _p(long, short)
    (sn, n), (sd, d) = twice(MOVE, "move"), twice(f"abs({MOVE})", "size")
    return beside(sn, sd) + _signal(w, f"100D * {div(n, d)}", f"TSI_{p}", f"TSIs_{p}", signal)


def inertia(w, length=20, rvi_length=14):
    sd, up, rvi = (f"__inertia_{x}{rvi_length}" for x in ("sd", "up", "rvi"))
    (su, u), (sa, a) = _ema_of(w, q(up), up, rvi_length), _ema_of(w, q(sd), sd, rvi_length)
    stages, spread = _std(w.moments(C, "c", rvi_length), rvi_length)
    return [*stages, [(sd, spread)], [(up, f"CASE WHEN {MOVE} > 0 THEN {q(sd)} ELSE 0D * {q(sd)} END")], *beside(su, sa),
            [(rvi, f"100D * {div(u, a)}")], [(f"INERTIA_{length}", w.linreg(q(rvi), length))]]


def adx(w, length=14):
    up, dn = f"({H} - {H1})", f"({L1} - {L})"
    pdm = f"CASE WHEN {up} > {dn} AND {up} > 0 THEN {up} ELSE 0D * {up} END"
    mdm = f"CASE WHEN {dn} > {up} AND {dn} > 0 THEN {dn} ELSE 0D * {dn} END"
    (st, atr_), (sp, p), (sm, m) = _rma_of(w, TR, "tr", length), _rma_of(w, pdm, "pdm", length), _rma_of(w, mdm, "mdm", length)
    dmp, dmn, dx = f"DMP_{length}", f"DMN_{length}", f"__dx{length}"
    return [*beside(st, sp, sm), [(dmp, f"100D * {div(p, atr_)}"), (dmn, f"100D * {div(m, atr_)}")],
            [(dx, f"100D * {div(f'abs({q(dmp)} - {q(dmn)})', f'({q(dmp)} + {q(dmn)})')}")], *w.rma(q(dx), f"ADX_{length}", length)]


def ema(w, length=10):
    stages, e = _ema_of(w, C, "c", length)
    return [*stages, [(f"EMA_{length}", e)]]


def rma(w, length=10):
    stages, y = _rma_of(w, C, "c", length)
    return [*stages, [(f"RMA_{length}", y)]]


def t3(w, length=10, a_=0.7):
    stages, e = _emas_of(w, C, "c", length, 6)
    k = a_
    weights = (-(k**3), 3 * k**2 + 3 * k**3, -6 * k**2 - 3 * k - 3 * k**3, 1 + 3 * k + k**3 + 3 * k**2)
    return [*stages, [(f"T3_{length}", " + ".join(f"{num(c)} * {x}" for c, x in zip(weights, reversed(e))))]]


def tema(w, length=10):
    stages, (e1, e2, e3) = _emas_of(w, C, "c", length, 3)
    return [*stages, [(f"TEMA_{length}", f"3D * {e1} - 3D * {e2} + {e3}")]]


def dema(w, length=10):
    stages, (e1, e2) = _emas_of(w, C, "c", length, 2)
    return [*stages, [(f"DEMA_{length}", f"2D * {e1} - {e2}")]]


def kc(w, length=20, scalar=2.0):
    (sm, mid), (sr, rng) = _ema_of(w, C, "c", length), _ema_of(w, TR, "tr", length)
    return [*beside(sm, sr), [(f"KCL_{length}", f"{mid} - {num(scalar)} * {rng}"), (f"KCM_{length}", mid), (f"KCU_{length}", f"{mid} + {num(scalar)} * {rng}")]]


def atr(w, length=14):
    stages, y = _rma_of(w, TR, "tr", length)
    return [*stages, [(f"ATR_{length}", y)]]


def natr(w, length=14):
    stages, y = _rma_of(w, TR, "tr", length)
    return [*stages, [(f"NATR_{length}", f"100D * {div(y, C)}")]]


def aberration(w, length=5, atr_length=15):
    stages, y = _rma_of(w, TR, "tr", atr_length)
    zg = q(f"ABER_ZG_{length}")
    return [*beside(stages, [[(f"ABER_ZG_{length}", w.mean(TP, length))]]),
            [(f"ABER_SG_{length}", f"{zg} + {y}"), (f"ABER_XG_{length}", f"{zg} - {y}"), (f"ABER_ATR_{length}", y)]]


def adosc(w, fast=3, slow=10):
    stages, f, s = _two_emas(w, q("__adl"), "ad", fast, slow)
    return [[("__adl", f"coalesce(sum(({CLV}) * {V}) {w.cum()}, 0D)")], *stages, [(f"ADOSC_{_p(fast, slow)}", f"{f} - {s}")]]


def kvo(w, fast=34, slow=55, signal=13):
    p = _p(fast, slow, signal)
    stages, f, s = _two_emas(w, f"({V} * signum({TP} - {q('__tp1')}))", "vf", fast, slow)
    return [[("__tp1", w.lag(TP))], *stages, *_signal(w, f"{f} - {s}", f"KVO_{p}", f"KVOs_{p}", signal)]


def aobv(w, length=2, fast=4, slow=12, lookback=2):
    (_, step), = obv(w)[0]
    line = q("OBV")
    stages, f, s = _two_emas(w, line, "obv", fast, slow)
    ef, es = q(f"OBVe_{fast}"), q(f"OBVe_{slow}")

    def runs(name, op):
        flag = f"__{name}_{_p(fast, slow)}"
        both = f"{ef} IS NOT NULL AND {es} IS NOT NULL"
        return [[(flag, f"CASE WHEN {ef} {op} {es} THEN 1D ELSE 0D END")],
                [(f"{name}_{length}", f"CASE WHEN {both} THEN CASE WHEN {w.sum(q(flag), length)} = {length} THEN 1D ELSE 0D END END")]]

    return [[("OBV", f"coalesce({step}, 0D)")], [(f"OBV_min_{lookback}", w.min(line, lookback)), (f"OBV_max_{lookback}", w.max(line, lookback))],
            *stages, [(f"OBVe_{fast}", f), (f"OBVe_{slow}", s)], *beside(runs("AOBV_LR", ">"), runs("AOBV_SR", "<"))]


def ha(w):
    hc, ho = q("HA_close"), q("HA_open")
    return [[("HA_close", f"({O} + {H} + {L} + {C}) / 4D")], [("__ha_in", f"CASE WHEN {RN} = 1D THEN ({O} + {C}) / 2D ELSE {w.lag(hc)} END")],
            *w.rma(q("__ha_in"), "HA_open", 1, 0.5), [("HA_high", f"greatest({H}, {ho}, {hc})"), ("HA_low", f"least({L}, {ho}, {hc})")]]


NATIVE = {
    f.__name__: f
    for f in (
        stoch, roc, mom, bop, cmo, er, kst, rvgi, uo, willr, cfo, cg, cti,
        aroon, chop, dpo, qstick, vhf, vortex,
        sma, wma, hma, vwma, vwap, bbands, donchian, linreg, midpoint, midprice, ichimoku,
        true_range, stdev, accbands,
        ad, obv, mfi, cmf, pvi, nvi, pvt,
        log_return, percent_return,
        entropy, zscore, skew, kurtosis, variance,
        ohlc4, hl2, hlc3,
        rsi, stochrsi, macd, ppo, apo, pgo, smi, trix, tsi, inertia, adx, ema, rma, t3, tema, dema, kc,
        atr, natr, aberration, adosc, kvo, aobv, ha,
    )
}
