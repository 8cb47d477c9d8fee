"""Risk-controlled quality rules.

Every rule is a share of a document between 0 and 1 (symbols, capitals, exclamation
marks, repeated neighbours); high shares are bad. Its cutoff is chosen in each
stratum (`lang`) on labelled documents: a cutoff may be used only if, by the exact
binomial bound, it rejects at most `risk / rules` of the good documents with the
required confidence, so all rules together reject at most `risk` of a stratum's good
documents. Multiple testing: the error `delta` is shared equally among all strata and
rules, and within one of these the cutoffs are tested in fixed sequence from the
laxest to stricter ones, ending at the first failure. Of the cutoffs that passed, the
one with the most bad documents rejected, less `PRICE` times the good ones, is taken;
without gain, or with too few labels, the rule rejects nothing in that stratum.

Base rule (always on): fewer than 10 words, or over 20 % of the words in five-word
windows that occur twice or more.

Results: a null text has no words and fails the base rule. A null `lang` is a stratum
of its own. Null ids, null labels and labels without a document don't count as
holdouts; of several labels of one id the lowest counts. A holdout is one text: the bound
needs independent draws, so repeated rows of an id and copies of a text in a stratum count
once, with the lowest label (of an id with several texts, the one with the smallest language and
hash counts). Repeated rows come out as often as they come in. Further columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.store import saved
from barwright.llm.words import ngram_hashes, split_words, steps, word_hashes

RULES = ("symbols", "capitals", "exclamations", "neighbours")
BINS = 64
RISK, DELTA, PRICE = 0.05, 0.05, 5
SMALL_STRATA = 10_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.int64)


def repeated_words(h: np.ndarray, row: np.ndarray, rows: int, n: int = 5) -> np.ndarray:
    """Words of each row that lie in an n-word window found twice or more in that row."""
    win, at = ngram_hashes(h, row, n)
    if not len(win):
        return np.zeros(rows, np.int64)
    order = np.lexsort((win, row[at]))
    same = (win[order][1:] == win[order][:-1]) & (row[at][order][1:] == row[at][order][:-1])
    twice = np.zeros(len(win), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + n, -1)
    return np.bincount(row, weights=np.cumsum(edge)[:-1] > 0, minlength=rows).astype(np.int64)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen, found = set(), 0
    if "\n" not in text:
        return 0
    for line in text.split("\n"):
        if line in seen:
            found += 1
        elif line.strip(" \t\n\r\x0b\x0c"):
            seen.add(line)
    return found


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every text, and the bin of each rule's share."""
    w = split_words(texts, lower=False)
    h = word_hashes(w)
    rows = w.rows
    code_points = np.concatenate([[0], np.cumsum((w.buf & 0xC0) != 0x80)])
    out = {
        "n_words": w.counts(),
        "word_chars": np.bincount(w.row, weights=code_points[w.end] - code_points[w.start], minlength=rows).astype(np.int64),
        "n_symbols": _per_row(_SYMBOL[w.buf], w.offsets),
        "n_dup_lines": np.array([duplicate_lines(t or "") for t in texts.to_pylist()], np.int64),
        "n_repeat_words": repeated_words(h, w.row, rows),
    }
    words, chars = np.maximum(out["n_words"], 1), np.maximum(out["word_chars"], 1)
    capitals = _per_row((w.buf >= 65) & (w.buf <= 90), w.offsets)
    marks = _per_row(w.buf == 33, w.offsets)
    pairs = np.flatnonzero((h[1:] == h[:-1]) & (w.row[1:] == w.row[:-1])) if len(h) else np.zeros(0, np.int64)
    neighbours = np.bincount(w.row[pairs], minlength=rows)
    for name, share in zip(RULES, (out["n_symbols"] / words, capitals / chars, marks / words, neighbours / words), strict=True):
        out[f"bin_{name}"] = np.floor(np.minimum(share, 1.0) * BINS).astype(np.int32)
    return out


def measured(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Columns `carry` of every row, the counts, and the rules' bins."""
    names = [*COUNTS, *(f"bin_{r}" for r in RULES)]
    src = docs.select(*carry, F.coalesce("text", F.lit("")).alias("__llm_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.drop("__llm_text").schema.fields]
    schema = ", ".join([*fields, *(f"{c} long" for c in COUNTS), *(f"bin_{r} int" for r in RULES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "__llm_text"):
            m = measures(b.column("__llm_text"))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in carry] + [pa.array(m[c]) for c in names], names=[*carry, *names])

    return src.mapInArrow(run, schema)


def base_failed(n_words, n_repeat_words):
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def binomial_cdf(x: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= x), exactly, as the regularised incomplete beta function I_{1-p}(n-x, x+1)."""
    if x >= n:
        return 1.0
    a, b, z = n - x, x + 1, 1 - p
    if z > (a + 1) / (a + b + 2):
        return 1 - _beta_fraction(b, a, p)
    return _beta_fraction(a, b, z)


def _beta_fraction(a: float, b: float, z: float) -> float:
    """I_z(a, b) by its continued fraction, evaluated by modified Lentz steps."""
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(z) + b * math.log1p(-z)) / a
    tiny = 1e-300
    f, c, d = 1.0, 1.0, 0.0
    for i in range(100_000):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * z / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * z / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 + term * d
        d = 1 / (d if abs(d) > tiny else tiny)
        c = 1 + term / c
        c = c if abs(c) > tiny else tiny
        f *= c * d
        if abs(1 - c * d) < 1e-14:
            break
    return min(1.0, front * (f - 1))


def choose_cutoff(good: np.ndarray, bad: np.ndarray, risk: float, delta: float) -> int:
    """Smallest rejected bin of one rule in one stratum (len(good): nothing is rejected).

    good, bad: documents of each bin. Cutoffs are tried from the last bin downwards.
    """
    n, x, y = int(good.sum()), 0, 0
    best, cutoff = 0, len(good)
    for t in range(len(good) - 1, 0, -1):
        x += int(good[t])
        y += int(bad[t])
        if n == 0 or binomial_cdf(x, n, risk) > delta:
            break
        if y - PRICE * x > best:
            best, cutoff = y - PRICE * x, t
    return cutoff


def cutoffs(features: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, cut array<int>): for each rule the smallest bin that is rejected.

    features: doc_id, lang, text_key and the rules' bins. Only counts by stratum, rule and bin are
    gathered, at most BINS + 1 rows for a rule and a label.
    """
    truth = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter("doc_id is not null and quality is not null")
    truth = truth.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    row = F.struct("lang", "text_key", *(f"bin_{r}" for r in RULES))
    held = features.select("doc_id", row.alias("row")).join(truth, "doc_id")
    held = held.groupBy("doc_id").agg(F.min("row").alias("row"), F.min("quality").alias("quality"))
    held = held.groupBy("row").agg(F.min("quality").alias("quality")).select("row.*", "quality")
    bins = F.explode(F.array(*(F.struct(F.lit(i).alias("rule"), F.col(f"bin_{r}").alias("bin")) for i, r in enumerate(RULES))))
    counts = (
        held.select("lang", "quality", bins.alias("b"))
        .groupBy("lang", "b.rule", "b.bin")
        .agg(F.sum((F.col("quality") > 0).cast("long")).alias("good"), F.sum((F.col("quality") <= 0).cast("long")).alias("bad"))
    )
    counts = saved(counts, "quality-counts")
    strata = max(1, counts.select("lang").distinct().count())
    share, level = risk / len(RULES), delta / (len(RULES) * strata)

    def pick(group: pd.DataFrame) -> pd.DataFrame:
        cut = []
        for rule in range(len(RULES)):
            rows = group[group["rule"] == rule]
            good, bad = (np.bincount(rows["bin"], weights=rows[c], minlength=BINS + 1) for c in ("good", "bad"))
            cut.append(choose_cutoff(good, bad, share, level))
        return pd.DataFrame({"stratum": [group["lang"].iloc[0]], "cut": [cut]})

    return counts.groupBy("lang").applyInPandas(pick, "stratum string, cut array<int>")


def judge(features: DataFrame, cuts: DataFrame) -> DataFrame:
    """`features` with base_failed and kept. `cuts` is broadcast if it is counted as small."""
    cuts = saved(cuts, "quality-cuts")
    if cuts.count() <= SMALL_STRATA:
        cuts = F.broadcast(cuts)
    rejected = F.lit(False)
    for i, r in enumerate(RULES):
        rejected = rejected | F.coalesce(F.col(f"bin_{r}") >= F.col("cut")[i], F.lit(False))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return (
        features.join(cuts, F.col("lang").eqNullSafe(F.col("stratum")), "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~rejected)
        .drop("stratum", "cut")
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, lang, text, and the hash by which copies of a text are told."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("text_key"))


def rate(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(doc_id, lang, text_key, counts, bins, base_failed, kept) of every row."""
    features = saved(measured(_keyed(docs), ["doc_id", "lang", "text_key"]), "quality-features")
    return judge(features, cutoffs(features, labels, risk, delta))


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of `docs` that pass; texts aren't shuffled, they are measured a second time."""
    cuts = cutoffs(measured(_keyed(docs), ["doc_id", "lang", "text_key"]), labels, risk, delta)
    return judge(measured(docs, docs.columns), cuts).filter("kept").select(*docs.columns)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return rate(docs, labels).select("doc_id", *COUNTS, "base_failed", "kept")
