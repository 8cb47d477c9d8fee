import collections
import math
import random

import numpy as np
import pyarrow as pa
from helpers import docs_of, odd_docs, words

from barwright.llm import quality_rules as q


def brute(text):
    w = words(text)
    seen = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines, repeated = set(), 0
    for line in (text or "").split("\n"):
        repeated += bool(words(line)) and line in lines
        lines.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(inside)


def test_counts():
    random.seed(8)
    texts = ["".join(random.choice("ab #|é😀\n \t") for _ in range(random.randint(0, 200))) for _ in range(60)]
    texts += [None, "", "a b c d e a b c d e", "x\nx\nx \n\n\n", "one " * 400, "a\x0bb\x0cc\x1cd　e"]
    got = q.measures(pa.array(texts))
    assert [tuple(int(got[c][i]) for c in q.COUNTS) for i in range(len(texts))] == [brute(t) for t in texts]


def test_binomial_bound_is_exact():
    for n, p in ((1, 0.5), (30, 0.02), (461, 0.0125), (2000, 0.01)):
        for x in {0, 1, 2, n // 50, n // 3, n - 1, n}:
            log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
            want = math.fsum(math.exp(log(i)) for i in range(min(x, n) + 1))
            assert abs(q.binomial_cdf(x, n, p) - want) < 1e-9, (n, p, x)


def test_cutoff_is_cautious():
    good, bad = np.zeros(65), np.zeros(65)
    good[0], bad[40:] = 5000, 10
    cut = q.choose_cutoff(good, bad, 0.0125, 0.003)
    assert 1 <= cut <= 40
    good[30] = 400  # a stricter cutoff would reject 8 % of the good ones
    assert 30 < q.choose_cutoff(good, bad, 0.0125, 0.003) <= 40
    assert q.choose_cutoff(np.where(np.arange(65) == 0, 50, 0), bad, 0.0125, 0.003) == 65  # too few labels
    assert q.choose_cutoff(np.zeros(65), bad, 0.0125, 0.003) == 65


def test_false_rejections_stay_below_the_risk():
    """Over many draws, a cutoff whose true rate is above the risk is used in at most a share delta of them."""
    rng = np.random.default_rng(9)
    rate = np.linspace(0, 0.08, 65)[::-1].copy()  # true share of good documents in the bins from t on
    broken = 0
    for _ in range(300):
        u = rng.random(3000)
        bins = np.searchsorted(-rate, -u, side="right") - 1
        good = np.bincount(np.clip(bins, 0, 64), minlength=65).astype(float)
        t = q.choose_cutoff(good, np.full(65, 500.0), 0.02, 0.05)
        broken += t < 65 and (1 - (u >= rate[t]).mean() > 0.02) and rate[t] > 0.02
    assert broken <= 300 * 0.05 + 10


def test_judged_rows(spark):
    clean = [f"this is a plain text number {i} about a few things that differ from page {i * 7} to page {i * 13} of it" for i in range(700)]
    junk = [" ".join(f"w{i}x{j} |" for j in range(30)) for i in range(80)]
    docs = docs_of(spark, clean + junk)
    labels = spark.createDataFrame([(i, int(i < 700), 0) for i in range(780)] + [(None, 1, 0), (5, None, 0), (99999, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in q.query(docs, labels).collect()}
    assert all(got[i].kept for i in range(700)) and not any(got[i].kept for i in range(700, 780))
    assert q.keep_good(docs, labels).count() == 700


def test_copies_are_one_holdout(spark):
    """150 different clean texts prove nothing, however often rows or texts repeat; 700 do."""
    clean = [f"this is a plain text number {i} about a few things that differ from page {i * 7} to page {i * 13} of it" for i in range(700)]
    junk = [" ".join(f"w{i}x{j} |" for j in range(30)) for i in range(80)]
    rows = [(i, clean[i]) for i in range(150) for _ in range(5)] + [(1000 + 150 * c + i, clean[i]) for i in range(150) for c in range(5)]
    rows += [(5000 + i, t) for i, t in enumerate(junk)]
    label = spark.createDataFrame([(i, int(i < 5000), 0) for i in range(6000)], "doc_id long, quality int, toxic int")
    few = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    assert few.count() == 1580 and q.query(few, label).filter("not kept and not base_failed").count() == 0
    many = spark.createDataFrame([(i, t, "en") for i, t in enumerate(clean)] + [(5000 + i, t, "en") for i, t in enumerate(junk)], few.schema)
    assert q.query(many, label).filter("not kept").count() == 80


def test_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = q.query(docs, labels).collect()
    want = [(r.doc_id, *brute(r.text)) for r in docs.collect()]
    assert sorted(tuple(r)[:6] for r in got if r.doc_id is not None) == sorted(w for w in want if w[0] is not None)
    assert len(got) == len(want) and all(r.kept != r.base_failed for r in got)
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.schema["size"].dataType == docs.schema["size"].dataType
    assert q.query(docs.limit(0), labels).count() == 0
