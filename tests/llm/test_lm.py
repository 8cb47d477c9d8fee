import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import DOCS, docs_of, lower, odd_docs, words

from barwright.llm import lm


def tokens(text):
    return [*words(lower(text)), "\0end"]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def brute(rows, prior, order):
    """Base and backoff scores by dictionaries; rows: (doc_id, text)."""
    count = collections.Counter()
    for i, t in rows:
        if not held(i):
            seq = ["\0begin", *tokens(t)]
            for n in range(1, order + 1):
                count.update(tuple(seq[k : k + n]) for k in range(len(seq) - n + 1))
    one = {k[0]: v for k, v in count.items() if len(k) == 1 and k[0] != "\0begin"}
    total, distinct = sum(one.values()), len(one)

    def p(history, w):
        if not history:
            return (one.get(w, 0) + 0.1) / (total + 0.1 * (distinct + 1))
        short = p(history[1:], w)
        seen = count.get(tuple(history), 0)
        return (count.get((*history, w), 0) + prior * short) / (seen + prior) if seen else short

    out = []
    for i, t in rows:
        seq = ["\0begin", *tokens(t)]
        base = sum(math.log10(p([], w)) for w in seq[1:])
        full = sum(math.log10(p(seq[max(0, k - order + 1) : k], seq[k])) for k in range(1, len(seq)))
        out.append((i, held(i), len(seq) - 1, sum(w in one for w in seq[1:]), total, base, full))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_match_dictionaries(spark, order):
    rng = np.random.default_rng(10)
    texts = [" ".join(rng.choice(list("ABcdeFgh"), rng.integers(0, 30))) for _ in range(120)]
    got = lm.score(docs_of(spark, texts), order=order, block_bytes=500, priors=(3.0,)).collect()
    want = brute(list(enumerate(texts)), 3.0, order)
    for a, b in zip(sorted(map(tuple, got)), sorted(want)):
        assert a[:5] == b[:5]
        assert np.allclose(a[5:7], b[5:7], rtol=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_probabilities_sum_to_one(order):
    """Over the whole vocabulary, the end and one unknown word, after seen, half seen and unknown histories."""
    training = ["a b a c", "b a", "c c a b", "a", "b c", "c a b a"] * 3
    histories, vocabulary = ["a", "b c", "c a b", "", "unknown", "unknown a"], ["a", "b", "c", "unseen"]
    asked = [f"{h} {w}" for h in histories for w in vocabulary] + histories
    block = lm.Block(pa.array(training + asked), np.array([False] * len(training) + [True] * len(asked)), order)
    ends = [len(t.split()) + 1 for t in training + asked]
    log10p = lm.BackoffAutomaton(block, block.needs(), sum(ends[: len(training)]), 4).walk(2.0)
    of_text = np.split(log10p, np.cumsum(ends)[:-1])[len(training) :]
    for i, h in enumerate(histories):
        after = len(h.split())
        total = sum(10 ** of_text[i * len(vocabulary) + j][after] for j in range(len(vocabulary))) + 10 ** of_text[len(histories) * len(vocabulary) + i][after]
        assert abs(total - 1) < 1e-12, (h, total)


def test_smoothing_is_chosen_by_likelihood(spark):
    """Ordered text favours the bigrams: the model beats its base on held-out texts."""
    rng = np.random.default_rng(11)
    names = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(400):
        k, seq = int(rng.integers(200)), []
        for _ in range(40):
            seq.append(names[k])
            k = (3 * k + int(rng.integers(0, 3))) % 200
        texts.append(" ".join(seq))
    got = [r for r in lm.query(docs_of(spark, texts)).collect() if r.held_out]
    assert got and sum(r.score for r in got) > 0.7 * sum(r.base_score for r in got)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = lm.score(docs, priors=(5.0,), block_bytes=4000).collect()
    want = brute(rows, 5.0, 2)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and np.allclose(a[5:7], b[5:7], rtol=1e-8)
    assert lm.query(docs.limit(0)).count() == 0
    alone = spark.createDataFrame([(None, "only held-out text", "en", "a", 1)], DOCS)
    r = lm.query(alone).collect()
    assert len(r) == 1
