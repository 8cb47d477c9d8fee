import random

import numpy as np
import pyarrow as pa
import xxhash
from helpers import docs_of, lower, odd_docs, words

from barwright.llm import simhash


def fingerprint(text, n=3):
    w = words(lower(text))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(fps, distance):
    fps = sorted(set(fps))
    up = {x: x for x in fps}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[:i]:
            if ((x ^ y) & (2**64 - 1)).bit_count() <= distance:
                up[top(x)] = top(y)
    return {x: top(x) for x in fps}


def test_fingerprints_and_bit_counts():
    random.seed(1)
    texts = [" ".join(random.choice("aa bb cc dd ee ff gg".split()) for _ in range(n)) for n in (0, 1, 2, 3, 4, 50, 255, 256, 257, 900)]
    got = simhash.fingerprints_of(pa.array([*texts, None]), 3)
    assert [int(x) & (2**64 - 1) for x in got] == [fingerprint(t) for t in [*texts, None]]


def _links_brute(spark, fps, distance):
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in set(signed)], "fp long")
    found = {r.node: r.root for r in simhash.components(simhash.links(df, distance)).collect()}
    want = roots(signed, distance)
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
    return groups({**{x: x for x in signed}, **found}), groups(want)


def test_links_of_small_and_large_buckets(spark):
    rng = np.random.default_rng(2)
    base = int(rng.integers(0, 2**63))
    # a crowd that shares whole blocks: over BUCKET members in one bucket
    crowd = [base ^ sum(1 << int(b) for b in rng.choice(14, rng.integers(0, 5), replace=False)) for _ in range(260)]
    far = [int(x) for x in rng.integers(0, 2**63, 120)]
    near = [x ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))) for x in far[:60]]
    for distance in (0, 1, 2):
        got, want = _links_brute(spark, [*crowd, *far, *near, 0], distance)
        assert got == want


def test_query_on_odd_rows(spark):
    docs = odd_docs(spark)
    rows = docs.collect()
    got = simhash.query(docs).collect()
    fp = [fingerprint(r.text) for r in rows]
    top = roots(fp, 2)
    low = {}
    for r, f in zip(rows, fp):
        if r.doc_id is not None:
            low[top[f]] = min(low.get(top[f], r.doc_id), r.doc_id)
    want = [(r.doc_id, f"{f:016x}", low.get(top[f])) for r, f in zip(rows, fp)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash.query(docs.limit(0)).count() == 0


def test_keep_one(spark):
    docs = odd_docs(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id, r.text is None) for r in kept.select("doc_id", "text").collect() if r.doc_id is not None)
    assert [i for i, _ in ids] == [1, 2, 3, 6, 7] or [i for i, _ in ids] == [1, 2, 3, 6, 7]
    copies = docs_of(spark, ["the same text again and again here"] * 9 + ["something else entirely, not close at all to it"])
    assert sorted(r.doc_id for r in simhash.keep_one(copies).collect()) == [0, 9]
