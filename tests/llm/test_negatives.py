"""Hard negatives against all inner products."""

import math
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwright.llm import hard_negatives
from barwright.llm.hard_negatives import Index

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    known = {}
    for r in rows:
        v = r["embedding"]
        if r["vec_id"] is None or r["label"] is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]
        row = (label, [math.floor(256 * x) for x in v])
        known[r["vec_id"]] = min(known.get(r["vec_id"], row), row)
    out = []
    for a, (label, v) in known.items():
        if a % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in known.items() if i != a and len(w) == len(v)]
        scored.sort()
        for p, pid in [(-s, i) for s, i, o in scored if o == label][:5]:
            fit = [(-s, i) for s, i, o in scored if o != label and 50 * p <= -100 * s <= 95 * p][:3]
            out += [(a, pid, k, i, p, s) for k, (s, i) in enumerate(fit, 1)]
    return sorted(out)


def check(df):
    made = hard_negatives.query(df)
    assert made.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(map(tuple, made.collect()))
    assert got == brute(df.collect())
    return got


def clusters(n, dims=16, seed=1, spread=0.6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, dims)) + 0.8
    labels = rng.integers(0, 10, n)
    v = centres[labels] + spread * rng.normal(size=(n, dims))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(i, [float(x) for x in v[i].astype(np.float32)], int(labels[i])) for i in range(n)]


def test_clusters(spark):
    assert len(check(spark.createDataFrame(clusters(900), SCHEMA))) > 100


def test_many_blocks_and_parts(spark, monkeypatch):
    for name, value in (("BLOCK", 64), ("PART", 3), ("PILOT", 100), ("GROUP", 2)):
        monkeypatch.setattr(hard_negatives, name, value)
    check(spark.createDataFrame(clusters(600, dims=11, seed=3), SCHEMA))


def test_pilot_without_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "PILOT", 1)
    check(spark.createDataFrame(clusters(300, dims=8, seed=4), SCHEMA))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    base = clusters(200, dims=4, seed=5)
    odd = [
        (None, [1.0, 0, 0, 0], 1), (1000, None, 1), (1001, [1.0, None, 0, 0], 1), (1050, [nan, 0, 0, 0], 2), (1100, [inf, 0, 0, 0], 2),
        (1150, [1.0, 0, 0, 0], None), (1200, [], 3), (1203, [], 3), (1250, [0.5, 0.5], 4), (1251, [0.5, 0.4], 4), (1252, [0.4, 0.4], 5),
        (1300, [0.0, 0, 0, 0], 6), (1301, [0.0, 0, 0, 0], 7), (1350, [-1.0, 0, 0, 0], 8), base[50], base[50], (50, [0.1, 0.2, 0.3, 0.4], 0),
        (1400, [3000.0, -2000.0, 0, 1], 1), (1401, [2900.0, -2000.0, 0, 1], 1), (1402, [1900.0, -1000.0, 0, 1], 2),
    ]
    odd = [(i, v and [x if x is None else float(x) for x in v], label) for i, v, label in odd]
    df = spark.createDataFrame(base + odd, SCHEMA)
    for c in ("v", "dim", "part", "block", "score", "rank", "low", "anchor", "anchor_id"):
        df = df.withColumn(c, F.lit(1))
    check(df)


def test_ties_and_equal_vectors(spark):
    rows = [(i, [0.5, 0.25], i % 3) for i in range(120)] + [(200 + i, [0.5 - i % 4 / 16, 0.1], 3) for i in range(60)]
    check(spark.createDataFrame(rows, SCHEMA))


def test_empty_table(spark):
    assert hard_negatives.query(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("dims", [1, 7, 8, 40])
def test_join_finds_all_pairs_and_omits_dimensions(dims):
    rng = np.random.default_rng(dims)
    q, v = rng.integers(-40, 90, (30, dims)).astype(float), rng.integers(-40, 90, (200, dims)).astype(float)
    v[3] = 0
    scores = q @ v.T
    for level in (-np.inf, 0.0, 0.3, 0.6, 0.9):
        t = np.full(30, -np.inf) if level == -np.inf else level * scores.max(axis=1)
        reach = hard_negatives._reach(q, t)
        index = Index(v, reach)
        qi, yi, s = index.join(q, t)
        assert sorted(zip(qi, yi, s)) == sorted((i, j, scores[i, j]) for i, j in zip(*np.nonzero(scores >= t[:, None])))
        if level == 0.9 and dims == 40:
            assert index.omitted.max() > 0 and len(index.rows) < 200


def test_first_entries_of_groups():
    group, score, ids = np.array([1, 0, 1, 1, 0]), np.array([5, 1, 5, 9, 1]), np.array([8, 3, 2, 1, 4])
    at = hard_negatives._firsts(group, score, ids, 2)
    assert [(g, [int(ids[i]) for i in x]) for g, x in groupby(at, key=lambda i: int(group[i])) for x in [list(x)]] == [(0, [3, 4]), (1, [1, 2])]
