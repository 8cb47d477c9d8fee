import numpy as np
import pytest

from barwright.llm import ann_tree

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, asks, k):
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows]
    out = {}
    for i, v in good:
        if asks(i):
            near = {}
            for j, w in good:
                if j != i and len(w) == len(v):
                    near[j] = max(float(v @ w), near.get(j, -np.inf))
            out.setdefault(i, sorted((-s, j) for j, s in near.items())[:k])
    return out


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def test_recall_on_clusters_and_noise(spark):
    rng = np.random.default_rng(16)
    centre = rng.normal(size=(12, 24))
    x = np.concatenate([centre[rng.integers(0, 12, 2500)] + 0.2 * rng.normal(size=(2500, 24)), rng.normal(size=(1500, 24))])
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = {}
    for r in ann_tree.query(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = exact(rows, lambda i: i % 20 == 0, 20)
    assert set(got) == set(want)
    found = [len({v for _, v, _ in got[q]} & {j for _, j in want[q]}) / 20 for q in want]
    assert np.mean(found) >= 0.9
    for q, near in got.items():
        assert sorted(r for r, _, _ in near) == list(range(1, 21))
        score = {j: s for _, j, s in near}
        assert all(abs(score[j] - float(np.float32(x[q]).astype(float) @ np.float32(x[j]).astype(float))) < 1e-12 for j in score)


def test_equal_vectors_and_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(0, 90)] + [(i, [float(i), 1.0, -1.0]) for i in range(100, 130)]
    rows += [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 2.0]), (260, [nan, 1.0, 1.0]), (280, [inf, 0.0, 0.0]), (300, [])]
    rows += [(320, [1.0, 1.0]), (321, [2.0, 1.0]), (340, [3.0]), (None, [1.0, 1.0, 1.0]), (20, [1.0, 2.0, 0.5]), (40, [9.0, 9.0, 9.0])]
    df = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)
    got = {}
    for r in ann_tree.query(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = exact([(i, v) for i, v in rows if i is not None and v and usable(v)], lambda i: i % 20 == 0, 20)
    want = {q: n for q, n in want.items() if n}
    assert set(got) == set(want)
    for q in want:
        if q == 40:
            continue  # has two vectors: searched by each
        near = [(j, -s) for s, j in want[q]]
        assert [(j, pytest.approx(s)) for _, j, s in sorted(got[q])] == near
    assert 340 not in got and [j for _, j, _ in got[320]] == [321]


def test_further_columns_with_clashing_names(spark):
    rng = np.random.default_rng(18)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(rng.normal(size=(300, 4)))]
    plain = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    names = ["query_id", "rank", "score", "leaf", "block", "part", "vec", "id", "n", "h"]
    clashing = plain.selectExpr("*", *(f"CAST(7 AS STRING) AS {c}" for c in names))
    first = lambda df: sorted(tuple(r)[:4] for r in ann_tree.query(df).collect())
    assert first(clashing) == first(plain) and len(first(plain)) == 15 * 20


def test_empty(spark):
    assert ann_tree.query(spark.createDataFrame([], SCHEMA)).count() == 0
    none = spark.createDataFrame([(1, [1.0], 0)], SCHEMA)
    assert ann_tree.query(none).count() == 0


def test_tree_visits_every_leaf_once():
    rng = np.random.default_rng(17)
    x = rng.normal(size=(3000, 8))
    tree = ann_tree.Tree(x, 40)
    assert sorted(tree.order(x[0], 10**6)) == list(range(tree.leaves)) and tree.leaves > 10
    assert tree.order(x[0], 3) == tree.order(x[0], 10**6)[:3]
    assert set(tree.place(x).tolist()) <= set(range(tree.leaves))
    assert ann_tree.Tree(np.ones((500, 4)), 50).leaves == 1
