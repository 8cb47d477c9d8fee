"""Merkle manifest against a plain recomputation of trees, proofs and folds."""

import hashlib
import zlib

import pytest
from helpers import DOCS, odd_docs

from barwright.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return H(*map(field, (row.doc_id, row.source, row.lang, row.n_chars, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, i):
    for nodes in levels[:-1]:
        run = i // 3 * 3
        yield nodes[run:i], nodes[i + 1 : run + 3]
        i //= 3


def brute(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r.source, []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        sources[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        trees[s] = tree([leaf(r, r.text) for r in sources[s]])
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for j, s in enumerate(names):
        for i, r in enumerate(sources[s]):
            steps = [*siblings(trees[s], i), *siblings(top, j)]
            bare = r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            h = leaf(r, r.text.replace("\n", "") if bare else r.text)
            for before, after in steps:
                h = H(*before, h, *after)
            proof = H(*[x for before, after in steps for x in before + after])
            out.append((r.doc_id, trees[s][0][i], trees[s][-1][0], top[-1][0], proof, h, h == top[-1][0]))
    return sorted(out, key=str)


def check(docs):
    made = merkle.query(docs)
    assert made.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, made.collect()), key=str) == brute(docs.select("doc_id", "source", "lang", "n_chars", "text").collect())


def test_odd_rows(spark):
    check(odd_docs(spark))


@pytest.mark.parametrize("sizes", [[1], [2], [81], [700, 1, 2, 3, 4, 9, 82, 244], [1] * 100])
def test_shapes_of_trees(spark, sizes):
    rows = [(s * 1000 + i, f"line {i}\nof {s}", "en", f"source {s:03}" if s else None, i) for s, n in enumerate(sizes) for i in range(n)]
    check(spark.createDataFrame(rows, DOCS))


def test_line_feeds_that_leave_break_the_proof(spark):
    rows = [(i, "a\nb" if i % 3 else "a b", "en", "x", 3) for i in range(40)]
    made = {r.doc_id: r.verified for r in merkle.query(spark.createDataFrame(rows, DOCS)).collect()}
    assert made == {i: not (i % 3 and zlib.crc32(str(i).encode()) % 2 == 0) for i in range(40)}


def test_null_and_empty_text_differ(spark):
    rows = [(1, "", "en", "x", 0), (2, None, "en", "x", 0)]
    a, b = merkle.leaves(spark.createDataFrame(rows, DOCS)).orderBy("doc_id").collect()
    assert a.leaf == H("1:1", "1:x", "2:en", "1:0", "0:") and b.leaf == H("1:2", "1:x", "2:en", "1:0", "-")


def test_empty_table(spark):
    assert merkle.query(spark.createDataFrame([], DOCS)).collect() == []


def test_stored_copies_bound_the_rows_of_a_key(spark):
    docs = spark.createDataFrame([(i, "t", "en", "x", 1) for i in range(81 * 60)], DOCS)
    climbers, nodes = merkle.build(merkle.leaves(docs))
    assert climbers.count() == 60
    top = nodes.where("up_tree IS NULL")
    assert top.count() == 60  # one tile below each of the 60 nodes of the only tile above
    rows = [(i, "t", "en", f"s{i % 2}", 1) for i in range(2 * 81 * 60)]
    climbers, nodes = merkle.build(merkle.leaves(spark.createDataFrame(rows, DOCS)))
    assert nodes.where("up_tree IS NULL").count() == 2 * -(-60 // merkle.SPREAD)
