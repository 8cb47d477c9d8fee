"""Approximate nearest neighbours by a hierarchical k-means tree.

Nearness is the inner product in double precision. The tree is fitted on the driver on a
bounded sample (at most `SAMPLE` vectors, taken by a hash of the id); every vector is then
put into its leaf, cluster by cluster downwards. A search walks the tree best bin first:
a priority queue holds the nodes seen so far by the inner product of query and node
centre; the best one is taken out, a leaf is visited, an inner node's children go in. The
number of leaves to visit is calibrated: for a sample of queries the exact neighbours are
found by brute force over all vectors, and visits are widened until the leaves hold
`RECALL` of them. All visited leaves are searched exactly.

Equal vectors form one class with its k + 1 smallest ids, which is all that any query can
need of them; equal queries are searched once. So a vector that a third of the rows share
costs as much as one. Leaves are cut into blocks of about `BLOCK` classes, a block's
queries into groups, and each pair of these is one matrix product.

Results: vectors that are null, zero or hold null or non-finite components take no part;
nor do null ids. Vectors are compared with those of the same length only. A query's own id
is never its neighbour; a repeated id counts once for each vector it has, at its best. With
fewer candidates than k all that were found come out. Further columns play no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.store import saved

SAMPLE, LEAF, BRANCH = 16_384, 512, 8
BLOCK, GROUP = 4096, 2048
CALIBRATE, RECALL = 256, 0.98


class Tree:
    """centres[i]: centre of node i; children[i]: its children, none for a leaf; leaf[i]: number of the leaf or -1."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int = 5):
        self.centres, self.children, self.leaf = [sample.mean(axis=0) if len(sample) else np.zeros(1)], [[]], [-1]
        rng = np.random.default_rng(seed)
        least = max(16, -(-len(sample) // max(1, leaves)))
        todo = [(0, np.arange(len(sample)))]
        while todo:
            node, rows = todo.pop()
            part, centre = _kmeans(sample[rows], BRANCH, rng) if len(rows) > 2 * least else (None, None)
            if part is None:
                self.leaf[node] = sum(x >= 0 for x in self.leaf)
                continue
            for j in range(len(centre)):
                self.children[node].append(len(self.centres))
                self.centres.append(centre[j])
                self.children.append([])
                self.leaf.append(-1)
                todo.append((len(self.centres) - 1, rows[part == j]))
        self.centres = np.array(self.centres)
        self.leaves = sum(x >= 0 for x in self.leaf)

    def place(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            near = _nearest(x[rows], self.centres[self.children[node]])
            todo += [(child, rows[near == j]) for j, child in enumerate(self.children[node])]
        return out

    def order(self, q: np.ndarray, visits: int) -> list[int]:
        """The first `visits` leaves of one query, best bin first."""
        score = self.centres @ q
        heap, out = [(-float(score[0]), 0)], []
        while heap and len(out) < visits:
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
            for child in self.children[node]:
                heapq.heappush(heap, (-float(score[child]), child))
        return out


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.argmin((centre**2).sum(axis=1) - 2 * (x @ centre.T), axis=1)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12):
    """Parts and centres; (None, None) if the vectors don't fall apart."""
    centre = np.unique(x[rng.choice(len(x), k, replace=False)], axis=0)
    for _ in range(rounds):
        part = _nearest(x, centre)
        centre = np.array([x[part == j].mean(axis=0) for j in range(len(centre)) if (part == j).any()])
    part = _nearest(x, centre)
    used = np.unique(part)
    if len(used) < 2:
        return None, None
    return np.searchsorted(used, part), centre[used]


def usable(v: Column) -> Column:
    """The vector is neither null nor zero, and all its components are finite numbers."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(col: pa.Array) -> np.ndarray:
    flat = pc.list_flatten(col).to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids): the k + 1 smallest ids of each distinct vector."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.distinct().withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def _best(score: np.ndarray, ids: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best ids for each row of `score`: largest score, then smallest id; and how many each row has.

    Class j holds the sorted ids ids[first[j]:first[j + 1]].
    """
    n = score.shape[1]
    if n > k:
        least = np.partition(score, n - k, axis=1)[:, n - k]
        row, col = np.nonzero(score >= least[:, None])  # all that tie with the last one as well
    else:
        row, col = (x.ravel() for x in np.indices(score.shape))
    held = (first[1:] - first[:-1])[col]
    at = np.arange(int(held.sum())) + np.repeat(first[col] - np.concatenate([[0], np.cumsum(held)[:-1]]), held) if len(col) else col
    row, value, near = np.repeat(row, held), np.repeat(score[row, col], held), ids[at]
    return _first_k(row, value, near, k, len(score))


def _first_k(row: np.ndarray, value: np.ndarray, near: np.ndarray, k: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((near, -value, row))
    row, value, near = row[order], value[order], near[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    some = place < k
    return near[some], value[some], np.bincount(row[some], minlength=rows)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


def _search_one(vectors: DataFrame, queries: DataFrame, dim: int, n: int, k: int) -> DataFrame:
    """Neighbours among the vectors of one length; n: how many there are."""
    seeded = F.xxhash64(F.lit(11), F.col("vec_id"))
    share = min(1.0, 0.9 * SAMPLE / max(1, n))
    picked = vectors.filter(F.abs(seeded % 1_000_000) < share * 1_000_000).select("v").limit(SAMPLE).toArrow()
    tree = Tree(_matrix(picked["v"].combine_chunks() if picked.num_rows else pa.array([], pa.list_(pa.float64()))).reshape(-1, dim), max(1, n // LEAF))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(tree.place(_matrix(b.column("v")))), *b.columns], names=["leaf", *b.schema.names])

    kind = vectors.schema["v"].dataType.simpleString()
    index = saved(_classes(vectors, k).mapInArrow(put, f"leaf long, v {kind}, ids array<long>"), "ann-index")

    ask = saved(queries.select("v").distinct().withColumn("qid", F.xxhash64("v")), "ann-queries")
    trial = ask.orderBy("qid").limit(CALIBRATE).toArrow()
    visits = _calibrate(tree, index, _matrix(trial["v"].combine_chunks()).reshape(-1, dim), k) if trial.num_rows else 1

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            go = [tree.order(q, visits) for q in _matrix(b.column("v"))]
            at = np.repeat(np.arange(len(go)), [len(x) for x in go])
            leaf = pa.array(np.concatenate([np.array(x, np.int64) for x in go]))
            yield pa.RecordBatch.from_arrays([leaf, b.column("qid").take(pa.array(at)), b.column("v").take(pa.array(at))], names=["leaf", "qid", "q"])

    blocks = index.groupBy("leaf").agg(F.count("*").alias("held"))
    cut = blocks.select("leaf", F.ceil(F.col("held") / BLOCK).cast("int").alias("n_blocks"))
    routed = saved(ask.select("qid", "v").mapInArrow(route, f"leaf long, qid long, q {kind}"), "ann-routes")
    groups = routed.groupBy("leaf").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("n_groups"))
    # each block of a leaf meets each group of its queries once
    cut = saved(cut.join(groups, "leaf"), "ann-cut")
    left = index.join(cut, "leaf").withColumn("block", F.pmod(F.xxhash64("ids"), "n_blocks").cast("int"))
    left = left.withColumn("group", F.explode(F.sequence(F.lit(0), F.col("n_groups") - 1))).select("leaf", "block", "group", "v", "ids")
    right = routed.join(cut, "leaf").withColumn("group", F.pmod("qid", "n_groups").cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select("leaf", "block", "group", "qid", "q")

    def meet(mine: pa.Table, asked: pa.Table) -> pa.Table:
        if not mine.num_rows or not asked.num_rows:
            return pa.table({"qid": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64())), "scores": pa.array([], pa.list_(pa.float64()))})
        ids = mine["ids"].combine_chunks()
        first = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy())])
        score = _matrix(asked["q"].combine_chunks()) @ _matrix(mine["v"].combine_chunks()).T
        near, value, n = _best(score, pc.list_flatten(ids).to_numpy(), first, k + 1)
        return pa.table({"qid": asked["qid"], "ids": _lists(near, n), "scores": _lists(value, n)})

    met = left.groupBy("leaf", "block", "group").cogroup(right.groupBy("leaf", "block", "group")).applyInArrow(
        meet, "qid long, ids array<long>, scores array<double>"
    )

    def merge(parts: pa.Table) -> pa.Table:
        ids, value = (pc.list_flatten(parts[c].combine_chunks()).to_numpy() for c in ("ids", "scores"))
        order = np.lexsort((-value, ids))  # an id with several vectors counts at its best
        ids, value = ids[order], value[order]
        one = np.concatenate([[True], ids[1:] != ids[:-1]])[: len(ids)]
        near, value, n = _first_k(np.zeros(int(one.sum()), np.int64), value[one], ids[one], k + 1, 1)
        return pa.table({"qid": parts["qid"][:1], "ids": _lists(near, n), "scores": _lists(value, n)})

    best = met.groupBy("qid").applyInArrow(merge, "qid long, ids array<long>, scores array<double>")
    told = queries.select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("qid")).distinct().join(best, "qid")
    near = F.slice(F.filter(F.arrays_zip("ids", "scores"), lambda x: x["ids"] != F.col("query_id")), 1, k)
    return told.select("query_id", F.posexplode(near).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score")
    )


def _calibrate(tree: Tree, index: DataFrame, trial: np.ndarray, k: int) -> int:
    """Leaves to visit so that the trial queries' exact k neighbours are found to the share RECALL.

    Each task keeps the k best of every trial query, so the driver gets a bounded table.
    """

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0), np.zeros(0, np.int64))] * len(trial)
        for b in batches:
            leaf = b.column("leaf").to_numpy()
            score = trial @ _matrix(b.column("v")).T
            for i in range(len(trial)):
                s, f = np.concatenate([best[i][0], score[i]]), np.concatenate([best[i][1], leaf])
                top = np.argsort(-s, kind="stable")[:k]
                best[i] = (s[top], f[top])
        n = [len(s) for s, _ in best]
        cols = [np.repeat(np.arange(len(trial)), n), np.concatenate([s for s, _ in best]), np.concatenate([f for _, f in best])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["trial", "score", "leaf"])

    rank = F.row_number().over(Window.partitionBy("trial").orderBy(F.desc("score"), "leaf"))
    true = index.mapInArrow(exact, "trial long, score double, leaf long").withColumn("rank", rank).filter(F.col("rank") <= k).toArrow()
    place = [{leaf: i for i, leaf in enumerate(tree.order(q, tree.leaves))} for q in trial]
    need = np.sort([place[t][f] for t, f in zip(true["trial"].to_pylist(), true["leaf"].to_pylist(), strict=True)])
    return int(need[min(len(need) - 1, int(np.ceil(RECALL * len(need))))]) + 1


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): up to k neighbours of every row of (vec_id, embedding) that `is_query` holds for."""
    rows = vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"), is_query.alias("asks"))
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("int")).alias("asked")).collect()
    out = None
    for dim, n, asked in sorted((x for x in lengths if x["asked"]), key=lambda x: x["dim"]):
        own = rows.filter(F.size("v") == dim)
        part = _search_one(own.select("vec_id", "v"), own.filter("asks").select("vec_id", "v"), dim, n, k)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def query(embeddings: DataFrame) -> DataFrame:
    return search(embeddings, F.col("vec_id") % 20 == 0, k=20)
