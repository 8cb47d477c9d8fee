"""Hard negatives by threshold joins over an inverted index with suffix-norm bounds (after L2AP).

Components become whole numbers, so scores are exact inner products. A join finds all
rows whose score with an anchor reaches the anchor's threshold: of each row, the leading
dimensions whose norm cannot reach any threshold alone are left out of the index, a row that is
left out whole is no candidate; partial scores accumulate over the indexed dimensions from the last
one on, a pair goes as soon as the partial score and the norms of what remains stay
below the threshold, and the pairs that are left are completed with the omitted dimensions.

Thresholds: each anchor first meets a pilot, a sample of about PILOT rows, where its
threshold is lowered until the window is full (five rows of its label; three rows in
the score range of each positive) or has reached its bottom. What the pilot holds, the
table holds as well, so the last score in a full window bounds the result from below; the join
of all rows then finds the exact answer whatever the pilot was.

Spark deals the rows by a hash of vec_id into blocks of about BLOCK rows and the
anchors into parts of about PART; each pair of a block and a part is one group, so no label and no
anchor has a task of its own. A block gives back only its own first rows of each
window, from which the first of all are chosen.

Results: rows with a null id, null label, null vector, null or non-finite components
take no part. Rows that repeat an id count once, the smallest by label and vector; equal
scores go by smaller vec_id. Vectors meet those of the same length only; the empty vector scores 0. An anchor without
positives, or a positive without rows in its range, gives no rows; an empty table gives none. Scores are
64-bit whole numbers. Further columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.store import saved

BLOCK = 1024  # rows of a block, about
PART = 1024  # anchors of a part, about
PILOT = 4096  # rows of the sample that sets the thresholds, about
GROUP = 256  # anchors that meet a block at once
SEGMENT = 8  # dimensions of a step
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # a negative's score in percent of the positive's
STEPS = (0.8, 0.6, 0.45, 0.3, 0.15)  # thresholds of the pilot, by the largest possible score; then none
EXACT = float(1 << 52)


def prepared(vectors: DataFrame, anchor: Column, label: Column) -> DataFrame:
    """(vec_id, label, v, dim, anchor): one row an id, components as whole numbers."""
    known = "embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND abs(x) < double('infinity'))"
    whole = F.expr("transform(embedding, x -> CAST(floor(256D * CAST(x AS DOUBLE)) AS BIGINT))")
    rows = vectors.where(known).select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("int").alias("label"), whole.alias("v"), anchor.alias("anchor"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL")
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v", "anchor")).alias("r")).select("vec_id", "r.*")
    return saved(rows.withColumn("dim", F.size("v")), "negatives-rows")


class Index:
    """Inverted index of some rows for queries whose threshold is at least `reach` times their own norm."""

    def __init__(self, v: np.ndarray, reach: float):
        cuts = list(range(0, v.shape[1], SEGMENT)) + [v.shape[1]]
        norms = np.sqrt(np.cumsum(np.square(v.astype(np.float64)), axis=1)) if v.shape[1] else np.zeros((len(v), 0))
        before = np.concatenate([np.zeros((len(v), 1)), norms], axis=1)[:, cuts]  # norm of what precedes each segment
        omitted = (before * (1 + 1e-9) < reach).sum(axis=1) - 1 if reach > 0 else np.zeros(len(v), np.int64)
        self.rows = np.argsort(omitted, kind="stable")
        self.rows = self.rows[omitted[self.rows] < max(1, len(cuts) - 1)]
        self.v, self.before, self.omitted, self.cuts = v[self.rows], before[self.rows], omitted[self.rows], cuts

    def join(self, q: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of all pairs whose score reaches the query's threshold."""
        partial = np.zeros((len(q), len(self.rows)), q.dtype)
        alive = np.ones(partial.shape, bool)
        norms = np.sqrt(np.cumsum(np.square(q.astype(np.float64)), axis=1))
        before = np.concatenate([np.zeros((len(q), 1)), norms], axis=1)[:, self.cuts]
        for s in range(len(self.cuts) - 2, -1, -1):
            listed = int(np.searchsorted(self.omitted, s, side="right"))  # rows whose index holds this segment
            at = slice(self.cuts[s], self.cuts[s + 1])
            partial[:, :listed] += q[:, at] @ self.v[:listed, at].T
            left = before[:, s : s + 1] * self.before[None, :listed, s]
            alive[:, :listed] &= partial[:, :listed] + left * (1 + 1e-9) + 1e-3 >= t[:, None]
        qi, yi = np.nonzero(alive)
        score = partial[qi, yi]
        for s in range(len(self.cuts) - 1):  # the omitted dimensions of what is left
            more = np.flatnonzero(self.omitted[yi] > s)
            at = slice(self.cuts[s], self.cuts[s + 1])
            score[more] += np.einsum("ij,ij->i", q[qi[more], at], self.v[yi[more], at])
        hit = score >= t[qi]
        return qi[hit], self.rows[yi[hit]], score[hit]


def _matrix(table: pa.Table) -> np.ndarray:
    lists = table.column("v").combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    v = flat.reshape(table.num_rows, -1) if len(flat) else np.zeros((table.num_rows, 0), np.int64)
    most = float(np.abs(v).max(initial=0))
    return v.astype(np.float64) if most * most * max(1, v.shape[1]) < EXACT else v


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy(zero_copy_only=False)


def _firsts(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each group's first k entries: larger scores first, ties by smaller id; sorted by group."""
    order = np.lexsort((ids, -score, group))
    starts = np.flatnonzero(np.diff(group[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < k]


def _reach(q: np.ndarray, t: np.ndarray) -> float:
    norm = np.sqrt(np.square(q.astype(np.float64)).sum(axis=1))
    return float(np.min(t / np.maximum(norm, 1e-9))) * (1 - 1e-9) if len(q) else 0.0


def _same_label(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    a, r = _column(anchors, "label"), _column(rows, "label")
    for label in np.intersect1d(a, r):
        mine = np.flatnonzero(a == label)
        for i in range(0, len(mine), GROUP):
            yield mine[i : i + GROUP], np.flatnonzero(r == label)


def _positives(anchors: pa.Table, rows: pa.Table, thresholds: Callable[[np.ndarray], np.ndarray]):
    """(anchor, row, score), both as places, of the first POSITIVES other rows of the anchor's label that reach its threshold."""
    q, v = _matrix(anchors), _matrix(rows)
    own, ids = _column(anchors, "anchor_id"), _column(rows, "vec_id")
    for a, r in _same_label(anchors, rows):
        t = thresholds(a)
        qi, yi, score = Index(v[r], _reach(q[a], t)).join(q[a], t)
        other = own[a][qi] != ids[r][yi]
        qi, yi, score = qi[other], yi[other], score[other]
        first = _firsts(qi, score, ids[r][yi], POSITIVES)
        yield a[qi[first]], r[yi[first]], score[first]


def _negatives(anchors: pa.Table, rows: pa.Table, thresholds: np.ndarray):
    """(anchor, positive, row, score), places, of the first NEGATIVES rows of other labels in each positive's range that reach the threshold."""
    q, v = _matrix(anchors), _matrix(rows)
    labels, ids, found = _column(anchors, "label"), _column(rows, "vec_id"), _column(rows, "label")
    p = _padded(anchors)
    for i in range(0, len(q), GROUP):
        a = np.arange(i, min(i + GROUP, len(q)))
        qi, yi, score = Index(v, _reach(q[a], thresholds[a])).join(q[a], thresholds[a])
        other = labels[a][qi] != found[yi]
        qi, yi, score = qi[other], yi[other], score[other]
        for j in range(p.shape[1]):
            inside = np.flatnonzero((LOW * p[a[qi], j] <= 100.0 * score) & (100.0 * score <= HIGH * p[a[qi], j]))  # NaN: no such positive
            first = inside[_firsts(qi[inside], score[inside], ids[yi[inside]], NEGATIVES)]
            yield a[qi[first]], np.full(len(first), j), yi[first], score[first]


def _padded(anchors: pa.Table) -> np.ndarray:
    """Scores of every anchor's positives, best first; NaN where there are fewer."""
    p = np.full((anchors.num_rows, POSITIVES), np.nan)
    for i, scores in enumerate(anchors.column("scores").to_pylist()):
        p[i, : len(scores)] = scores
    return p


def _pilot_positives(anchors: pa.Table, rows: pa.Table) -> np.ndarray:
    """Every anchor's threshold: lowered until POSITIVES rows of its label are found; none where the pilot holds fewer."""
    q = _matrix(anchors)
    norm = np.sqrt(np.square(q.astype(np.float64)).sum(axis=1))
    most = norm * np.sqrt(np.square(_matrix(rows).astype(np.float64)).sum(axis=1)).max(initial=0)
    low = np.full(len(q), -np.inf)
    waiting = np.arange(len(q))
    for step in STEPS:
        sub = anchors.take(pa.array(waiting))
        full = np.zeros(len(waiting), np.int64)
        last = np.full(len(waiting), np.inf)
        for a, _, score in _positives(sub, rows, lambda x, w=waiting, s=step: s * most[w[x]]):
            full += np.bincount(a, minlength=len(waiting))
            np.minimum.at(last, a, score)
        low[waiting[full == POSITIVES]] = last[full == POSITIVES]
        waiting = waiting[full < POSITIVES]
    return low


def _pilot_negatives(anchors: pa.Table, rows: pa.Table) -> np.ndarray:
    """Every anchor's threshold: lowered until NEGATIVES rows are in each positive's range, to the lowest range's bottom at last."""
    p = _padded(anchors)
    bottom = np.ceil(np.nanmin(p, axis=1) * LOW / 100)
    top = np.nanmax(p, axis=1)
    low = bottom.copy()
    waiting = np.arange(len(p))
    for step in (0.85, 0.75, 0.65):
        t = np.maximum(step * top, bottom)
        full = np.zeros(p.shape, np.int64)
        last = np.full(p.shape, np.inf)
        for a, j, _, score in _negatives(anchors.take(pa.array(waiting)), rows, t[waiting]):
            np.add.at(full, (waiting[a], j), 1)
            np.minimum.at(last, (waiting[a], j), score)
        done = ((full == NEGATIVES) | np.isnan(p))[waiting].all(axis=1)
        low[waiting[done]] = np.maximum(np.where(np.isnan(p), np.inf, last)[waiting[done]].min(axis=1), bottom[waiting[done]])
        waiting = waiting[~done]
    return low


def _anchored(anchors: DataFrame, rows: DataFrame, keys: list[str], work, schema: str) -> DataFrame:
    """`work(anchors, rows)` on each group of the keys that has both."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        made = work(left, right) if left.num_rows and right.num_rows else None
        return made if made is not None else pa.Table.from_pylist([], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    return anchors.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(run, schema)


def _with_thresholds(anchors: DataFrame, pilot: DataFrame, choose) -> DataFrame:
    """The anchors again with the threshold `low` that the pilot rows give them."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        return left.append_column("low", pa.array(choose(left, right), pa.float64()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema.fields) + ", low double"
    found = _anchored(anchors, pilot, ["dim", "part"], work, schema)
    return found


def _everywhere(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.withColumn(column, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def mine(vectors: DataFrame, anchor: Column, label: Column) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows where `anchor` holds."""
    rows = prepared(vectors, anchor, label)
    n, n_anchors = rows.agg(F.count("vec_id"), F.count(F.when(F.col("anchor"), 1))).first()
    blocks, parts, thin = max(1, -(-n // BLOCK)), max(1, -(-n_anchors // PART)), max(1, -(-n // PILOT))
    dealt = F.xxhash64("vec_id")
    plain = rows.select("vec_id", "label", "v", "dim")
    # Both sides of a cogroup come from one table: named anew, their columns are told apart.
    anchors = rows.where("anchor").select(F.col("vec_id").alias("anchor_id"), *[F.col(c).alias(c) for c in ("label", "v", "dim")], F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)).cast("int").alias("part"))
    pilot = _everywhere(plain.where(F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(thin)) == 0), "part", parts)
    table = _everywhere(plain.withColumn("block", F.pmod(dealt, F.lit(blocks)).cast("int")), "part", parts)

    def positives(left: pa.Table, right: pa.Table) -> pa.Table:
        low = _column(left, "low")
        found = [np.concatenate(x) for x in zip(*_positives(left, right, lambda a: low[a]), strict=True)] or [np.zeros(0, np.int64)] * 3
        return pa.table({"anchor_id": pa.array(_column(left, "anchor_id")[found[0]], pa.int64()), "positive_id": pa.array(_column(right, "vec_id")[found[1]], pa.int64()),
                         "score": pa.array(found[2].astype(np.int64), pa.int64())})

    guided = _spread(_with_thresholds(anchors, pilot, _pilot_positives), anchors, blocks)
    met = _anchored(guided, table, ["dim", "part", "block"], positives, "anchor_id long, positive_id long, score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    first = saved(met.withColumn("place", F.row_number().over(best)).where(F.col("place") <= POSITIVES), "negatives-positives")

    def negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        made = [np.concatenate(x) for x in zip(*_negatives(left, right, _column(left, "low")), strict=True)] or [np.zeros(0, np.int64)] * 4
        return pa.table({"anchor_id": pa.array(_column(left, "anchor_id")[made[0]], pa.int64()), "place": pa.array(made[1] + 1, pa.int32()),
                         "negative_id": pa.array(_column(right, "vec_id")[made[2]], pa.int64()), "negative_score": pa.array(made[3].astype(np.int64), pa.int64())})

    scores = first.groupBy("anchor_id").agg(F.expr("transform(sort_array(collect_list(struct(place, score))), x -> x.score)").alias("scores"))
    ranged = anchors.join(scores, "anchor_id")
    guided = _spread(_with_thresholds(ranged, pilot, _pilot_negatives), ranged, blocks)
    met = _anchored(guided, table, ["dim", "part", "block"], negatives, "anchor_id long, place int, negative_id long, negative_score long")
    best = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    chosen = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= NEGATIVES)
    return chosen.join(first.withColumnRenamed("score", "positive_score"), ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _spread(guided: DataFrame, anchors: DataFrame, blocks: int) -> DataFrame:
    """Guided anchors for every block. Where a group of anchors met no pilot row, its anchors have no threshold and join whole."""
    rest = anchors.join(guided.select("anchor_id"), "anchor_id", "left_anti").withColumn("low", F.lit(float("-inf")))
    return _everywhere(saved(guided.unionByName(rest), "negatives-anchors"), "block", blocks)


def query(vectors: DataFrame) -> DataFrame:
    vec_id = F.col("vec_id").cast("long")
    shifted = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors, F.coalesce(vec_id % 50 == 0, F.lit(False)), shifted)


def oracle() -> str:
    return f"""
WITH known AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), rows_ AS (
  SELECT vec_id, label, v FROM known QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id,
         CASE WHEN len(a.v) = 0 THEN 0 ELSE CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(r.v AS DOUBLE[])) AS BIGINT) END AS score
  FROM rows_ a JOIN rows_ r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id AND len(a.v) = len(r.v)
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= {NEGATIVES}
"""
