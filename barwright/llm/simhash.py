"""SimHash near-dedup: pigeonhole blocks, Hamming check, connected components.

Fingerprint: words (lower-cased A-Z), shingles of `shingle` words with repeats,
one XXH64 (seed 42) each; a bit is set if over half the hashes have it set. A text
with fewer words has its whole word sequence as the one shingle; one without words
has fingerprint zero.

Links: fingerprints at most `distance` bits apart. The 64 bits are cut into
distance + 2 blocks, so a close pair agrees in two blocks at least; fingerprints
are joined on every pair of blocks and checked by Hamming distance. A bucket with
over `BUCKET` different fingerprints is not paired off: its members go to an exact
second way, in which each fingerprint is put under itself and its one-bit changes
(two fingerprints up to two bits apart meet under one of these) and linked to the
smallest under the same key. Work stays linear in such buckets and no link is lost.

Nulls: a null text is empty. Rows with a null doc_id take part; a component made of
such rows alone has a null component_id. Repeated rows come out as often as they
come in. Further columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm.store import doc_columns, saved
from barwright.llm.words import joined, split_words, steps

SEED = 42
BUCKET = 64

_LANES = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], dtype=np.uint64)


def bit_counts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many hashes of each group (rows first[i]:first[i+1], none empty) have each bit set."""
    # bytes spread to byte-wide counters; 255 rows can be added before a counter is full
    part = np.concatenate([np.arange(a, b, 255) for a, b in zip(first[:-1], first[1:], strict=True)])
    lanes = _LANES[hashes.astype("<u8").view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, part, axis=0).view(np.uint8).reshape(-1, 64).astype(np.int64)
    return np.add.reduceat(sums, np.searchsorted(part, first[:-1]), axis=0)


def fingerprints_of(texts: pa.Array, shingle: int) -> np.ndarray:
    """Signed 64-bit fingerprint of each text."""
    w = split_words(texts, lower=True)
    out = np.zeros(w.rows, dtype="<u8")
    count = w.counts()
    have = np.flatnonzero(count)
    if not len(have):
        return out.view("<i8")
    data, begin, end = joined(w)
    first = w.first()
    n_sh = np.maximum(count[have] - shingle + 1, 1)
    at = np.concatenate([[0], np.cumsum(n_sh)])
    left = np.arange(at[-1]) + np.repeat(first[have] - at[:-1], n_sh)
    right = left + np.repeat(np.minimum(count[have], shingle) - 1, n_sh)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(data[a:b], SEED) for a, b in zip(begin[left].tolist(), end[right].tolist(), strict=True)),
        dtype=np.uint64,
        count=len(left),
    )
    bits = 2 * bit_counts(hashes, at) > n_sh[:, None]
    out[have] = np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view("<u8").ravel()
    return out.view("<i8")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; text_hash tells rows with one doc_id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text"):
            fp = pa.array(fingerprints_of(b.column("text"), shingle).astype(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), fp], names=["doc_id", "text_hash", "fp"])

    return doc_columns(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, text_hash long, fp long")


def _hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def block_keys(fp: Column, distance: int) -> list[Column]:
    """One key for each pair of the distance + 2 blocks: the pair's number and its bits."""
    n = distance + 2
    edges = [64 * i // n for i in range(n + 1)]
    masks = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(n)]
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    return [
        F.struct(F.lit(i).alias("pair"), fp.bitwiseAND(F.lit(signed(a | b))).alias("bits"))
        for i, (a, b) in enumerate(combinations(masks, 2))
    ]


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """(a, b) with a < b: links that join the same fingerprints as all close pairs do."""
    if not 0 <= distance <= 2:
        raise ValueError("distance must be 0, 1 or 2")
    keyed = fps.select("fp", F.explode(F.array(*block_keys(F.col("fp"), distance))).alias("k")).select("fp", "k.pair", "k.bits")
    keyed = saved(keyed.groupBy("pair", "bits").agg(F.count("*").alias("n")).filter("n > 1").join(keyed, ["pair", "bits"]), "simhash-buckets")
    few = keyed.filter(F.col("n") <= BUCKET).select("pair", "bits", "fp")
    pairs = (
        few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), ["pair", "bits"])
        .filter((F.col("a") < F.col("b")) & (_hamming(F.col("a"), F.col("b")) <= distance))
        .select("a", "b")
    )
    many = keyed.filter(F.col("n") > BUCKET).select("fp").distinct()
    # all fingerprints under one centre are at most two bits apart (one bit for distance 1: the pair's smaller member)
    turned = [F.col("fp").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(64)] if distance else []
    centred = many.select("fp", F.explode(F.array(F.col("fp"), *turned)).alias("centre"))
    lead = centred.groupBy("centre").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).filter("a < z").select("centre", "a")
    stars = lead.join(centred, "centre").select("a", F.col("fp").alias("b")).filter((F.col("a") < F.col("b")) & (_hamming(F.col("a"), F.col("b")) <= distance))
    if distance == 1:  # only a centre that is itself a fingerprint links, and it links to its own neighbours
        stars = centred.join(many.select(F.col("fp").alias("centre")), "centre").filter("fp != centre").select(F.least("fp", "centre").alias("a"), F.greatest("fp", "centre").alias("b"))
    return pairs.union(stars).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the component's smallest node.

    Large-star and small-star rounds; each star takes the smallest neighbour by an
    aggregation with map-side combine and joins it back, so no neighbourhood is
    gathered in one place. Every round is written to the shared folder.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select("b", "a")) if large else e.select(F.greatest("a", "b"), F.least("a", "b"))
        both = both.toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        told = both.join(low, "u")
        if large:
            out = told.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = told.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select("u", "m"))
        return out.filter("a != b").distinct()

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    e = saved(edges.select("a", "b"), "cc")
    last = None
    for _ in range(max_rounds):
        e = saved(star(star(e, True), False), "cc")
        now = state(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for every row of `docs`."""
    rows = saved(fingerprints(docs, shingle), "simhash-fp")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    found = components(links(distinct.select("fp"), distance))
    named = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = saved(named, "simhash-roots")
    smallest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return rows.join(named.select("fp", "root").join(smallest, "root"), "fp")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """The rows of `docs` that stay: of each component the one with the smallest doc_id.

    Ties on doc_id go to the smallest text hash, and equal rows stay once; null ids
    come last.
    """
    told = near_duplicates(docs, shingle, distance)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    chosen = told.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias("__llm_id"), F.col("k.text_hash").alias("__llm_hash"))
    text_hash = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    kept = docs.withColumn("__llm_h", text_hash).join(
        chosen, F.col("doc_id").cast("long").eqNullSafe(F.col("__llm_id")) & (F.col("__llm_h") == F.col("__llm_hash")), "left_semi"
    )
    return kept.dropDuplicates(["doc_id", "__llm_h"]).drop("__llm_h")


def query(docs: DataFrame) -> DataFrame:
    out = near_duplicates(docs, shingle=3, distance=2)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
