"""Mixing sources to target weights by subset-sum budget fitting.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share
`share` times all words; a target stops at `cap` times its source's words, and the
excess is reshared by weight until none is above.

Fitting: each source is taken whole as often as its target allows; the remaining
budget is met by a subset of its documents. Only the number of documents of each exact
length is needed for that: from the longest length down a proportional part of the
documents is planned, the rest of the budget is filled greedily, and a
bounded-knapsack dynamic programme over the lengths that are left closes the last gap.
Which documents of a length are taken is decided by a seeded hash of the id, so reruns
agree. No document is taken more than `cap` times.

Results: a null text has no words; a document without words is taken zero words, and
its copies count as taken where its source is taken whole. Null ids and repeated rows
take part like others; repeated rows are told apart only by their order. Further
columns are carried by `mix` and play no part.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.store import saved

SHARE, CAP, WEIGHTS, SEED = 1.5, 2, (5, 2, 1), 7
BUCKETS = 256  # parts into which the documents of one source and length are dealt for ranking
GAP, TABLE = 4, 1 << 18  # the dynamic programme's budget: so many times the longest length, in a table of so many words


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = SHARE, cap: int = CAP, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size, weight, target) of every source, from (source, n_docs, source_size).

    A source is full if its cap is below its weight's part. In order of cap per weight,
    the first sources are full and the rest share what is left; the level is the
    first one that the next source's cap exceeds. The windows run over sources only.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    t = sizes.withColumn("weight", w.cast("double")).withColumn("limit", cap * F.col("source_size").cast("double"))
    ratio = F.col("limit") / F.col("weight")
    before = Window.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    t = t.withColumn("ratio", ratio)
    t = t.withColumn("full", F.coalesce(F.sum("limit").over(before), F.lit(0.0))).withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    t = t.withColumn("level", (share * F.sum("source_size").over(everything) - F.col("full")) / (F.sum("weight").over(everything) - F.col("gone")))
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"]
    t = t.withColumn("water", level)
    out = F.coalesce(F.least("limit", F.col("water") * F.col("weight")), F.col("limit"))
    return t.select("source", "source_size", F.col("weight"), out.alias("target"))


def fit_counts(length: np.ndarray, count: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come near `budget`, never over it.

    Lengths are distinct and positive. The sum reached is the greatest one that the
    dynamic programme can reach after the planned part: the best of all where the budget is at
    most `GAP` times the longest length, else possibly a few words less.
    """
    take = np.zeros(len(length), np.int64)
    total = int((length * count).sum())
    if budget <= 0 or not len(length):
        return take
    if budget >= total:
        return count.astype(np.int64)
    gap = min(GAP * int(length.max()), TABLE)
    take = np.array([int(c) * max(0, budget - gap) // total for c in count], np.int64)
    left = budget - int((take * length).sum())
    order = np.argsort(-length)
    for i in order:  # greedy, but stay a gap away from the end
        n = min(int(count[i] - take[i]), max(0, left - gap) // int(length[i]))
        take[i] += n
        left -= n * int(length[i])
    # bounded knapsack on the gap: bit b of `reach` says that b words can be made of the lengths so far
    mask = (1 << (left + 1)) - 1
    reach, steps = 1, []
    for i in order:
        free, part = int(count[i] - take[i]), 1
        while free > 0 and not reach >> left & 1:
            part = min(part, free)
            add = part * int(length[i])
            if add <= left:
                steps.append((int(i), part, reach))
                reach |= (reach << add) & mask
            free -= part
            part *= 2
    at = reach.bit_length() - 1
    for i, part, before in reversed(steps):
        if not before >> at & 1:
            take[i] += part
            at -= part * int(length[i])
    return take


def plan(sized: DataFrame, share: float = SHARE, cap: int = CAP, weights: tuple = WEIGHTS) -> DataFrame:
    """(src, size, source_size, target, whole, extra) from (src, source, size): how often every document
    of a source is taken, and how many documents of this length are taken once more.

    A group holds one row for each distinct length of a source, not its documents.
    """
    lengths = saved(sized.groupBy("src", "source", "size").agg(F.count("*").alias("n")), "mix-lengths")
    sources = lengths.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    aims = targets(sources, share, cap, weights).withColumn("src", source_key(F.col("source"))).select("src", "source_size", "target")
    told = lengths.drop("source").join(saved(aims, "mix-targets"), "src")

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        total, target = int(g["source_size"].iloc[0]), float(g["target"].iloc[0])
        whole = min(cap, int(target // total)) if total else 0
        extra = np.zeros(len(g), np.int64)
        if whole < cap and total:
            some = (g["size"] > 0).to_numpy()
            extra[some] = fit_counts(g["size"].to_numpy()[some], g["n"].to_numpy()[some], math.floor(target - whole * total + 0.5))
        return g.assign(whole=whole, extra=extra)[["src", "size", "source_size", "target", "whole", "extra"]]

    return told.groupBy("src").applyInPandas(fit, "src string, size long, source_size long, target double, whole int, extra long")


def source_key(source: Column) -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def mix(docs: DataFrame, share: float = SHARE, cap: int = CAP, weights: tuple = WEIGHTS, seed: int = SEED) -> DataFrame:
    """Every row of `docs` (doc_id, text, source and further columns) with size, source_size, target, copies.

    A length's documents are ranked by a seeded hash in two steps: they are dealt over
    buckets by the hash, counts run over the buckets, and only one bucket's rows are
    sorted together, so a large group of equal lengths isn't one task's. Input columns
    that bear one of the four names are replaced.
    """
    draw = F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"))
    source = F.col("source").cast("string")
    rows = docs.drop("size", "source_size", "target", "copies").withColumns({
        "__llm_src": source_key(source), "__llm_size": word_count(F.col("text")), "__llm_draw": draw,
        "__llm_b": F.shiftrightunsigned(draw, 56), "__llm_tie": F.xxhash64("text"),
    })
    thin = docs.select(source_key(source).alias("src"), source.alias("source"), word_count(F.col("text")).alias("size"), F.shiftrightunsigned(draw, 56).alias("b"))
    planned = saved(plan(thin, share, cap, weights), "mix-plan")
    held = thin.groupBy("src", "size", "b").agg(F.count("*").alias("held"))
    run = Window.partitionBy("src", "size").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("held").over(run), F.lit(0)))
    dealt = held.join(planned, ["src", "size"]).select(
        F.col("src").alias("__llm_src"), F.col("size").alias("__llm_size"), F.col("b").alias("__llm_b"), "size", "before", "source_size", "target", "whole", "extra"
    )
    rank = F.row_number().over(Window.partitionBy("__llm_src", "__llm_size", "__llm_b").orderBy("__llm_draw", "__llm_tie"))
    out = rows.withColumn("__llm_rank", rank).join(dealt, ["__llm_src", "__llm_size", "__llm_b"])
    more = (F.col("before") + F.col("__llm_rank") <= F.col("extra")).cast("int")
    return out.select(*docs.drop("size", "source_size", "target", "copies").columns, "size", "source_size", "target", (F.col("whole") + more).alias("copies"))


def mixed(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: the rows that are taken, each as often as it is taken."""
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    return mix(docs, **params).filter("copies > 0").withColumn("__llm_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*kept)


def query(docs: DataFrame) -> DataFrame:
    out = mix(docs.select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
