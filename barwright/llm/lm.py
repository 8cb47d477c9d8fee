"""n-gram language model with weighted backoff, evaluated order by order.

Tokens: words of the text with A-Z lower-cased, then one end token. Base: unigrams
with 0.1 added, over the training tokens. Higher orders are smoothed by
p(w | h) = (c(h w) + k p(w | h')) / (c(h) + k), h' being h without its first word. Read as an
automaton, every history seen in training is a state, the arc of a seen n-gram
carries log10 p(w | h), and where there is no arc a failure arc adds
log10(k / (c(h) + k)) and goes on from h'. That automaton isn't built here: the same sums are taken
for all tokens of a block at once, from the shortest history to the longest, as array operations, and no
state is carried from token to token. The smoothing k is chosen from `PRIORS` by the
training tokens' own likelihood with each token's own count taken out.

The model isn't bounded, so it is neither collected nor broadcast. Documents are dealt
into blocks by a hash of the id; a block sends the sorted distinct n-gram hashes it
needs, with its own training counts, cut into parts by hash range; each part adds up
the counts of all blocks and sends the totals back, in the same order. A block then
holds just the counts that its texts need.
Block and part sizes follow from BLOCK_BYTES, and their numbers grow with the input.
Every document's n-grams count, whatever their frequency.

Words are told apart by 64-bit hashes. Results: null and empty texts hold just the end
token. A null doc_id counts as the text '' for the hold-out rule, and is dealt by its
text. Repeated rows count and come out each. Without training tokens all counts are
zero (N = V = 0), so every token has base probability 1. Further columns play no part.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.store import saved
from barwright.llm.words import hashed_words, mix64

ORDER = 2
BLOCK_BYTES = 8 << 20
PRIORS = (0.5, 2.0, 8.0, 32.0, 128.0, 512.0, 4096.0)
END = np.uint64(0x5851F42D4C957F2D)
BEGIN = np.uint64(0x14057B7EF767814F)
ADD = 0.1


ORDER_BITS = np.uint64(7)  # the lowest bits of a gram's hash tell its order


def _gram(chain: np.ndarray, m: int) -> np.ndarray:
    """Hashes of grams with m tokens before the last one."""
    return mix64(chain ^ np.uint64((m + 1) << 56)) & ~ORDER_BITS | np.uint64(m)


class Block:
    """The tokens of some documents and their n-grams of each order, with a begin token before each text.

    hashes: the sorted distinct gram hashes; of[m][i]: which of them ends at token i with
    m tokens before it, -1 where it would leave the text.
    """

    def __init__(self, texts: pa.Array, held_out: np.ndarray, order: int):
        count, hashes = hashed_words(texts, lower=True)
        size = count + 2
        first = np.concatenate([[0], np.cumsum(size)])
        tokens = np.full(int(first[-1]), BEGIN, np.uint64)
        tokens[first[1:] - 1] = END
        tokens[np.arange(len(hashes)) + np.repeat(first[:-1] + 1 - np.concatenate([[0], np.cumsum(count)[:-1]]), count)] = hashes
        self.rows, self.order = len(count), order
        del hashes
        self.row = np.repeat(np.arange(self.rows, dtype=np.int32), size)
        place = (np.arange(len(tokens)) - first[:-1][self.row]).astype(np.int32)
        self.at = np.flatnonzero(place > 0).astype(np.int32)  # all but the begin tokens
        self.trains = ~held_out[self.row]
        found, self.of, acc = [], [], tokens
        for m in range(order):  # one order after the other: sorting takes most of the memory
            if m:
                longer = np.zeros_like(tokens)
                longer[1:] = mix64(acc[:-1] + np.uint64(m)) + tokens[1:]
                acc = longer
            fits = place >= m
            distinct, back = np.unique(_gram(acc[fits], m), return_inverse=True)
            which = np.full(len(tokens), -1, np.int32)
            which[fits] = back
            found.append(distinct)
            self.of.append(which)
        every = np.concatenate(found)
        by = np.argsort(every)
        self.hashes = every[by]
        moved = np.empty(len(by), np.int32)
        moved[by] = np.arange(len(by), dtype=np.int32)
        begin = 0
        for distinct, which in zip(found, self.of, strict=True):
            np.copyto(which, moved[begin : begin + len(distinct)][which] if len(distinct) else which, where=which >= 0)
            begin += len(distinct)

    def needs(self) -> np.ndarray:
        """Count, in this block's training texts, of each gram in `hashes`."""
        counts = np.zeros(len(self.hashes), np.int64)
        for m in range(self.order):
            counts += np.bincount(self.of[m][(self.of[m] >= 0) & self.trains], minlength=len(counts))
        return counts


class BackoffAutomaton:
    """The grams of one block's tokens, with their counts in the whole corpus, by order."""

    def __init__(self, block: Block, totals: np.ndarray, tokens: int, distinct: int):
        self.block, self.space, self.tokens = block, ADD * (distinct + 1), tokens
        at = block.at
        self.known = totals[block.of[0][at]]
        self.arcs = []  # of each order: the places with such a gram, the state's count and the arc's count
        for m in range(1, block.order):
            fit = np.flatnonzero(block.of[m][at] >= 0)
            self.arcs.append((fit, totals[block.of[m - 1][at[fit] - 1]], totals[block.of[m][at[fit]]]))

    def base(self, less: int = 0) -> np.ndarray:
        return (np.maximum(self.known - less, 0) + ADD) / (self.tokens - less + self.space)

    def walk(self, prior: float, less: int = 0) -> np.ndarray:
        """log10 probability of every token but the begin tokens, in text order.

        What an automaton's arcs and failure arcs would add up to, by the recursion from the base upwards; a
        history that was not seen leaves the shorter one's value. `less` is taken out of every count on the way, for the token's own occurrence.
        """
        p = self.base(less)
        for fit, history, seen in self.arcs:
            longer = (np.maximum(seen - less, 0) + prior * p[fit]) / (np.maximum(history - less, 0) + prior)
            p[fit] = np.where(history > less, longer, p[fit])  # without the state the walk is at the shorter history
        return np.log10(p)


def _blob(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def _small(x: np.ndarray) -> np.ndarray:
    """Counts in the narrowest type that holds them; the type is read back from the length."""
    for t in (np.uint8, np.uint16, np.uint32):
        if not len(x) or x.max() <= np.iinfo(t).max:
            return x.astype(t)
    return x.astype(np.uint64)


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[len(data) // n]).astype(np.int64) if n else np.zeros(0, np.int64)


def _parts_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Cuts of the sorted hashes into equal hash ranges."""
    edges = np.array([(1 << 64) * i // parts for i in range(1, parts)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])


def _sum_part(table: pa.Table) -> pa.Table:
    """Totals of one hash range: for each block its grams' counts over all blocks, and the range's sums.

    The row with block -1 holds the training tokens and distinct tokens of the range.
    """
    blocks = table["block"].to_pylist()
    hashes = [np.frombuffer(x.as_py(), np.uint64) for x in table["hashes"]]
    counts = [_wide(x.as_py(), len(h)) for x, h in zip(table["counts"], hashes, strict=True)]
    every = np.concatenate(hashes)
    distinct, back = np.unique(every, return_inverse=True)
    total = np.bincount(back, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
    single = (distinct & ORDER_BITS == 0) & (distinct != _gram(np.array([BEGIN]), 0)[0])
    answers, at = [], 0
    for h in hashes:
        answers.append(_blob(_small(total[back[at : at + len(h)]])))
        at += len(h)
    part = table["part"][0].as_py()
    return pa.table({
        "block": pa.array([*blocks, -1], pa.int64()), "part": pa.array([part] * (len(blocks) + 1), pa.int64()),
        "totals": pa.array([*answers, b""], pa.binary()), "sizes": pa.array([*map(len, hashes), 0], pa.int64()),
        "tokens": pa.array([0] * len(blocks) + [int(total[single].sum())], pa.int64()),
        "distinct": pa.array([0] * len(blocks) + [int((total[single] > 0).sum())], pa.int64()),
    })


def _column(table: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays([c.cast(pa.large_string()) for c in table[name].chunks]) if table.num_rows else pa.array([], pa.large_string())


def score(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES, priors: tuple = PRIORS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, prior) of every row."""
    if not 1 <= order <= int(ORDER_BITS) + 1:
        raise ValueError("order must be between 1 and 8")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), (F.crc32(key) % 10 == 0).alias("held_out"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    parts = blocks
    dealt = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    src = src.withColumn("block", F.pmod(dealt, F.lit(blocks)))

    def block_of(table: pa.Table) -> Block:
        return Block(_column(table, "text"), table["held_out"].to_numpy().astype(bool), order)

    def ask(table: pa.Table) -> pa.Table:
        block = block_of(table)
        hashes, counts = block.hashes, block.needs()
        cut = _parts_of(hashes, parts)
        n = table["block"][0].as_py()
        rows = [(p, a, b) for p, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
        return pa.table({
            "block": pa.array([n] * len(rows), pa.int64()), "part": pa.array([p for p, _, _ in rows], pa.int64()),
            "hashes": pa.array([_blob(hashes[a:b]) for _, a, b in rows], pa.binary()),
            "counts": pa.array([_blob(_small(counts[a:b])) for _, a, b in rows], pa.binary()),
        })

    asked = src.groupBy("block").applyInArrow(ask, "block long, part long, hashes binary, counts binary")
    told = saved(asked.groupBy("part").applyInArrow(_sum_part, "block long, part long, totals binary, sizes long, tokens long, distinct long"), "lm-totals")
    corpus = told.filter("block = -1").agg(F.sum("tokens"), F.sum("distinct")).first()
    tokens, distinct = int(corpus[0] or 0), int(corpus[1] or 0)
    names = [f"score_{i}" for i in range(len(priors))]

    def walk(docs_of: pa.Table, answers: pa.Table) -> pa.Table:
        block = block_of(docs_of)
        by = np.argsort(answers["part"].to_numpy())
        sizes = answers["sizes"].to_numpy()
        totals = np.concatenate([_wide(answers["totals"][int(i)].as_py(), int(sizes[i])) for i in by])
        model = BackoffAutomaton(block, totals, tokens, distinct)
        row, trains = block.row[block.at], block.trains[block.at]
        add = lambda x: np.bincount(row, weights=x, minlength=block.rows)
        made = {
            "doc_id": docs_of["doc_id"], "held_out": docs_of["held_out"],
            "n_tokens": pa.array(add(None).astype(np.int64)), "n_known": pa.array(add(model.known > 0).astype(np.int64)),
            "base_score": pa.array(add(np.log10(model.base()))),
        }
        for i, k in enumerate(priors):
            made[f"score_{i}"] = pa.array(add(model.walk(k)))
            made[f"own_{i}"] = pa.array(add(np.where(trains, model.walk(k, less=1), 0.0)))
        return pa.table(made)

    fields = ["doc_id long", "held_out boolean", "n_tokens long", "n_known long", "base_score double"]
    fields += [f"{n} double" for i in range(len(priors)) for n in (f"score_{i}", f"own_{i}")]
    answers = told.filter("block >= 0").select("block", "part", "totals", "sizes")
    scored = saved(src.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(walk, ", ".join(fields)), "lm-scores")
    sums = scored.agg(*(F.sum(f"own_{i}") for i in range(len(priors)))).first()
    best = max(range(len(priors)), key=lambda i: (sums[i] if sums[i] is not None else 0.0, -i))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score",
        F.col(names[best]).alias("score"), F.lit(float(priors[best])).alias("prior"),
    )


def query(docs: DataFrame) -> DataFrame:
    return score(docs)
