import numpy as np
import pyarrow as pa
from helpers import lower, words
from hypothesis import given, settings
from hypothesis import strategies as st

from barwright.llm.words import BLOCK, _lower, _space, hashed_words, joined, mix64, ngram_hashes, split_words, steps

TEXT = st.text(alphabet=st.sampled_from(list("aAbB zZ\t\n\r\x0b\x0c\x1c\x85 　é😀")), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8))
def test_words_and_counts(texts):
    col = pa.array(["x", *texts], pa.string()).slice(1)
    w = split_words(col, lower=True)
    got = [[] for _ in texts]
    for r, s, e in zip(w.row, w.start, w.end):
        got[r].append(w.buf[s:e].tobytes().decode())
    assert got == [words(lower(t)) for t in texts]
    data, begin, end = joined(w)
    assert [data[b:e].decode() for b, e in zip(begin, end)] == [x for g in got for x in g]


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_hashes_follow_the_words(texts):
    count, h = hashed_words(pa.array(texts, pa.string()), lower=False)
    flat = [w for t in texts for w in words(t)]
    assert len(set(flat)) == len(set(h.tolist())) and len(flat) == len(h)
    row = np.repeat(np.arange(len(count)), count)
    grams, at = ngram_hashes(h, row, 2)
    pairs = [(i, a, b) for i, t in enumerate(texts) for a, b in zip(words(t), words(t)[1:])]
    assert len(grams) == len(pairs) and len(set(grams.tolist())) == len({p[1:] for p in pairs})


def test_steps_cut_between_rows():
    b = pa.RecordBatch.from_arrays([pa.array(["a" * 10] * 7 + [None, "b" * 100])], names=["t"])
    parts = list(steps(iter([b]), "t", 25))
    assert sum(p.num_rows for p in parts) == 9 and max(p.num_rows for p in parts) <= 3
    assert list(steps(iter([b.slice(0, 0)]), "t")) == []


def test_long_words():
    count, h = hashed_words(pa.array(["a" * 300 + " " + "a" * 301, "a" * 300]), lower=False)
    assert count.tolist() == [2, 1] and h[0] == h[2] != h[1]


def test_blocks_of_numbers_and_bytes():
    """Hashes do not depend on the blocks they are made in, and all bytes are told apart as the pattern does."""
    rng = np.random.default_rng(43)
    h, row = rng.integers(0, 1 << 63, 2 * BLOCK + 100).astype(np.uint64), np.zeros(2 * BLOCK + 100, np.int64)
    value, at = ngram_hashes(h, row, 5)
    assert len(value) == len(h) - 4 and at.tolist() == list(range(len(value)))
    for i in (0, BLOCK - 5, BLOCK - 1, BLOCK, 2 * BLOCK - 3, len(value) - 1):
        assert value[i] == ngram_hashes(h[i : i + 5], row[:5], 5)[0][0] and mix64(h)[i] == mix64(h[i : i + 1])[0]
    every = np.arange(256, dtype=np.uint8)
    assert np.flatnonzero(_space(every)).tolist() == [9, 10, 11, 12, 13, 32]
    assert _lower(every).tobytes() == bytes(range(256)).lower()
