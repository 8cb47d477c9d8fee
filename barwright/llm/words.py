"""Vectorised words of Arrow text columns: spans, 64-bit hashes, n-gram hashes.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, which for UTF-8 is
the pattern [^\\x20\\x09-\\x0D]+. Lower-casing touches A-Z alone. Texts are whole;
batches are cut between rows so that one step holds a bounded number of bytes
(a single longer text makes a step of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STEP_BYTES = 2 << 20

BLOCK = 1 << 14  # numbers that are worked on together, so that they stay in the processor's cache


def _space(buf: np.ndarray) -> np.ndarray:
    """Which bytes are 0x20 or 0x09-0x0D."""
    return (buf == 0x20) | (buf - np.uint8(9) < 5)


def _lower(buf: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased."""
    return buf + ((buf - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64 constants)."""
    x = x.astype(np.uint64, order="C", copy=True)
    flat = x.reshape(-1)
    shifted = np.empty(min(len(flat), BLOCK), np.uint64)
    for i in range(0, len(flat), BLOCK):
        part = flat[i : i + BLOCK]
        other = shifted[: len(part)]
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            part ^= np.right_shift(part, np.uint64(shift), out=other)
            if factor > 1:
                part *= np.uint64(factor)
    return x


def _multipliers(n: int) -> np.ndarray:
    return mix64((np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_MULT = _multipliers(64)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows, and the offsets of the rows in them; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    _, offsets, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """Words of `rows` texts: spans [start, end) in `buf`, `row` of each word."""

    buf: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows).astype(np.int64)

    def first(self) -> np.ndarray:
        """Index of each row's first word, and one past the last row's words."""
        return np.concatenate([[0], np.cumsum(self.counts())])


def split_words(col: pa.Array, lower: bool) -> Words:
    buf, offsets = text_buffer(col)
    if lower:
        buf = _lower(buf)
    n = len(buf)
    inside = ~_space(buf)
    cut = offsets[:-1][offsets[:-1] < n]
    before = np.empty(n, bool)
    before[1:] = inside[:-1]
    if n:
        before[cut] = False
        before[0] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[:-1] = inside[1:]
    if n:
        after[-1] = False
        after[cut[cut > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(buf, offsets, start, end, row)


def _span_index(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions of the spans, one after another."""
    total = int(length.sum())
    shift = np.repeat(start - np.concatenate([[0], np.cumsum(length)[:-1]]), length) if len(length) else np.zeros(0, np.int64)
    return np.arange(total, dtype=np.int64) + shift


def word_hashes(w: Words) -> np.ndarray:
    """64-bit multilinear hash of each word's bytes."""
    if not len(w.start):
        return np.zeros(0, np.uint64)
    global _MULT
    length = w.end - w.start
    longest = int(length.max())
    if longest > len(_MULT):
        _MULT = _multipliers(2 * longest)
    raw = w.buf[~_space(w.buf)]  # the words' bytes, one word after another
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    pos = np.arange(len(raw), dtype=np.int64) - np.repeat(first, length)
    terms = raw.astype(np.uint64)
    terms += np.uint64(1)
    terms *= _MULT.take(pos)
    return mix64(np.add.reduceat(terms, first))


def joined(w: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words joined by one space each; begin and end of each word in that."""
    length = w.end - w.start
    begin = np.concatenate([[0], np.cumsum(length + 1)[:-1]]) if len(length) else np.zeros(0, np.int64)
    out = np.full(int((length + 1).sum()), 0x20, np.uint8)
    out[_span_index(begin, length)] = w.buf[_span_index(w.start, length)]
    return out.tobytes(), begin, begin + length


def ngram_hashes(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n consecutive words inside one row, and the index of their first word."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(h) - n + 1
    acc = h[:m].copy()
    for i in range(0, m if n > 1 else 0, BLOCK):
        part = acc[i : i + BLOCK]
        for j in range(1, n):
            part = mix64(part + np.uint64(0x9E3779B97F4A7C15)) + h[i + j : i + j + len(part)]
        acc[i : i + len(part)] = mix64(part)
    at = np.flatnonzero(row[:m] == row[n - 1 : n - 1 + m])
    return acc[at], at


def steps(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut between rows to at most `max_bytes` of text where possible."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            done = size[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(size, done + max_bytes, side="right")))
            yield batch.slice(begin, stop - begin)
            begin = stop


def hashed_words(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Number of words of each row, and all words' hashes; made step by step to bound memory."""
    batch = pa.RecordBatch.from_arrays([texts], names=["t"])
    counts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for b in steps(iter([batch]), "t", STEP_BYTES // 4):
        w = split_words(b.column(0), lower)
        counts.append(w.counts())
        hashes.append(word_hashes(w))
    return np.concatenate(counts), np.concatenate(hashes)
