"""Byte-level BPE by backtracking over longest matches.

A piece (one match of the split pattern) is read as Latin-1, one character a byte,
and an Aho-Corasick automaton over the vocabulary finds the longest token at every
place. Tokens are laid down left to right, each the longest that is compatible with
the one before; where none fits, the last token is shortened. Two tokens are
compatible if merging their joint bytes gives those two tokens back; a row of tokens
whose neighbours are all compatible is the exact merge result, so the outcome equals
merging by rank. Compatibility, shortenings and whole pieces are memoised, and a
place that failed once is not tried again, so a piece takes linear time.

Vocabulary: the path of a rank file (base64 token and rank on each line), a parameter;
each executor needs the file at that path.

Results: null and empty texts have no tokens. A null doc_id stays null; repeated rows
come out as often as they come in; further columns of the input play no part.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from barwright.llm.store import doc_columns
from barwright.llm.words import steps

MEMO_ENTRIES = 400_000  # of each of a memo's two halves in a Python worker


class _Memo(dict):
    """Made values in two halves: a full new half becomes the old one, and what is still asked for moves on."""

    def __init__(self, make):
        self._make, self._old = make, {}

    def __missing__(self, key):
        if len(self) >= MEMO_ENTRIES:
            self._old = dict(self)
            self.clear()
        value = self._old[key] if key in self._old else self._make(key)
        self[key] = value
        return value


class Codec:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.size = {r: len(t) for t, r in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.shorter = _Memo(self._shorter)
        self.compatible = _Memo(self._compatible)
        self.piece = _Memo(self._piece)
        self.reachable = _Memo(lambda r: len(self.bytes_of[r]) == 1 or self.merge(self.bytes_of[r]) == [r])
        self.trie = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.trie.add_word(token.decode("latin-1"), (len(token), rank))
        self.trie.make_automaton()

    def merge(self, data: bytes) -> list[int]:
        """Ranks of `data` by repeated lowest-rank merges; only for short data."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def _shorter(self, rank: int) -> int | None:
        """The longest reachable token that is a proper prefix of this one."""
        token = self.bytes_of[rank]
        for n in range(len(token) - 1, 0, -1):
            r = self.ranks.get(token[:n])
            if r is not None and self.reachable[r]:
                return r
        return None

    def _compatible(self, pair: tuple[int, int]) -> bool:
        return self.merge(self.bytes_of[pair[0]] + self.bytes_of[pair[1]]) == list(pair)

    def encode_bytes(self, data: bytes) -> list[int]:
        """Exact merge result of one piece."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        size, compatible, shorter, reachable = self.size, self.compatible, self.shorter, self.reachable
        n = len(data)
        longest: list[int | None] = [None] * n
        for last, (length, rank) in self.trie.iter(data.decode("latin-1")):
            if reachable[rank]:  # matches come by their end, so of one start the longest comes last
                longest[last - length + 1] = rank
        out: list[int] = []
        dead = bytearray(n + 1)
        at, rank = 0, longest[0] if n else None
        while at < n:
            while rank is not None:
                end = at + size[rank]
                if not dead[end] and (not out or compatible[out[-1], rank]):
                    break
                rank = shorter[rank]
            if rank is not None:
                out.append(rank)
                at = end
                rank = longest[at] if at < n else None
            elif not out:
                raise ValueError("the vocabulary cannot spell these bytes")
            else:
                dead[at] = 1
                rank = out.pop()
                at -= size[rank]
                rank = shorter[rank]
        return out

    def encode(self, text: str) -> list[int]:
        return [r for p in self.split(text) for r in self.encode_bytes(p.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def _piece(self, piece: str) -> tuple[str, bytes]:
        ids = self.encode_bytes(piece.encode())
        return ",".join(map(str, ids)), self.decode(ids)

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of the joined ids and of the decoded bytes."""
        found = list(map(self.piece.__getitem__, self.split(text)))
        ids = ",".join([x for x, _ in found])
        raw = b"".join([x for _, x in found])
        return ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for a rank file; it outlives tasks, as do its memos."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
    return Codec(ranks, pattern)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in steps(batches, "text"):
            ids = [c.encode(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return doc_columns(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, data binary) of every row of (doc_id, ids); null ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            raw = [c.decode(x.as_py() or []) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(raw, pa.binary())], names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, encoded and decoded in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in steps(batches, "text"):
            made = [c.digest(t) for t in pc.fill_null(b.column("text"), "").to_pylist()]
            n, ids, raw = zip(*made, strict=True)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return doc_columns(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(docs: DataFrame) -> DataFrame:
    return digests(docs, *default_vocabulary())
