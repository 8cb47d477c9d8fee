import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from helpers import odd_docs

from barwright.llm import bpe


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_exact_merges(reference):
    c = bpe.codec(*bpe.default_vocabulary())
    random.seed(3)
    marks = [chr(i) for i in [*range(0, 300), 0x3000, 0x2028, 0x1F600, 0x4E2D, 0x301]]
    texts = ["".join(random.choice(marks) for _ in range(random.randint(0, 50))) for _ in range(500)]
    texts += ["a" * 20_000, "ab" * 9000, " " * 3000 + "x", "the" * 3000, "<|endoftext|>", "", "1234567890" * 50]
    texts += ["a b", " a b", "a  b c", "a b ", "a\n b c", "a \nb", "it's  it's 's", "x\u3000 y z", "a\x1c b", "12 34. 56,7 !!", " ", "  "]
    texts += [" ".join(random.choice(["we'll", "a,b", "x", "\n", "", "\t", "1.5", "\u00a0"]) for _ in range(20)) for _ in range(300)]
    for t in texts:
        ids = c.encode(t)
        assert ids == reference.encode_ordinary(t)
        assert c.decode(ids) == t.encode()
        sha = lambda b: hashlib.sha256(b).hexdigest()
        assert c.digest(t) == (len(ids), sha(",".join(map(str, ids)).encode()), sha(t.encode()))


def test_tokens_that_merges_cannot_reach():
    # "abc" can only come whole; "ab" + "c" is no merge result of its own as a part
    ranks = {b"a": 0, b"b": 1, b"c": 2, b"bc": 3, b"ab": 4, b"abcd": 5, b"d": 6}
    c = bpe.Codec(ranks, r"\S+|\s+")
    e = tiktoken.Encoding("small", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={}, explicit_n_vocab=7)
    for t in ("abc", "abcd", "aabcd", "abcdabc", "bcd", "abab", "dabcdd"):
        assert c.encode(t) == e.encode_ordinary(t), t


def test_odd_rows(spark, reference):
    docs = odd_docs(spark)
    got = sorted(map(tuple, bpe.query(docs).collect()), key=str)
    want = []
    for r in docs.collect():
        ids = reference.encode_ordinary(r.text or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode())))
    assert got == sorted(want, key=str)
    path = bpe.default_vocabulary()
    back = bpe.decode(bpe.encode(docs, *path), *path)
    assert sorted(bytes(r.data).decode() for r in back.collect()) == sorted(r.text or "" for r in docs.collect())
    assert bpe.query(docs.limit(0)).count() == 0
