"""Brute-force pieces for the operator tests."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return (text or "").encode().lower().decode()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def docs_of(spark, texts, langs="en", sources="a"):
    rows = [(i, t, langs, sources, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (1, "one two three four five six seven eight nine ten eleven", "en", "a", 3),
        (1, "one two three four five six seven eight nine ten eleven", "en", "a", 3),
        (2, "one two three four five six seven eight nine ten eleven", "en", "b", 3),
        (2, "another text under the same id", None, "b", 3),
        (3, "", "en", None, 0), (4, None, None, None, None), (5, " \t\n ", "de", "b", 4),
        (None, "no id here", "en", "a", 9), (None, None, None, None, None), (6, long, "en", "a", len(long)),
        (7, "é😀 ß　x\x00y", "fr", "ü", 8),
    ]
    schema = DOCS + ", size long, block long, src string, fp long, __text string, shard int, bin int, rank int, target double"
    return spark.createDataFrame([(*r, 1, 2, "s", 3, "t", 4, 5, 6, 0.5) for r in rows], schema)
