import random

import duckdb
import pytest
from helpers import docs_of, lower, odd_docs

import re

from barwright.llm import license_scan as ls


def brute(text):
    w = re.findall(ls.WORD, lower(text))
    places, labels = [], set()
    for phrase, label in ls.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_places(spark):
    random.seed(12)
    bits = ["MIT", "License", "mit license", "Apache  License", "general", "public", "GENERAL-public_license", "é", "x", "license,mit license.", "\x00"]
    texts = [" ".join(random.choices(bits, k=random.randint(0, 25))) for _ in range(80)] + [None, ""]
    got = {r.doc_id: tuple(r)[1:6] for r in ls.query(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [brute(t) for t in texts]


def test_notices_with_small_changes(spark):
    whole = next(n for n in ls.NOTICES if n.startswith("Redistribution"))
    cut = whole.replace("with or without", "with, or even without")  # one word more
    half = " ".join(whole.split()[:9])
    far = whole.split()
    got = {r.doc_id: (r.labels, r.score) for r in ls.query(docs_of(spark, [whole, f"x y {cut} z", half, " ".join(far[::-1]), "Licensed under CC BY-NC 4.0."])).collect()}
    assert got[0] == ("bsd", 1.0) and got[1][0] == "bsd" and 0.85 <= got[1][1] < 1
    assert got[2][0] == got[3][0] == "" and got[4][0] == "cc-by-nc-4.0"


def labels_of(text):
    """Labels of a text by trying every begin of every span."""
    w = lower_words(text)
    out = set()
    for notice, label in ls.NOTICES.items():
        t = lower_words(notice)
        hits = sorted({(i - j, i, j) for i in range(len(w) - 1) for j in range(len(t) - 1) if w[i : i + 2] == t[j : j + 2]})
        bands = []
        for d, i, j in hits:
            if bands and d - bands[-1][-1][0] <= ls.BAND:
                bands[-1].append((d, i, j))
            else:
                bands.append([(d, i, j)])
        for band in bands:
            for _, begin, _ in band:
                covered = {j for _, i, j in band if 0 <= i - begin and i - begin + 2 <= ls.STRETCH * len(t)}
                if (len(covered) + 1) / len(t) >= ls.COVER:
                    out.add(label)
    return ",".join(sorted(out | set(filter(None, brute(text)[4].split(",")))))


def lower_words(text):
    return re.findall(ls.WORD, lower(text))


def test_stray_words_beside_a_notice(spark):
    mit = "Released under the MIT License"
    texts = [f"{mit}.", f"{mit} (MIT License).", f"under the {mit}.", f"under the MIT license under the {mit} the MIT License", f"{mit} {mit} under the MIT",
             "Released, see under the MIT or other License", "under the MIT License under the MIT License", "Licensed under the " + "Licensed under the Apache License, Version 2.0 License, Version 2.0"]
    random.seed(3)
    bits = [w for n in list(ls.NOTICES)[:3] for w in n.split()] + ["x"]
    for _ in range(150):
        notice = random.choice(list(ls.NOTICES)).split()
        body = [w for w in notice if random.random() > 0.05]
        texts.append(" ".join(random.choices(bits, k=random.randint(0, 12)) + notice[: random.randint(0, 5)] + body + notice[-random.randint(1, 5) :] + random.choices(bits, k=3)))
    docs = docs_of(spark, texts)
    got = {r.doc_id: r for r in ls.query(docs).collect()}
    assert [got[i].labels for i in range(len(texts))] == [labels_of(t) for t in texts]
    assert all("mit-notice" in got[i].labels for i in range(5)) and got[6].labels == "mit"
    con = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841
    assert sorted(con.sql(ls.oracle()).fetchall()) == sorted(map(tuple, got.values()))


def test_odd_rows_and_sql(spark):
    docs = odd_docs(spark)
    got = ls.query(docs).collect()
    want = [(r.doc_id, *brute(r.text)) for r in docs.collect()]
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    assert ls.query(docs.limit(0)).count() == 0
    con = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841
    sql = con.sql(ls.oracle()).fetchall()
    assert sorted(((int(r[0]) if r[0] is not None and r[0] == r[0] else None, *r[1:]) for r in sql), key=str) == sorted(map(tuple, got), key=str)


def test_templates_must_stay_small(spark):
    with pytest.raises(ValueError):
        ls.templates(spark, {"a b " * 60_000: "x"}, {}).count()
