import hashlib
import os
import random
import shutil
import subprocess
import sys

import corpus_pipeline as cp
import duckdb
import pytest

from helpers import odd_docs, words

from barwright.llm import queries, quality_rules, simhash

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF001 = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    assert [n for n, _ in cp.STAGES] == ["quality", "near_dedup", "passages", "mix", "tokens"]
    kept = cp.quality(spark, docs, SF001)
    good = {r.doc_id for r in quality_rules.query(docs, labels).collect() if r.kept}
    assert {r.doc_id for r in kept.collect()} == good and kept.columns == docs.columns
    one = cp.near_dedup(spark, kept, SF001)
    want = {r.component_id for r in simhash.query(kept).collect()}
    assert {r.doc_id for r in one.collect()} == want and one.columns == docs.columns
    cut = cp.passages(spark, one, SF001)
    assert cut.columns == docs.columns and {r.doc_id for r in cut.collect()} <= want
    assert cp.mix(spark, cut, SF001).columns == docs.columns
    out = cp.run(spark, SF001)
    rows = out.collect()
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows and {r.doc_id for r in rows} <= ids


def run_on(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return cp.run(spark, str(folder))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_run_on_odd_rows_and_an_empty_table(spark, tmp_path):
    """The one text that passes the base rule, kept once of its copies, in a table with clashing columns."""
    out = run_on(spark, tmp_path / "odd", odd_docs(spark))
    assert {(r.doc_id, r.decoded_sha256) for r in out.collect()} == {(1, sha("one two three four five six seven eight nine ten eleven"))}
    assert run_on(spark, tmp_path / "none", odd_docs(spark).limit(0)).count() == 0


def test_run_on_planted_documents(spark, tmp_path):
    """Clean documents stay whole, copies and junk go, a passage that repeats an earlier document's is cut."""
    rng = random.Random(21)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows = [(i, text(rng.randint(60, 120))) for i in range(50)]
    copies = [(100 + i, rows[i][1]) for i in range(20)] + [(200 + i, rows[0][1]) for i in range(10)]
    junk = [(300, "too short"), (301, "again and again and so " * 30), (302, None), (303, "")]
    ahead, behind = text(40), text(40)
    passage = rows[7][1]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in [*rows, *copies, *junk, (400, f"{ahead} {passage} {behind}")]], "doc_id long, text string, lang string, source string, n_chars long")
    got = {}
    for r in run_on(spark, tmp_path / "planted", docs).collect():
        got.setdefault(r.doc_id, []).append(r.decoded_sha256)
    assert set(got) == {*range(50), 400}
    assert all(set(got[i]) == {sha(t)} for i, t in rows)
    assert len(set(got[400])) == 1 and got[400][0] != sha(f"{ahead} {passage} {behind}")
    assert all(1 <= len(x) <= 2 for x in got.values())
    size = {i: len(words(t)) for i, t in rows}
    assert abs(sum(size[i] * len(got[i]) for i in size) + 80 * len(got[400]) - 1.5 * (sum(size.values()) + 80)) < 200


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.sql(f"create view {table} as select * from '{SF001}/{table}.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF001)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == sorted(want.select(*columns).fetchall(), key=str)


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_entry_without_this_subpackage(tmp_path):
    """The driver may delete the folders: the rest still imports."""
    shutil.copytree(os.path.join(ROOT, "barwright"), tmp_path / "barwright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)
