import collections
import hashlib

import duckdb
import pytest
from helpers import docs_of, odd_docs

from barwright.llm import sharding


def number(s):
    return int(hashlib.md5(s.encode()).hexdigest()[:15], 16)


def filled(shards, slots):
    """Turn by turn, from each shard's written-out order of preference."""
    order = [[(number(f"start-{i}") + k * (number(f"stride-{i}") % (slots - 1) + 1)) % slots for k in range(slots)] for i in range(shards)]
    assert all(sorted(o) == list(range(slots)) for o in order)
    owner = {}
    for turn in range(slots):
        mine = order[turn % shards]
        owner[next(s for s in mine if s not in owner)] = turn % shards
    return [owner[s] for s in range(slots)]


def test_table_is_filled_in_turns():
    for shards, slots in ((1, 5), (3, 101), (7, 211)):
        assert sharding.table(shards, slots) == filled(shards, slots)
    size = collections.Counter(sharding.table(sharding.SHARDS, sharding.SLOTS))
    assert max(size.values()) - min(size.values()) <= 1


def test_one_shard_less_moves_little():
    a, b = sharding.table(20, 4099), sharding.table(19, 4099)
    moved = sum(x != y for x, y in zip(a, b) if x != 19)
    assert moved < 0.2 * 4099


def test_bad_tables():
    for shards, slots in ((3, 100), (10, 7), (2, 1_000_033)):
        with pytest.raises(ValueError):
            sharding.table(shards, slots)


def test_odd_rows_and_sql(spark):
    docs = odd_docs(spark)
    got = sharding.query(docs).collect()
    owner = sharding.table(sharding.SHARDS, sharding.SLOTS)
    want = []
    for r in docs.collect():
        key = str(r.doc_id) if r.doc_id is not None else ("text:" + r.text if r.text is not None else "")
        want.append((r.doc_id, number(key) % sharding.SLOTS, owner[number(key) % sharding.SLOTS]))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sharding.query(docs.limit(0)).count() == 0
    wide = sharding.place(docs)
    assert wide.columns == [c for c in docs.columns if c != "shard"] + ["slot", "shard"]
    documents = docs.toPandas()  # noqa: F841
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    sql = duckdb.connect().sql(sharding.oracle()).fetchall()
    assert sorted(sql, key=str) == sorted(map(tuple, got), key=str)


def test_files(spark, scratch):
    docs = docs_of(spark, [f"text {i}" for i in range(200)])
    sharding.write(docs, scratch + "/out", shards=5, slots=101)
    back = spark.read.parquet(scratch + "/out")
    assert back.count() == 200 and back.select("shard").distinct().count() == 5
