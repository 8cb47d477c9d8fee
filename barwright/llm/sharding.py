"""Sharding by a permutation-filled lookup table, with DataFrame functions only.

Every shard has its own preference order over the slots of a table of prime size: start
and stride come from a hash of the shard's name. The shards take turns, each claiming
the first slot of its order that is still free, until all slots are claimed; so slots
are spread evenly, and a shard that comes or goes moves few of the others' slots. A key is
placed by its hash: slot = hash mod table size, shard = owner of the slot. The table has
`slots` rows whatever the input's size, and is broadcast.

Results: every row is placed. A null key is placed by the row's whole text, so null keys
don't meet in one shard; a row without either goes where the empty key goes. Repeated
keys share a slot. Further columns are carried; input columns named slot or shard are
replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS, SLOTS = 32, 4099
MAX_SLOTS = 1_000_003


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def table(shards: int, slots: int) -> list[int]:
    """Owner of every slot."""
    if slots > MAX_SLOTS or slots < shards or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime between the number of shards and the bound of the broadcast table")
    owner = [-1] * slots
    at = [_number(f"start-{i}") % slots for i in range(shards)]
    stride = [_number(f"stride-{i}") % (slots - 1) + 1 for i in range(shards)]
    for turn in range(slots):
        i = turn % shards
        while owner[at[i]] >= 0:
            at[i] = (at[i] + stride[i]) % slots
        owner[at[i]] = i
    return owner


def lookup(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard) for every slot."""
    rows = ", ".join(f"({s}, {o})" for s, o in enumerate(table(shards, slots)))
    return spark.sql(f"SELECT CAST(slot AS BIGINT) AS slot, shard FROM VALUES {rows} AS t(slot, shard)")


def slot_of(key: Column, text: Column, slots: int) -> Column:
    whole = F.coalesce(key.cast("string"), F.concat(F.lit("text:"), text), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("long"), F.lit(slots).cast("long"))


def place(docs: DataFrame, key: str = "doc_id", shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """`docs` with slot and shard."""
    rows = docs.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), F.col("text"), slots))
    return rows.join(F.broadcast(lookup(docs.sparkSession, shards, slots)), "slot").select(*docs.drop("slot", "shard").columns, "slot", "shard")


def write(docs: DataFrame, path: str, key: str = "doc_id", shards: int = SHARDS, slots: int = SLOTS, spread: int = 16) -> None:
    """Parquet folders shard=0, shard=1, ...; each shard is written by up to `spread` tasks."""
    out = place(docs, key, shards, slots)
    out.repartition(shards * spread, "shard", F.pmod("slot", F.lit(spread))).write.partitionBy("shard").parquet(path)


def query(docs: DataFrame) -> DataFrame:
    return place(docs.select("doc_id", "text")).select("doc_id", "slot", "shard")


def oracle(shards: int = SHARDS, slots: int = SLOTS) -> str:
    """The same for DuckDB; the filled table is a list (the filling itself is tested apart)."""
    return f"""
WITH keyed AS (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'text:' || text, '')), 1, 15))::BIGINT % {slots} AS slot FROM documents)
SELECT doc_id, slot, {table(shards, slots)}[slot + 1]::INTEGER AS shard FROM keyed"""
