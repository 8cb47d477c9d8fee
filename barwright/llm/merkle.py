"""Merkle manifest of a document table: three-way hash trees by source under one root.

Every row is a leaf, the SHA-256 of its fields with their lengths. The leaves of a source
ascend by doc_id and are hashed in runs of three up to the source's subroot; the
subroots, ordered by source, are hashed in the same way up to the root. Digests enter a
hash as hex text.

Building: the place of a leaf in its source comes from a range partitioning, rows counted
by partition and a running sum over these counts, so that no source is ranked in one
task. Four levels of a tree at a time make a tile: 81 consecutive nodes and the
four levels of hashes above them, one row of a grouping whose groups are bounded by 81.
Each node of a tile becomes a stored row that links to the tile's top node and holds
the siblings on the way there.

Climbing: a recursive query starts from the leaves and joins the node rows by the link
they stand at; each step appends the siblings there and folds every leaf's (perhaps
tampered) digest, until no link is left. The leaves of one tile have the same way up from its top, so they
climb in one row and the siblings beyond the tile are appended once for all 81. Since all tiles of a source meet in
its upper nodes, a node row stands once for every SPREAD tiles below it, and tiles
choose one of these copies by their place: no join key has many more rows than that.

Results: every input row has one result row. Null fields are hashed as `-`; a null
source is the first source of its own, a null doc_id comes first in its source and is never tampered with. Rows of
one doc_id are ordered by their leaf; equal rows have equal leaves, each with the proof of its own place. An empty text is a value
of length 0 and not the same as null. An empty table has no rows and no root. Further
columns of the input play no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.store import saved

FANOUT = 3
TILE_LEVELS = 4
TILE = FANOUT**TILE_LEVELS
SPREAD = 27  # tiles of leaves for each stored copy of an upper node
TOP = "top"  # the tree of subroots; sources are "-" for null, or "=" and their name
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _digest(fields: dict[str, Column]) -> Column:
    """SHA-256 of the fields, each `-` if null, else its length in bytes, `:` and itself."""
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in fields.values()]
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, tree, leaf, folded): every row's digest, and the digest to be folded.

    `folded` is the tampered row's: line feeds leave the text where the unsigned CRC-32 of doc_id is even.
    """
    fields = {c: F.col(c).cast("string") for c in FIELDS}
    hit = (F.crc32(fields["doc_id"]) % 2 == 0) & fields["text"].contains("\n")
    bare = {**fields, "text": F.replace(fields["text"], F.lit("\n"), F.lit(""))}
    leaf = _digest(fields)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), fields["source"]), F.lit("-")).alias("tree"),
        leaf.alias("leaf"), F.when(hit, _digest(bare)).alias("bare"),
    )
    return rows.select("doc_id", "tree", "leaf", F.coalesce("bare", "leaf").alias("folded"))


def placed(rows: DataFrame, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """`rows` with the range `part` they lie in and their place `inside` it, by tree and `order`; and
    (tree, part, start, total): the place in its tree where each part begins, and the tree's size."""
    dealt = rows.repartitionByRange("tree", *[F.col(c).asc_nulls_first() for c in order])
    dealt = saved(dealt.withColumn("part", F.spark_partition_id()), name)
    by_part = Window.partitionBy("tree").orderBy("part")
    starts = dealt.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "tree", "part", (F.sum("n").over(by_part) - F.col("n")).alias("start"),
        F.sum("n").over(Window.partitionBy("tree")).alias("total"))
    inside = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*[F.col(c).asc_nulls_first() for c in order])) - 1
    return dealt.withColumn("inside", inside), starts


# Hashes of all levels of a tile: its nodes, then each level made of the runs of the one before.
_LEVELS = f"""aggregate(slice(sequence(0, steps), 2, steps), array(run.h), (made, k) -> concat(made, array(
    transform(sequence(0, (size(made[k - 1]) - 1) div {FANOUT}),
              i -> sha2(concat_ws('', slice(made[k - 1], cast({FANOUT} * i as int) + 1, {FANOUT})), 256)))))"""
# The siblings of node `i` of a tile before and after it, level by level.
_SIBLINGS = f"""transform(transform(slice(sequence(0, steps), 1, steps), k -> struct(levels[k] as row, cast(i div cast(power({FANOUT}, k) as int) as int) as at)),
    x -> struct(concat_ws('', slice(x.row, x.at - x.at % {FANOUT} + 1, x.at % {FANOUT})) as before,
                concat_ws('', slice(x.row, x.at + 2, {FANOUT - 1} - x.at % {FANOUT})) as after))"""
_FOLD = "aggregate({steps}, {h}, (h, s) -> sha2(concat(s.before, h, s.after), 256))"
_PROOF = "unhex(array_join(transform({steps}, s -> concat(s.before, s.after)), ''))"


def _tiles(nodes: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each tile of (tree, idx, n, h, tiles, spos, keep): its hash levels, and the link of the node `made` on its top."""
    steps = reduce(lambda e, k: F.when(F.col("n") <= FANOUT**k, k).otherwise(e), range(TILE_LEVELS - 1, -1, -1), F.lit(TILE_LEVELS))
    made = nodes.groupBy("tree", F.expr(f"idx div {TILE}").alias("tile")).agg(
        F.sort_array(F.collect_list(F.struct("idx", "h", "tiles", *keep))).alias("run"), F.first("n").alias("n"), F.first("spos").alias("spos"))
    made = made.withColumn("steps", steps).withColumn("levels", F.expr(_LEVELS)).withColumn("made", F.expr("levels[steps][0]"))
    last = F.col("n") <= TILE
    below = F.lit(1).cast("long") if keep else F.expr("aggregate(run.tiles, 0L, (a, x) -> a + x)")
    return made.withColumn("below", below).select(
        "*", F.when(~last, F.col("tree")).when(F.col("tree") != TOP, TOP).alias("up_tree"), F.when(last, F.col("spos")).otherwise(F.col("tile")).alias("up_idx"))


def _above(tiles: DataFrame) -> DataFrame:
    """The nodes on top of the tiles, as nodes of the next level; tops of whole trees have n = 1."""
    return tiles.select("tree", F.col("tile").alias("idx"), F.expr(f"(n + {TILE - 1}) div {TILE}").alias("n"), F.col("made").alias("h"),
                        F.col("below").alias("tiles"), "spos")


def _trees(nodes: DataFrame, lvl: int, largest: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Stored rows of all nodes from level `lvl` on, each linked to the top of its tile, and every tree's top node."""
    stored, tops = [], [nodes.where("n = 1")]
    while largest > 1:
        tiles = saved(_tiles(nodes.where("n > 1"), []), f"{name}-tiles")
        stored.append(tiles.select("*", F.posexplode("run").alias("i", "node")).select(
            "tree", F.lit(lvl).alias("lvl"), F.col("node.idx").alias("idx"), F.col("node.tiles").alias("tiles"), F.expr(_SIBLINGS).alias("siblings"),
            F.col("made").alias("up"), "up_tree", F.when(F.col("n") <= TILE, 0).otherwise(lvl + 1).alias("up_lvl"), "up_idx",
            _copies("below").alias("up_copies")))
        nodes, lvl, largest = _above(tiles), lvl + 1, -(-largest // TILE)
        tops.append(nodes.where("n = 1"))
    return stored, reduce(DataFrame.unionByName, tops)


def _copies(tiles: str) -> Column:
    return F.ceil(F.col(tiles) / SPREAD).cast("long")


def build(leaf_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(climbers, nodes) of `leaves(docs)`: the tiles of leaves, digests folded up to their tops, and the stored node rows above."""
    rows, starts = placed(saved(leaf_rows, "merkle-leaves"), ["doc_id", "leaf"], "merkle-dealt")
    sizes = starts.groupBy("tree").agg(F.max("total").alias("total"))
    named, begins = placed(sizes.select(F.lit(TOP).alias("tree"), F.col("tree").alias("own"), "total"), ["own"], "merkle-sources")
    sources = named.join(begins.drop("total"), ["tree", "part"]).select(
        F.col("own").alias("tree"), (F.col("start") + F.col("inside")).alias("spos"), "total")
    sources = saved(sources, "merkle-places")
    size, count = sources.agg(F.coalesce(F.max("total"), F.lit(0)), F.count("tree")).first()
    # Places of sources meet the leaves by (tree, part): a hot source has as many such keys as parts.
    nodes = rows.join(starts.join(sources.drop("total"), "tree"), ["tree", "part"]).select(
        "tree", (F.col("start") + F.col("inside")).alias("idx"), F.col("total").alias("n"), F.col("leaf").alias("h"),
        F.lit(1).cast("long").alias("tiles"), "spos", "doc_id", "folded")
    tiles = saved(_tiles(nodes, ["doc_id", "folded"]), "merkle-leaf-tiles")
    stored, tops = _trees(_above(tiles), 1, -(-size // TILE), "merkle")
    subroots = tops.select(F.lit(TOP).alias("tree"), F.col("spos").alias("idx"), F.lit(count).cast("long").alias("n"), "h", "tiles",
                           F.lit(None).cast("long").alias("spos"))
    top_stored, _ = _trees(saved(subroots, "merkle-subroots"), 0, count, "merkle-top")
    up_tree = F.col("up_tree") if count > 1 else F.when(F.col("up_tree") != TOP, F.col("up_tree"))  # an only subroot is the root
    folded = F.expr(f"transform(run, (x, i) -> struct(x.doc_id, x.h, {_FOLD.format(steps=_SIBLINGS, h='x.folded')} as folded))")
    climbers = tiles.select(
        folded.alias("run"), "steps", F.lit(b"").alias("proof"), F.col("made").alias("up"), F.col("tile").alias("place"), up_tree.alias("tree"),
        F.when(F.col("n") <= TILE, 0).otherwise(1).alias("lvl"), F.col("up_idx").alias("idx"),
        F.when(F.col("up_tree") == TOP, F.col("made")).alias("subroot"), F.lit(0).cast("long").alias("copy"))
    # A tile's own top is one tile; as the top of a whole tree it stands among the copies of a subroot that has it alone.
    columns = "tree string, lvl int, idx long, tiles long, siblings array<struct<before:string,after:string>>, up string, up_tree string, up_lvl int, up_idx long, up_copies long"
    stored = reduce(DataFrame.unionByName, stored + top_stored or [leaf_rows.sparkSession.createDataFrame([], columns)])
    stored = stored.withColumn("up_tree", up_tree).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), _copies("tiles") - 1))).drop("tiles")
    return saved(climbers, "merkle-climbers"), saved(stored, "merkle-nodes")


_CLIMB = f"""
WITH RECURSIVE climb(run, steps, proof, up, place, tree, lvl, idx, subroot, copy) AS (
  SELECT run, steps, proof, up, place, tree, lvl, idx, subroot, copy FROM {{climbers}}
  UNION ALL
  SELECT transform(c.run, x -> named_struct('doc_id', x.doc_id, 'h', x.h, 'folded', {_FOLD.format(steps="n.siblings", h="x.folded")})), c.steps,
         concat(c.proof, {_PROOF.format(steps="n.siblings")}), n.up, c.place, n.up_tree, n.up_lvl, n.up_idx,
         coalesce(c.subroot, CASE WHEN n.up_tree = '{TOP}' OR n.up_tree IS NULL THEN n.up END), c.place % n.up_copies
  FROM climb c JOIN {{nodes}} n ON c.tree = n.tree AND c.lvl = n.lvl AND c.idx = n.idx AND c.copy = n.copy
), arrived AS (
  SELECT posexplode(run) AS (i, x), steps, proof, up, subroot, levels FROM (SELECT *, {_LEVELS} AS levels FROM climb WHERE tree IS NULL)
)
SELECT x.doc_id, x.h AS leaf, subroot, up AS root,
       sha2(concat(array_join(transform({_SIBLINGS}, s -> concat(s.before, s.after)), ''), lower(hex(proof))), 256) AS proof_sha256,
       x.folded AS folded_root, x.folded = up AS verified
FROM arrived
"""


def climb(climbers: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every leaf's proof and folded root, by a recursive query over the stored node rows."""
    spark = climbers.sparkSession
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")  # rows of all steps together; the steps are bounded by the height of the trees
    try:
        return saved(spark.sql(_CLIMB, climbers=climbers, nodes=nodes), "merkle-proofs")
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)


def query(docs: DataFrame) -> DataFrame:
    return climb(*build(leaves(docs)))


def _oracle_tree(start: str, name: str, levels: int) -> str:
    """CTEs for the levels of the trees in `start` (tree, idx, n, h): nodes {name}<k> and siblings {name}_by<k>."""
    out = []
    for k in range(levels):
        below = start if k == 0 else f"{name}{k}"
        run = f"OVER (PARTITION BY tree, idx // {FANOUT} ORDER BY idx ROWS BETWEEN "
        out.append(f"""{name}_by{k} AS MATERIALIZED (SELECT tree, idx, coalesce(string_agg(h, '') {run}UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
  coalesce(string_agg(h, '') {run}1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {below} WHERE n > 1)""")
        out.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT tree, idx // {FANOUT} AS idx, (max(n) + {FANOUT - 1}) // {FANOUT} AS n, sha256(string_agg(h, '' ORDER BY idx)) AS h
  FROM {below} WHERE n > 1 GROUP BY tree, idx // {FANOUT})""")
    tops = " UNION ALL ".join(f"SELECT tree, h FROM {start if k == 0 else f'{name}{k}'} WHERE n = 1" for k in range(levels + 1))
    out.append(f"{name}_top AS MATERIALIZED ({tops})")
    return ",\n".join(out)


def oracle(levels: int = 13, source_levels: int = 8) -> str:
    """DuckDB SQL of `query`, for up to 3^levels rows a source and 3^source_levels sources."""

    def field(x: str) -> str:
        return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"

    fields = [field(x) for x in FIELDS]
    bare = " || ".join([*fields[:-1], field("replace(text, chr(10), '')")])
    # CRC-32 bit by bit: a byte is XORed in, and eight shifts (-1) follow it.
    shifts = ", ".join(["-1"] * 8)
    crc = f"""xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), {shifts}]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""
    climbs, at = [], "placed"
    for name, steps, key in (("d", levels, "tree"), ("s", source_levels, "'top'")):
        for k in range(steps):
            idx = f"c.idx // {FANOUT**k}" if name == "d" else f"c.spos // {FANOUT**k}"
            made = f"{name}_climb{k}"
            climbs.append(f"""{made} AS MATERIALIZED (SELECT c.* EXCLUDE (folded, proof), coalesce(sha256(b.before || c.folded || b.after), c.folded) AS folded,
  c.proof || coalesce(b.before || b.after, '') AS proof FROM {at} c LEFT JOIN {name}_by{k} b ON b.tree = {key if name == "s" else "c.tree"} AND b.idx = {idx})""")
            at = made
    return f"""
WITH hashed AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '-') AS tree, sha256({" || ".join(fields)}) AS leaf, sha256({bare}) AS bare, {crc} AS crc FROM documents
), placed AS MATERIALIZED (
  SELECT doc_id, tree, leaf, CASE WHEN crc % 2 = 0 THEN bare ELSE leaf END AS folded, '' AS proof,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n,
         dense_rank() OVER (ORDER BY encode(tree)) - 1 AS spos
  FROM hashed
), start AS MATERIALIZED (SELECT tree, idx, n, leaf AS h FROM placed),
{_oracle_tree("start", "d", levels)},
sources AS MATERIALIZED (SELECT 'top' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS n, h FROM d_top),
{_oracle_tree("sources", "s", source_levels)},
{", ".join(climbs)}
SELECT c.doc_id, c.leaf, d.h AS subroot, s.h AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = s.h AS verified
FROM {at} c JOIN d_top d ON d.tree = c.tree JOIN s_top s ON true
"""
