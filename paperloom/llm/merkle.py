"""A manifest of a table as a forest of hash trees, and proofs climbed by a recursive query.

Every row is a leaf. Leaves of one group (a language, say) in ascending order
of their key form a tree: runs of eight consecutive nodes become one node until
a single one is left, the group's subroot; subroots in order of the groups form
the top tree in the same way, up to the root. Built levels are stored as rows
that know their parent, and a recursive query climbs from the leaves over those
links, gathering the siblings met on the way and folding a claimed hash with
them. A claimed row is the one in the manifest if its folded hash is the root.

Hashes are SHA-256 over the hex text of what they cover; they are kept as bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.llm.rows import quoted
from paperloom.operators.joins import join_unique
from paperloom.staging import broadcast_if_small, fits, stage

# Nodes under one parent, and bytes of a hash.
FANOUT = 8
WIDTH = 32
# The number of the tree over the subroots; trees of groups count from 0.
TOP = -1
# Nodes of upper levels that every task may hold; one takes about 350 bytes.
MAX_UPPER_NODES = 100_000


def field(value: Column) -> Column:
    """A value as the bytes count of its text, a colon and the text; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    """The hash of a row: of its fields, one after the other."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def hash_of(nodes: Column) -> Column:
    """The hash of a run of hashes, given as their bytes."""
    return F.unhex(F.sha2(digits(nodes), 256))


def digits(value: Column) -> Column:
    return F.lower(F.hex(value))


@dataclass(frozen=True)
class Manifest:
    """``runs``: the leaves of each lowest run with their claimed hashes; ``levels``: node tables from there upwards.

    The first ``height`` levels are those of the groups' trees, the others those
    of the top tree. ``subroots`` has the hash of each of ``n_trees`` trees,
    ``root`` is the hash of all (null for an empty table).
    """

    runs: DataFrame
    levels: list[DataFrame]
    height: int
    subroots: DataFrame
    n_trees: int
    root: bytes | None


def _placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` with the number of their tree, their place in it and its number of leaves.

    Rows are sorted by ranges; a row's place is its place in its range, from
    what the ranges before it hold. No task sees a whole tree.
    """
    order = ["_group", "_key", "_leaf"]
    ranged = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stage(ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), "merkle-rows")
    # one row for each range and each group in it
    pieces = stage(rows.groupBy("_part", "_group").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")), "merkle-pieces")
    trees = _numbered(pieces.groupBy("_group").agg(F.sum("_n").alias("n")))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = pieces.withColumn("_ahead", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    known = ahead.alias("a").join(trees.alias("t"), F.col("a._group").eqNullSafe(F.col("t._group"))).select("a._part", "a._group", "a._first", "a._ahead", "t.tree", "t.n")
    known = broadcast_if_small(stage(known, "merkle-places"), 200_000)
    same = (F.col("r._part") == F.col("k._part")) & F.col("r._group").eqNullSafe(F.col("k._group"))
    pos = F.col("k._ahead") + F.col("r._at") - F.col("k._first")
    return rows.alias("r").join(known.alias("k"), same).select("r._group", "r._key", "r._leaf", "r._claimed", "k.tree", pos.alias("pos"), "k.n")


def _numbered(groups: DataFrame) -> DataFrame:
    """Groups with their rank, nulls first, from 0."""
    ranged = groups.repartitionByRange("_group").sortWithinPartitions("_group")
    rows = stage(ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), "merkle-groups")
    # one row a range
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    ahead = parts.withColumn("_ahead", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return rows.join(ahead.drop("_n"), "_part").select("_group", "n", (F.col("_ahead") + F.col("_at") - F.col("_first")).alias("tree"))


def _runs(nodes: DataFrame, *more: str) -> DataFrame:
    """Runs of eight nodes: ``tree, pos, n`` (nodes of the run's tree on their level), ``children`` as bytes."""
    members = F.sort_array(F.collect_list(F.struct("pos", "hash", *more)))
    grouped = nodes.groupBy("tree", F.floor(F.col("pos") / FANOUT).alias("pos"), "n").agg(members.alias("_members"))
    hashes = F.array_join(F.transform("_members", lambda m: F.hex(m["hash"])), "")
    return grouped.select("tree", "pos", "n", F.unhex(hashes).alias("children"), *[F.col(f"_members.{c}").alias(c) for c in more])


def _level(runs: DataFrame, level: int, n_trees: int) -> DataFrame:
    """Node rows of one level, each with the place of its parent (null for the root) and its place under it."""
    n = F.ceil(F.col("n") / FANOUT).cast("bigint")
    single, last = n == 1, (F.col("tree") == TOP) | F.lit(n_trees == 1)
    up = lambda below, top: F.when(~single, below).when(~last, top).cast("bigint")
    return runs.select(
        "tree",
        F.lit(level).cast("bigint").alias("level"),
        "pos",
        n.alias("n"),
        "children",
        hash_of(F.col("children")).alias("hash"),
        up(F.col("tree"), F.lit(TOP)).alias("up_tree"),
        up(F.lit(level + 1), F.lit(1)).alias("up_level"),
        up(F.floor(F.col("pos") / FANOUT), F.floor(F.col("tree") / FANOUT)).alias("up_pos"),
        up(F.col("pos") % FANOUT, F.col("tree") % FANOUT).alias("up_at"),
    )


def _grow(first: DataFrame, n_trees: int, most: int) -> list[DataFrame]:
    """Level tables from the runs of a forest's leaves upwards; ``most`` is the number of leaves of its largest tree."""
    levels = [stage(_level(first, 1, n_trees), "merkle-level")] if most > 1 else []
    most = -(-most // FANOUT)
    while most > 1:
        runs = _runs(levels[-1].filter("n > 1").select("tree", "pos", "n", "hash"))
        levels.append(stage(_level(runs, len(levels) + 1, n_trees), "merkle-level"))
        most = -(-most // FANOUT)
    return levels


def build_manifest(docs: DataFrame, leaf: Column, key: str = "doc_id", group: str = "lang", claimed: Column | None = None) -> Manifest:
    """Hash trees over all rows of ``docs``.

    ``leaf`` is the hash of a row as it is, ``claimed`` of the row as somebody
    says it is (null: the same). Leaves stand in order of ``key``, null first;
    rows of one key in order of their hash, so repeated rows are leaves beside
    each other and the trees depend on the rows alone. Groups stand in the
    order of their UTF-8 bytes, null first. Null and empty values hash
    differently, texts of any length are hashed whole. An empty table has no
    node and no root. Other columns of ``docs`` say nothing here, whatever
    their names. Each level is a written table.
    """
    claimed = F.lit(None).cast("binary") if claimed is None else claimed
    leaves = docs.select(F.col(quoted(group)).alias("_group"), F.col(quoted(key)).alias("_key"), leaf.alias("_leaf"), claimed.alias("_claimed"))
    # hashed once, however often ranges are sampled
    placed = _placed(stage(leaves, "merkle-leaves"))
    named = placed.select("tree", "pos", "n", F.col("_leaf").alias("hash"), F.col("_key").alias("key"), F.col("_claimed").alias("claimed"))
    runs = stage(_runs(named, "key", "claimed"), "merkle-runs")
    most, n_trees = runs.agg(F.max("n"), F.max("tree") + 1).first()
    if most is None:
        return Manifest(runs, [], 0, runs.select("tree", F.col("children").alias("hash")), 0, None)
    levels = _grow(runs.filter("n > 1"), n_trees, most)
    height = len(levels)
    ends = [runs.filter("n = 1").select("tree", F.col("children").alias("hash")), *[t.filter("n = 1").select("tree", "hash") for t in levels]]
    subroots = ends[0]
    for more in ends[1:]:
        subroots = subroots.unionByName(more)
    subroots = stage(subroots, "merkle-subroots")
    if n_trees > 1:
        over = subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("pos"), F.lit(n_trees).cast("bigint").alias("n"), "hash")
        levels += _grow(_runs(over), n_trees, n_trees)
        root = levels[-1].first()["hash"]
    else:
        root = subroots.first()["hash"]
    return Manifest(runs, levels, height, subroots, n_trees, bytes(root))


def folded(children: Column, at: Column, own: Column) -> Column:
    """The hash of a run in which ``own`` stands at place ``at``."""
    return hash_of(F.concat(F.substring(children, F.lit(1), at * WIDTH), own, F.substring(children, (at + 1) * WIDTH + 1, F.lit(FANOUT * WIDTH))))


# One step of the climb: from a node to its parent's run, over the stored link.
_CLIMB = f"""
WITH RECURSIVE climb(tree, run, folded, siblings, up_tree, up_level, up_pos, up_at) AS (
  SELECT tree, run, folded, siblings, up_tree, up_level, up_pos, up_at FROM {{start}}
  UNION ALL
  SELECT {{hint}} c.tree, c.run,
    transform(c.folded, own -> unhex(sha2(lower(hex(concat(
      substring(n.children, 1, int(c.up_at * {WIDTH})), own, substring(n.children, int((c.up_at + 1) * {WIDTH} + 1))))), 256))),
    concat(c.siblings, substring(n.children, 1, int(c.up_at * {WIDTH})), substring(n.children, int((c.up_at + 1) * {WIDTH} + 1))),
    n.up_tree, n.up_level, n.up_pos, n.up_at
  FROM climb c JOIN {{nodes}} n ON n.tree = c.up_tree AND n.level = c.up_level AND n.pos = c.up_pos)
SELECT tree, run, folded, siblings, up_tree, up_level, up_pos, up_at FROM climb
"""
_LIMIT = "spark.sql.cteRecursionRowLimit"


@contextmanager
def _any_rows(spark: SparkSession) -> Iterator[None]:
    """A recursive query stops at a number of rows; a climb has as many as the table asks for."""
    before = spark.conf.get(_LIMIT, None)
    spark.conf.set(_LIMIT, "-1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_LIMIT)
        else:
            spark.conf.set(_LIMIT, before)


def _ascend(start: DataFrame, tables: list[DataFrame], broadcast: bool, ended: Column) -> DataFrame:
    """Where the rows of ``start`` have come to when their next parent is in none of ``tables``, as ``ended`` says."""
    spark = start.sparkSession
    nodes = tables[0]
    for more in tables[1:]:
        nodes = nodes.unionByName(more)
    hint = "/*+ BROADCAST(n) */" if broadcast else ""
    with _any_rows(spark):
        passed = spark.sql(_CLIMB.replace("{hint}", hint), start=start, nodes=nodes)
        return stage(passed.filter(ended).select(start.columns), "merkle-climb")


def climb(manifest: Manifest) -> DataFrame:
    """``tree, run, folded, siblings``: each lowest run's claimed hashes at the root, and what was met above the run.

    The eight leaves of a run have all siblings above it in common, so they
    climb as one row with a folded hash for each. Lower levels, in which a
    parent is shared by few rows, are joined by shuffle; the upper ones, which
    all rows meet, hold a counted number of nodes and are in every task.
    """
    upper, room = [], MAX_UPPER_NODES
    lower = list(manifest.levels)
    while lower and fits(lower[-1], room):
        upper.insert(0, lower.pop())
        room -= upper[0].count()
    first = manifest.levels[0] if manifest.height else None
    runs = manifest.runs.withColumns({"run": F.col("pos"), "_many": F.col("n") > 1})
    leaf = lambda i: F.substring(F.col("children"), i * WIDTH + 1, F.lit(WIDTH))
    own = F.transform("claimed", lambda c, i: F.coalesce(c, leaf(i)))
    claims = runs.select("tree", "run", "_many", F.when(F.col("_many"), F.transform(own, lambda c, i: folded(F.col("children"), i, c))).otherwise(own).alias("folded"))
    single = F.lit(None).cast("bigint")
    up = lambda value: value if manifest.n_trees > 1 else single
    # the only leaf of a tree is its subroot
    lone = claims.filter("NOT _many").select(
        "tree", "run", "folded", F.lit(b"").alias("siblings"),
        up(F.lit(TOP).cast("bigint")).alias("up_tree"), up(F.lit(1).cast("bigint")).alias("up_level"),
        up(F.floor(F.col("tree") / FANOUT)).alias("up_pos"), up(F.col("tree") % FANOUT).alias("up_at"),
    )
    start = lone
    if first is not None:
        places = first.select("tree", F.col("pos").alias("run"), "up_tree", "up_level", "up_pos", "up_at")
        many = claims.filter("_many").join(places, ["tree", "run"]).withColumn("siblings", F.lit(b""))
        start = many.select(lone.columns).unionByName(lone)
    start = stage(start, "merkle-start")
    if lower:
        lowest = F.when(F.col("up_tree") == TOP, F.lit(len(lower) - manifest.height)).otherwise(F.lit(len(lower)))
        start = _ascend(start, lower, False, F.col("up_tree").isNull() | (F.col("up_level") > lowest))
    if upper:
        start = _ascend(start, upper, True, F.col("up_tree").isNull())
    return start.select("tree", "run", "folded", "siblings")


def prove(manifest: Manifest) -> DataFrame:
    """A row for each leaf: ``key, leaf, subroot, siblings, folded`` (hashes as bytes, siblings one after the other) and ``verified``.

    Siblings stand in order of the levels, from left to right in each. Every
    row of the table has one; null claims fold the leaf itself.
    """
    above = climb(manifest).select("tree", "run", "folded", F.col("siblings").alias("above"))
    runs = manifest.runs.withColumnRenamed("pos", "run").join(above, ["tree", "run"])
    rooted = join_unique(runs, manifest.subroots.withColumnRenamed("hash", "subroot"), ["tree"])
    each = rooted.select("children", "above", "subroot", F.posexplode(F.arrays_zip("key", "folded")).alias("i", "of"))
    start = F.col("i") * WIDTH
    beside = F.concat(F.substring("children", F.lit(1), start), F.substring("children", start + WIDTH + 1, F.lit(FANOUT * WIDTH)))
    return each.select(
        F.col("of.key").alias("key"),
        F.substring("children", start + 1, F.lit(WIDTH)).alias("leaf"),
        "subroot",
        F.concat(beside, "above").alias("siblings"),
        F.col("of.folded").alias("folded"),
        (F.col("of.folded") == F.lit(manifest.root)).alias("verified"),
    )
