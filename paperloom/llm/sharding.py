"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at many places of a ring; a row belongs to the first place
at or after the hash of its key. A shard takes rows up to its capacity only: the
rows beyond continue clockwise to the next shard that has room. Rows are never
ranked whole: they are counted in small pieces of the ring, and the counts of
the arcs between places, a table as large as the ring, say how many rows of
each arc stay and where the others go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.llm.rows import packed, quoted, unpacked, without
from paperloom.staging import stage

# Equal cells the ring is cut into, and how often each shard stands on it.
CELL_BITS = 14
PLACES = 64
# Parts a cell's rows are dealt into, so that one key's rows are not one group.
SALTS = 8


def _ring(spark: SparkSession, shards: int, places: int, seed: int) -> DataFrame:
    """Arcs ``arc, shard, cells, walk`` of the ring; ``walk`` lists all shards clockwise from there."""
    stands = spark.range(shards * places).select(
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 64 - CELL_BITS).alias("cell"), F.expr(f"id div {places}").cast("int").alias("shard")
    )
    # of places that fall together the smaller shard stays
    ring = stands.groupBy("cell").agg(F.min("shard").alias("shard")).groupBy().agg(F.array_sort(F.collect_list(F.struct("cell", "shard"))).alias("ring"))
    arcs = ring.select("ring", F.posexplode("ring").alias("arc", "stand"))
    after = F.coalesce(F.get("ring.cell", F.col("arc") - 1) + 1, F.lit(0))
    last = F.element_at("ring.cell", -1)
    beyond = F.when((F.col("arc") == 0) & (last + 1 < 1 << CELL_BITS), F.sequence(last + 1, F.lit((1 << CELL_BITS) - 1))).otherwise(F.array().cast("array<bigint>"))
    clockwise = F.concat(F.slice("ring.shard", F.col("arc") + 1, F.size("ring")), F.slice("ring.shard", F.lit(1), F.col("arc")), F.sequence(F.lit(0), F.lit(shards - 1)))
    return arcs.select("arc", F.col("stand.shard").alias("shard"), F.concat(F.sequence(after, F.col("stand.cell")), beyond).alias("cells"), F.array_distinct(clockwise).alias("walk"))


# The rows of one arc walk on from shard to shard, each taking what it has room for.
_WALK = """
aggregate(x.walk,
  named_struct('room', state.room, 'lo', x.stay, 'moves', cast(array() as array<struct<arc:int,shard:int,lo:bigint,hi:bigint>>)),
  (s, shard) -> named_struct(
    'room', transform(s.room, (r, i) -> if(i = shard, r - least(r, x.n - s.lo), r)),
    'lo', s.lo + least(s.room[shard], x.n - s.lo),
    'moves', if(least(s.room[shard], x.n - s.lo) > 0,
                concat(s.moves, array(named_struct('arc', x.arc, 'shard', shard, 'lo', s.lo, 'hi', s.lo + least(s.room[shard], x.n - s.lo)))),
                s.moves)))"""
_WALKS = f"""
aggregate(arcs,
  named_struct('room', room, 'moves', cast(array() as array<struct<arc:int,shard:int,lo:bigint,hi:bigint>>)),
  (state, x) -> transform(array({_WALK}), w -> named_struct('room', w.room, 'moves', concat(state.moves, w.moves)))[0],
  state -> state.moves)"""


def _segments(arcs: DataFrame, shards: int, capacity: Column) -> DataFrame:
    """``arc, shard, lo, hi, base``: which rows of an arc go where, and their first slot.

    ``arcs`` has ``arc, shard, walk, n``. At home the first arcs of a shard are
    served first; then each arc's other rows walk, arc by arc.
    """
    by_shard = Window.partitionBy("shard").orderBy("arc")
    before = F.coalesce(F.sum("n").over(by_shard.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    stay = F.greatest(F.lit(0), F.least(F.col("n"), capacity - before)).cast("bigint")
    home = stage(arcs.withColumn("stay", stay), "arcs")
    # every shard's room, also that of one without an arc
    served = F.broadcast(home.groupBy("shard").agg(F.sum("stay").alias("served")))
    room = arcs.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(served, "shard", "left")
    room = room.groupBy().agg(F.array_sort(F.collect_list(F.struct("shard", (capacity - F.coalesce("served", F.lit(0))).cast("bigint").alias("r")))).alias("room"))
    over = home.filter("n > stay").groupBy().agg(F.array_sort(F.collect_list(F.struct("arc", "stay", "n", "walk"))).alias("arcs"))
    both = over.withColumn("_", F.lit(0)).join(F.broadcast(room.select(F.col("room.r").alias("room"), F.lit(0).alias("_"))), "_")
    moved = both.select(F.explode(F.expr(_WALKS)).alias("m")).select("m.*")
    kept = home.filter("stay > 0").select("arc", "shard", F.lit(0).cast("bigint").alias("lo"), F.col("stay").alias("hi"))
    slots = Window.partitionBy("shard").orderBy("arc", "lo").rowsBetween(Window.unboundedPreceding, -1)
    return kept.unionByName(moved).withColumn("base", F.coalesce(F.sum(F.col("hi") - F.col("lo")).over(slots), F.lit(0)))


def shard_rows(
    df: DataFrame, key: str, shards: int, slack: float = 0.0, places: int = PLACES, seed: int = 0, keep: list[str] | None = None
) -> DataFrame:
    """``df`` with ``shard`` (from 0) and ``slot``, the row's place in its shard (gapless from 0).

    With ``slack`` 0 the shards' row counts differ by at most one; otherwise no
    shard exceeds the mean by more than that share, and fewer rows leave their
    own place on the ring. The same rows give the same shards; a further shard
    takes its own arcs and the room it adds, other rows stay where they fit.

    A null key has a place on the ring like any other. Rows of one key stand
    together, in parts, so that neither repeated rows nor one key's rows are
    sorted in one task. Of equal rows any may have any of their slots. ``keep``
    names the columns carried along (all by default): carry little, and join
    the rest by key. New columns replace those of their names.
    """
    kept = without(df.columns if keep is None else keep, ["shard", "slot"])
    place = F.xxhash64(F.lit(seed), F.col(quoted(key)))
    arcs = stage(_ring(df.sparkSession, shards, places, seed), "ring")
    lookup = F.broadcast(arcs.select("arc", F.explode("cells").alias("_cell")))
    rows = df.select(packed(df, kept), place.alias("_place"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("_salt"))
    rows = rows.withColumn("_cell", F.shiftrightunsigned("_place", 64 - CELL_BITS)).join(lookup, "_cell")
    rows = stage(rows, "placed")  # the parts must not change between counting and ranking

    piece = ["arc", "_cell", "_salt"]
    pieces = stage(rows.groupBy(*piece).agg(F.count("*").alias("n")), "pieces")
    ahead = Window.partitionBy("arc").orderBy("_cell", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    first = pieces.select(*piece, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_first"))
    total = rows.count()
    mean = total / shards
    even = F.lit(total // shards) + (F.col("shard") < total % shards).cast("bigint")
    capacity = even if slack == 0 else F.lit(int(-(-mean * (1 + slack) // 1)))
    counted = arcs.select("arc", "shard", "walk").join(F.broadcast(pieces.groupBy("arc").agg(F.sum("n").alias("n"))), "arc", "left").fillna(0, ["n"])
    segments = stage(_segments(counted, shards, capacity), "segments")

    # the ring, its pieces and segments are as large as the parameters say
    ranked = rows.join(F.broadcast(first), piece)
    rank = F.col("_first") + F.row_number().over(Window.partitionBy(*piece).orderBy("_place", F.xxhash64("_row"))) - 1
    ranked = ranked.withColumn("_rank", rank)
    placed = ranked.join(F.broadcast(segments), (ranked["arc"] == segments["arc"]) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi")))
    slot = F.col("base") + F.col("_rank") - F.col("lo")
    return placed.select(*unpacked(kept), F.col("shard"), slot.cast("bigint").alias("slot"))
