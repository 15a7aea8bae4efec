"""Mixing sources to target weights, budgeted down a tree.

A budget of tokens is passed down the levels of a tree (say domain, language,
source). At each node it is dealt to the children by weight. A child that holds
too little, counting the most epochs its texts may be read, gets what it holds,
and the shortage goes to its siblings; only when a whole subtree holds too
little does the parent level share the rest. A leaf reads all of its documents
for as many epochs as its budget lasts, and of the next epoch, in an order
seeded for that epoch, the prefix that fills it.

Everything is DataFrame expressions. The tables of nodes and cuts have a row
for each leaf; documents are never sorted whole: their tokens are summed over
4,096 slices of the order, and only the slice in which a leaf's prefix ends is
put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.llm.rows import packed, quoted, unpacked, without
from paperloom.operators.joins import join_unique
from paperloom.staging import once, stage

SLICE_BITS = 12
MAX_EPOCHS = 4
WORD = r"[^\x20\x09-\x0D]+"

Weights = dict[tuple[str, ...], int]


def count_words(text: str = "text") -> Column:
    """Words of a text, the tokens that budgets are counted in; none in a null."""
    return F.coalesce(F.regexp_count(F.col(quoted(text)), F.lit(WORD)), F.lit(0)).cast("bigint")


def _weight(weights: Weights, levels: list[Column]) -> Column:
    given = {"\x1f".join(k): int(w) for k, w in weights.items() if len(k) == len(levels)}
    if not given:
        return F.lit(1).cast("bigint")
    table = F.create_map(*[F.lit(x) for k, w in given.items() for x in (k, w)])
    return F.coalesce(F.try_element_at(table, F.concat_ws("\x1f", *levels)), F.lit(1)).cast("bigint")


def _deal(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """``nodes`` (parents, name, weight, capacity, parent_budget) with their own ``budget``.

    Children come in order of capacity for each unit of weight: those that hold
    no more than their part of what is left get their capacity, the rest share
    by weight. Differences of rounded running parts add up to the whole.
    """
    within = Window.partitionBy(*parents)
    order = within.orderBy(F.col("capacity").cast("double") / F.col("weight"), name)
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    nothing = F.lit(0).cast("bigint")
    left = F.col("parent_budget") - F.coalesce(F.sum("capacity").over(before), nothing)
    others = F.sum("weight").over(within) - F.coalesce(F.sum("weight").over(before), nothing)
    wide = "decimal(38,0)"
    tested = nodes.withColumn("full", F.col("capacity").cast(wide) * others.cast(wide) <= left.cast(wide) * F.col("weight").cast(wide))
    open_weight = F.when(F.col("full"), nothing).otherwise(F.col("weight"))
    shared = tested.select(
        "*",
        (F.col("parent_budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(within), nothing)).alias("rest"),
        F.greatest(F.sum(open_weight).over(within), F.lit(1)).alias("all_open"),
        F.sum(open_weight).over(upto).alias("upto"),
    )
    running = "(cast({} as decimal(38,0)) * cast(rest as decimal(38,0))) div cast(all_open as decimal(38,0))"
    part = F.expr(running.format("upto")) - F.expr(running.format("(upto - weight)"))
    return shared.withColumn("budget", F.when(F.col("full"), F.col("capacity")).otherwise(part).cast("bigint"))


def _named(levels: list[Column]) -> list[Column]:
    """Level columns as names; a null is a child of its own, named by nothing."""
    return [F.coalesce(c.cast("string"), F.lit("")) for c in levels]


def leaf_budgets(supply: DataFrame, names: list[str], weights: Weights, total: int, max_epochs: int) -> DataFrame:
    """``supply`` (a row of names and tokens for each leaf) with the leaf's ``budget``."""
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights are positive")
    nodes = stage(supply.withColumn("capacity", F.col("supply") * max_epochs), "leaves")
    budgets = None
    for depth in range(1, len(names) + 1):
        path, parents = names[:depth], names[: depth - 1]
        level = nodes.groupBy(*path).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(weights, [F.col(n) for n in path]))
        if budgets is None:
            level = level.withColumn("parent_budget", F.least(F.lit(total), F.sum("capacity").over(Window.partitionBy(F.lit(0)))))
        else:
            level = level.join(budgets.select(*parents, F.col("budget").alias("parent_budget")), parents)
        budgets = _deal(level, parents or [F.lit(0)], path[-1])
    return nodes.join(budgets.select(*names, "budget"), names)


def mix_sources(
    docs: DataFrame,
    levels: list[Column],
    weights: Weights,
    budget: int | float,
    seed: int = 0,
    max_epochs: int = MAX_EPOCHS,
    text: str = "text",
    doc_id: str = "doc_id",
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``epoch``, ``tokens`` and ``tokens_taken``: a row for each reading of a document.

    ``levels`` are the names of the tree from the top down, ``weights`` the
    weight of a path (1 where none is given). ``budget`` is a number of tokens,
    or as a float a share of all tokens there are; what exceeds ``max_epochs``
    readings of everything is not spent. Tokens are words. The last document of
    a leaf's prefix may be taken in part: ``tokens_taken`` says how far.

    A null level is a child named by nothing, a null or empty text has no
    tokens. Documents are put in order by a hash of seed, epoch, id and text,
    so ids may be null or repeated; of equal rows any is as good. ``keep`` names
    the columns that stay (all by default); new columns replace those of their
    names.
    """
    names = [f"_level{i}" for i in range(len(levels))]
    labels = [c.alias(n) for n, c in zip(names, _named(levels))]
    text_hash = F.substring(F.md5(F.coalesce("_value", F.lit("")).cast("binary")), 1, 15)
    kept = without(docs.columns if keep is None else keep, ["epoch", "tokens", "tokens_taken"])
    labelled = docs.select(packed(docs, kept), *labels, F.col(quoted(doc_id)).cast("string").alias("_id"), F.col(quoted(text)).alias("_value"))
    measured = once(labelled, _tokens=count_words("_value"), _text=text_hash).drop("_value")
    known = stage(measured.select(*names, "_id", "_tokens", "_text"), "measured")

    supply = known.groupBy(*names).agg(F.sum("_tokens").alias("supply"))
    total = int(budget) if not isinstance(budget, float) else int((known.agg(F.sum("_tokens")).first()[0] or 0) * budget)
    leaves = leaf_budgets(supply, names, weights, total, max_epochs).filter("budget > 0")
    leaves = leaves.select(*names, F.expr("budget div supply").cast("int").alias("_epochs"), F.expr("budget % supply").alias("_room"))
    leaves = stage(leaves, "budgets")

    place = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("_epochs").cast("string"), "_id", "_text").cast("binary")), 1, 15), 16, 10).cast("bigint")
    piece = F.shiftright(F.col("_place"), 60 - SLICE_BITS)
    placed = join_unique(known, leaves, names, "inner").withColumn("_place", place)
    slices = placed.groupBy(*names, "_room", piece.alias("_slice")).agg(F.sum("_tokens").alias("n"))
    running = F.sum("n").over(Window.partitionBy(*names).orderBy("_slice"))
    ends = slices.withColumn("_upto", running).withColumn("_before", F.col("_upto") - F.col("n"))
    cuts = ends.filter("_before < _room AND _room <= _upto").select(*names, F.col("_slice").alias("_cut"), "_before")
    plan = leaves.join(cuts, names, "left")

    rows = once(join_unique(measured, plan, names, "inner"), _place=place).withColumn("_slice", piece)

    def taken(df: DataFrame, epoch: Column, part: Column) -> DataFrame:
        return df.select(*unpacked(kept), epoch.cast("int").alias("epoch"), F.col("_tokens").alias("tokens"), part.cast("bigint").alias("tokens_taken"))

    readings = F.sequence(F.lit(0), F.col("_epochs") - F.when(F.coalesce(F.col("_slice") < F.col("_cut"), F.lit(False)), 0).otherwise(1))
    several = rows.filter("_epochs > 0 OR _slice < _cut").withColumn("_epoch", F.explode(readings))
    in_order = Window.partitionBy(*names).orderBy("_place", "_id", "_tokens").rowsBetween(Window.unboundedPreceding, -1)
    last = rows.filter("_slice = _cut").withColumn("_ahead", F.col("_before") + F.coalesce(F.sum("_tokens").over(in_order), F.lit(0))).filter("_ahead < _room")
    return taken(several, F.col("_epoch"), F.col("_tokens")).unionByName(
        taken(last, F.col("_epochs"), F.least(F.col("_tokens"), F.col("_room") - F.col("_ahead")))
    )
