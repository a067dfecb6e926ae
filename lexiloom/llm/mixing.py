"""Mixing sources to target weights: a budget handed down a tree, and token prefixes of seeded epochs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.common import stage, text_bytes

LEVELS = ("domain", "lang", "source")
#: Slices of a leaf's order; a task holds one slice, not a leaf. Two hex digits name 256 slices, three 4096.
SLICE_DIGITS = 3


def _share(budget: Column, weight: Column, before: Column, total: Column) -> Column:
    """A node's part of ``budget`` by weight in whole tokens; parts of siblings sum up to the budget."""

    def upto(w: Column) -> Column:
        return F.floor(budget.cast("decimal(38,0)") * w.cast("decimal(18,0)") / total.cast("decimal(18,0)")).cast("long")

    return upto(before + weight) - upto(before)


def water_fill(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Add ``given`` to siblings (``parent``..., ``budget``, ``weight``, ``capacity``).

    Every sibling gets its share of the parent's budget by weight, but no more than its capacity; what
    one can't take goes to the others by their weights. In order of capacity per weight, the siblings
    that are filled come first: one is filled if what is left for it and those after it would
    give it at least its capacity. All sums are whole numbers, ties go by ``name``.
    """
    ratio = F.col("capacity").cast("double") / F.col("weight")
    order = Window.partitionBy(*parent).orderBy("_ratio", name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = nodes.withColumn("_ratio", ratio).select(
        "*",
        F.coalesce(F.sum("capacity").over(before), F.lit(0)).alias("_filled"),
        F.sum("weight").over(rest).alias("_rest"),
    )
    left = (F.col("budget") - F.col("_filled")).cast("decimal(38,0)")
    full = F.col("capacity").cast("decimal(38,0)") * F.col("_rest") <= left * F.col("weight")
    rows = rows.withColumn("_full", full)
    # Capacity per weight rises along the order, so all filled siblings come before the others.
    whole = Window.partitionBy(*parent)
    rows = rows.select(
        "*",
        F.sum(F.when(F.col("_full"), F.col("capacity")).otherwise(0)).over(whole).alias("_taken"),
        F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(whole).alias("_open"),
        F.coalesce(F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(before), F.lit(0)).alias("_before"),
    )
    part = _share(F.col("budget") - F.col("_taken"), F.col("weight"), F.col("_before"), F.greatest("_open", F.lit(1)))
    given = F.when(F.col("_full"), F.col("capacity")).otherwise(F.least(part, F.col("capacity")))
    return rows.withColumn("given", given).drop("_ratio", "_filled", "_rest", "_full", "_taken", "_open", "_before")


def leaf_budgets(leaves: DataFrame, budget: int, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """(levels..., tokens, given) for every leaf of the tree.

    ``leaves`` has the levels, ``tokens``, ``capacity`` and a weight ``w_<level>`` for each level, a
    whole number that is the same for all leaves below one node. Capacities are summed up the tree, then
    the budget, no more than all capacities, is handed down level by level: a shortage stays with the siblings as long as they have
    capacity, and only what a whole subtree can't take has been left to its parent's siblings.
    """
    nodes = leaves
    tops = []
    for depth in range(len(levels), 0, -1):
        keys = list(levels[:depth])
        weight = f"w_{keys[-1]}"
        tops.append(nodes.groupBy(*keys).agg(F.sum("capacity").alias("capacity"), F.max(weight).alias("weight")))
    given = None
    for depth, node in enumerate(reversed(tops), 1):
        keys = list(levels[:depth])
        if given is None:
            handed = node.withColumns({"_root": F.lit(0), "budget": F.lit(budget).cast("long")})
            parent = ["_root"]
        else:
            handed = node.join(given.select(*keys[:-1], F.col("given").alias("budget")), keys[:-1])
            parent = keys[:-1]
        given = water_fill(handed, parent, keys[-1]).select(*keys, "capacity", "given")
    return given.join(leaves.select(*levels, "tokens"), list(levels)).select(*levels, "tokens", "given")


def _counted(rows: DataFrame) -> DataFrame:
    """The rows with the number of words between ASCII white space in place of the text ``n``."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = pa.array([len(x.as_py().split()) for x in batch.column(len(names) - 1)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], counts], names=names)

    return rows.mapInArrow(run, ", ".join([*[f"`{x}` string" for x in names[:-1]], "n long"]))


def mix(
    docs: DataFrame,
    weights: dict[str, Column],
    budget_share: tuple[int, int] = (1, 2),
    epochs: int = 2,
    seed: int = 17,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, domain, lang, source, epoch, n_tokens, n_taken): the documents of the mixture.

    ``docs`` has the columns ``domain``, ``lang`` and ``source``, a tree of three levels, null
    being a node of its own name ``''``. ``weights`` gives each level's weight as a positive whole number
    from the columns down to that level. The budget is ``budget_share`` (a fraction) of all tokens, words
    between ASCII white space; a leaf can give ``epochs`` times its tokens.

    Within a leaf, epoch after epoch, documents follow each other in the order of a hash of seed, epoch
    and id, until the leaf's budget is reached; of the last one only the first ``n_taken`` tokens belong
    to the mixture. Texts without words are never part of it. Repeated rows take turns as rows of their
    own, in the order of their number of tokens; rows that are equal in all of that are interchangeable.

    Whole epochs need no order. The last one is summed in ``16 ** SLICE_DIGITS`` slices of the hash;
    only the slice in which the budget ends is put in order, so no task ever holds a leaf.
    """
    rows = docs.select(
        F.col(id_column).cast("string").alias("_id"),
        *[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in LEVELS],
        text_bytes(text_column).alias("n"),
    )
    rows = _counted(rows).withColumn("_id", F.col("_id").cast(docs.schema[id_column].dataType))
    rows = stage(rows.where("n > 0"), "lengths")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n").alias("tokens"))
    leaves = stage(leaves.select("*", (F.col("tokens") * epochs).alias("capacity"), *[weights[x].cast("long").alias(f"w_{x}") for x in LEVELS]), "leaves")
    above, below = budget_share
    tokens, capacity = leaves.agg(F.sum("tokens"), F.sum("capacity")).first()
    budget = min((tokens or 0) * above // below, capacity or 0)
    given = leaf_budgets(leaves, budget).withColumns({"whole": F.expr("given div tokens"), "rest": F.expr("given % tokens")})
    given = stage(given, "given")

    full = rows.join(given.select(*LEVELS, "whole").where("whole > 0"), list(LEVELS))
    full = full.select("_id", *LEVELS, F.explode(F.sequence(F.lit(0), (F.col("whole") - 1).cast("int"))).alias("epoch"), "n", F.col("n").alias("taken"))

    part = rows.join(given.select(*LEVELS, F.col("whole").cast("int").alias("epoch"), "rest").where("rest > 0"), list(LEVELS))
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce(F.col("_id").cast("string"), F.lit(""))))
    part = stage(part.withColumn("place", place).withColumn("slice", F.substring("place", 1, SLICE_DIGITS)), "places")
    slices = part.groupBy(*LEVELS, "slice").agg(F.sum("n").alias("sum"), F.max("rest").alias("rest"))
    order = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(*LEVELS, "slice", F.coalesce(F.sum("sum").over(order), F.lit(0)).alias("start"), "sum", "rest").where("start < rest")
    inside = part.drop("rest").join(slices, [*LEVELS, "slice"])
    before = F.col("start") + F.col("sum") <= F.col("rest")
    full = full.unionByName(inside.where(before).select("_id", *LEVELS, "epoch", "n", F.col("n").alias("taken")))
    order = Window.partitionBy(*LEVELS).orderBy("place", "n").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("start") + F.coalesce(F.sum("n").over(order), F.lit(0))
    last = inside.where(~before).withColumn("at", at).where("at < rest")
    last = last.select("_id", *LEVELS, "epoch", "n", F.least(F.col("n"), F.col("rest") - F.col("at")).alias("taken"))
    return full.unionByName(last).select(
        F.col("_id").alias(id_column), *LEVELS, F.col("epoch").cast("long").alias("epoch"), F.col("n").alias("n_tokens"), F.col("taken").alias("n_taken")
    )
