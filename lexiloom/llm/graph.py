"""Connected components as rounds of joins: distributed union-find without any driver state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import stage


def _jump(parents: DataFrame) -> DataFrame:
    """Replace each parent by its own parent."""
    up = parents.select(F.col("id").alias("_id"), F.col("parent").alias("_up"))
    return parents.join(up, F.col("parent") == F.col("_id"), "left").select(
        "id", F.coalesce("_up", "parent").alias("parent")
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (a, b); the component is its smallest vertex.

    Each round hooks every vertex to its smallest neighbour, doubles the pointers twice, and
    contracts the edges to the hooked labels. A vertex with many edges only takes part in a
    minimum, which is combined before the shuffle, and in joins against a table with one row per
    vertex. Every round is a stored table; the rounds end when no edge is left, after about
    ``log(longest path) / log(4)`` of them. Null ends and loops are no edges; no edges give no rows.
    """
    left = stage(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    labels = None
    while not left.isEmpty():
        ends = left.select(F.col("a").alias("id"), F.col("b").alias("other")).union(left.select("b", "a"))
        hooked = ends.groupBy("id").agg(F.min("other").alias("parent"))
        hooked = stage(hooked.select("id", F.least("id", "parent").alias("parent")), "hooked")
        parents = stage(_jump(_jump(hooked)), "parents")
        low = parents.select(F.col("id").alias("a"), F.col("parent").alias("pa"))
        high = parents.select(F.col("id").alias("b"), F.col("parent").alias("pb"))
        left = stage(
            left.join(low, "a")
            .join(high, "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(),
            "edges",
        )
        if labels is None:
            labels = parents.withColumnRenamed("parent", "component")
        else:
            up = parents.select(F.col("id").alias("_id"), "parent")
            labels = labels.join(up, F.col("component") == F.col("_id"), "left").select(
                "id", F.coalesce("parent", "component").alias("component")
            )
    if labels is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stage(labels, "components")
