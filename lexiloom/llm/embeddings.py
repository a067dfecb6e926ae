"""Embedding near-duplicates: an exact range join on angles, with pivots and the triangle inequality."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import arrow_rows, stage
from lexiloom.llm.graph import connected_components

COSINE = 0.93
#: Pivots of all labels together; they go to every task, so their number is fixed.
PIVOTS = 32
#: Vectors of a cell that a task holds at once; larger cells are joined chunk by chunk.
CHUNK = 8192
#: Slack for rounding of angles, in radians.
SLACK = 1e-6
BLOCK = 256


def _angles(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ pivots.T, -1.0, 1.0))


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of all pairs at once; roots are the smallest places, pointers are flat afterwards."""
    while True:
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return
        x, y = x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))


def _usable(column: str) -> Column:
    """Whether a vector has a direction: no null or non-finite component, and not all zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def embedding_groups(
    vectors: DataFrame,
    cosine: float = COSINE,
    pivots: int = PIVOTS,
    chunk: int = CHUNK,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(id, n_links, component_id, kept) per row.

    Two rows link if their labels are equal and not null, their vectors have as many components, and
    their cosine in double precision is at least ``cosine`` (above 0). Vectors that are null, zero or
    have null or non-finite components link with nothing, nor do rows without label. ``n_links`` counts the
    other rows linked directly, ``component_id`` is the smallest id reachable, the row's own included.
    Repeated rows are rows of their own and link with each other. Other columns are not read.

    * Rows with equal vectors are one vector with a weight, so copies cost nothing further.
    * Each vector belongs to the cell of its nearest pivot; pivots are a fixed number of vectors
      taken by hash. A pair within angle t of each other, of cells p < q, meets in cell p: the vector of
      q goes there if its angle to pivot p is at most t more than the cell's radius, and at most
      2 t more than to its own pivot. Both follow from the triangle inequality, so no pair is lost.
    * Cells are joined on their own. A cell of more than ``chunk`` vectors is cut into chunks by
      hash; visitors go to all of them, its own vectors also to the chunks before theirs.
    * A task holds one chunk and streams its visitors by it in blocks. It gives back one row per vector it
      has met links of: their number and one edge, to its group inside the chunk. Pairs are never rows.

    In many dimensions with no structure, radii overlap and most vectors visit most cells; then
    the number of comparisons grows with the square of a label's distinct vectors, which is what an exact
    answer costs there; where vectors are clustered, far cells are skipped.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    reach = float(np.arccos(cosine)) + SLACK
    doubles = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"), doubles.alias("v"))
    usable = F.col("label").isNotNull() & _usable("v")
    distinct = rows.where(usable).groupBy("label", "v").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    distinct = stage(distinct.withColumn("gid", F.monotonically_increasing_id()), "vectors")
    chosen = distinct.orderBy(F.xxhash64("v"), "gid").limit(pivots).select("v").collect()
    by_size: dict[int, np.ndarray] = {}
    for size in {len(r.v) for r in chosen}:
        found = np.array([r.v for r in chosen if len(r.v) == size])
        found /= np.abs(found).max(axis=1, keepdims=True)
        by_size[size] = found / np.linalg.norm(found, axis=1, keepdims=True)

    label_type = distinct.schema["label"].dataType.simpleString()
    placed_schema = f"label {label_type}, size int, gid long, n long, u binary, cell int, own double, angles array<double>"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, cells, own, angles = [], [], [], []
            for v in batch.column(3).to_pylist():
                v = np.array(v)
                v /= np.abs(v).max()
                v /= np.linalg.norm(v)
                units.append(v.tobytes())
                at = _angles(v[None], by_size[len(v)])[0] if len(v) in by_size else np.zeros(1)
                angles.append(at)
                cells.append(int(at.argmin()))
                own.append(float(at.min()))
            sizes = pa.array([len(u) // 8 for u in units], pa.int32())
            columns = [batch.column(0), sizes, batch.column(1), batch.column(2), pa.array(units, pa.binary()), pa.array(cells, pa.int32()), pa.array(own, pa.float64()), pa.array(angles, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "size", "gid", "n", "u", "cell", "own", "angles"])

    placed = stage(distinct.select("label", "gid", "n", "v").mapInArrow(place, placed_schema), "cells")
    cells = placed.groupBy("label", "size", "cell").agg(F.max("own").alias("radius"), F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    cells = cells.groupBy("label", "size").agg(F.collect_list(F.struct("cell", "radius", "chunks")).alias("cells"))
    met = placed.join(cells, ["label", "size"])

    def chunk_of(chunks):
        return F.pmod(F.xxhash64("gid"), chunks.cast("long")).cast("int")

    def parts(c):
        own = c["cell"] == F.col("cell")
        near = F.element_at("angles", c["cell"] + 1) <= F.least(c["radius"], F.col("own") + reach) + reach
        visits = F.when(own, chunk_of(c["chunks"]) + 1).when((c["cell"] < F.col("cell")) & near, c["chunks"]).otherwise(0)
        numbers = F.filter(F.sequence(F.lit(0), c["chunks"] - 1), lambda i: i < visits)
        return F.transform(numbers, lambda i: F.struct(c["cell"].alias("at"), i.alias("part"), (~own | (i < visits - 1)).alias("visitor")))

    spread = met.select("label", "size", "gid", "n", "u", F.inline(F.flatten(F.transform("cells", parts))))
    key = ["label", "size", "at", "part"]
    spread = spread.select(F.xxhash64(*key).alias("hash"), F.to_json(F.struct(*key)).alias("key"), "visitor", "gid", "n", "u")
    met_schema = pa.schema([("gid", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, own = None, [], None

        def load():
            nonlocal own, held
            own = Held(held, cosine)
            held = []
            return own.inside()

        for batch in batches:
            keys, visitors, gids, ns = (batch.column(i).to_pylist() for i in (1, 2, 3, 4))
            vectors = batch.column(5)
            todo = []
            for i, key in enumerate(keys):
                if key != now:
                    if todo:
                        yield own.visited(todo)
                        todo = []
                    if held:
                        yield load()
                    if own is not None:
                        yield own.result()
                    now, own = key, None
                row = (gids[i], ns[i], np.frombuffer(vectors[i].as_py()))
                if not visitors[i]:
                    held.append(row)
                    continue
                if own is None:
                    yield load()
                todo.append(row)
                if len(todo) >= BLOCK:
                    yield own.visited(todo)
                    todo = []
            if todo:
                yield own.visited(todo)
        if held:
            yield load()
        if own is not None:
            yield own.result()

    class Held:
        """The vectors of a chunk, their links counted so far, and their groups."""

        def __init__(self, rows: list, least: float):
            self.least = least
            self.gids = np.array([r[0] for r in rows], np.int64)
            self.weights = np.array([r[1] for r in rows], np.float64)
            self.units = np.stack([r[2] for r in rows])
            self.links = np.zeros(len(rows))
            self.parent = np.arange(len(rows))

        def inside(self) -> pa.RecordBatch:
            for at in range(0, len(self.gids), BLOCK):
                near = self.units[at : at + BLOCK] @ self.units.T >= self.least
                near[np.arange(len(near)), np.arange(at, at + len(near))] = False
                self.links[at : at + BLOCK] += near @ self.weights
                a, b = np.nonzero(near)
                _unite(self.parent, a + at, b)
            return arrow_rows(met_schema, [[], [], []])

        def visited(self, rows: list) -> pa.RecordBatch:
            gids = np.array([r[0] for r in rows], np.int64)
            near = np.stack([r[2] for r in rows]) @ self.units.T >= self.least
            some = near.any(axis=1)
            near, gids = near[some], gids[some]
            if not len(gids):
                return arrow_rows(met_schema, [[], [], []])
            weights = np.array([r[1] for r in rows], np.float64)[some]
            self.links += weights @ near
            a, b = np.nonzero(near)
            first = near.argmax(axis=1)
            _unite(self.parent, first[a], b)
            return arrow_rows(met_schema, [gids, (near @ self.weights).astype(np.int64), self.gids[first]])

        def result(self) -> pa.RecordBatch:
            some = self.links > 0
            return arrow_rows(met_schema, [self.gids[some], self.links[some].astype(np.int64), self.gids[self.parent[some]]])

    placed_rows = spread.repartition("hash").sortWithinPartitions("hash", "key", "visitor")
    found = stage(placed_rows.mapInArrow(compare, "gid long, links long, other long"), "links")
    links = found.groupBy("gid").agg(F.sum("links").alias("links"))
    parts_of = connected_components(found.select(F.col("gid").alias("a"), F.col("other").alias("b")))

    named = distinct.join(links, "gid", "left").join(parts_of, F.col("gid") == F.col("id"), "left")
    named = named.select("label", "v", "n", "first", "links", F.coalesce("component", "gid").alias("part"))
    heads = named.groupBy("part").agg(F.min("first").alias("component_id"))
    named = named.join(heads, "part").select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "component_id")
    linked = rows.where(usable).join(named, ["label", "v"]).select("id", "links", "component_id")
    alone = rows.where(~usable).select("id", F.lit(0).cast("long"), "id")
    return linked.union(alone).select(
        F.col("id").alias(id_column), F.col("links").alias("n_links"), F.col("component_id"), F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
