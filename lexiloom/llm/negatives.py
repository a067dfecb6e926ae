"""Hard-negative mining: exact searches for windows of inner products in cover trees over norm-augmented vectors."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.common import arrow_rows, stage

#: Bytes of the vectors of one tree; a tree is built and searched inside one task.
TREE_BYTES = 1 << 21
LEAST_TREE = 64
#: Cells at most; their centres, and a summary of each cell, go to every task.
CELLS = 1024
#: Anchors that meet one tree in one task.
VISITORS = 65536
#: The covering radius of a level is so many times smaller than that of the level above.
BASE = 1.5
#: A node of so few vectors is a leaf, and so is one whose children would hold fewer than so many vectors on average:
#: to compare a leaf costs one product of matrices, to open a node about as much as to compare a hundred vectors.
LEAF = 256
CHILD = 8
#: Candidates for centres that are compared with each other at once.
CENTRES = 64
#: Slack for rounding of angles, in radians.
SLACK = 1e-6
#: Integer scores up to here are exact as doubles.
EXACT = 1 << 53


def augmented(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Unit vectors with one more component, which gives all of them the same norm before scaling.

    The inner product of a query, with 0 as its further component, is then a function of the angle alone.
    """
    if norm == 0:
        return np.concatenate([np.zeros_like(vectors), np.ones((len(vectors), 1))], axis=1)
    more = np.sqrt(np.maximum(norm**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
    return np.concatenate([vectors, more[:, None]], axis=1) / norm


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def product_bounds(angle: np.ndarray, radius: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of a query with the vectors within ``radius`` of a centre at ``angle``."""
    low = np.cos(np.minimum(angle + radius + SLACK, np.pi)) * scale
    high = np.cos(np.maximum(angle - radius - SLACK, 0.0)) * scale
    # Room for rounding: scores are whole numbers.
    room = 1 + 1e-12 * scale
    return low - room, high + room


def net(units: np.ndarray, places: np.ndarray, radius: float, most: int) -> list[np.ndarray] | None:
    """``places`` in groups, each within ``radius`` of its first place, and first places further apart; the
    first place leads the first group. None if it takes more than ``most`` groups."""
    left, groups = places, []
    while len(left):
        some = left[:CENTRES]
        apart = angles(units[some], units[some]) > radius
        chosen: list[int] = []
        for i in range(len(some)):
            if apart[i, chosen].all():
                chosen.append(i)
        centres = some[chosen]
        if len(groups) + len(centres) > most:
            return None
        far = angles(units[left], units[centres])
        nearest = far.argmin(axis=1)
        # A centre is its own, also next to one with an equal vector.
        inside = far[np.arange(len(left)), nearest] <= radius
        at = {int(c): i for i, c in enumerate(centres)}
        for i in range(len(some)):
            if (own := at.get(int(left[i]))) is not None:
                nearest[i], inside[i] = own, True
        for i, centre in enumerate(centres):
            members = left[inside & (nearest == i)]
            groups.append(np.concatenate([[centre], members[members != centre]]))
        left = left[~inside]
    return groups


class Tree:
    """A cover tree per label over one chunk of vectors.

    Nodes are in arrays: the centre of node i is vector ``centre[i]``, all its vectors are within
    ``radius[i]``, they are ``vectors[start[i] : end[i]]``, and its children are the nodes ``kids[i]`` to
    ``kids_end[i]``, none for a leaf. Children's centres are apart by more than the covering radius of
    their level, which falls by ``BASE`` from level to level.
    """

    #: The arrays, in the types they are stored in.
    TYPES = {
        "vectors": np.float64, "ids": np.int64, "gids": np.int64, "centre": np.int64, "radius": np.float64,
        "start": np.int64, "end": np.int64, "kids": np.int64, "kids_end": np.int64, "roots": np.int64,
    }

    def __init__(self, size: int, norm: float, labels: list[str], arrays: dict[str, np.ndarray]):
        self.size, self.norm, self.labels = size, norm, labels
        self.__dict__.update(arrays)
        self.vectors = self.vectors.reshape(len(self.ids), size)
        self.units = augmented(self.vectors[self.centre], norm)
        self.label_of = dict(zip(labels, self.roots.tolist(), strict=True))

    @classmethod
    def build(cls, labels: list[str], vectors: np.ndarray, ids: np.ndarray, gids: np.ndarray, norm: float) -> Tree:
        units = augmented(vectors, norm)
        names, numbers = np.unique(np.array(labels, dtype=str), return_inverse=True)
        found: dict[str, list] = {x: [] for x in ("centre", "radius", "start", "end", "kids", "kids_end", "roots")}
        order = np.empty(0, np.int64)
        todo: list[tuple[int, np.ndarray, float]] = []

        def node(places: np.ndarray, at: int) -> tuple[int, float]:
            radius = float(angles(units[places], units[places[:1]]).max())
            for x, value in (("centre", places[0]), ("radius", radius), ("start", at), ("end", at + len(places)), ("kids", 0), ("kids_end", 0)):
                found[x].append(value)
            return len(found["centre"]) - 1, radius

        for places in np.split(np.argsort(numbers, kind="stable"), np.cumsum(np.bincount(numbers))[:-1]):
            root, radius = node(places, len(order))
            found["roots"].append(root)
            order = np.concatenate([order, places])
            todo.append((root, places, radius))
        while todo:
            parent, places, radius = todo.pop()
            at = found["start"][parent]
            groups, level = None, radius
            # Levels that would only repeat the node are skipped.
            while len(places) > LEAF and level > SLACK:
                level /= BASE
                groups = net(units, places, level, len(places) // CHILD)
                if groups is None or len(groups) > 1:
                    break
            if not groups or len(groups) < 2:
                order[at : at + len(places)] = places
                continue
            found["kids"][parent] = len(found["centre"])
            for members in groups:
                child, reach = node(members, at)
                at += len(members)
                todo.append((child, members, min(reach, level)))
            found["kids_end"][parent] = len(found["centre"])
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        found["centre"] = back[np.array(found["centre"], np.int64)]
        arrays = {x: np.asarray(y, cls.TYPES[x]) for x, y in found.items()}
        arrays |= {"vectors": vectors[order], "ids": ids[order], "gids": gids[order]}
        return cls(vectors.shape[1], norm, names.tolist(), arrays)

    def stored(self) -> dict[str, bytes]:
        return {x: np.ascontiguousarray(getattr(self, x), t).tobytes() for x, t in self.TYPES.items()}

    @classmethod
    def read(cls, size: int, norm: float, labels: list[str], stored: dict[str, bytes]) -> Tree:
        return cls(size, norm, labels, {x: np.frombuffer(stored[x], t) for x, t in cls.TYPES.items()})

    def search(self, query: np.ndarray, label: str, gid: int, windows: list[Wanted], same: bool) -> None:
        """Offer the windows all vectors that can be among their best, in the order of what nodes may hold."""
        scale = float(np.linalg.norm(query)) * self.norm
        unit = np.append(query, 0.0) / (np.linalg.norm(query) or 1.0)
        if same:
            starts = [self.label_of[label]] if label in self.label_of else []
        else:
            starts = [root for name, root in self.label_of.items() if name != label]
        heap: list[tuple[float, int, float, float]] = []

        def push(nodes: np.ndarray) -> None:
            low, high = product_bounds(angles(self.units[nodes], unit[None])[:, 0], self.radius[nodes], scale)
            for i, a, b in zip(nodes.tolist(), low.tolist(), high.tolist()):
                # How far below a window's upper end the node's best score lies, at least.
                gaps = [w.high - min(b, w.high) for w in windows if w.may_take(a, b)]
                if gaps:
                    heapq.heappush(heap, (min(gaps), i, a, b))

        push(np.array(starts, np.int64))
        while heap:
            _, i, a, b = heapq.heappop(heap)
            open_windows = [w for w in windows if w.may_take(a, b)]
            if not open_windows:
                continue
            if self.kids_end[i] > self.kids[i]:
                push(np.arange(self.kids[i], self.kids_end[i]))
                continue
            part = slice(self.start[i], self.end[i])
            scores = products(self.vectors[part], query, scale)
            for w in open_windows:
                w.offer(scores, self.ids[part], self.gids[part], gid)


def products(vectors: np.ndarray, query: np.ndarray, most: float) -> np.ndarray:
    """Inner products of whole numbers, exact: as doubles, or as integers where they may not fit a double."""
    if most <= EXACT:
        return (vectors @ query).astype(np.int64)
    return vectors.astype(np.int64) @ query.astype(np.int64)


class Wanted:
    """The best ``k`` scores of a window, equal ones by ascending id, and never the anchor's own row."""

    def __init__(self, low: int, high: int, k: int, least: int):
        self.low, self.high, self.k = low, high, k
        #: Scores below are not needed: so many good ones are known from elsewhere.
        self.least = max(low, least)
        self.rows: list[tuple[int, int, int]] = []

    def may_take(self, low: float, high: float) -> bool:
        return low <= self.high and high >= self.least

    def offer(self, scores: np.ndarray, ids: np.ndarray, gids: np.ndarray, own: int) -> None:
        some = np.flatnonzero((scores >= self.least) & (scores <= self.high) & (gids != own))
        if not len(some):
            return
        if len(some) > self.k:
            edge = np.partition(scores[some], len(some) - self.k)[len(some) - self.k]
            some = some[scores[some] >= edge]
            some = some[np.lexsort((gids[some], ids[some], -scores[some]))[: self.k]]
        self.rows += list(zip((-scores[some]).tolist(), ids[some].tolist(), gids[some].tolist()))
        self.rows = sorted(self.rows)[: self.k]
        if len(self.rows) == self.k:
            self.least = max(self.least, -self.rows[-1][0])


_TREE_SCHEMA = "key long, size int, labels string, " + ", ".join(f"{x} binary" for x in Tree.TYPES)
_ASKED = "array<struct<w: int, low: long, high: long, least: long>>"
_ENDS = 1 << 62
_FOUND = pa.schema([(x, pa.int64()) for x in ("anchor", "w", "score", "id", "gid")])


class Forest:
    """Candidate vectors in cells of near ones, each cell in trees of bounded size, stored once."""

    def __init__(self, rows: DataFrame, cells: int, tree_bytes: int):
        """``rows`` are (gid, id, label, size, v, binary), v of whole numbers, stored."""
        self.spark = rows.sparkSession
        totals = rows.agg(F.count("*"), F.max("size"), F.max("norm")).first()
        count, longest, norm = totals[0], totals[1] or 0, float(totals[2] or 0.0)
        if not 100 * norm**2 < 2**63:
            raise ValueError("percentages of scores don't fit into 64 bits: the vectors are too long")
        self.norm = norm
        self.tree_bytes, self.most = tree_bytes, max(LEAST_TREE, tree_bytes // (8 * max(longest, 1)))
        wanted = min(cells, -(-count // self.most))
        sample = rows.orderBy(F.xxhash64("v"), "gid").limit(4 * wanted).select("v").collect() if wanted > 1 else []
        self.centres = self._spread([np.frombuffer(bytes(r.v)) for r in sample], wanted)
        self.shared = self.spark.sparkContext.broadcast((self.centres, norm))
        placed = stage(self._placed(rows), "cells")
        summary = placed.groupBy("size", "cell").agg(F.max("angle").alias("radius"), F.ceil(F.count("*") / self.most).cast("int").alias("parts"))
        self.cells = stage(summary, "summary")
        self.trees = stage(self._built(placed), "trees")

    def _spread(self, vectors: list[np.ndarray], wanted: int) -> dict[int, np.ndarray]:
        """Per vector size the unit centres of cells: farthest first, so they are a net of the sample."""
        out = {}
        for size in sorted({len(v) for v in vectors}):
            units = augmented(np.stack([v for v in vectors if len(v) == size]), self.norm)
            chosen, far = [0], angles(units, units[:1])[:, 0]
            while len(chosen) < min(wanted, len(units)) and far.max() > SLACK:
                chosen.append(int(far.argmax()))
                far = np.minimum(far, angles(units, units[chosen[-1:]])[:, 0])
            out[size] = units[chosen]
        return out

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Every vector with its nearest centre; sizes without centres are one cell around zero."""
        shared = self.shared
        schema = pa.schema([("gid", pa.int64()), ("id", pa.int64()), ("label", pa.string()), ("size", pa.int32()), ("v", pa.binary()), ("cell", pa.int32()), ("angle", pa.float64())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres, norm = shared.value
            for batch in batches:
                cells, far = [], []
                for size, v in zip(batch.column(3).to_pylist(), batch.column(4)):
                    at = angles(augmented(np.frombuffer(v.as_py())[None], norm), centres_of(centres, size))[0]
                    cells.append(int(at.argmin()))
                    far.append(float(at.min()))
                yield arrow_rows(schema, [*[batch.column(i) for i in range(5)], cells, far])

        return rows.select("gid", "id", "label", "size", "v").mapInArrow(run, "gid long, id long, label string, size int, v binary, cell int, angle double")

    def _built(self, placed: DataFrame) -> DataFrame:
        """One row per tree. Rows of a cell are dealt to its trees by hash and arrive one tree after the other."""
        norm, limit = self.norm, 4 * self.most
        keyed = placed.join(self.cells.select("size", "cell", "parts"), ["size", "cell"])
        keyed = keyed.withColumn("key", tree_key(F.col("size"), F.col("cell"), F.pmod(F.xxhash64("gid"), F.col("parts").cast("long")).cast("int")))
        dealt = keyed.select("key", "gid", "id", "label", "size", "v").repartition("key").sortWithinPartitions("key")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, held = None, []

            def tree() -> pa.RecordBatch:
                size = len(held[0][3]) // 8
                vectors = np.frombuffer(b"".join(r[3] for r in held)).reshape(len(held), size)
                made = Tree.build([r[2] for r in held], vectors, np.array([r[1] for r in held], np.int64), np.array([r[0] for r in held], np.int64), norm)
                columns = {"key": [now], "size": [size], "labels": [json.dumps(made.labels)]}
                columns |= {x: [b] for x, b in made.stored().items()}
                types = [pa.int64(), pa.int32(), pa.string()] + [pa.binary()] * len(Tree.TYPES)
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns.values(), types)], names=list(columns))

            for batch in batches:
                keys, gids, ids, labels, vectors = (batch.column(i) for i in (0, 1, 2, 3, 5))
                for key, *row in zip(keys.to_pylist(), gids.to_pylist(), ids.to_pylist(), labels.to_pylist(), vectors.to_pylist()):
                    # Rows dealt by hash exceed the share of a tree by little; the limit holds in any case.
                    if held and (key != now or len(held) >= limit):
                        yield tree()
                        held = []
                    now = key
                    held.append(row)
            if held:
                yield tree()

        return dealt.mapInArrow(run, _TREE_SCHEMA)

    def search(self, anchors: DataFrame, k: int, same: bool, count: int) -> DataFrame:
        """(anchor, w, score, id, gid): the best ``k`` of every window w of every anchor.

        ``anchors`` are stored rows (gid, label, size, v, asked), about ``count`` of them; ``asked`` has an
        anchor's windows (w, low, high). First the anchor goes to the trees of one cell, the one that may
        hold the best scores; then to all trees of the other cells that may hold a score of a window not
        below its k-th best so far. Cells whose bounds lie outside all windows are never visited.
        """
        first = stage(self._visits(anchors, False, k, same, count), "first")
        best = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id", "gid")
        ranked = first.select("*", F.row_number().over(best).alias("r"))
        known = ranked.where(F.col("r") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("known"))
        left = anchors.join(known.withColumnRenamed("anchor", "gid"), "gid", "left")

        def raised(x: Column) -> Column:
            least = F.coalesce(F.element_at("known", x["w"].cast("long")), x["least"])
            return F.struct(x["w"].alias("w"), x["low"].alias("low"), x["high"].alias("high"), least.alias("least"))

        left = left.select("gid", "label", "size", "v", F.transform("asked", raised).alias("asked"))
        more = self._visits(left, True, k, same, count)
        both = first.unionByName(more)
        return both.select("*", F.row_number().over(best).alias("r")).where(F.col("r") <= k).drop("r")

    def _visits(self, anchors: DataFrame, rest: bool, k: int, same: bool, count: int) -> DataFrame:
        """Searches of anchors in the trees of their best cell, or of all cells but that one."""
        shared, norm = self.shared, self.norm
        cells = self.cells.groupBy("size").agg(F.sort_array(F.collect_list(F.struct("cell", "radius", "parts"))).alias("cells"))
        slices = max(1, -(-count // VISITORS))

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres, _ = shared.value
            for batch in batches:
                rows, to_cell, to_part = [], [], []
                columns = (batch.column(x) for x in ("size", "v", "asked", "cells"))
                for at, (size, v, asked, found) in enumerate(zip(*columns)):
                    size, asked = size.as_py(), asked.as_py()
                    known = [(x["cell"], x["radius"], x["parts"]) for x in found.as_py()]
                    query = np.frombuffer(v.as_py())
                    length = float(np.linalg.norm(query))
                    units = centres_of(centres, size)[[c for c, _, _ in known]]
                    low, high = product_bounds(angles(units, np.append(query, 0.0)[None] / (length or 1.0))[:, 0], np.array([r for _, r, _ in known]), length * norm)

                    def gap(a: float, b: float, asked: list, raised: bool) -> float:
                        fits = [x["high"] - min(b, x["high"]) for x in asked if a <= x["high"] and b >= x["least" if raised else "low"]]
                        return min(fits) if fits else np.inf

                    # The same choice in both rounds: it goes by the windows alone.
                    gaps = [gap(a, b, asked, False) for a, b in zip(low, high)]
                    one = min(range(len(known)), key=lambda i: (gaps[i], -high[i], i))
                    for i, (cell, _, parts) in enumerate(known):
                        if (i != one and gap(low[i], high[i], asked, True) < np.inf) if rest else (i == one and gaps[i] < np.inf):
                            rows += [at] * parts
                            to_cell += [cell] * parts
                            to_part += range(parts)
                picked = batch.drop_columns(["cells"]).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(to_cell, pa.int32()), pa.array(to_part, pa.int32())], names=[*picked.schema.names, "cell", "part"])

        routed = anchors.join(cells, "size").select("gid", "label", "size", "v", "asked", "cells").mapInArrow(route, f"gid long, label string, size int, v binary, asked {_ASKED}, cell int, part int")
        key = tree_key(F.col("size"), F.col("cell"), F.col("part"))
        visitors = routed.select(key.alias("key"), F.pmod(F.xxhash64("gid"), F.lit(slices)).cast("int").alias("slice"), F.lit(1).alias("kind"), "gid", "label", "v", "asked")
        visited = visitors.select("key", "slice").distinct() if slices > 1 else None
        trees = self.trees.select("*", F.lit(0).alias("slice")) if visited is None else self.trees.join(visited, "key")
        rows = visitors.unionByName(trees.withColumn("kind", F.lit(0)), allowMissingColumns=True)
        dealt = rows.repartition("key", "slice").sortWithinPartitions("key", "slice", "kind")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, trees = None, []
            for batch in batches:
                out: list[tuple] = []
                names = batch.schema.names
                column = {x: batch.column(x) for x in names}
                keys, kinds, places = column["key"].to_pylist(), column["kind"].to_pylist(), column["slice"].to_pylist()
                for i, (key, kind) in enumerate(zip(keys, kinds)):
                    if (key, places[i]) != now:
                        now, trees = (key, places[i]), []
                    if kind == 0:
                        # A tree cut by the limit has several rows.
                        trees.append(Tree.read(column["size"][i].as_py(), norm, json.loads(column["labels"][i].as_py()), {x: column[x][i].as_py() for x in Tree.TYPES}))
                        continue
                    query, label, gid = np.frombuffer(column["v"][i].as_py()), column["label"][i].as_py(), column["gid"][i].as_py()
                    asked = column["asked"][i].as_py()
                    windows = [Wanted(x["low"], x["high"], k, x["least"]) for x in asked]
                    for tree in trees:
                        tree.search(query, label, gid, windows, same)
                    out += [(gid, x["w"], -s, b, g) for x, w in zip(asked, windows) for s, b, g in w.rows]
                if out:
                    yield arrow_rows(_FOUND, list(zip(*out)))

        return dealt.mapInArrow(run, "anchor long, w long, score long, id long, gid long")


def centres_of(centres: dict[int, np.ndarray], size: int) -> np.ndarray:
    return centres[size] if size in centres else np.append(np.zeros(size), 1.0)[None]


def tree_key(size: Column, cell: Column, part: Column) -> Column:
    return F.xxhash64(size, cell, part)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    lowest: int = 30,
    highest: int = 90,
    scale: int = 256,
    label: Column | None = None,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    cells: int = CELLS,
    tree_bytes: int = TREE_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the inner product of two vectors whose components x became ``floor(scale * x)``. For every
    row with ``is_anchor``, its positives are the ``positives`` other rows of its label with the highest
    scores. For each of them, the negatives are the ``negatives`` rows of other labels with the highest scores
    from ``lowest`` to ``highest`` percent of the positive's. Equal scores go by ascending id. ``label``
    may replace the label column.

    Rows without id, label or vector, or with a null or non-finite component, take no part; empty tables and anchors
    without positives or negatives give no rows. Rows are told apart by place, not by id: a
    repeated row is another row of its label, and each repeated anchor has rows of its own. Vectors only meet
    those with as many components. Vectors whose squared length reaches 2^63 / 100
    are an error. Other columns are
    not read.

    * Candidates get one more component that makes all norms equal, so an inner product follows from an
      angle, for which the triangle inequality holds. They are dealt to cells of near centres, at most ``cells``, from a
      sample of four rows per cell by hash, and cells to trees of about ``tree_bytes``. All rows are in trees.
    * Every tree is a cover tree per label. The covering radius of a node bounds the scores of
      all its vectors from both sides; the best node comes first, those outside the windows or below what is found are
      skipped, leaves are compared one by one, in whole numbers. Nothing is approximate.
    * Anchors are sent only to cells that may hold what they seek, and in groups of ``VISITORS`` to a tree, so neither a hot
      label nor a tree that all anchors want is one task.
    """
    if not 0 <= lowest <= highest <= 100:
        raise ValueError("lowest and highest are percentages, the lower one first")
    chosen = F.col(label_column) if label is None else label
    doubles = F.col(vector_column).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), chosen.cast("string").alias("label"), doubles.alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor")
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(finite).withColumn("gid", F.monotonically_increasing_id())
    schema = pa.schema([("gid", pa.int64()), ("id", pa.int64()), ("label", pa.string()), ("anchor", pa.bool_()), ("size", pa.int32()), ("norm", pa.float64()), ("v", pa.binary())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.floor(scale * np.array(v, np.float64)) for v in batch.column(4).to_pylist()]
            sizes, norms = [len(v) for v in found], [float(np.linalg.norm(v)) for v in found]
            yield arrow_rows(schema, [*[batch.column(i) for i in range(4)], sizes, norms, [v.tobytes() for v in found]])

    rows = rows.select("gid", "id", "label", "anchor", "v").mapInArrow(whole, "gid long, id long, label string, anchor boolean, size int, norm double, v binary")
    rows = stage(rows, "vectors")
    forest = Forest(rows, cells, tree_bytes)
    anchors = stage(rows.where("anchor").select("gid", "id", "label", "size", "v"), "anchors")
    count = anchors.count()

    ends = [F.lit(x).cast("long").alias(name) for name, x in (("low", -_ENDS), ("high", _ENDS), ("least", -_ENDS))]
    everything = F.struct(F.lit(0).alias("w"), *ends)
    asked = stage(anchors.select("gid", "label", "size", "v", F.array(everything).alias("asked")), "asked")
    best = forest.search(asked, positives, True, count)
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "gid"))
    best = stage(best.select("anchor", (place - 1).cast("int").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # A negative positive score has an empty window.
    best = best.where("positive_score >= 0")
    low, high = F.expr(f"(positive_score * {lowest} + 99) div 100"), F.expr(f"positive_score * {highest} div 100")
    windows = best.select("anchor", F.struct("w", low.alias("low"), high.alias("high"), low.alias("least")).alias("x"))
    windows = windows.where("x.low <= x.high").groupBy("anchor").agg(F.sort_array(F.collect_list("x")).alias("asked"))
    asked = stage(anchors.join(windows.withColumnRenamed("anchor", "gid"), "gid").select("gid", "label", "size", "v", "asked"), "asked")
    found = forest.search(asked, negatives, False, count)
    rank = F.row_number().over(Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id", "gid"))
    found = found.select("anchor", F.col("w").cast("int").alias("w"), rank.alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = found.join(best, ["anchor", "w"]).join(anchors.select(F.col("gid").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
