"""Ranked lexical search: bit-sliced Bloom signatures bound all scores, what they can't exclude is scored exactly."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.common import arrow_rows, stage, text_bytes

#: Terms are runs of digits, letters and all bytes beyond ASCII; only A-Z are lower-cased.
_SEPARATED = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256)).lower()

#: A signature holds (term, level) for every level up to the term's occurrences, so it also bounds those.
LEVELS = (1, 2, 4, 8, 16)
#: Least bits of a signature per key in it, and bits set per key: at most 2.4 % of absent keys seem present.
BITS_PER_KEY = 8
PROBES = 4
#: Documents of a block, and bytes of its slices; a block of longer documents holds fewer.
BLOCK_DOCS = 1024
BLOCK_BYTES = 1 << 21
#: Items whose bounds are worked out together, and bytes of item texts that a task holds.
ITEM_GROUP = 32
ITEM_BYTES = 1 << 24
#: Documents by bound, per wanted result, whose exact scores give the first threshold.
FIRST_SCORED = 4

_SALTS = [(0x9E3779B97F4A7C15 * (i + 1)) & 0xFFFFFFFFFFFFFFFF for i in range(len(LEVELS))]


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_SEPARATED).split()


def term_hash(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term)


def slots(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """The bits of (term, level) in signatures of ``width`` bits, a power of two: one row per term."""
    x = (hashes ^ np.uint64(_SALTS[level])) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    low, high = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + np.arange(PROBES, dtype=np.uint64) * high[:, None]) & np.uint64(width - 1)).astype(np.int64)


def length_norm(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """A document's m, for its number of terms."""
    return 100 - 75 + (75 * n * documents) // max(terms, 1)


def tf_part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term's occurrences contribute per unit of weight; never falls as they rise."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class _Block:
    """Documents with signatures of one width, collected until their slices are written."""

    def __init__(self, width: int):
        self.width = width
        self.most = min(BLOCK_DOCS, max(8, BLOCK_BYTES * 8 // width))
        self.ids, self.hashes, self.n, self.top, self.slots = [], [], [], [], []

    def add(self, key: str | None, h: int, n: int, top: int, slots_of: np.ndarray) -> bool:
        self.ids.append(key)
        self.hashes.append(h)
        self.n.append(n)
        self.top.append(top)
        self.slots.append(slots_of)
        return len(self.ids) >= self.most

    def slices(self) -> bytes:
        """A bitmap over the documents for every bit of their signatures."""
        bits = np.zeros((self.width, -(-len(self.ids) // 8) * 8), np.uint8)
        for at, found in enumerate(self.slots):
            bits[found, at] = 1
        return np.packbits(bits, axis=1).tobytes()


_INDEX = pa.schema(
    [
        ("width", pa.int64()), ("ids", pa.list_(pa.string())), ("hashes", pa.list_(pa.int64())),
        ("n", pa.list_(pa.int64())), ("top", pa.list_(pa.int64())), ("slices", pa.binary()),
    ]
)


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Bit-sliced signatures of all documents that have terms: one row per block of documents.

    ``ids`` and ``hashes`` (of the texts) name a block's documents, ``n`` counts their terms with repeats,
    ``top`` is the most occurrences of one term. ``slices`` has ``width`` bitmaps over the documents: bitmap b
    says whose signature has bit b. The width is a power of two and follows the number of keys, so long and
    short documents are never in one block and signatures take a fixed share of the texts. One narrow pass;
    a task holds a block per width.
    """
    rows = docs.select(F.col(id_column).cast("string").alias("id"), F.xxhash64(text_column).alias("h"), text_bytes(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, _Block] = {}

        def written(block: _Block) -> pa.RecordBatch:
            del blocks[block.width]
            columns = [block.width], [block.ids], [block.hashes], [block.n], [block.top], [block.slices()]
            return arrow_rows(_INDEX, list(columns))

        for batch in batches:
            for key, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                counts = Counter(terms_of(text.as_py()))
                if not counts:
                    continue
                hashes = np.fromiter(map(term_hash, counts), np.uint64, len(counts))
                tf = np.fromiter(counts.values(), np.int64, len(counts))
                levels = [hashes[tf >= least] for least in LEVELS]
                width = 1 << max(6, (BITS_PER_KEY * sum(map(len, levels)) - 1).bit_length())
                found = np.concatenate([slots(x, level, width).ravel() for level, x in enumerate(levels)])
                block = blocks.setdefault(width, _Block(width))
                if block.add(key, h, int(tf.sum()), int(tf.max()), found):
                    yield written(block)
        for block in list(blocks.values()):
            yield written(block)

    schema = "width long, ids array<string>, hashes array<long>, n array<long>, top array<long>, slices binary"
    return rows.mapInArrow(run, schema)


def document_frequencies(docs: DataFrame, terms: Iterable[bytes], text_column: str = "text") -> dict[bytes, int]:
    """The number of documents that hold each of ``terms``, a set that the driver has."""
    named = sorted(terms)
    places = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(named)})
    schema = pa.schema([("term", pa.int64()), ("df", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = places.value
        wanted = at.keys()
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                found.update(wanted & set(terms_of(text.as_py())))
        yield arrow_rows(schema, [[at[t] for t in found], list(found.values())])

    counts = docs.select(text_bytes(text_column)).mapInArrow(run, "term long, df long")
    return {named[r.term]: r.df for r in counts.groupBy("term").agg(F.sum("df").alias("df")).collect()}


class Queries:
    """Items as weighted terms, and the bounds of their scores over a block of the index."""

    def __init__(self, items: list[list[bytes]], df: dict[bytes, int], documents: int, terms: int):
        self.documents, self.terms = documents, terms
        self.weights = [{t: c * weight(df[t], documents) for t, c in Counter(x).items() if t in df} for x in items]
        self.groups = []
        for at in range(0, len(items), ITEM_GROUP):
            group = self.weights[at : at + ITEM_GROUP]
            places = {t: i for i, t in enumerate(dict.fromkeys(t for x in group for t in x))}
            hashes = np.fromiter(map(term_hash, places), np.uint64, len(places))
            rows = [(np.array([places[t] for t in x], np.int64), np.array(list(x.values()), np.int64)) for x in group]
            self.groups.append((at, hashes, rows))

    def bounds(self, width: int, n: np.ndarray, top: np.ndarray, slices: bytes) -> Iterator[tuple[int, np.ndarray]]:
        """(item, upper bound of its score for each document of the block)."""
        packed = np.frombuffer(slices, np.uint8).reshape(width, -1)
        m = length_norm(n, self.documents, self.terms)
        # A term that isn't at the next level occurs less often than that level says.
        most = [np.minimum(top, LEVELS[i + 1] - 1) if i + 1 < len(LEVELS) else top for i in range(len(LEVELS))]
        parts = [tf_part(tf, m) for tf in most]
        for at, hashes, rows in self.groups:
            held = None
            bound = np.zeros((len(hashes), len(n)), np.int64)
            some = np.arange(len(hashes))
            for level in range(len(LEVELS)):
                found = slots(hashes[some], level, width)
                bits = np.bitwise_and.reduce(packed[found], axis=1)
                held = bits if held is None else held & bits
                left = held.any(axis=1)
                some, held = some[left], held[left]
                if not len(some):
                    break
                more = parts[level] - (parts[level - 1] if level else 0)
                bound[some] += np.unpackbits(held, axis=1, count=len(n)) * more
            for i, (places, weights) in enumerate(rows):
                yield at + i, weights @ bound[places]

    def score(self, item: int, counts: Counter, m: int) -> int:
        return sum(w * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 8 * m)) for t, w in self.weights[item].items() if t in counts)


def _candidates(index: DataFrame, shared, most: int | None, least: list[int]) -> DataFrame:
    """(item, id, h, bound) of the documents whose bound reaches the item's ``least``; of each task
    only the ``most`` with the highest bounds, or all."""
    schema = pa.schema([("item", pa.int64()), ("id", pa.string()), ("h", pa.int64()), ("bound", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        held: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                n, top = np.array(r["n"], np.int64), np.array(r["top"], np.int64)
                out: list[tuple] = []
                for item, bound in queries.bounds(r["width"], n, top, r["slices"]):
                    places = np.flatnonzero(bound >= max(least[item], 1))
                    if most and len(places) > most:
                        places = places[np.argpartition(-bound[places], most)[:most]]
                    rows = [(item, r["ids"][p], r["hashes"][p], int(bound[p])) for p in places]
                    if most:
                        held[item] = sorted(held.get(item, []) + rows, key=lambda x: -x[3])[:most]
                    else:
                        out += rows
                if out:
                    yield arrow_rows(schema, list(zip(*out)))
        for rows in held.values():
            if rows:
                yield arrow_rows(schema, list(zip(*rows)))

    return index.mapInArrow(run, "item long, id string, h long, bound long")


def _scored(docs: DataFrame, candidates: DataFrame, shared, id_column: str, text_column: str) -> DataFrame:
    """(item, id, score) of candidate documents, from their whole texts, if above 0."""
    wanted = candidates.groupBy("id", "h").agg(F.collect_set("item").alias("items"))
    wanted = stage(wanted.select(F.col("id").alias("_id"), F.col("h").alias("_h"), "items"), "candidates")
    rows = docs.select(F.col(id_column).cast("string").alias("id"), F.xxhash64(text_column).alias("h"), text_bytes(text_column).alias("text"))
    met = rows.join(wanted, (F.col("h") == F.col("_h")) & F.col("id").eqNullSafe(F.col("_id"))).select("id", "text", "items")
    schema = pa.schema([("item", pa.int64()), ("id", pa.string()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        for batch in batches:
            out = []
            for key, text, items in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                counts = Counter(terms_of(text.as_py()))
                m = int(length_norm(counts.total(), queries.documents, queries.terms))
                out += [(item, key, score) for item in items if (score := queries.score(item, counts, m)) > 0]
            if out:
                yield arrow_rows(schema, list(zip(*out)))

    return met.mapInArrow(run, "item long, id string, score long")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """(item id, rank, id, score) of the ``k`` documents with the highest scores above 0 for each item.

    Scores are sums over the item's terms, repeats included, of a weight that falls with the number of
    documents that hold the term, times a part that rises with its occurrences and falls with the
    document's length (:func:`weight`, :func:`tf_part`, :func:`length_norm`). Equal scores go by ascending id, a
    null id last. Null, empty and termless texts are no documents and give items no rows; no documents,
    no rows. Every row of ``items`` is searched by itself, and repeated documents are ranked one by one. Other
    columns are not read. Texts of any length count whole; one text must fit into a task.

    * :func:`build_index` makes signatures of all terms of all documents, once for all items.
    * Signatures say of a term at most too much, so with the document's length they bound its score from
      above. The exact scores of the documents with the highest bounds give a threshold per item: the
      k-th best of them. Every document whose bound reaches it is scored from its whole text, all others
      can't be among the best. Nothing else is cut.
    * Items are the query set: ``item_bytes`` of their texts are worked on at a time, and what goes to all
      tasks, their terms with weights, is bounded by that.
    """
    spark = docs.sparkSession
    named = items.select(F.col(item_id_column).alias("item_id"), text_bytes(item_text_column).alias("text"))
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    index = stage(build_index(docs, id_column, text_column), "index")
    totals = index.agg(F.sum(F.size("n")), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    documents, terms = totals[0] or 0, totals[1] or 0
    id_type = docs.schema[id_column].dataType
    blocks = max(1, -(-size // item_bytes))
    found = None
    for block in range(blocks):
        mine = named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        texts = [terms_of(bytes(r.text)) for r in mine]
        df = document_frequencies(docs, {t for x in texts for t in x}, text_column)
        shared = spark.sparkContext.broadcast(Queries(texts, df, documents, terms))
        first = _candidates(index, shared, FIRST_SCORED * k, [1] * len(mine))
        by_bound = Window.partitionBy("item").orderBy(F.desc("bound"), "id", "h")
        first = first.select("*", F.row_number().over(by_bound).alias("r")).where(F.col("r") <= FIRST_SCORED * k)
        by_score = Window.partitionBy("item").orderBy(F.desc("score"))
        reached = _scored(docs, first, shared, id_column, text_column).select("item", "score", F.row_number().over(by_score).alias("r"))
        least = [1] * len(mine)
        for r in reached.where(F.col("r") == k).collect():
            least[r.item] = r.score
        scored = _scored(docs, _candidates(index, shared, None, least), shared, id_column, text_column)
        scored = scored.select("item", F.col("id").cast(id_type).alias("id"), "score")
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        scored = scored.select("*", F.row_number().over(best).alias("rank")).where(F.col("rank") <= k)
        numbers = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(mine)], f"item long, item_id {items.schema[item_id_column].dataType.simpleString()}")
        part = scored.join(numbers, "item").select(
            F.col("item_id").alias(item_id_column), "rank", F.col("id").alias(id_column), "score"
        )
        found = part if found is None else found.union(part)
    return found
