"""Benchmark decontamination: winnowed k-gram fingerprints, joined, and hits extended word by word."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.common import arrow_rows, stage, text_bytes, unused

WINDOW = 10
GRAM = 5
#: Bytes of words: digits, lower-case letters and everything beyond ASCII; capitals are lowered.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def gram_hashes(words: list[bytes], k: int) -> np.ndarray:
    """One hash for each ``k`` consecutive words."""
    n = len(words) - k + 1
    if n < 1:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = (out ^ one[i : i + n]) * _FACTOR
        out ^= out >> np.uint64(29)
    out *= _MIX
    return out ^ out >> np.uint64(32)


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places of the smallest hash of every ``width`` consecutive ones (the last of equal ones).

    Two texts that share ``width`` consecutive hashes get the same smallest hash from them.
    """
    n = len(hashes) - width + 1
    if n < 1:
        return np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes[::-1], width)[::-1]
    return np.unique(np.arange(n) + width - 1 - views.argmin(axis=1))


def fingerprints(text: bytes, window: int, gram: int, short: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of a document: the winnowed k-grams, and all m-grams for lengths of short items."""
    words = words_of(text)
    hashes = gram_hashes(words, gram)
    at = winnow(hashes, window - gram + 1)
    found, places = [hashes[at]], [at]
    for m in short:
        found.append(gram_hashes(words, m) ^ _FACTOR)
        places.append(np.arange(len(found[-1])))
    return np.concatenate(found), np.concatenate(places)


def item_fingerprints(words: list[bytes], window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of an item; one shorter than the window has the hash of all its words."""
    if len(words) < window:
        return gram_hashes(words, len(words)) ^ _FACTOR, np.zeros(1, np.int64)
    hashes = gram_hashes(words, gram)
    at = winnow(hashes, window - gram + 1)
    return hashes[at], at


def equal_runs(ours: list[bytes], theirs: list[bytes], least: int) -> list[tuple[int, int]]:
    """[start, end) of the maximal runs of at least ``least`` equal words at equal places."""
    same = np.fromiter((a == b for a, b in zip(ours, theirs, strict=False)), np.int8, min(len(ours), len(theirs)))
    edges = np.diff(np.concatenate(([0], same, [0])))
    return [(int(a), int(b)) for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True) if b - a >= least]


def contamination_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Spans (_id, _h, group, start, end) of document words that equal item words, and (group, item_id).

    ``_id`` and ``_h``, the id as text and a hash of the text, name a document: rows repeated as a whole
    share them. Items with equal words are one group. A span is a maximal run of at least ``window``
    words shared with an item at one alignment (or the whole of a shorter item).

    Documents and items keep the smallest of each ``window - gram + 1`` consecutive k-gram hashes, so
    any ``window`` shared words leave a shared hash. The join on hashes is left to Spark: the items'
    side is a stored table, which is broadcast only if it is below the session's threshold. Each hit
    gives an alignment; the document's words along it are cut out and compared with the item.
    """
    if not 0 < gram <= window:
        raise ValueError("need 0 < gram <= window")
    named = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("_id"),
        F.xxhash64(text_column).alias("_h"),
        text_bytes(text_column).alias("_t"),
    )

    item_schema = pa.schema([("item", pa.string()), ("words", pa.binary()), ("n", pa.int32())])

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(x.as_py()) for x in batch.column(1)]
            yield arrow_rows(item_schema, [batch.column(0), [b" ".join(w) for w in words], [len(w) for w in words]])

    wanted = benchmark.select(F.col(item_column).cast("string"), text_bytes(item_text_column))
    rows = wanted.mapInArrow(items, "item string, words binary, n int").where("n > 0")
    rows = stage(rows.withColumn("group", F.sha1("words")), "items")
    members = rows.where("item is not null").select("group", F.col("item").alias(item_column)).distinct()
    groups = stage(rows.groupBy("group").agg(F.first("words").alias("words"), F.first("n").alias("n")), "groups")
    # At most window - 1 numbers.
    short = sorted(r.n for r in groups.where(F.col("n") < window).select("n").distinct().collect())

    print_schema = pa.schema([("group", pa.string()), ("n", pa.int32()), ("fp", pa.int64()), ("place", pa.int32())])

    def item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words.split()
                hashes, at = item_fingerprints(words, window, gram)
                yield arrow_rows(print_schema, [[group] * len(at), [len(words)] * len(at), hashes.view(np.int64), at.astype(np.int32)])

    # A stored table has a known size, by which Spark decides between a broadcast and a shuffle.
    prints = groups.select("group", "words").mapInArrow(item_prints, "group string, n int, fp long, place int")
    prints = stage(prints, "item_prints")

    doc_schema = pa.schema([("_id", pa.string()), ("_h", pa.int64()), ("prints", pa.list_(pa.struct([("fp", pa.int64()), ("at", pa.int32())])))])

    def doc_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprints(x.as_py(), window, gram, short) for x in batch.column(2)]
            ends = np.cumsum([0, *(len(at) for _, at in found)]).astype(np.int32)
            hashes = np.concatenate([h for h, _ in found] or [np.empty(0, np.uint64)]).view(np.int64)
            places = np.concatenate([at for _, at in found] or [np.empty(0, np.int64)]).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(hashes), pa.array(places)], names=["fp", "at"])
            yield arrow_rows(doc_schema, [batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pairs)])

    ours = named.mapInArrow(doc_prints, "_id string, _h long, prints array<struct<fp: long, at: int>>")
    ours = ours.select("_id", "_h", F.inline("prints"))
    hits = ours.join(prints, "fp").select("_id", "_h", "group", "n", (F.col("at") - F.col("place")).alias("shift")).distinct()
    hits = stage(hits, "hits")

    wants = hits.groupBy("_id", "_h").agg(F.collect_list(F.struct("group", "shift", "n")).alias("wants"))
    cut_schema = pa.schema([("_id", pa.string()), ("_h", pa.int64()), ("group", pa.string()), ("shift", pa.int32()), ("words", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, h, text, asked in zip(*(c for c in batch.columns), strict=True):
                words = words_of(text.as_py())
                found = [(w["group"], max(0, w["shift"]), b" ".join(words[max(0, w["shift"]) : w["shift"] + w["n"]]), w["shift"]) for w in asked.as_py()]
                parts = [[key.as_py()] * len(found), [h.as_py()] * len(found), [f[0] for f in found], [f[3] for f in found], [f[2] for f in found]]
                yield arrow_rows(cut_schema, parts)

    texts = named.join(wants, ["_id", "_h"]).select("_id", "_h", "_t", "wants")
    pieces = texts.mapInArrow(cut, "_id string, _h long, group string, shift int, words binary").distinct()
    aligned = pieces.join(groups.select("group", "n", F.col("words").alias("item")), "group")
    span_schema = pa.schema([("_id", pa.string()), ("_h", pa.int64()), ("group", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                item, skip = row["item"].split(), max(0, -row["shift"])
                least = min(window, len(item))
                for a, b in equal_runs(row["words"].split(), item[skip:], least):
                    start = max(0, row["shift"])
                    out.append((row["_id"], row["_h"], row["group"], start + a, start + b))
            yield arrow_rows(span_schema, list(map(list, zip(*out, strict=True))) if out else [[]] * 5)

    spans = aligned.select("_id", "_h", "group", "shift", "words", "item").mapInArrow(
        extend, "_id string, _h long, group string, start int, end int"
    )
    return stage(spans.distinct(), "spans"), members


def _counted(named: DataFrame) -> DataFrame:
    """(_id, _h, n_words) of rows (_id, _h, _t)."""
    schema = pa.schema([("_id", pa.string()), ("_h", pa.int64()), ("n_words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [len(words_of(x.as_py())) for x in batch.column(2)]
            yield arrow_rows(schema, [batch.column(0), batch.column(1), counts])

    return named.mapInArrow(run, "_id string, _h long, n_words long")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies in a span shared with an item. Null, empty and wordless texts have
    no words and no hits; items without words hit nothing; an item without an id hits words but is not
    counted; equal rows get equal results; other columns are not read.
    """
    spans, members = contamination_spans(docs, benchmark, window, gram, id_column, text_column, item_column)
    order = Window.partitionBy("_id", "_h").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.max("end").over(order), F.lit(0))
    hit = spans.select("_id", "_h", F.greatest(F.lit(0), F.col("end") - F.greatest("start", before)).alias("n"))
    hit = hit.groupBy("_id", "_h").agg(F.sum("n").alias("n_hit"))
    items = spans.select("_id", "_h", "group").distinct().join(members, "group")
    items = items.groupBy("_id", "_h").agg(F.sort_array(F.collect_set(item_column)).alias("items"))
    id_type = docs.schema[id_column].dataType
    rows = _counted(docs.select(F.col(id_column).cast("string").alias("_id"), F.xxhash64(text_column).alias("_h"), text_bytes(text_column).alias("_t")))
    rows = rows.select(F.col("_id").cast(id_type).alias(id_column), F.coalesce("_id", F.lit("")).alias("_id"), "_h", "n_words")
    found = hit.join(items, ["_id", "_h"], "left")
    return rows.join(found, ["_id", "_h"], "left").select(
        id_column,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the rows that share a window with the benchmark; columns and other rows as they are."""
    spans, _ = contamination_spans(docs, benchmark, window, gram, id_column, text_column)
    own_id, own_hash = unused(docs, "hit_id", "hit_hash")
    found = spans.select(F.col("_id").alias(own_id), F.col("_h").alias(own_hash)).distinct()
    same = (F.coalesce(F.col(id_column).cast("string"), F.lit("")) == F.col(own_id)) & (F.xxhash64(text_column) == F.col(own_hash))
    return docs.join(found, same, "left_anti")
