"""Substring dedup: fixed-block anchors, rolling probes, repeats extended window by window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import arrow_rows, stage, text_bytes

WINDOW = 35
#: Text bytes behind one bucket of hashes and one batch of documents: what a task holds follows from it.
BUCKET_BYTES = 16 << 20
#: Hashes a task gathers before it hands them on by bucket.
HELD = 1 << 21
_ODD = np.uint64(0x9E3779B97F4A7C15 & ~7 | 5)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every ``size`` consecutive word hashes, from sums over powers."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_ODD, len(hashes)), dtype=np.uint64)))
    out = (sums[size:] - sums[:n]) * _powers(_INVERSE, n)
    out ^= out >> np.uint64(31)
    out *= _MIX
    return out ^ out >> np.uint64(29)


def _by_bucket(buckets: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(bucket, its part of each column) in order of the buckets."""
    order = np.argsort(buckets, kind="stable")
    buckets = buckets[order]
    columns = [c[order] for c in columns]
    cuts = np.flatnonzero(np.diff(buckets, prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(buckets[a]), *(c[a:b] for c in columns)


def _seen_twice(parts: list[np.ndarray], twice: list[np.ndarray], kind: type) -> np.ndarray:
    """Values that occur in two of ``parts``, or in ``twice``; a part has each value once."""
    values = np.sort(np.concatenate([*parts, *twice, *twice] or [np.empty(0, kind)]))
    return np.unique(values[1:][values[1:] == values[:-1]])


def _known(values: np.ndarray, answer: np.ndarray) -> np.ndarray:
    """Which values are in ``answer``, which is ascending and not empty; costs nothing for its length."""
    at = np.searchsorted(answer, values)
    return answer[np.minimum(at, len(answer) - 1)] == values


def _covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Whether each of ``n`` words lies in a window that starts at one of ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + size, n), -1)
    return np.cumsum(steps[:n]) > 0


def _near(anchored: np.ndarray, before: int, n: int) -> np.ndarray:
    """Places below ``n`` that are at most ``before`` words before an anchored block, or at it."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, np.minimum(np.maximum(anchored - before, 0), n), 1)
    np.add.at(steps, np.minimum(anchored + 1, n), -1)
    return np.flatnonzero(np.cumsum(steps[:n]) > 0)


def _replies(docs: DataFrame, replies: DataFrame, batches: int) -> DataFrame:
    """Documents with the replies of their batch just before them, batch after batch."""
    first = replies.select(
        "batch", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("id"), F.col("hashes").alias("data")
    )
    then = docs.select("batch", F.lit(1).alias("kind"), "id", F.col("t").alias("data"))
    return first.unionByName(then).repartition(batches, "batch").sortWithinPartitions("batch", "kind")


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(id, text, n_words, n_removed) per row; ``text`` is what is left, its words joined by a blank.

    A word goes if it lies in a window of ``window`` words that also starts elsewhere, in this row or
    another. Words are runs without ASCII white space. Null, empty and wordless texts have no
    words and give an empty text; repeated rows repeat each other; other columns are not read.

    * Anchors: every document is cut into blocks of ``(window + 1) // 2`` words, so a repeated window
      holds a whole block of its own document. All blocks are indexed, and every rolling window of
      that many words probes the index: a block is a hit if its words start anywhere twice.
    * Extension: windows around hits are hashed with 64 bits (besides the bits that choose the
      bucket), and those which occur twice are repeats. Runs of them are the maximal repeats.

    Hashes travel packed, one row per bucket. A task names a hash once, however often it has met it, and
    a hash is answered once per batch of documents, not per document: a passage in a third of all
    documents is no more than (number of batches) entries. Buckets and batches grow in number with the
    text, so a task holds the hashes of about ``bucket_bytes`` of text; documents stream one by one.
    """
    block = (window + 1) // 2
    id_type = docs.schema[id_column].dataType
    source = docs.select(F.col(id_column).cast("string").alias("id"), text_bytes(text_column).alias("t"))
    total = source.agg(F.sum(F.length("t"))).first()[0] or 0
    count = max(8, -(-total // bucket_bytes))
    named = source.withColumn("batch", F.pmod(F.xxhash64("id", "t"), F.lit(count)).cast("int"))

    def place(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and the 32 bits kept of it."""
        return ((hashes >> _HALF) % np.uint64(count)).astype(np.int64), (hashes & _LOW).astype(np.uint32)

    binary = pa.binary()
    index_schema = pa.schema([("bucket", pa.int32()), ("once", binary), ("twice", binary), ("blocks", binary), ("owners", binary)])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolls: list[np.ndarray] = []
        blocks: list[np.ndarray] = []
        owners: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not rolls:
                return
            buckets, low = place(np.concatenate(rolls))
            both, seen = np.unique(buckets.astype(np.uint64) << _HALF | low, return_counts=True)
            own, own_low = place(np.concatenate(blocks))
            pairs = np.unique(np.stack([own << 32 | own_low, np.concatenate(owners)]), axis=1) if len(own) else np.empty((2, 0), np.int64)
            once = both[seen == 1]
            out = {b: [x.tobytes(), b"", b"", b""] for b, x in _by_bucket((once >> _HALF).astype(np.int64), once.astype(np.uint32))}
            for b, more in _by_bucket((both[seen > 1] >> _HALF).astype(np.int64), both[seen > 1].astype(np.uint32)):
                out.setdefault(b, [b"", b"", b"", b""])[1] = more.tobytes()
            for b, more, owner in _by_bucket(pairs[0] >> 32, pairs[0].astype(np.uint32), pairs[1].astype(np.uint32)):
                out.setdefault(b, [b"", b"", b"", b""])[2:] = [more.tobytes(), owner.tobytes()]
            rolls.clear(), blocks.clear(), owners.clear()
            yield arrow_rows(index_schema, [list(out), *map(list, zip(*out.values(), strict=True))])

        held = 0
        for batch in batches:
            for owner, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = text.as_py().split()
                if len(words) < window:
                    # Too short for a window of its own, and so for a part in anyone's.
                    continue
                found = window_hashes(word_hashes(words), block)
                rolls.append(found)
                blocks.append(found[::block])
                owners.append(np.full(len(blocks[-1]), owner, np.int64))
                held += len(found)
                if held >= HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    reply_schema = pa.schema([("batch", pa.int32()), ("hashes", binary)])

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice, blocks, owners, bucket = [], [], [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                bucket = row["bucket"]
                once.append(np.frombuffer(row["once"], np.uint32))
                twice.append(np.frombuffer(row["twice"], np.uint32))
                blocks.append(np.frombuffer(row["blocks"], np.uint32))
                owners.append(np.frombuffer(row["owners"], np.uint32))
        again = _seen_twice(once, twice, np.uint32)
        low, owner = np.concatenate(blocks), np.concatenate(owners)
        chosen = np.isin(low, again)
        low = low[chosen].astype(np.uint64) | np.uint64(bucket) << _HALF
        rows = [(b, np.unique(x).tobytes()) for b, x in _by_bucket(owner[chosen].astype(np.int64), low)]
        yield arrow_rows(reply_schema, [[b for b, _ in rows], [x for _, x in rows]])

    indexed = named.select("batch", "t").mapInArrow(index, "bucket int, once binary, twice binary, blocks binary, owners binary")
    anchors = stage(indexed.groupBy("bucket").applyInArrow(hits, "batch int, hashes binary"), "anchors")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(batch, id, words, answer of the batch so far) per document; a batch's answer precedes it."""
        now, parts, answer = None, [], np.empty(0, np.uint64)
        for rows in batches:
            for batch, kind, key, data in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), rows.column(2).to_pylist(), rows.column(3), strict=True):
                if batch != now:
                    now, parts, answer = batch, [], np.empty(0, np.uint64)
                if kind == 0:
                    parts.append(np.frombuffer(data.as_py(), np.uint64))
                    continue
                if parts:
                    answer, parts = np.unique(np.concatenate(parts)), []
                yield batch, key, data.as_py().split(), answer

    window_schema = pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("once", binary), ("twice", binary)])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, last = 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            both, seen = np.unique(np.concatenate(held), return_counts=True)
            out = {b: [x.tobytes(), b""] for b, x in _by_bucket((both[seen == 1] % np.uint64(count)).astype(np.int64), both[seen == 1])}
            for b, x in _by_bucket((both[seen > 1] % np.uint64(count)).astype(np.int64), both[seen > 1]):
                out.setdefault(b, [b"", b""])[1] = x.tobytes()
            held.clear()
            yield arrow_rows(window_schema, [list(out), [last] * len(out), *map(list, zip(*out.values(), strict=True))])

        for batch, _, words, answer in texts(batches):
            if batch != last or size >= HELD:
                yield from flush()
                size, last = 0, batch
            if len(words) < window or not len(answer):
                continue
            hashes = word_hashes(words)
            buckets, low = place(window_hashes(hashes, block)[::block])
            own = buckets.astype(np.uint64) << _HALF | low
            anchored = np.flatnonzero(_known(own, answer)) * block
            if not len(anchored):
                continue
            # A window holds the block if it starts at most (window - block) words before it.
            n = len(words) - window + 1
            held.append(window_hashes(hashes, window)[_near(anchored, window - block, n)])
            size += len(held[-1])
        yield from flush()

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice, owners = [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                once.append(np.frombuffer(row["once"], np.uint64))
                twice.append(np.frombuffer(row["twice"], np.uint64))
                owners.append(row["batch"])
        again = _seen_twice(once, twice, np.uint64)
        rows = [(b, np.concatenate((x[_known(x, again)] if len(again) else x[:0], y)).tobytes()) for b, x, y in zip(owners, once, twice, strict=True)]
        yield arrow_rows(reply_schema, [[b for b, x in rows if x], [x for _, x in rows if x]])

    seen = _replies(named, anchors, count).mapInArrow(candidates, "bucket int, batch int, once binary, twice binary")
    repeated = stage(seen.groupBy("bucket").applyInArrow(repeats, "batch int, hashes binary"), "repeats")

    kept_schema = pa.schema([("id", pa.string()), ("text", binary), ("n_words", pa.int64()), ("n_removed", pa.int64())])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for _, key, words, answer in texts(batches):
            left = words
            if len(words) >= window and len(answer):
                starts = np.flatnonzero(_known(window_hashes(word_hashes(words), window), answer))
                if len(starts):
                    gone = _covered(starts, window, len(words))
                    left = [words[i] for i in np.flatnonzero(~gone).tolist()]
            out.append((key, b" ".join(left), len(words), len(words) - len(left)))
            size += len(out[-1][1])
            if size > 8 << 20 or len(out) >= 2000:
                yield arrow_rows(kept_schema, list(map(list, zip(*out, strict=True))))
                out, size = [], 0
        if out:
            yield arrow_rows(kept_schema, list(map(list, zip(*out, strict=True))))

    kept = _replies(named, repeated, count).mapInArrow(keep, "id string, text binary, n_words long, n_removed long")
    return kept.select(F.col("id").cast(id_type).alias(id_column), F.col("text").cast("string").alias("text"), "n_words", "n_removed")
