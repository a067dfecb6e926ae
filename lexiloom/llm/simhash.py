"""SimHash near-duplicates: pigeonhole blocks, verified Hamming distance, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import arrow_rows, stage, text_bytes
from lexiloom.llm.graph import connected_components

SEED = 42
BITS = 64
#: Hashes whose bits are counted at once, so a very long text needs no more memory than its words.
CHUNK = 1 << 14


def fingerprint(text: bytes, words_per_shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text, ASCII letters lowered; 0 without words."""
    words = text.lower().split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    size = min(words_per_shingle, n)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)),
            np.uint64,
            min(CHUNK, len(starts) - at),
        )
        octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp) per row; ``fp`` is the fingerprint as a signed long. Null texts count as empty."""
    id_type = docs.schema[id_column].dataType
    arrow = pa.schema([(id_column, pa.string()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py(), words_per_shingle) for x in batch.column(1)]
            yield arrow_rows(arrow, [batch.column(0), np.array(found, np.uint64).view(np.int64)])

    rows = docs.select(F.col(id_column).cast("string"), text_bytes(text_column).alias("t"))
    out = rows.mapInArrow(run, f"`{id_column}` string, fp long")
    return out.withColumn(id_column, F.col(id_column).cast(id_type))


def block_masks(distance: int, blocks: int) -> list[int]:
    """Masks, as signed longs, of which every pair within ``distance`` bits agrees under one."""
    if not 0 <= distance < blocks <= BITS:
        raise ValueError("need 0 <= distance < blocks <= 64")
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(blocks)]
    masks = [sum(x) for x in combinations(parts, blocks - distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def hamming_components(prints: DataFrame, distance: int = 3, blocks: int = 6) -> DataFrame:
    """(fp, component) of every distinct fingerprint that links to another.

    Pairs within ``distance`` bits agree in at least ``blocks - distance`` whole blocks, so each
    choice of that many blocks is a key; with 6 blocks and 3 bits, 20 keys of about 32 bits, which
    keeps the chance groups of a key small for billions of texts.

    Members of a key's group are not paired with each other. First each one is compared with its
    group's smallest and largest fingerprint, which come from an aggregation that is combined before the
    shuffle and one row per group joined back, so no task has to hold a group. The links found are contracted to
    components. Only groups that still span several components are joined with themselves, for
    pairs of different components only, and the distance is part of the join's condition. No link
    between different components is lost, and links inside a component would not change it. A group
    holds distinct fingerprints, so exact copies, however many, are one row in it; the join is
    one that adaptive execution splits where a group is large.
    """
    distinct = prints.select("fp").where("fp is not null").distinct()
    masks = F.posexplode(F.array(*[F.lit(m).cast("long") for m in block_masks(distance, blocks)]))

    def grouped(rows: DataFrame) -> DataFrame:
        return rows.select("*", masks.alias("part", "mask")).withColumn("key", F.expr("fp & mask")).drop("mask")

    def near(a: str, b: str):
        return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance

    distinct = stage(distinct, "fingerprints")
    ends = grouped(distinct).groupBy("part", "key").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    ends = ends.where("low <> high")
    found = grouped(distinct).join(ends, ["part", "key"]).select(F.col("fp").alias("a"), F.explode(F.array("low", "high")).alias("b"))
    links = stage(found.where((F.col("a") != F.col("b")) & near("a", "b")).distinct(), "links")
    parts = connected_components(links)

    labelled = distinct.join(parts, F.col("fp") == F.col("id"), "left").select(
        "fp", F.coalesce("component", "fp").alias("component")
    )
    spans = grouped(labelled).groupBy("part", "key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    spans = spans.where("least <> most").select("part", "key")
    mixed = grouped(labelled).join(spans, ["part", "key"], "left_semi")
    mixed = stage(mixed.select("part", "key", "fp", "component"), "mixed")
    x, y = mixed.alias("x"), mixed.alias("y")
    same_group = (F.col("x.part") == F.col("y.part")) & (F.col("x.key") == F.col("y.key"))
    more = x.join(y, same_group & (F.col("x.component") < F.col("y.component")) & near("x.fp", "y.fp")).select(
        F.col("x.fp").alias("a"), F.col("y.fp").alias("b")
    )
    # The first links go on as one edge per member, so the second run starts from contracted stars.
    stars = parts.select(F.col("id").alias("a"), F.col("component").alias("b"))
    return connected_components(stars.union(more)).select(F.col("id").alias("fp"), "component")


def simhash_groups(
    docs: DataFrame,
    distance: int = 3,
    blocks: int = 6,
    words_per_shingle: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, fingerprint, component_id) per row of ``docs``.

    ``component_id`` is the smallest id that can be reached over links, the row's own included.
    Null and wordless texts have fingerprint 0 and link like any other; repeated rows stay rows; a
    null id is never the smallest one unless there is no other. Other columns are not read.
    """
    prints = stage(fingerprints(docs, words_per_shingle, id_column, text_column), "prints")
    parts = hamming_components(prints, distance, blocks)
    least = prints.groupBy("fp").agg(F.min(id_column).alias("first"))
    named = least.join(parts, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    heads = named.groupBy("component").agg(F.min("first").alias("component_id"))
    heads = named.join(heads, "component").select("fp", "component_id")
    return prints.join(heads, "fp").select(
        id_column, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
