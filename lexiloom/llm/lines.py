"""Fuzzy line dedup with DataFrame functions only: MinHash bands, exact Jaccard, components."""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.common import stage, unused
from lexiloom.llm.graph import connected_components

SHINGLE = 8
JACCARD = 0.8
BANDS = 12
ROWS = 3
BLANKS = " \t\r\x0b\x0c"
#: Words of a line's parity map of shingles, a power of two; 32 are 2,048 bits.
MAP_WORDS = 32
#: Words it is folded to, which are compared first.
FOLDED_WORDS = 8
#: Shingles of a line in one row of the aggregation of its signature.
BLOCK = 8
#: Bands that share a pair of hashes of a shingle; each has an order of its own from them.
SHARED = 12
#: One constant per minimum of a band; xor with it puts the band's hashes of all shingles in another order.
_BITS = random.Random(20)
_ORDERS = [_BITS.getrandbits(64) - (1 << 63) for _ in range(64)]


def line_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, nr, line, h) of the lines that are not blank; ``line`` without blanks at its ends, ``h`` its hash."""
    cut = docs.select(F.col(id_column).alias("id"), F.posexplode(F.split(text_column, "\n")).alias("nr", "raw"))
    lines = cut.select("id", "nr", F.btrim("raw", F.lit(BLANKS)).alias("line")).where("line <> ''")
    return lines.withColumn("h", F.xxhash64("line"))


def code_units(line: Column) -> Column:
    """The line in two bytes per character unit, in which a shingle is cut without counting."""
    return F.encode(line, "UTF-16BE")


def _last_start(units: Column, shingle: int) -> Column:
    """Where in the code units the last shingle starts, in bytes from 1, as all starts are."""
    return F.greatest(F.lit(1), F.octet_length(units) - (2 * shingle - 1))


def _shingle(units: Column, at: Column, shingle: int) -> Column:
    return F.xxhash64(F.substring(units, at, F.lit(2 * shingle)))


def band_keys(lines: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(h, n, keys) per distinct line of (h, line): its rows, and a key for each band of its MinHash signature.

    The number of the band is part of what a key is a hash of, so keys are grouped without it.
    Lines are spread by ``h`` once; their shingles are made and reduced to minima inside the same
    stage, a block of them per row in generated code, so shingles are never shuffled or held.
    """
    distinct = lines.groupBy("h").agg(F.min("line").alias("line"), F.count("*").alias("n"))
    cut = distinct.select("h", "n", code_units(F.col("line")).alias("units"))
    last = _last_start(F.col("units"), shingle)
    cut = cut.select("h", "n", "units", last.alias("last"), F.explode(F.sequence(F.lit(1), last, F.lit(2 * BLOCK))).alias("at"))
    # The last block of a line repeats its last shingle, which changes no minimum.
    starts = [F.least(F.col("at") + 2 * j, "last") if j else F.col("at") for j in range(BLOCK)]
    hashed = cut.select("h", "n", *[_shingle(F.col("units"), at, shingle).alias(f"x{j}") for j, at in enumerate(starts)])
    shared = range((bands + SHARED - 1) // SHARED)
    hashed = hashed.select("*", *[F.xxhash64(f"x{j}", F.lit(g)).alias(f"y{j}_{g}") for j in range(BLOCK) for g in shared])

    def least_of(band: int, row: int) -> Column:
        # Orders by xor with constants alone depend on each other on short lines. So every band has hashes of its own: a
        # shingle's second hash, shifted by another number of bits, changes the upper bits of the first, which orders go by.
        g, shift = divmod(band, SHARED)
        of = [F.col(f"x{j}").bitwiseXOR(F.shiftleft(f"y{j}_{g}", 4 * shift)).bitwiseXOR(F.lit(_ORDERS[row])) for j in range(BLOCK)]
        return F.min(F.least(*of))

    signature = [least_of(b, i).alias(f"s{b}_{i}") for b in range(bands) for i in range(rows)]
    keys = [F.xxhash64(F.lit(b), *[f"s{b}_{i}" for i in range(rows)]) for b in range(bands)]
    return hashed.groupBy("h", "n").agg(*signature).select("h", "n", F.array(*keys).alias("keys"))


def shingle_set(units: str, shingle: int = SHINGLE) -> Column:
    """The distinct shingles, as 64-bit hashes, of a line's code units.

    The units are bound to a variable first: read from the row, they would be copied for every shingle.
    """

    def of(bound: Column) -> Column:
        starts = F.sequence(F.lit(1), _last_start(bound, shingle), F.lit(2))
        return F.array_distinct(F.transform(starts, lambda i: _shingle(bound, i, shingle)))

    return F.transform(F.array(units), of)[0]


def similar(pairs: DataFrame, texts: DataFrame, least: float = JACCARD, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose lines in ``texts`` (h, units) have a Jaccard similarity of at least ``least``."""
    left = texts.select(F.col("h").alias("a"), F.col("units").alias("units_a"))
    right = texts.select(F.col("h").alias("b"), F.col("units").alias("units_b"))
    joined = pairs.join(left, "a").join(right, "b")
    both_sets = F.struct(shingle_set("units_a", shingle).alias("x"), shingle_set("units_b", shingle).alias("y"))
    # Sets come out of a generator, so that what follows reads them instead of working them out again.
    sets = joined.select("a", "b", F.explode(F.array(both_sets)).alias("sets")).select("a", "b", "sets.x", "sets.y")
    x, y = F.size("x"), F.size("y")
    both = F.size(F.array_intersect("x", "y"))
    # The larger set must not be larger than the smaller one allows, whatever they share. The second test is
    # both / (x + y - both) >= least with ``both`` on one side, and with room for rounding at a tie.
    near = (F.least(x, y) >= least * F.greatest(x, y)) & (both * (1 + least) >= least * (x + y) - 1e-9)
    return sets.where(near).select("a", "b")


def shingle_maps(texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(h, size, words, folded) of (h, units): the number of different shingles, and for each of a fixed number
    of buckets whether an odd number of their hashes falls into it; ``folded`` has fewer and larger buckets.

    Lines are spread by ``h``, so that words are made and put together in one stage.
    """
    # As in `similar`, the set comes out of a generator, so that it is worked out once.
    sets = texts.repartition("h").select("h", F.explode(F.array(shingle_set("units", shingle))).alias("set"))
    hashed = sets.select("h", F.explode("set").alias("x"))
    word = F.shiftrightunsigned("x", 64 - MAP_WORDS.bit_length() + 1)
    bit = F.expr("shiftleft(1L, cast(x & 63 as int))")
    words = hashed.groupBy("h", word.alias("word")).agg(F.count("*").alias("size"), F.bit_xor(bit).alias("bits"))
    row = [F.coalesce(F.max(F.when(F.col("word") == j, F.col("bits"))), F.lit(0).cast("long")) for j in range(MAP_WORDS)]
    maps = words.groupBy("h").agg(F.sum("size").alias("size"), *[w.alias(f"w{j}") for j, w in enumerate(row)])
    folded = [reduce(Column.bitwiseXOR, [F.col(f"w{j}") for j in range(i, MAP_WORDS, FOLDED_WORDS)]) for i in range(FOLDED_WORDS)]
    return maps.select("h", "size", F.array(*[f"w{j}" for j in range(MAP_WORDS)]).alias("words"), F.array(*folded).alias("folded"))


def may_be_similar(a: str, b: str, least: float) -> Column:
    """False only if two lines, by their maps, can't have a Jaccard similarity of ``least``.

    A bucket in which the maps differ holds a shingle of one line only; what both lines have cancels out, so long lines
    fill no map. With d such buckets and s shingles in both sets together, the similarity is at most (s - d) / (s + d).
    It is also at most the ratio of the sizes. Sizes and folded maps rule out most pairs, so that few whole maps are compared.
    """
    x, y = F.col(f"{a}.size"), F.col(f"{b}.size")
    p, q = F.col(f"{a}.words"), F.col(f"{b}.words")
    p8, q8 = F.col(f"{a}.folded"), F.col(f"{b}.folded")
    folded = sum((F.bit_count(F.get(p8, F.lit(j)).bitwiseXOR(F.get(q8, F.lit(j)))) for j in range(FOLDED_WORDS)), F.lit(0))
    # Word by word, as generated code for all words at once is too long for the JVM to compile.
    whole = F.aggregate(F.zip_with(p, q, lambda v, w: F.bit_count(v.bitwiseXOR(w))), F.lit(0), lambda d, more: d + more)

    def near(d: Column) -> Column:
        # With ``d`` on one side: what occurs twice in a condition is worked out before all of it.
        return d * (1 + least) <= (x + y) * (1 - least) + 1e-9

    return (F.least(x, y) >= least * F.greatest(x, y) - 1e-9) & near(folded) & near(whole)


def leader_pairs(keys: DataFrame) -> DataFrame:
    """(a, b): every line of a group of equal band keys but its leader, with the leader, which has the most rows.

    The key alone, a number, is what tasks sort groups by, with its order at hand in the sort.
    """
    grouped = keys.select("h", "n", F.explode("keys").alias("key"))
    order = Window.partitionBy("key").orderBy(F.desc("n"), "h")
    pairs = grouped.select(F.col("h").alias("a"), F.first("h").over(order).alias("b"))
    return pairs.where("a <> b").distinct()


def line_components(lines: DataFrame, least: float = JACCARD, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(h, component) of the lines that are similar to a different line.

    Lines with an equal band key are candidates. Inside a group every line is first compared with one
    leader only, the line with the most rows: in a group of near copies that is the text they were copied from,
    which is nearer to each of them than they are to each other. The links found are contracted to components. Groups that
    still hold several components are joined with themselves, for pairs of different components that parity maps
    of their shingles don't rule out; a link inside a component would change nothing, so none is lost, and a group of near copies costs about
    its number of lines, not its square. Equal lines are one line from the start.
    """
    keys = stage(band_keys(lines, shingle, bands, rows), "bands")
    pairs = stage(leader_pairs(keys), "pairs")
    wanted = pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct()
    texts = lines.select("h", "line").join(wanted, "h", "left_semi").groupBy("h").agg(F.min("line").alias("line"))
    texts = stage(texts.select("h", code_units(F.col("line")).alias("units")), "texts")
    parts = connected_components(similar(pairs, texts, least, shingle))

    labelled = keys.join(wanted, "h", "left_semi").join(parts, F.col("h") == F.col("id"), "left")
    labelled = labelled.select("h", F.coalesce("component", "h").alias("component"), F.explode("keys").alias("key"))
    whole = Window.partitionBy("key")
    mixed = labelled.select("*", F.min("component").over(whole).alias("low"), F.max("component").over(whole).alias("high"))
    mixed = stage(mixed.where("low <> high").select("key", "h", "component"), "mixed")
    maps = shingle_maps(texts.join(mixed.select("h").distinct(), "h", "left_semi"), shingle)
    mixed = stage(mixed.join(maps, "h"), "maps")
    x, y = mixed.alias("x"), mixed.alias("y")
    more = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") < F.col("y.component")) & may_be_similar("x", "y", least))
    more = more.select(F.col("x.h").alias("a"), F.col("y.h").alias("b")).distinct()
    done = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = more.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).join(done, ["a", "b"], "left_anti")
    links = similar(more, texts, least, shingle).union(parts.select("id", "component"))
    return connected_components(links).select(F.col("id").alias("h"), "component")


def line_classes(
    docs: DataFrame,
    least: float = JACCARD,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, line_nr, keeper_id, keeper_line_nr, kept) of every line that is not blank, counted from 0.

    Lines are similar if the Jaccard similarity of their character shingles is at least ``least``;
    blanks at their ends don't count, a line shorter than a shingle is its own only shingle. Of every
    component of similar and equal lines the first one, by document id and line number, is the keeper; it is kept.
    Null, empty and blank texts have no lines. Repeated rows share ids and numbers, and so does
    each of their keepers. Rows without an id come first. Two lines count as equal if their
    64-bit hashes are; other columns are not read.

    ``bands`` bands of ``rows`` minima find a pair of similarity s with a probability of at least
    ``1 - (1 - s**rows)**bands``: 99.98 % at 0.8 with the defaults.
    """
    found = line_rows(docs, id_column, text_column)
    parts = line_components(found.select("h", "line"), least, shingle, bands, rows)
    placed = found.select("id", "nr", "h").join(parts, "h", "left").select("id", "nr", F.coalesce("component", "h").alias("part"))
    placed = stage(placed, "placed")
    keepers = placed.groupBy("part").agg(F.min(F.struct("id", "nr")).alias("keeper"))
    joined = placed.join(keepers, "part")
    kept = F.col("id").eqNullSafe(F.col("keeper.id")) & (F.col("nr") == F.col("keeper.nr"))
    return joined.select(
        F.col("id").alias(id_column), F.col("nr").alias("line_nr"), F.col("keeper.id").alias("keeper_id"), F.col("keeper.nr").alias("keeper_line_nr"), kept.alias("kept")
    )


def dedup_lines(
    docs: DataFrame,
    least: float = JACCARD,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with all lines but the keepers of :func:`line_classes` taken out of the text.

    Blank lines stay where they are. Documents and other columns stay as they are, also documents that
    lose all lines; a null text stays null. Rows repeated as a whole keep the same lines.
    """
    key = F.struct(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("hash"))
    rows_of = docs.select(key.alias("_key"), F.col(text_column).alias("_text"))
    classes = line_classes(rows_of, least, shingle, bands, rows, "_key", "_text")
    gone = classes.where("not kept").groupBy("_key").agg(F.collect_set("line_nr").alias("_gone"))
    # Joined by the hash, which spreads rows without an id.
    own_id, own_hash, lost = unused(docs, "lost_id", "lost_hash", "lost_lines")
    gone = gone.select(F.col("_key.hash").alias(own_hash), F.col("_key.id").alias(own_id), F.col("_gone").alias(lost))
    match = (F.xxhash64(text_column) == F.col(own_hash)) & F.col(id_column).eqNullSafe(F.col(own_id))
    def left(found: Column) -> Column:
        # Numbers are taken out by hash, so the cost is that of the lines, however many of them go.
        numbers = F.array_except(F.sequence(F.lit(0), F.size(found) - 1), F.col(lost))
        return F.array_join(F.transform(numbers, lambda nr: F.get(found, nr)), "\n")

    cut = F.transform(F.array(F.split(text_column, "\n")), left)[0]
    text = F.when(F.col(lost).isNull(), F.col(text_column)).otherwise(cut)
    return docs.join(gone, match, "left").withColumn(text_column, text).select(*docs.columns)
