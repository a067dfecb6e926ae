"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.llm.common import arrow_rows, stage

UNKNOWN = "und"
#: Ranks compared, of a document and of a language.
RANKS = 300
#: Profiles are held by every task, so their number has a limit; more labels than this are an error.
MAX_LANGUAGES = 1000
#: Characters counted at once, and (language, n-gram) sums a task holds before it hands them on.
CHUNK = 1 << 20
HELD_GRAMS = 1 << 21
SPACE = 32
SHIFT = np.uint64(21)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum counts of equal n-grams; the n-grams come out ascending."""
    if len(parts) == 1:
        return parts[0]
    grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    counts = np.zeros(len(grams), np.int64)
    np.add.at(counts, at, np.concatenate([c for _, c in parts]))
    return grams, counts


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Ascending 1-, 2- and 3-grams of the lower-cased words of a text, with their counts.

    Words are runs of letters between blanks; an n-gram spans no blank but at its ends. A code holds
    the code points, 21 bits each.
    """
    if not text:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[codes], codes, SPACE)
    blank = codes == SPACE
    codes = codes[~(blank & np.concatenate(([True], blank[:-1])))].astype(np.uint64)
    if not len(codes):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    codes = np.concatenate(([SPACE], codes, [SPACE] if codes[-1] != SPACE else [])).astype(np.uint64)
    parts = []
    for at in range(0, len(codes), CHUNK):
        one = codes[at : at + CHUNK + 2]
        first, two = one[:CHUNK], (one[:-1] << SHIFT | one[1:])[:CHUNK]
        three = (one[:-2] << (SHIFT + SHIFT) | one[1:-1] << SHIFT | one[2:])[one[1:-1] != SPACE]
        grams = np.sort(np.concatenate((first[first != SPACE], two, three)))
        ends = np.flatnonzero(np.concatenate((grams[1:] != grams[:-1], [True])))
        parts.append((grams[ends], np.diff(ends, prepend=-1)))
    return _merge(parts)


def top_ranks(grams: np.ndarray, counts: np.ndarray, ranks: int) -> np.ndarray:
    """The most frequent n-grams in order; ties go to the smaller code."""
    return grams[np.argsort(-counts, kind="stable")[:ranks]]


def learn_profiles(docs: DataFrame, ranks: int = RANKS, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """(lang, gram, rank) of the most frequent n-grams of each label, over all given texts.

    Tasks hand on one row per (label, n-gram), so a label with most of the rows weighs no more in the
    shuffle than a rare one. Null labels and texts are left out.
    """
    arrow = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                grams, counts = _merge(parts)
                yield arrow_rows(arrow, [[lang] * len(grams), grams.view(np.int64), counts])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                parts = held.setdefault(lang, [])
                parts.append(ngrams(text.as_py()))
                if len(parts) >= 200:
                    parts[:] = [_merge(parts)]
                size += len(parts[-1][0])
                if size > 8 * HELD_GRAMS:
                    for own in held.values():
                        own[:] = [_merge(own)]
                    size = sum(len(own[0][0]) for own in held.values())
                    if size > HELD_GRAMS:
                        yield from flush()
                        size = 0
        yield from flush()

    rows = docs.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text")).dropna()
    counts = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # The limit is on the bare row number, so each task keeps only its own first ones before they meet.
    first = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= ranks)
    return first.select("lang", "gram", (F.col("place") - 1).alias("rank"))


class Profiles:
    """Ranks of all languages as one matrix over the union of their n-grams."""

    def __init__(self, rows: list, ranks: int):
        self.ranks = ranks
        self.langs = sorted({r.lang for r in rows})
        self.grams = np.unique(np.array([r.gram for r in rows], np.int64).view(np.uint64))
        # One column more for n-grams of no profile; a missing n-gram is out of place by all ranks.
        self.place = np.full((len(self.langs), len(self.grams) + 1), -1, np.int32)
        at = {lang: i for i, lang in enumerate(self.langs)}
        for r in rows:
            self.place[at[r.lang], np.searchsorted(self.grams, np.uint64(r.gram))] = r.rank

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language with the smallest out-of-place distance, ties to the first name, and a score.

        The score is one minus the distance over the largest possible one.
        """
        grams, counts = ngrams(text)
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        own = top_ranks(grams, counts, self.ranks)
        at = np.searchsorted(self.grams, own)
        at[at < len(self.grams)] += (self.grams[at[at < len(self.grams)]] != own[at < len(self.grams)]) * len(self.grams)
        place = self.place[:, np.minimum(at, len(self.grams))]
        away = np.where(place < 0, self.ranks, np.abs(place - np.arange(len(own), dtype=np.int32))).sum(axis=1)
        best = int(np.argmin(away))
        return self.langs[best], 1.0 - float(away[best]) / (self.ranks * len(own))


def identify(
    docs: DataFrame,
    learn_from: Column | None = None,
    ranks: int = RANKS,
    text_column: str = "text",
    lang_column: str = "lang",
    pred_column: str = "lang_pred",
    score_column: str = "score",
) -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1) added, or replaced if they have such columns.

    Profiles are learned from the texts and non-null labels of the rows where ``learn_from`` holds (all
    by default); a prediction reads nothing but the text. A text that is null or has no letter, and any
    text when nothing could be learned, is ``und`` with score 0. All other columns are kept as they are.
    """
    learned = docs if learn_from is None else docs.where(learn_from)
    profiles = stage(learn_profiles(learned, ranks, text_column, lang_column), "profiles")
    if profiles.select("lang").distinct().count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    model = Profiles(profiles.collect(), ranks)
    kept = docs.drop(pred_column, score_column)
    schema = T.StructType([*kept.schema, T.StructField(pred_column, T.StringType()), T.StructField(score_column, T.DoubleType())])
    at = kept.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(x.as_py()) for x in batch.column(at)]
            langs, scores = pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, langs, scores], names=[*batch.schema.names, pred_column, score_column])

    return kept.mapInArrow(run, schema)


def identify_held_out(docs: DataFrame, folds: int = 4, held: int = 2, ranks: int = RANKS, id_column: str = "doc_id") -> DataFrame:
    """(id, held_out, lang_pred, score): the fold ``held`` of crc32(id as text) is not learned from.

    A row without an id is in no held-out fold.
    """
    fold = F.coalesce(F.crc32(F.col(id_column).cast("string")) % folds, F.lit(-1))
    rows = docs.select(id_column, "text", "lang")
    out = identify(rows, fold != held, ranks).withColumn("held_out", fold == held)
    return out.select(id_column, "held_out", "lang_pred", "score")
