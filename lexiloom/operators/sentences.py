"""Sentences as data: abbreviations learned from the corpus, then a running sentence number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions import tags
from lexiloom.functions import text as txt
from lexiloom.schemas import require_columns

CHUNK_KEY = ["author", "document_id", "chunk_id"]

#: A form is an abbreviation from this score on, if it occurs at least so often.
LEAST_SCORE = 0.3
LEAST_COUNT = 5
#: How often a full stop follows an abbreviation, in the model against which chance is held.
ABBREVIATION_STOPS = 0.99
#: Where a capital follows an abbreviation's stop at least this often, it says nothing about a new sentence.
USUAL_CAPITAL = 0.5


def placed_tokens(chunks: DataFrame) -> DataFrame:
    """Token rows of a chunk table with the tokens around them: ``previous``, ``following``, ``second``.

    They come from the chunk's own array, so no token leaves the task of its chunk. They are looked up behind the
    generator, in generated code, and only those that are asked for.
    """
    columns = [x for x in chunks.columns if x != "text_clean"]
    found = chunks.select(*columns, txt.tokens(F.col("text_clean")).alias("_tokens"))
    # Not the column itself: Spark would filter by its size, and for that tokenise before a shuffle and again after it.
    each = F.coalesce("_tokens", F.array().cast("array<string>"))
    rows = found.select(*columns, "_tokens", F.posexplode(each).alias("token_id", "token"))
    around = {"previous": -1, "following": 1, "second": 2}
    return rows.select(
        *columns, "token_id", "token", *[F.get("_tokens", F.col("token_id") + n).alias(name) for name, n in around.items()]
    )


def _is_capital(token: str) -> Column:
    return F.col(token).rlike(r"^\p{Lu}")


def stop_counts(chunks: DataFrame) -> DataFrame:
    """(language, form, n, n_stop, n_capital) per lower-cased word: its occurrences, those before a full stop,
    and those of these before a capital. Words are tokens that begin with a letter; counts are combined
    before their shuffle."""
    require_columns(chunks, {"language", "text_clean"}, "stop_counts")
    rows = placed_tokens(chunks.select("language", "text_clean")).where(F.col("token").rlike(r"^[\p{L}\p{M}]"))
    stop = F.col("following") == "."
    return rows.groupBy("language", F.lower("token").alias("form")).agg(
        F.count("*").alias("n"),
        F.count_if(stop).alias("n_stop"),
        F.count_if(stop & _is_capital("second")).alias("n_capital"),
    )


def abbreviation_scores(counts: DataFrame) -> DataFrame:
    """``counts`` of forms seen before a full stop, with ``score``.

    The score is the log-likelihood ratio of the form and the full stop, where chance is the language's
    share of words before a stop, times ``exp(-length)``, since abbreviations are short, and divided by the length to
    the power of the occurrences without a stop. (Kiss and Strunk, 2006, without their later re-classification.)
    """
    require_columns(counts, {"language", "form", "n", "n_stop", "n_capital"}, "abbreviation_scores")
    totals = counts.groupBy("language").agg((F.sum("n_stop") / F.sum("n")).alias("_share"))
    n, k, length = F.col("n"), F.col("n_stop"), F.length("form")
    share = F.col("_share")
    chance = k * F.log(share) + (n - k) * F.log(F.greatest(1 - share, F.lit(1e-9)))
    bound = k * F.log(F.lit(ABBREVIATION_STOPS)) + (n - k) * F.log(F.lit(1 - ABBREVIATION_STOPS))
    ratio = -2 * (chance - bound)
    # One exponential, so long and frequent forms end at zero instead of overflowing.
    score = ratio * F.exp(-length - (n - k) * F.log(length.cast("double")))
    return counts.where("n_stop > 0").join(totals, "language").withColumn("score", score).drop("_share")


def abbreviations(counts: DataFrame, least_score: float = LEAST_SCORE, least_count: int = LEAST_COUNT) -> DataFrame:
    """(language, form, capital) of the abbreviations in :func:`stop_counts`; ``capital`` says whether a capital
    usually follows, as after a title."""
    found = abbreviation_scores(counts).where((F.col("score") >= least_score) & (F.col("n") >= least_count))
    return found.select("language", "form", (F.col("n_capital") >= USUAL_CAPITAL * F.col("n_stop")).alias("capital"))


def _ends(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Placed token rows with ``_end``: 1 if the token ends a sentence, else 0."""
    require_columns(known, {"language", "form", "capital"}, "abbreviations")
    named = known.select(F.col("language").alias("_language"), F.col("form").alias("_form"), F.col("capital").alias("_capital"))
    met = (F.col("language") == F.col("_language")) & (F.lower("previous") == F.col("_form")) & (F.col("token") == ".")
    goes_on = F.col("_form").isNotNull() & (~F.coalesce(_is_capital("following"), F.lit(False)) | F.col("_capital"))
    end = (F.col("token").isin(tags.SENTENCE_END) & ~goes_on).cast("int")
    return rows.join(named, met, "left").withColumn("_end", end)


def sentence_offsets(chunks: DataFrame, known: DataFrame) -> DataFrame:
    """(author, document_id, chunk_id, offset): the sentence ends in the earlier chunks of the document.

    Only end marks are looked up, and one row per chunk is all that a document sends to one task.
    """
    require_columns(chunks, {*CHUNK_KEY, "language", "text_clean"}, "sentence_offsets")
    marks = placed_tokens(chunks.select(*CHUNK_KEY, "language", "text_clean")).where(F.col("token").isin(tags.SENTENCE_END))
    ended = _ends(marks, known).select(*CHUNK_KEY, "_end")
    # Chunks without a mark have an offset, too.
    rows = ended.union(chunks.select(*CHUNK_KEY, F.lit(0).alias("_end")))
    counted = rows.groupBy(*CHUNK_KEY).agg(F.sum("_end").alias("_ends"))
    earlier = Window.partitionBy("author", "document_id").orderBy("chunk_id").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(*CHUNK_KEY, F.coalesce(F.sum("_ends").over(earlier), F.lit(0)).alias("offset"))


def with_sentences(chunks: DataFrame, known: DataFrame, offsets: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """Token rows of a chunk table with ``previous`` and ``sentence_id``, the sentence's number in its document from 0.

    ``known`` are abbreviations (language, form, capital). A sentence ends with one of the end marks; a full stop
    after an abbreviation ends none, unless a capital follows that usually doesn't. The end of a chunk ends no
    sentence. Numbers run on over the chunks of a document: a first pass counts the ends of every chunk, unless the caller has
    stored its ``offsets`` (:func:`sentence_offsets`). Chunks get their first number and are spread by their key before they
    become tokens, and everything by chunk keeps that partitioning: tokens are never shuffled. Texts take a fraction of the room of
    their token rows, so Spark's own number of tasks, by bytes of text, may be too small for a large table; ``partitions`` sets it. ``known`` carries no hint: a table that measures small is
    broadcast, a large one is joined by a shuffle.
    """
    require_columns(chunks, {*CHUNK_KEY, "language", "text_clean"}, "with_sentences")
    if offsets is None:
        offsets = sentence_offsets(chunks, known)
    own = chunks.select(*CHUNK_KEY, "language", "text_clean")
    key = [F.col(f"c.{x}").eqNullSafe(F.col(f"o.{x}")) for x in CHUNK_KEY]
    numbered = own.alias("c").join(offsets.alias("o"), key).select("c.*", F.col("o.offset").alias("_offset"))
    dealt = numbered.repartition(partitions, *CHUNK_KEY) if partitions else numbered.repartition(*CHUNK_KEY)
    before = Window.partitionBy(*CHUNK_KEY).orderBy("token_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = _ends(placed_tokens(dealt), known).withColumn("_ordinal", F.coalesce(F.sum("_end").over(before), F.lit(0)))
    sentence = (F.col("_ordinal") + F.col("_offset")).alias("sentence_id")
    return rows.select(*CHUNK_KEY, "language", "token_id", "token", "previous", sentence)
