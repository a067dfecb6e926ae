"""Vocabulary and part-of-speech tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions import scores, tags
from lexiloom.schemas import require_columns

_DOCUMENT = ["author", "document_id", "language"]


def _words(tokens: DataFrame, normalise_pos: bool) -> DataFrame:
    pos = F.col("pos")
    return tokens.where(tags.is_lexical(tags.universal_tag(pos) if normalise_pos else pos))


def zipf(
    tokens: DataFrame, max_rank: int | None = None, normalise_pos: bool = False
) -> DataFrame:
    """Rank-frequency table of the lower-cased tokens of each document.

    ``rank`` is 1 plus the number of more frequent terms, so it depends on the frequency
    alone. It is therefore computed on the histogram of frequencies, which has at most
    sqrt(2 * tokens) rows per document, instead of sorting a document's whole vocabulary
    in one window task. The histogram is joined back by frequency; Spark broadcasts it
    when it measures small and otherwise splits hot frequencies as skewed partitions.

    Tokens are spread by document and term before they are counted: most terms of a document are
    rare, so counts before the shuffle would be a task's largest table and save little of it.

    ``max_rank`` keeps the terms of the top ranks, ties included. Penn punctuation tags
    count as words unless ``normalise_pos`` maps tags first.
    """
    require_columns(
        tokens, {"author", "document_id", "language", "token", "pos"}, "zipf"
    )
    terms = (
        _words(tokens, normalise_pos)
        .select(*_DOCUMENT, F.lower("token").alias("token"))
        .repartition(*_DOCUMENT, "token")
        .groupBy(*_DOCUMENT, "token")
        .agg(F.count("*").alias("frequency"))
    )
    more_frequent = (
        Window.partitionBy("author", "document_id")
        .orderBy(F.desc("frequency"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = (
        terms.groupBy("author", "document_id", "frequency")
        .agg(F.count("*").alias("_terms"))
        .select(
            F.col("author").alias("_author"),
            F.col("document_id").alias("_document_id"),
            F.col("frequency").alias("_frequency"),
            (F.coalesce(F.sum("_terms").over(more_frequent), F.lit(0)) + 1)
            .cast("int")
            .alias("rank"),
        )
    )
    if max_rank is not None:
        ranks = ranks.where(F.col("rank") <= max_rank)
    same_key = (
        F.col("author").eqNullSafe(F.col("_author"))
        & F.col("document_id").eqNullSafe(F.col("_document_id"))
        & (F.col("frequency") == F.col("_frequency"))
    )
    return terms.join(ranks, same_key).select(
        *_DOCUMENT,
        "token",
        "frequency",
        "rank",
        F.ln(F.col("rank").cast("double")).alias("log_rank"),
        F.ln(F.col("frequency").cast("double")).alias("log_frequency"),
    )


def type_token_ratio(tokens: DataFrame, normalise_pos: bool = False) -> DataFrame:
    """Distinct lower-cased lemmas over word tokens, per document.

    Tokens are spread by document and lemma, and Spark reduces them to distinct pairs there, so
    neither a hot document nor a hot lemma ends up in one task. Pairs before the shuffle would be a
    task's largest table and save little of it.
    """
    require_columns(
        tokens, {"author", "document_id", "language", "lemma", "pos"}, "type_token_ratio"
    )
    return (
        _words(tokens, normalise_pos)
        .select(*_DOCUMENT, F.lower("lemma").alias("_lemma"))
        .repartition(*_DOCUMENT, "_lemma")
        .groupBy(*_DOCUMENT)
        .agg(
            F.count("*").alias("total_tokens"),
            F.countDistinct("_lemma").alias("unique_lemmas"),
        )
        .withColumn("ttr", scores.ratio(F.col("unique_lemmas"), F.col("total_tokens")))
    )


def lemma_sketches(tokens: DataFrame, normalise_pos: bool = False, precision: int = 14) -> DataFrame:
    """Word tokens and a sketch of the distinct lower-cased lemmas, per document.

    Sketches merge: :func:`merged_type_token_ratio` counts lemmas of any group of documents from them, without the
    tokens. A sketch of ``precision`` p has at most about ``2**p`` bytes and a standard error of ``0.83 / 2**(p / 2)``,
    0.65 % for 14; null lemmas are not counted.
    """
    require_columns(
        tokens, {"author", "document_id", "language", "lemma", "pos"}, "lemma_sketches"
    )
    # Sketches ignore empty texts, which are lemmas here.
    lemma = F.concat(F.lit(":"), F.lower("lemma"))
    return (
        _words(tokens, normalise_pos)
        .groupBy(*_DOCUMENT)
        .agg(
            F.count("*").alias("total_tokens"),
            F.hll_sketch_agg(lemma, F.lit(precision)).alias("lemmas"),
        )
    )


def merged_type_token_ratio(sketches: DataFrame, *keys: str) -> DataFrame:
    """Estimated type-token ratio of the documents of :func:`lemma_sketches` together, per ``keys``.

    A merge is combined before the shuffle, so a hot group is not one task.
    """
    require_columns(sketches, {*keys, "total_tokens", "lemmas"}, "merged_type_token_ratio")
    merged = sketches.groupBy(*keys).agg(
        F.sum("total_tokens").alias("total_tokens"), F.hll_union_agg("lemmas").alias("_lemmas")
    )
    counted = merged.withColumn("unique_lemmas", F.hll_sketch_estimate("_lemmas")).drop("_lemmas")
    return counted.withColumn("ttr", scores.ratio(F.col("unique_lemmas"), F.col("total_tokens")))


def pos_distribution(tokens: DataFrame) -> DataFrame:
    """Share of each reported tag among all tokens of the document.

    One conditional count per tag and the total come out of a single aggregation; tags
    that do not occur in a document give no row.
    """
    require_columns(
        tokens, {"author", "document_id", "language", "pos"}, "pos_distribution"
    )
    pos = F.col("pos_normalised")
    counts = (
        tokens.withColumn("pos_normalised", tags.universal_tag(F.col("pos")))
        .groupBy(*_DOCUMENT)
        .agg(
            F.count("*").alias("total_tokens"),
            *(F.count_if(pos == tag).alias(tag) for tag in tags.REPORTED_TAGS),
        )
    )
    by_tag = F.array(
        *(
            F.struct(F.lit(tag).alias("pos_normalised"), F.col(tag).alias("token_count"))
            for tag in tags.REPORTED_TAGS
        )
    )
    return (
        counts.select(*_DOCUMENT, "total_tokens", F.inline(by_tag))
        .where(F.col("token_count") > 0)
        .select(
            *_DOCUMENT,
            "pos_normalised",
            "token_count",
            "total_tokens",
            scores.ratio(F.col("token_count"), F.col("total_tokens")).alias("pos_ratio"),
        )
    )
