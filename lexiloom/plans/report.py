"""Report tables over the results: roll-ups, pivots, curves and orderings.

Shown numbers are rounded half to even.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom import dimensions
from lexiloom.functions import tags
from lexiloom.operators.enrich import add_era
from lexiloom.operators.lexical import zipf

CURVE_RANKS = 500


def rounded(column: str | Column, digits: int) -> Column:
    """Half to even on the scaled value, as numeric libraries do for binary fractions."""
    value = F.col(column) if isinstance(column, str) else column
    return F.rint(value * float(10**digits)) / float(10**digits)


def readability_table(scores: DataFrame, eras: DataFrame | None = None) -> DataFrame:
    """Global scores with author labels, two decimals, by language and score."""
    return (
        add_era(scores, eras)
        .orderBy("language", "readability_score", "author", "document_id")
        .select(
            "author_label",
            "document_id",
            "language",
            "readability_index",
            *(
                rounded(name, 2).alias(name)
                for name in ("readability_score", "avg_sentence_length", "avg_syllables_per_word")
            ),
        )
    )


def sliding_series(
    sliding: DataFrame, documents: Sequence[str] | DataFrame | None = None
) -> DataFrame:
    """Sliding scores with a display label per window size, for all or for chosen documents.

    These are a list of ids, or a table of any size with ``document_id`` and perhaps ``author``.
    """
    chosen = sliding
    if isinstance(documents, DataFrame):
        key = [x for x in ("author", "document_id") if x in documents.columns]
        chosen = sliding.join(documents, key, "left_semi")
    elif documents is not None:
        chosen = sliding.where(F.col("document_id").isin(list(documents)))
    return chosen.withColumn(
        "window_size_label", F.concat(F.col("window_size").cast("string"), F.lit(" chunks"))
    )


def sliding_summary(sliding: DataFrame) -> DataFrame:
    """Mean, sample deviation, minimum and maximum score per language and window size."""
    score = F.col("readability_score")
    return sliding.groupBy("language", "readability_index", "window_size").agg(
        rounded(F.avg(score), 2).alias("mean_score"),
        rounded(F.stddev_samp(score), 2).alias("std_score"),
        rounded(F.min(score), 2).alias("min_score"),
        rounded(F.max(score), 2).alias("max_score"),
    )


def zipf_curves(
    tokens: DataFrame,
    representatives: DataFrame | None = None,
    eras: DataFrame | None = None,
    max_rank: int = CURVE_RANKS,
) -> DataFrame:
    """Top ranks of one document per author, joined to the author label.

    The semi-join runs on the token table, so only the chosen documents are counted.
    """
    if representatives is None:
        representatives = dimensions.representative_dim(tokens.sparkSession)
    chosen = tokens.join(
        representatives.select("author", "document_id"), ["author", "document_id"], "left_semi"
    )
    return add_era(zipf(chosen, max_rank=max_rank), eras)


def ttr_by_era(ttr: DataFrame, eras: DataFrame | None = None) -> DataFrame:
    """Type-token rows labelled and ordered by era; authors without era are left out."""
    return (
        add_era(ttr, eras)
        .where(F.col("era").isNotNull())
        .orderBy("era", "author", "document_id")
    )


def corpus_size(ttr: DataFrame, eras: DataFrame | None = None) -> DataFrame:
    """Documents by word tokens, longest first."""
    return (
        add_era(ttr, eras)
        .select("era", "author_label", "author", "document_id", "language", "total_tokens")
        .orderBy(F.desc("total_tokens"), "author", "document_id")
    )


def pos_by_author(pos: DataFrame, eras: DataFrame | None = None) -> DataFrame:
    """Tag shares per author: summed counts over summed totals of documents with the tag."""
    return (
        add_era(pos, eras)
        .where(F.col("author_label").isNotNull() & F.col("era").isNotNull())
        .where(F.col("pos_normalised").isin(tags.REPORTED_TAGS))
        .groupBy("author_label", "era", "pos_normalised")
        .agg(F.sum("token_count").alias("token_count"), F.sum("total_tokens").alias("total"))
        .withColumn("pos_ratio", F.col("token_count") / F.col("total"))
    )


def pos_heatmap(author_pos: DataFrame) -> DataFrame:
    """Authors by tags, in a fixed tag order, 0 where a tag is absent, three decimals."""
    return (
        author_pos.groupBy("author_label")
        .pivot("pos_normalised", tags.REPORTED_TAGS)
        .agg(F.avg("pos_ratio"))
        .select(
            "author_label",
            *(rounded(F.coalesce(tag, F.lit(0.0)), 3).alias(tag) for tag in tags.REPORTED_TAGS),
        )
    )


def dialog_table(summary: DataFrame, eras: DataFrame | None = None) -> DataFrame:
    """Dialog ratios with three decimals, highest first."""
    return (
        add_era(summary, eras)
        .orderBy(F.desc("dialog_ratio"), "author", "document_id")
        .select(
            "era",
            "author_label",
            "author",
            "document_id",
            "language",
            "dialog_tokens",
            "total_tokens",
            rounded("dialog_ratio", 3).alias("dialog_ratio"),
        )
    )
