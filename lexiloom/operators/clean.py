"""Document cleaning and per-document text statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions import text as txt
from lexiloom.schemas import require_columns


def strip_boilerplate(df: DataFrame) -> DataFrame:
    """Replace ``raw_text`` by the part between the licence markers; NULL becomes ''."""
    require_columns(df, {"raw_text"}, "strip_boilerplate")
    return df.withColumn("raw_text", txt.without_boilerplate(F.col("raw_text")))


def clean_corpus(df: DataFrame) -> DataFrame:
    """Add ``text_clean`` and the document statistics.

    Case is kept, because proper nouns are recognised by it later. All columns are narrow
    expressions: the result has no shuffle and unused ones are pruned.
    """
    require_columns(df, {"raw_text"}, "clean_corpus")
    clean = F.col("text_clean")
    return (
        df.withColumn("text_clean", txt.normalised(F.col("raw_text")))
        .withColumns(
            {
                "char_count": F.length(clean),
                "word_count": txt.word_count(clean),
                "sentences": txt.sentences(clean),
            }
        )
        .withColumn("sentence_count", F.size("sentences"))
        .withColumn(
            "avg_words_per_sentence",
            F.when(F.col("sentence_count") == 0, 0.0).otherwise(
                F.col("word_count") / F.col("sentence_count")
            ),
        )
    )


def corpus_statistics(clean_df: DataFrame, top: int | None = None) -> DataFrame:
    """Document statistics, longest first; ``top`` keeps the longest few for a report."""
    columns = [
        "author",
        "document_id",
        "language",
        "era",
        "char_count",
        "word_count",
        "sentence_count",
        "avg_words_per_sentence",
    ]
    require_columns(clean_df, columns, "corpus_statistics")
    ordered = clean_df.select(*columns).orderBy(F.desc("word_count"), "author", "document_id")
    return ordered if top is None else ordered.limit(top)
