"""Splitting documents into bounded chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions import text as txt
from lexiloom.schemas import require_columns


def chunk_corpus(df: DataFrame, max_chars: int = txt.DEFAULT_CHUNK_CHARS) -> DataFrame:
    """One row per chunk: ``document_id, author, language, chunk_id, text_clean``.

    Narrow: chunk rows stay in the task that read the document, and bound the row size of
    everything downstream. Blank documents give no rows.
    """
    require_columns(
        df, {"document_id", "author", "language", "text_clean"}, "chunk_corpus"
    )
    return df.select(
        "document_id",
        "author",
        "language",
        F.posexplode(txt.chunks(F.col("text_clean"), max_chars)).alias(
            "chunk_id", "text_clean"
        ),
    )


def chunk_plan(chunks: DataFrame) -> DataFrame:
    """Number of chunks per document, the work list of annotation."""
    require_columns(chunks, {"language", "author", "document_id"}, "chunk_plan")
    return (
        chunks.groupBy("language", "author", "document_id")
        .agg(F.count("*").alias("chunk_count"))
        .orderBy("author", "document_id")
    )
