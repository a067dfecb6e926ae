"""Table schemas and the column contract every operator checks on entry."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

DOCUMENT_KEY = ["author", "document_id"]

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType(), False)
        for name in (
            "raw_text",
            "source_path",
            "author",
            "filename",
            "document_id",
            "language",
            "era",
        )
    ]
)

TOKEN_SCHEMA = T.StructType(
    [
        T.StructField("document_id", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("chunk_id", T.IntegerType()),
        T.StructField("token_id", T.IntegerType()),
        T.StructField("token", T.StringType()),
        T.StructField("lemma", T.StringType()),
        T.StructField("pos", T.StringType()),
        T.StructField("ner", T.StringType()),
        T.StructField("author", T.StringType()),
    ]
)

TOKEN_COLUMNS = TOKEN_SCHEMA.fieldNames()


def require_columns(df: DataFrame, columns: Iterable[str], context: str) -> DataFrame:
    """Fail before any job starts when ``df`` lacks a column ``context`` needs."""
    missing = sorted(set(columns).difference(df.columns))
    if missing:
        raise ValueError(f"{context} missing required columns: {missing}")
    return df
