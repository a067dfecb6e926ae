"""Small builders shared by the tests."""

from __future__ import annotations

from lexiloom.local import local_table

TOKENS = (
    "author string, document_id string, language string, chunk_id int, token_id int, "
    "token string, lemma string, pos string, ner string"
)


def token_rows(chunks, author="a", document="d", language="en"):
    """Token rows of one document given as a list of token lists, one per chunk."""
    return [
        (author, document, language, c, t, token, (token or "").lower(), "NOUN", "O")
        for c, tokens in enumerate(chunks)
        for t, token in enumerate(tokens)
    ]


def token_table(spark, rows):
    return local_table(spark, rows, TOKENS)


def one_column(spark, values, name="text"):
    return local_table(spark, list(enumerate(values)), f"n int, {name} string")


def by_row(df, *columns):
    rows = df.select("n", *columns).orderBy("n").collect()
    return [row[1] if len(columns) == 1 else tuple(row)[1:] for row in rows]
