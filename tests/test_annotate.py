from __future__ import annotations

import pytest

from lexiloom.functions.lexicon import builtin_rows, suffix_rows
from lexiloom.local import local_table
from lexiloom.operators.annotate import annotate, annotate_chunks, explode_annotations
from lexiloom.operators.chunk import chunk_corpus, chunk_plan

CHUNKS = "document_id string, author string, language string, chunk_id int, text_clean string"


def tagged(spark, text, language="en", lexicon=None):
    chunks = local_table(spark, [("d", "a", language, 0, text)], CHUNKS)
    rows = annotate_chunks(chunks, lexicon).orderBy("token_id").collect()
    return [(r["token"], r["lemma"], r["pos"], r["ner"]) for r in rows]


def test_english(spark):
    assert tagged(spark, "The cats were running. Mary quickly paid 3,5 $ - “yes”!") == [
        ("The", "the", "DT", "O"),
        ("cats", "cat", "NNS", "O"),
        ("were", "be", "VBD", "O"),
        ("running", "runn", "VBG", "O"),
        (".", ".", ".", "O"),
        ("Mary", "mary", "NN", "O"),  # may be capitalised as the first word
        ("quickly", "quickly", "RB", "O"),
        ("paid", "paid", "NN", "O"),
        ("3,5", "3,5", "CD", "O"),
        ("$", "$", "SYM", "O"),
        ("-", "-", "HYPH", "O"),
        ("“", "“", "``", "O"),
        ("yes", "yes", "UH", "O"),
        ("”", "”", "''", "O"),
        ("!", "!", ".", "O"),
    ]
    assert tagged(spark, "then Mary came")[1] == ("Mary", "mary", "NNP", "ENT")


def test_french(spark):
    assert tagged(spark, "Les chevaux dormaient : Paris, 12 € lentement", "fr") == [
        ("Les", "le", "DET", "O"),
        ("chevaux", "cheval", "NOUN", "O"),
        ("dormaient", "dormer", "VERB", "O"),
        (":", ":", "PUNCT", "O"),
        ("Paris", "paris", "PROPN", "ENT"),
        (",", ",", "PUNCT", "O"),
        ("12", "12", "NUM", "O"),
        ("€", "€", "SYM", "O"),
        ("lentement", "lentement", "ADV", "O"),
    ]


def test_caller_lexicon_never_multiplies_tokens(spark):
    lexicon = local_table(
        spark,
        [("en", "cats", "cat", "NNS"), ("en", "cats", "zat", "NN"), ("en", "bar", None, "JJ"),
         ("fr", "cats", "no", "X"), ("en", None, "n", "X")],
        "language string, form string, lemma string, pos string",
    )
    assert tagged(spark, "Cats bar tables", lexicon=lexicon) == [
        ("Cats", "cat", "NNS", "O"),
        ("bar", "bar", "JJ", "O"),
        ("tables", "table", "NNS", "O"),
    ]
    with pytest.raises(ValueError, match="lexicon missing"):
        tagged(spark, "a", lexicon=lexicon.drop("pos"))


def test_builtin_tables_are_keys(spark):
    forms = [(row[0], row[1]) for row in builtin_rows()]
    suffixes = [(row[0], row[1]) for row in suffix_rows()]
    assert len(forms) == len(set(forms))
    assert len(suffixes) == len(set(suffixes))


def test_other_languages_and_blank_texts_drop_out(spark):
    documents = local_table(
        spark,
        [("d1", "a", "de", "Der Hund"), ("d2", "a", "en", "  "), ("d3", "a", None, "x"),
         ("d4", "a", "fr", None), ("d5", "a", "fr", "un chat")],
        "document_id string, author string, language string, text_clean string",
    )
    assert {r["document_id"] for r in annotate(documents).collect()} == {"d5"}


def test_positions_and_plan(spark):
    documents = local_table(
        spark, [("d", "a", "en", "one two three four")],
        "document_id string, author string, language string, text_clean string",
    )
    got = annotate(documents, max_chars=10).orderBy("chunk_id", "token_id").collect()
    assert [(r["chunk_id"], r["token_id"], r["token"]) for r in got] == [
        (0, 0, "one"), (0, 1, "two"), (1, 0, "three"), (1, 1, "four"),
    ]
    assert dict(annotate(documents).dtypes)["token_id"] == "int"
    plan = chunk_plan(chunk_corpus(documents, 10)).collect()
    assert [tuple(r) for r in plan] == [("en", "a", "d", 2)]


def test_explode_annotations(spark):
    df = local_table(
        spark,
        [("d", "a", "en", 0, ["Mary", "ran", "far"], ["mary", "run"], ["NNP", "VBD", "RB"]),
         ("d", "a", "en", 1, [], [], [])],
        "document_id string, author string, language string, chunk_id int, "
        "token_out array<string>, lemma_out array<string>, pos_out array<string>",
    )
    got = explode_annotations(df).collect()
    assert [tuple(r)[3:] for r in got] == [
        (0, 0, "Mary", "mary", "NNP", "ENT"),
        (0, 1, "ran", "run", "VBD", "O"),
        (0, 2, "far", None, "RB", "O"),
    ]
