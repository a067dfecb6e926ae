from __future__ import annotations

import random
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiloom.functions import text as txt
from lexiloom.local import local_table
from lexiloom.operators.clean import clean_corpus, strip_boilerplate
from lexiloom.schemas import require_columns
from tests.helpers import by_row, one_column

BLANKS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0       　"

few = settings(max_examples=8, deadline=None)
words = st.text(alphabet="abé'.😀 \n\t\xa0\x1c ", max_size=60)


def greedy(text, limit):
    """Word packing by a plain loop: every word of the first chunk is charged a space."""
    packed, line, used = [], [], 0
    for word in (text or "").split():
        if line and used + len(word) + 1 > limit:
            packed.append(" ".join(line))
            line, used = [word], len(word)
        else:
            line.append(word)
            used += len(word) + 1
    return packed + ([" ".join(line)] if line else [])


def chunked(spark, texts, limit):
    return by_row(one_column(spark, texts).withColumn("c", txt.chunks(F.col("text"), limit)), "c")


def test_chunk_examples(spark):
    texts = ["aaa bbb ccc", "abcdefghijkl x", "", None, "  a \x1c b c ", "abcdefghij k lm"]
    assert chunked(spark, texts, 10) == [
        ["aaa bbb", "ccc"],
        ["abcdefghijkl", "x"],
        [],
        [],
        ["a b c"],
        ["abcdefghij", "k lm"],
    ]


@pytest.mark.parametrize("limit", [1, 2, 3, 7, 10, 4000])
def test_chunks_follow_greedy_packing(spark, limit):
    @few
    @given(st.lists(words, min_size=1, max_size=60))
    def check(texts):
        assert chunked(spark, texts, limit) == [greedy(t, limit) for t in texts]

    check()


def test_chunks_of_long_mixed_width_text(spark):
    texts = ["😀 a " * 20_000, "😀a" * 20_000, "x" * 9_000 + " y"]
    assert chunked(spark, texts, 4000) == [greedy(t, 4000) for t in texts]


def test_every_blank_separates_words(spark):
    text = "".join(f"w{blank}" for blank in BLANKS)
    assert chunked(spark, [text], 4000) == [[" ".join("w" * len(BLANKS))]]


def cut_markers(text):
    """Boilerplate removal by string search on a lower-cased copy."""
    if text is None:
        return ""
    text = text.replace("\r\n", "\n").replace("\r", "\n")

    def find(kind, within):
        return re.search(
            r"\*\*\*\s*%s of (?:the|this) project gutenberg ebook[\s\S]*?\*\*\*" % kind,
            within.lower(),
        )

    head = find("start", text)
    text = text[head.end():] if head else text
    tail = find("end", text)
    return (text[: tail.start()] if tail else text).strip()


START = "*** START OF THE PROJECT GUTENBERG EBOOK X ***"
END = "*** END OF THIS PROJECT GUTENBERG EBOOK X ***"


def test_boilerplate_cases(spark):
    texts = [
        f"pre {START}\r\nbody\r\n{END} post",
        f"{START} only start ",
        f"only end {END} x",
        f"{END} a {START} b {END} c",
        f"a {START} b {START} c {END} d {END}",
        START.lower() + " mixed " + END.title(),
        "***START OF THE PROJECT GUTENBERG EBOOK\nmulti\nline ***in",
        "*** START OF A PROJECT GUTENBERG EBOOK X *** kept",
        "no *** marker\r here",
        "*** START OF THE PROJECT GUTENBERG EBOOK never closed",
        "\x1c　 outer blanks \xa0\x85",
        "   ",
        "",
        None,
    ]
    df = one_column(spark, texts, "raw_text")
    assert by_row(strip_boilerplate(df), "raw_text") == [cut_markers(t) for t in texts]


def test_long_blank_runs_stay_linear(spark):
    text = "a" + " " * 400_000 + "b" + "\n" * 400_000
    df = one_column(spark, [text], "raw_text")
    assert by_row(strip_boilerplate(df), "raw_text") == [text.strip()]


def statistics(raw):
    text = re.sub(r"\r\n|\r", "\n", raw or "")
    text = re.sub(r"\n{2,}", "\n\n", text)
    text = re.sub(r"[ \t]+", " ", text).strip(" ")
    if not text:
        return text, 0, 0, [], 0, 0.0
    count = len(re.split(r"[ \t\n\x0b\f\r]+", text))
    parts = re.split(r"(?<=[.!?])[ \t\n\x0b\f\r]+", text)
    return text, len(text), count, parts, len(parts), count / len(parts)


def test_clean_statistics(spark):
    @few
    @given(st.lists(st.text(alphabet="ab.!?é \t\n\r\xa0", max_size=40), min_size=1, max_size=60))
    def check(texts):
        df = clean_corpus(one_column(spark, [*texts, None], "raw_text"))
        got = by_row(
            df,
            "text_clean",
            "char_count",
            "word_count",
            "sentences",
            "sentence_count",
            "avg_words_per_sentence",
        )
        assert got == [statistics(t) for t in [*texts, None]]

    check()


VOWELS = {"fr": "aeiouyàâäéèêëîïôùûüœæ", "en": "aeiouy"}


def vowel_runs(token, language):
    if not token or re.match(r"^[\W\d]+$", token):
        return 0
    found = re.findall(f"[{VOWELS['fr' if language == 'fr' else 'en']}]+", token, re.IGNORECASE)
    return max(1, len(found))


def test_syllables(spark):
    tokens = [
        "beautiful", "Élève", "élève", "...", "rhythm", "tsk", "", None, "123", "a1", "_", "²",
        "ÀÉ", "cœur", "ŒUVRE", "naïve", "l'homme", "İstanbul", "ı", "—", "Ñandú", "½", "3.14",
    ]
    rows = [(i, t, lang) for i, t in enumerate(tokens) for lang in ("en", "fr", "de", None)]
    df = local_table(spark, rows, "n int, token string, language string")
    got = df.withColumn("s", txt.syllables(F.col("token"), F.col("language"))).collect()
    assert [r["s"] for r in got] == [vowel_runs(r["token"], r["language"]) for r in got]


def test_tokens(spark):
    text = "L'homme, aujourd'hui: well-known 3,14 -- « Oui… » (a)...b_c"
    assert by_row(one_column(spark, [text]).withColumn("t", txt.tokens(F.col("text"))), "t") == [
        ["L'homme", ",", "aujourd'hui", ":", "well-known", "3,14", "--", "«", "Oui", "…", "»",
         "(", "a", ")", "...", "b", "_", "c"]
    ]


def test_required_columns(spark):
    df = one_column(spark, ["x"])
    with pytest.raises(ValueError, match=r"here missing required columns: \['author', 'pos'\]"):
        require_columns(df, {"text", "pos", "author"}, "here")
    with pytest.raises(ValueError, match="clean_corpus"):
        clean_corpus(df)


def lexed(text):
    """Tokens by one walk over the characters."""

    def letter(c):
        return unicodedata.category(c)[0] in "LM"

    def run(i, test):
        while i < len(text) and test(text[i]):
            i += 1
        return i

    def digit(c):
        return unicodedata.category(c) == "Nd"

    out, i = [], 0
    while i < len(text):
        start, test, marks = i, letter if letter(text[i]) else digit, "'’-" if letter(text[i]) else ".,"
        if letter(text[i]) or digit(text[i]):
            i = run(i, test)
            while i + 1 < len(text) and text[i] in marks and test(text[i + 1]):
                i = run(i + 1, test)
        elif text.startswith("...", i):
            i += 3
        elif text.startswith("--", i):
            i += 2
        else:
            i += 1
            if text[start].isspace():
                continue
        out.append(text[start:i])
    return out


def test_tokens_of_long_texts_without_blanks(spark):
    parts = ["1,", "1.", "a-", "a’", "é'1", "...", "--", "a1-", "-,", "1,a", "....-", "x"]
    texts = [p * (1_000_000 // len(p)) for p in parts] + ["".join(random.Random(1).choices(parts, k=3000))]
    found = by_row(one_column(spark, texts), txt.tokens(F.col("text")))
    assert found == [lexed(t) for t in texts]
