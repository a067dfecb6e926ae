from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from lexiloom.functions import tags
from lexiloom.operators.lexical import lemma_sketches, merged_type_token_ratio, pos_distribution, type_token_ratio, zipf
from lexiloom.plans import report
from tests.helpers import token_table

TAGS = ["NN", "NNP", "VBD", "JJ", ".", ",", "``", "PUNCT", "SYM", "X", "DET", "ADP", "HYPH", None]


def rows_of(words, author="a", document="d", language="en"):
    return [
        (author, document, language, 0, i, token, lemma, pos, "O")
        for i, (token, lemma, pos) in enumerate(words)
    ]


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for document in range(12):
        words = [
            (rng.choice("aAbBcdefgh"), rng.choice(["l", "L", "m", "n", None]), rng.choice(TAGS))
            for _ in range(rng.randint(0, 80))
        ]
        rows += rows_of(words, f"a{document % 3}", f"d{document}", rng.choice(["en", "fr"]))
    return rows


def test_zipf_example(spark):
    words = [(w, w, "NN") for w in "A a b B c"]
    words = [w for w in words if w[0] != " "]
    got = {r["token"]: r for r in zipf(token_table(spark, rows_of(words))).collect()}
    assert {t: (r["frequency"], r["rank"]) for t, r in got.items()} == {
        "a": (2, 1), "b": (2, 1), "c": (1, 3),
    }
    assert got["c"]["log_rank"] == pytest.approx(math.log(3))
    assert got["a"]["log_frequency"] == pytest.approx(math.log(2))


@pytest.mark.parametrize("max_rank", [None, 1, 3])
def test_zipf_ranks(spark, max_rank):
    rows = random_rows(1)
    counts = Counter(
        (r[0], r[1], r[2], r[5].lower()) for r in rows if r[7] not in ("PUNCT", "SYM", "X", None)
    )
    want = set()
    for (author, document, language, token), n in counts.items():
        rank = 1 + sum(m > n for (a, d, _, _), m in counts.items() if (a, d) == (author, document))
        if max_rank is None or rank <= max_rank:
            want.add((author, document, language, token, n, rank))
    got = zipf(token_table(spark, rows), max_rank=max_rank).collect()
    assert {tuple(r)[:6] for r in got} == want
    assert len(got) == len(want)


def test_zipf_keeps_null_keys(spark):
    rows = [(None, "d", "en", 0, i, t, t, "NN", "O") for i, t in enumerate("aab")]
    assert {(r["token"], r["rank"]) for r in zipf(token_table(spark, rows)).collect()} == {
        ("a", 1), ("b", 2),
    }


def test_penn_punctuation_counts_unless_normalised(spark):
    tokens = token_table(spark, rows_of([("cat", "cat", "NN"), (".", ".", ".")]))
    assert type_token_ratio(tokens).collect()[0]["total_tokens"] == 2
    assert type_token_ratio(tokens, normalise_pos=True).collect()[0]["total_tokens"] == 1
    assert zipf(tokens).count() == 2
    assert zipf(tokens, normalise_pos=True).count() == 1


def test_type_token_ratio(spark):
    rows = random_rows(2)
    want = {}
    for r in rows:
        if r[7] not in ("PUNCT", "SYM", "X", None):
            total, lemmas = want.setdefault(r[:3], [0, set()])
            want[r[:3]][0] += 1
            if r[6] is not None:
                lemmas.add(r[6].lower())
    got = {tuple(r)[:3]: tuple(r)[3:] for r in type_token_ratio(token_table(spark, rows)).collect()}
    assert got == {k: (n, len(s), len(s) / n) for k, (n, s) in want.items()}


def test_pos_distribution(spark):
    rows = random_rows(3)
    universal = {p: u for u, penn in tags.PENN_BY_UNIVERSAL.items() for p in penn}
    totals = Counter(r[:3] for r in rows)
    counts = Counter((*r[:3], universal.get(r[7], r[7])) for r in rows)
    want = {
        (*key, n, totals[key[:3]], n / totals[key[:3]])
        for key, n in counts.items()
        if key[3] in tags.REPORTED_TAGS
    }
    got = pos_distribution(token_table(spark, rows)).collect()
    assert {tuple(r) for r in got} == want
    assert len(got) == len(want)


def test_author_shares_and_heatmap(spark):
    rows = rows_of([("a", "a", "NN"), ("b", "b", "VBD")], "zola", "nana")
    rows += rows_of([("a", "a", "NN")] * 3, "zola", "germinal")
    rows += rows_of([("a", "a", "NN")], "unknown", "x")
    shares = report.pos_by_author(pos_distribution(token_table(spark, rows)))
    assert {tuple(r) for r in shares.collect()} == {
        ("Zola", "realist", "NOUN", 4, 5, 0.8),
        # The denominator covers only documents in which the tag occurs.
        ("Zola", "realist", "VERB", 1, 2, 0.5),
    }
    heat = report.pos_heatmap(shares)
    assert heat.columns == ["author_label", *tags.REPORTED_TAGS]
    assert [tuple(r) for r in heat.collect()] == [("Zola", 0.8, 0.5, 0.0, 0.0, 0.0, 0.0, 0.0)]


def test_zipf_curves_use_representatives(spark):
    rows = rows_of([("a", "a", "NN")], "zola", "germinal") + rows_of(
        [("b", "b", "NN")], "zola", "nana"
    )
    got = report.zipf_curves(token_table(spark, rows)).collect()
    assert [(r["document_id"], r["token"], r["author_label"]) for r in got] == [
        ("germinal", "a", "Zola")
    ]


def test_lemma_sketches_merge(spark):
    schema = "author string, document_id string, language string, lemma string, pos string"
    rows = [("a", f"d{i % 7}", "en", f"Word{i % 5000}" if i % 2 else f"word{i % 5000}", "NOUN") for i in range(20_000)]
    rows += [("b", "d", "en", x, "NOUN") for x in ("", "", None, "one", "ONE", "two")] + [(None, "d", "en", "x", "NOUN"), ("c", "d", "en", None, "X")]
    sketches = lemma_sketches(spark.createDataFrame(rows, schema))
    assert sketches.count() == 9
    found = {r.author: r for r in merged_type_token_ratio(sketches, "author").collect()}
    assert {k: r.total_tokens for k, r in found.items()} == {"a": 20_000, "b": 6, None: 1}
    assert abs(found["a"].unique_lemmas - 5000) <= 150 and found["b"].unique_lemmas == 3 and found[None].unique_lemmas == 1
    assert found["b"].ttr == 0.5
    assert merged_type_token_ratio(sketches.limit(0), "author").count() == 0
