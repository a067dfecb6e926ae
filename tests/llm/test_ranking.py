"""Ranked search against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lexiloom.llm import ranking
from lexiloom.llm.ranking import build_index, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    found = [(i, Counter(terms(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n, total = len(found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in found:
            m = 25 + 75 * c.total() * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def search(spark, docs, items, **settings):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in ranked_search(d, i, **settings).collect()), key=str)


def invented(n, seed, longest=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    return [(i, " ".join(rng.choices(words, [1 / (j + 1) for j in range(300)], k=rng.randint(0, longest)))) for i in range(n)]


@pytest.mark.parametrize("settings", [{}, {"k": 3}, {"item_bytes": 200}])
def test_same_as_all_scores(spark, settings):
    docs, items = invented(400, 1), [(i, t) for i, t in invented(12, 2, 15)]
    expected = brute(docs, items, settings.get("k", 10))
    assert search(spark, docs, items, **settings) == expected != []


def test_marks_case_ties_repeats_and_nulls(spark):
    docs = [(1, "A-b_c É é"), (2, "a b"), (3, "a b"), (3, "a b"), (None, "a b"), (4, None), (5, ""), (6, "...;"), (7, "x"), (8, "naïve ıİ")]
    items = [(1, "a B"), (1, "a B"), (2, None), (3, ""), (4, "É"), (5, "zzz"), (None, "x naïve"), (6, "a a a")]
    assert search(spark, docs, items) == brute(docs, items)


def test_very_long_and_hot(spark):
    rng = random.Random(3)
    docs = [(i, "common " * (i % 40) + f"rare{i % 5}") for i in range(200)] + [(500, " ".join(f"t{rng.randint(0, 30000)}" for _ in range(40000)))]
    items = [(0, "common rare1"), (1, "t5 t6 t7 common"), (2, "rare4")]
    assert search(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert search(spark, [], [(1, "a")]) == []
    assert search(spark, [(1, "a")], []) == []
    assert search(spark, [(1, None)], [(1, "a")]) == []


def test_other_columns(spark):
    docs, items = invented(50, 4), invented(5, 5)
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item string, score int")
    i = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    assert sorted(map(tuple, ranked_search(d, i).collect()), key=str) == brute(docs, items)


def test_bounds_hold_and_exclude(spark):
    docs = invented(600, 6, 200)
    rows = build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    texts = {str(i): Counter(x.encode() for x in terms(t)) for i, t in docs}
    some = [terms_ for _, t in invented(6, 7, 20) if (terms_ := [x.encode() for x in terms(t)])]
    df = Counter(t for c in texts.values() for t in c)
    n, total = sum(bool(c) for c in texts.values()), sum(c.total() for c in texts.values())
    queries = ranking.Queries(some, df, n, total)
    assert sorted(i for r in rows for i in r.ids) == sorted(i for i, c in texts.items() if c)
    slack = []
    for r in rows:
        for item, bound in queries.bounds(r.width, np.array(r.n), np.array(r.top), bytes(r.slices)):
            for i, most in zip(r.ids, bound):
                m = int(ranking.length_norm(texts[i].total(), n, total))
                score = queries.score(item, texts[i], m)
                assert score <= most
                slack.append(most - score)
    assert np.mean(slack) < 0.5 * np.mean([ranking.weight(df[t], n) for x in some for t in x]) * 1e6
