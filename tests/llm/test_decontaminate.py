"""Decontamination against brute force."""

import hashlib
import random
import re

import numpy as np

from lexiloom.llm.decontaminate import contamination, decontaminate, gram_hashes, winnow

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return PATTERN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, other in items:
            v = words(other)
            n = min(10, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
            for i in range(len(w) - n + 1) if v else ():
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= {str(item)} if item is not None else set()
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rng = random.Random(7)
    vocabulary = ["Alpha", "beta", "gamma", "é", "x1", "日本"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([10, 11, 14, 30]))) for i in range(12)]
    items += [(20, "zeta eta"), (21, "Theta!"), (22, ""), (23, None), (24, " .. "), (25, items[0][1]), (None, "omega psi chi"), (20, "zeta eta")]
    docs = [(i, f"{text(rng.randrange(30))} {rng.choice(items)[1] or ''} {text(rng.randrange(30))}") for i in range(60)]
    docs += [(100, None), (101, ""), (102, "zeta   ETA theta zeta eta"), (103, "omega psi chi"), (104, items[3][1] * 3), (104, "again")]
    docs += [(None, items[1][1]), (105, text(5000)), (5, docs[5][1]), (106, "a\x00b\x7fc É\xa0"), (107, " ".join(items[2][1].split()[1:9]))]
    frame = spark.createDataFrame([(*d, "g", 3) for d in docs], "doc_id long, text string, `group` string, n int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    result = contamination(frame, bench)
    assert result.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r) for r in result.collect()), key=str) == brute(docs, items)
    clean = decontaminate(frame, bench)
    assert clean.columns == frame.columns
    kept = sorted((str(r[0]), r[1] or "") for r in clean.collect())
    flags = [any(r[5] for r in brute([d], items)) for d in docs]
    assert kept == sorted((str(d[0]), d[1] or "") for d, f in zip(docs, flags, strict=True) if not f)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert sorted((r.doc_id, r.n_words, r.contaminated) for r in contamination(docs, bench).collect()) == [(1, 2, False), (2, 0, False)]
    assert contamination(docs.limit(0), spark.createDataFrame([(1, "some words")], "item_id long, text string")).count() == 0


def test_winnowing_guarantee():
    rng = random.Random(1)
    shared = [b"s%d" % i for i in range(10)]
    for _ in range(200):
        one = [b"a%d" % rng.randrange(9) for _ in range(rng.randrange(20))] + shared + [b"b"] * rng.randrange(9)
        two = [b"c"] * rng.randrange(20) + shared + [b"d%d" % rng.randrange(9) for _ in range(rng.randrange(20))]
        prints = []
        for w in (one, two):
            h = gram_hashes(w, 5)
            prints.append(set(h[winnow(h, 6)].tolist()))
        assert prints[0] & prints[1] & set(gram_hashes(shared, 5).tolist())
    assert winnow(np.array([3, 1, 1, 2], np.uint64), 2).tolist() == [1, 2]

