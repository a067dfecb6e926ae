"""Repeated passages against brute force."""

import random
from collections import Counter

import numpy as np

from lexiloom.llm.substrings import remove_repeats, window_hashes, word_hashes


def brute(docs, window):
    split = [(key, (text or "").encode().split()) for key, text in docs]
    seen = Counter(tuple(w[i : i + window]) for _, w in split for i in range(len(w) - window + 1))
    out = []
    for key, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        left = [x.decode() for i, x in enumerate(w) if i not in gone]
        out.append((key, " ".join(left), len(w), len(gone)))
    return sorted(out, key=str)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [word() for _ in range(50)]
    docs = []
    for i in range(80):
        cut = rng.randrange(30)
        docs.append((i, " ".join([word() for _ in range(rng.randrange(60))] + passage[cut : cut + rng.randrange(51)] + [word() for _ in range(rng.randrange(60))])))
    docs += [(100, None), (101, ""), (102, " \t\n"), (103, "same " * 40), (104, "same " * 35), (105, "same " * 34), (3, docs[3][1]), (None, docs[4][1])]
    long = [word() for _ in range(20000)]
    docs += [(106, " ".join(long)), (107, "É \x85\xa0 " + "  ".join(long[7000:7035])), (108, " ".join(long[100:134]))]
    frame = spark.createDataFrame([(*d, 1, b"x") for d in docs], "doc_id long, text string, batch int, hashes binary")
    expected = brute(docs, 35)
    assert rows(remove_repeats(frame)) == expected
    assert rows(remove_repeats(frame, bucket_bytes=2000)) == expected


def test_small_windows(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choices("abcd", k=rng.randrange(25)))) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for window in (1, 2, 5, 8):
        assert rows(remove_repeats(frame, window)) == brute(docs, window)
    assert remove_repeats(frame.limit(0)).count() == 0


def test_window_hashes_depend_on_the_words_alone():
    words = [b"a", b"b", b"c"] * 50
    found = window_hashes(word_hashes(words), 9)
    assert len(np.unique(found)) == 3 and (found[:3] == found[3:6]).all()
