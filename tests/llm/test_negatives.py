"""Hard negatives against a comparison with every row, and the tree against its own rules."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.llm import negatives
from lexiloom.llm.negatives import Tree, Wanted, angles, hard_negatives

SCHEMA = "vec_id long, label string, embedding array<double>"


def brute(rows, every, positives=5, negatives=10):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) by the definition."""
    ok = [(i, y, [int(np.floor(256 * x)) for x in v]) for i, y, v in rows if None not in (i, y, v) and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (i, y, v) in enumerate(ok):
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, z) for other, (j, z, w) in enumerate(ok) if other != at and len(v) == len(w)]
        scored.sort(key=lambda x: x[:2])
        for p, j, _ in [x for x in scored if x[2] == y][:positives]:
            fit = [x for x in scored if x[2] != y and 30 * -p <= 100 * -x[0] <= 90 * -p][:negatives]
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k, _) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, every, **settings):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hard_negatives(df, F.col("vec_id") % every == 0, **settings).collect())


def clustered(n, size, seed, ties=False):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, size))
    v = middles[rng.integers(0, 6, n)] + 0.3 * rng.normal(size=(n, size))
    if ties:
        v = np.round(v)
    labels = rng.integers(0, 3, n)
    labels[: n // 3] = 0
    return [(i, str(y), x.tolist()) for i, (y, x) in enumerate(zip(labels.tolist(), v))]


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("settings", [{}, {"tree_bytes": 1}, {"tree_bytes": 1, "cells": 2}])
def test_same_as_all_comparisons(spark, settings, ties):
    rows = clustered(400, 5, 1, ties)
    assert mined(spark, rows, 20, **settings) == brute(rows, 20) != []


def test_anchors_in_groups(spark, monkeypatch):
    monkeypatch.setattr(negatives, "VISITORS", 7)
    rows = clustered(300, 4, 2)
    assert mined(spark, rows, 10, tree_bytes=1) == brute(rows, 10)


def test_rows_that_take_no_part(spark):
    rows = clustered(60, 3, 3)
    bad = [(None, "0", [1.0, 2.0, 3.0]), (100, None, [1.0, 2.0, 3.0]), (110, "0", None), (120, "0", [1.0, None, 2.0]), (130, "1", [1.0, float("nan"), 2.0]), (140, "1", [float("inf"), 0.0, 0.0])]
    assert mined(spark, rows + bad, 10) == brute(rows, 10)


def test_repeated_rows_other_sizes_and_zero_vectors(spark):
    rows = clustered(40, 3, 4) * 2 + clustered(40, 2, 5) + [(50, "0", []), (60, "1", []), (70, "0", [0.0, 0.0, 0.0]), (80, "1", [0.0, 0.0, 0.0])]
    assert mined(spark, rows, 10) == brute(rows, 10)
    assert mined(spark, rows, 10, tree_bytes=1) == brute(rows, 10)


def test_empty_tables_and_single_label(spark):
    assert mined(spark, [], 1) == []
    assert mined(spark, [(i, "a", [1.0, float(i)]) for i in range(9)], 3) == []
    assert mined(spark, [(0, "a", [1.0])], 1) == []


def test_long_vectors(spark):
    rows = [(i, "ab"[i % 2], [random.Random(i).uniform(-1e5, 1e5) for _ in range(3)]) for i in range(50)]
    assert mined(spark, rows, 10) == brute(rows, 10)
    with pytest.raises(ValueError, match="64 bits"):
        mined(spark, [(0, "a", [1e9]), (1, "b", [1e9])], 1)


def test_clashing_columns(spark):
    rows = clustered(40, 3, 6)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", gid string, cell int, score int")
    found = sorted(tuple(r) for r in hard_negatives(df, F.col("vec_id") % 10 == 0).collect())
    assert found == brute(rows, 10)


def test_tree_covers_and_skips():
    rng = np.random.default_rng(7)
    middles = rng.normal(size=(8, 16))
    v = np.floor(256 * (middles[rng.integers(0, 8, 2000)] + 0.05 * rng.normal(size=(2000, 16))))
    norm = float(np.linalg.norm(v, axis=1).max())
    ids = np.arange(2000)
    tree = Tree.build(["a"] * 2000, v, ids, ids, norm)
    tree = Tree.read(16, norm, tree.labels, tree.stored())
    units = negatives.augmented(tree.vectors, norm)
    for i in range(len(tree.centre)):
        far = angles(units[tree.start[i] : tree.end[i]], units[tree.centre[i]][None])
        assert far.max() <= tree.radius[i] + 1e-9
    assert sorted(tree.ids.tolist()) == list(range(2000))
    seen = []

    class Counted(Wanted):
        def offer(self, scores, *rest):
            seen.append(len(scores))
            super().offer(scores, *rest)

    window = Counted(-(1 << 62), 1 << 62, 5, -(1 << 62))
    tree.search(v[3], "a", 3, [window], True)
    scores = v @ v[3]
    scores[3] = -np.inf
    assert [-s for s, _, _ in window.rows] == sorted(scores, reverse=True)[:5]
    assert sum(seen) < 1000
