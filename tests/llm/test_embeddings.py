"""Embedding links against all pairs, with few pivots, small chunks and odd vectors."""

import numpy as np
import pytest

from lexiloom.llm.embeddings import embedding_groups

SCHEMA = "vec_id long, embedding array<float>, label int, cell int, gid string"


def brute(rows, least=0.93):
    good = []
    for _, v, label in rows:
        ok = label is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
        good.append(np.array(v, np.float32).astype(np.float64) if ok else None)
    n = len(rows)
    near = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            a, b = good[i], good[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= least:
                near[i].append(j)
                near[j].append(i)
    out, seen = [None] * n, set()
    for i in range(n):
        if i in seen:
            continue
        todo, part = [i], {i}
        while todo:
            for j in near[todo.pop()]:
                if j not in part:
                    part.add(j)
                    todo.append(j)
        seen |= part
        ids = [rows[j][0] for j in part if rows[j][0] is not None]
        least_id = min(ids) if ids else None
        for j in part:
            out[j] = (rows[j][0], len(near[j]), least_id, rows[j][0] == least_id)
    return sorted(out, key=str)


def vectors(rng, n=150, size=8):
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.normal(0, 0.08, size)
        else:
            v = rng.normal(0, 1, size)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    return rows


@pytest.mark.parametrize(("pivots", "chunk"), [(5, 8192), (12, 7), (1, 10)])
def test_against_all_pairs(spark, pivots, chunk):
    rng = np.random.default_rng(pivots)
    rows = vectors(rng)
    rows += [(200 + i, rows[3][1], rows[3][2]) for i in range(20)] + [(230, [2 * x for x in rows[3][1]], rows[3][2])]
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * 8, 1), (303, [None] * 8, 1), (304, [float("nan")] * 8, 1), (305, [float("inf")] + [1.0] * 7, 1)]
    rows += [(306, rows[0][1], None), (307, [1.0, 2.0], 1), (308, [1.0, 2.0], 1), (309, [-0.0, 1.0], 1), (310, [0.0, 1.0], 1), (5, rows[5][1], rows[5][2]), (None, rows[6][1], rows[6][2])]
    frame = spark.createDataFrame([(*r, 3, "g") for r in rows], SCHEMA)
    found = embedding_groups(frame, pivots=pivots, chunk=chunk)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert embedding_groups(spark.createDataFrame([], SCHEMA)).count() == 0
