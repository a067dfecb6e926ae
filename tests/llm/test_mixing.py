"""Budgets against an independent water filling, and prefixes against plain sums."""

import hashlib
import random
from fractions import Fraction

from pyspark.sql import functions as F

from lexiloom.llm.mixing import leaf_budgets, mix


def fill(budget, nodes):
    """nodes: name -> (weight, capacity); exact shares, by repeated redistribution."""
    given, open_, left = dict.fromkeys(nodes, Fraction(0)), dict(nodes), Fraction(budget)
    while open_ and left > 0:
        total = sum(w for w, _ in open_.values())
        full = {k for k, (w, c) in open_.items() if c <= left * w / total}
        if not full:
            for k, (w, _) in open_.items():
                given[k] = left * w / total
            break
        for k in full:
            given[k] = Fraction(open_.pop(k)[1])
        left = budget - sum(given.values())
    return given


def test_tree_budgets(spark):
    rng = random.Random(3)
    leaves, dw, lw = [], {}, {}
    for d in range(4):
        dw[f"d{d}"] = rng.randrange(1, 9)
        for x in range(3):
            lw[f"d{d}", f"l{x}"] = rng.randrange(1, 9)
            for s in range(rng.randrange(1, 5)):
                leaves.append((f"d{d}", f"l{x}", f"s{s}", rng.randrange(1, 1000), rng.randrange(1, 5)))
    rows = [(d, x, s, n, 2 * n, dw[d], lw[d, x], w) for d, x, s, n, w in leaves]
    frame = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long, capacity long, w_domain long, w_lang long, w_source long")
    cap = lambda f: sum(r[4] for r in rows if f(r))
    for budget in (0, 1, 1000, cap(lambda r: True) // 2, cap(lambda r: True)):
        found = {(r.domain, r.lang, r.source): r.given for r in leaf_budgets(frame, budget).collect()}
        top = fill(budget, {d: (w, cap(lambda r, d=d: r[0] == d)) for d, w in dw.items()})
        for d in dw:
            mid = fill(top[d], {x: (w, cap(lambda r, d=d, x=x: r[:2] == (d, x))) for (e, x), w in lw.items() if e == d})
            for x in mid:
                low = fill(mid[x], {r[2]: (r[7], r[4]) for r in rows if r[:2] == (d, x)})
                for s, want in low.items():
                    assert abs(found[d, x, s] - want) <= 4, (budget, d, x, s)
        assert budget - 20 <= sum(found.values()) <= budget
        assert all(found[r[:3]] <= r[4] for r in rows)


def docs(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(1, 60), f"d{i % 2}", rng.choice(["en", "fr", None]), f"s{i % 5}") for i in range(300)]
    rows += [(900, None, "d0", "en", "s0"), (901, "", "d0", "en", "s0"), (902, " \t\n", "d0", "en", "s0"), (None, "a b c", None, None, None), (3, "x y", "d1", "en", "s3")]
    rows += [(903, "long " * 5000, "d1", "fr", "s1")]
    return rows, spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, domain string, lang string, source string, epoch int, n int")


def weights():
    return {"domain": F.when(F.col("domain") == "d0", 5).otherwise(1), "lang": F.lit(1), "source": F.lit(1)}


def test_prefixes(spark):
    rows, frame = docs(spark)
    found = [r.asDict() for r in mix(frame, weights(), (1, 1), epochs=3).collect()]
    size = {}
    for key, text, *leaf in rows:
        size.setdefault(tuple(x or "" for x in leaf), []).append((key, len((text or "").split())))
    for leaf, members in size.items():
        members = [m for m in members if m[1]]
        own = [r for r in found if (r["domain"], r["lang"], r["source"]) == leaf]
        total, taken = sum(n for _, n in members), sum(r["n_taken"] for r in own)
        whole = taken // total if total else 0
        for epoch in range(4):
            got = sorted(((r["doc_id"], r["n_tokens"], r["n_taken"]) for r in own if r["epoch"] == epoch), key=str)
            if epoch < whole:
                assert got == sorted(((k, n, n) for k, n in members), key=str)
                continue
            rest, want = max(0, min(total, taken - epoch * total)), []
            order = lambda m: (hashlib.md5(f"17:{epoch}:{'' if m[0] is None else m[0]}".encode()).hexdigest(), m[1])  # noqa: B023, E731
            for k, n in sorted(members, key=order):
                if rest <= 0:
                    break
                want.append((k, n, min(n, rest)))
                rest -= n
            assert got == sorted(want, key=str)
    assert all(r["epoch"] < 3 for r in found)
    budget = sum(n for m in size.values() for _, n in m)
    assert budget - 30 <= sum(r["n_taken"] for r in found) <= budget


def test_empty_table(spark):
    assert mix(docs(spark)[1].limit(0), weights()).count() == 0
