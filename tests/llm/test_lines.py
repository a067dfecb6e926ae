"""Line dedup against brute force on all pairs."""

import random
import re
import time

from pyspark.sql import functions as F

from lexiloom.llm.lines import band_keys, code_units, dedup_lines, leader_pairs, line_classes, line_rows, may_be_similar, shingle_maps, shingle_set, similar


def strip(line):
    return line.strip(" \t\r\x0b\x0c")


def units(line):
    data = line.encode("utf-16-be")
    return {data[2 * i : 2 * i + 16] for i in range(max(1, len(data) // 2 - 7))}


def brute(docs):
    lines = [(key, nr, strip(line)) for key, text in docs if text is not None for nr, line in enumerate(text.split("\n")) if strip(line)]
    distinct = sorted({x for _, _, x in lines})
    sets = {x: units(x) for x in distinct}
    parent = {x: x for x in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(distinct):
        for y in distinct[:i]:
            both = len(sets[x] & sets[y])
            if both >= 0.8 * (len(sets[x]) + len(sets[y]) - both):
                parent[root(x)] = root(y)
    first = {}
    order = lambda k: (k[0] is not None, k[0] or 0, k[1])
    for key, nr, x in lines:
        first[root(x)] = min(first.get(root(x), (key, nr)), (key, nr), key=order)
    return sorted(((key, nr, *first[root(x)], (key, nr) == first[root(x)]) for key, nr, x in lines), key=str)


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9)))
    base = [" ".join(word() for _ in range(rng.randrange(1, 40))) for _ in range(40)]
    docs = []
    for i in range(40):
        lines = []
        for _ in range(rng.randrange(6)):
            line = rng.choice(base).split()
            if rng.random() < 0.5:
                line[rng.randrange(len(line))] = word()
            lines.append(rng.choice(["", " ", "\t"]) + " ".join(line) + rng.choice(["", "\r", "  "]))
        docs.append((i, "\n".join(lines)))
    docs += [(100, None), (101, ""), (102, "\n \n\t\n"), (103, "short\nshort\nshor"), (104, "日本語のテキスト行です𝄞𝄞\n日本語のテキスト行です𝄞𝄞"), (105, "x" * 300_000 + "\n" + "x" * 9)]
    # A group of near copies: each differs from the base by one word, in its own place.
    line = [word() for _ in range(120)]
    docs += [(200 + i, " ".join(line[:i] + ["changed%d" % i] + line[i + 1 :])) for i in range(50)]
    docs += [(7, docs[7][1]), (None, docs[8][1])]
    return docs


def test_against_brute_force(spark):
    docs = corpus()
    frame = spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, h int, keys string")
    expected = brute(docs)
    # So many narrow bands that no similar pair is missed.
    found = sorted((tuple(r) for r in line_classes(frame, bands=20, rows=2).collect()), key=str)
    assert found == expected
    default = sorted((tuple(r) for r in line_classes(frame).collect()), key=str)
    assert sum(a == b for a, b in zip(default, expected, strict=True)) >= 0.97 * len(expected)


def test_texts_without_repeats(spark):
    docs = corpus()
    frame = spark.createDataFrame([(*d, d[0], None) for d in docs], "doc_id long, text string, lost_id long, n_chars long")
    kept = dedup_lines(frame, bands=20, rows=2)
    assert kept.columns == frame.columns
    flags = {(k, nr): f for k, nr, _, _, f in brute(docs)}
    expected = [(k, None if t is None else "\n".join(x for nr, x in enumerate(t.split("\n")) if flags.get((k, nr), True)), k) for k, t in docs]
    assert sorted(((r[0], r[1], r[2]) for r in kept.collect()), key=str) == sorted(expected, key=str)


def test_exact_threshold(spark):
    texts = spark.createDataFrame([(1, "abcdefghijklmnop"), (2, "abcdefghijklmno"), (3, "abcdefghijkl"), (4, "x")], "h long, line string")
    texts = texts.select("h", code_units(texts.line).alias("units"))
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (2, 3)], "a long, b long")
    # 9, 8, 5 and 1 shingles: 8/9, 5/9, 0 and 5/8.
    assert [tuple(r) for r in similar(pairs, texts).collect()] == [(1, 2)]
    assert sorted(tuple(r) for r in similar(pairs, texts, 5 / 8).collect()) == [(1, 2), (2, 3)]
    assert texts.select(shingle_set("units").alias("s")).collect()[0].s.__len__() == 9


def test_native_plan_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = line_classes(frame)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert line_classes(frame.limit(0)).count() == 0 and line_rows(frame).count() == 2


def test_groups_are_sorted_by_their_key_alone(spark):
    """Keys of different bands differ, also where a line has one shingle; pairs are those of the leader of each group."""
    rows = spark.createDataFrame([(1, "aaaaaaaaaaaaaaaa"), (2, "short"), (2, "short"), (3, "a somewhat longer line")], "h long, line string")
    keys = [k for r in band_keys(rows).collect() for k in r["keys"]]
    assert len(keys) == len(set(keys)) == 36
    groups = spark.createDataFrame([(1, 1, [10, 20]), (2, 5, [10, 21]), (3, 5, [10, 20]), (4, 1, [11, 21])], "h long, n long, keys array<long>")
    pairs = leader_pairs(groups)
    assert sorted(tuple(r) for r in pairs.collect()) == [(1, 2), (1, 3), (3, 2), (4, 2)]
    sorts = re.findall(r"Sort \[(\w+)#", pairs._jdf.queryExecution().executedPlan().toString())
    assert sorts and set(sorts) == {"key"}


def test_maps_never_rule_out_a_similar_pair(spark):
    rng = random.Random(9)
    lines = ["".join(rng.choices("abc ", k=rng.randrange(1, 200))) for _ in range(20)]
    lines += [line[:i] + "X" + line[i + 1 :] for line in lines for i in (3, len(line) // 2) if i < len(line)]
    texts = spark.createDataFrame(list(enumerate(lines)), "h long, line string")
    maps = shingle_maps(texts.select("h", code_units(texts.line).alias("units"))).collect()
    rows = spark.createDataFrame(maps)
    kept = rows.alias("x").join(rows.alias("y"), may_be_similar("x", "y", 0.8) & F.expr("x.h < y.h"))
    found = {(r[0], r[1]) for r in kept.select("x.h", "y.h").collect()}
    sets = [units(line) for line in lines]
    near = {(i, j) for j in range(len(lines)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert near and near <= found and len(found) < 2 * len(near) + 20


def test_short_lines_at_the_threshold_are_found(spark):
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    lines = ["".join(rng.choices(letters, k=12)) for _ in range(3000)]
    # 5 and 4 shingles, 4 of them shared: a similarity of 0.8, and no other line links the two.
    frame = spark.createDataFrame([(i, f"{line}\n{line[:11]}") for i, line in enumerate(lines)], "doc_id long, text string")
    found = line_classes(frame)
    assert found.count() == 6000
    assert found.where("kept").count() <= 3000 + 5


def test_very_many_lines_of_one_document(spark):
    text = "\n".join(["the same line every time"] * 200_000 + ["", "another line at the end of the text"])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begin = time.perf_counter()
    assert dedup_lines(docs).first().text == "the same line every time\n\nanother line at the end of the text"
    assert time.perf_counter() - begin < 60


def test_long_near_copies_in_one_group(spark):
    """Members of one large group that leaders don't join are found by exact comparison, in components of their own."""
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    base = [rng.choice(letters) for _ in range(900)]
    rows = []
    for i in range(60):
        line = list(base)
        for _ in range(rng.choice([3, 8, 14, 20])):
            line[rng.randrange(900)] = rng.choice(letters)
        rows.append((i, "".join(line)))
    sets = [{t[k : k + 8] for k in range(len(t) - 7)} for _, t in rows]
    parent = list(range(60))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(60):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    found = line_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.keeper_id for r in found} == {i: find(i) for i in range(60)}


def test_signatures_take_their_shingles_in_blocks(spark):
    """Lines whose numbers of shingles are no multiple of a block have the minima of all their shingles, and a row per block."""
    rng = random.Random(3)
    base = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200))
    lines = [base[:k] for k in range(1, 60)] + ["x" * 9, "x" * 300, "é𝄞" * 30]
    rows = spark.createDataFrame(list(enumerate(lines)), "h long, line string")
    frame = band_keys(rows, bands=16, rows=1)
    keys = {r["h"]: r["keys"] for r in frame.collect()}
    assert keys.keys() == set(range(len(lines))) and all(len(set(k)) == 16 for k in keys.values())
    sets = [units(line) for line in lines]
    assert keys[59] == keys[60] and sets[59] == sets[60]
    # A minimum of a prefix stays the same or gets smaller as shingles are added: equal minima are frequent where sets are similar.
    for i in range(20, 58):
        equal = sum(a == b for a, b in zip(keys[i], keys[i + 1], strict=True))
        assert equal >= 8
    step = re.search(r"sequence\(1, .*?, (?:Some\()?(\d+)", frame._jdf.queryExecution().optimizedPlan().toString())
    assert step and int(step[1]) == 16


def test_maps_are_folded_and_compared_in_steps(spark):
    """Folded maps are those of fewer buckets; no part of the condition is worked out for pairs that sizes rule out."""
    rng = random.Random(4)
    lines = ["".join(rng.choices("abcdefgh", k=k)) for k in (1, 8, 30, 400, 3000)]
    texts = spark.createDataFrame(list(enumerate(lines)), "h long, line string")
    maps = shingle_maps(texts.select("h", code_units(texts.line).alias("units")))
    for r in maps.collect():
        assert r["size"] == len(units(lines[r.h]))
        folded = [0] * len(r.folded)
        for j, word in enumerate(r.words):
            folded[j % len(folded)] ^= word
        assert r.folded == folded and sum(bin(w & (2**64 - 1)).count("1") for w in r.words) % 2 == r["size"] % 2
    condition = may_be_similar("x", "y", 0.8)._jc.toString()
    assert condition.count("zip_with") == 1
