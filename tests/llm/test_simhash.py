"""SimHash against brute force, with nulls, empty, long and repeated texts."""

import xxhash

from lexiloom.llm.graph import connected_components
from lexiloom.llm.simhash import block_masks, fingerprint, hamming_components, simhash_groups


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(rows):
    prints = [brute_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), key), key)
    return sorted((key, f"{prints[i]:016x}", least[root(i)]) for i, (key, _) in enumerate(rows))


def test_prints_and_groups(spark):
    base = [f"word{i * 7 % 97}" for i in range(400)]
    rows = [(10, " ".join(base)), (4, None), (3, ""), (5, " \t\n"), (8, "One two"), (9, "one  TWO"), (9, "one  TWO")]
    rows += [(7, "É \x85 \xa0x \x0b Y z \x1c q"), (90, " ".join(base * 200)), (91, " ".join(base * 200))]
    for i in range(60):
        words = list(base)
        words[i * 5] = "changed" if i % 3 else "other"
        rows.append((100 + i, " ".join(words)))
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, component int")
    found = sorted(tuple(r) for r in simhash_groups(docs).collect())
    assert found == brute_groups(rows)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_groups(docs).columns == ["doc_id", "fingerprint", "component_id"]
    assert simhash_groups(docs).count() == 0


def test_pairs_meet_under_a_mask():
    masks = block_masks(3, 6)
    assert len(masks) == 20
    for bits in [(0, 1, 2), (0, 31, 63), (10, 21, 42), (63,), ()]:
        flip = sum(1 << b for b in bits)
        assert any(flip & m % (1 << 64) == 0 for m in masks)


def test_dense_group_keeps_every_link(spark):
    """Chains of small steps inside one group, where the smallest member is far from most."""
    prints = {0, 0xF << 60}
    value = 0
    for bit in range(0, 40, 2):
        value |= 3 << bit
        prints.add(value)
    prints |= {value ^ 1 << b for b in range(50, 60)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r.fp: r.component for r in hamming_components(frame).collect()}
    groups = {}
    for p in signed:
        groups.setdefault(found.get(p, p), set()).add(p % (1 << 64))
    expected = []
    left = set(prints)
    while left:
        todo = [left.pop()]
        group = set(todo)
        while todo:
            x = todo.pop()
            near = {y for y in left if (x ^ y).bit_count() <= 3}
            left -= near
            group |= near
            todo += near
        expected.append(group)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 70), (70, 100), (5, 5), (80, 81), (81, 82), (82, 80)]
    frame = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    found = {r.id: r.component for r in connected_components(frame).collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, 100: 70, 70: 70, 80: 80, 81: 80, 82: 80}
    assert fingerprint(b"") == 0
