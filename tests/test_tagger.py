"""Sentences and learned tags against brute force, on invented grammars."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexiloom.local import local_table
from lexiloom.operators import tagger
from lexiloom.operators.annotate import annotate_chunks, rule_tags
from lexiloom.operators.sentences import abbreviation_scores, abbreviations, sentence_offsets, stop_counts, with_sentences
from lexiloom.operators.tagger import START, learn_tags, tag_emissions, tag_sentences, tag_transitions

CHUNKS = "document_id string, author string, language string, chunk_id int, text_clean string"
TAGGED = "author string, document_id string, chunk_id int, sentence_id long, language string, token_id int, token string, pos string"


def chunk_table(spark, texts, language="en"):
    return local_table(spark, [("d", "a", language, i, t) for i, t in enumerate(texts)], CHUNKS)


def sentence_ids(spark, texts, known=()):
    table = local_table(spark, [("en", form, capital) for form, capital in known], "language string, form string, capital boolean")
    rows = with_sentences(chunk_table(spark, texts), table).orderBy("chunk_id", "token_id").collect()
    return [(r.token, r.sentence_id) for r in rows]


def test_sentence_numbers_run_over_chunks(spark):
    assert sentence_ids(spark, ["One . Two !", "three", "four ? five"]) == [
        ("One", 0), (".", 0), ("Two", 1), ("!", 1), ("three", 2), ("four", 2), ("?", 2), ("five", 3)
    ]


def test_abbreviations_end_no_sentence(spark):
    known = [("dr", True), ("etc", False)]
    got = sentence_ids(spark, ["Dr. Who met etc. and etc. The end. X dr."], known)
    assert got == [
        ("Dr", 0), (".", 0), ("Who", 0), ("met", 0), ("etc", 0), (".", 0), ("and", 0), ("etc", 0), (".", 0),
        ("The", 1), ("end", 1), (".", 1), ("X", 2), ("dr", 2), (".", 2),
    ]


def abbreviated(n, seed):
    rng = random.Random(seed)
    words = "house river the of went saw old new far green paper stone".split()
    out = []
    for _ in range(n):
        parts = rng.choices(words, k=rng.randint(3, 9))
        parts.insert(rng.randint(0, len(parts) - 1), rng.choice(["Dr. Smith", "p. 5", "Mr. Jones", "so"]))
        line = " ".join(parts)
        out.append(line[0].upper() + line[1:] + ".")
    return out


def test_abbreviations_are_learned(spark):
    counts = stop_counts(chunk_table(spark, abbreviated(400, 1)))
    found = {r.form: r.capital for r in abbreviations(counts).collect()}
    assert found == {"dr": True, "mr": True, "p": False}


def test_scores_by_the_formula(spark):
    counts = stop_counts(chunk_table(spark, abbreviated(60, 2)))
    rows = {r.form: r for r in counts.collect()}
    share = sum(r.n_stop for r in rows.values()) / sum(r.n for r in rows.values())
    got = abbreviation_scores(counts).collect()
    assert {r.form for r in got} == {f for f, r in rows.items() if r.n_stop}
    for r in got:
        n, k = r.n, r.n_stop
        ratio = 2 * (k * math.log(0.99) + (n - k) * math.log(0.01) - k * math.log(share) - (n - k) * math.log(1 - share))
        assert r.score == pytest.approx(ratio / math.exp(len(r.form)) / len(r.form) ** (n - k), rel=1e-9, abs=1e-12)


def invented(n, seed, new=False):
    """Sentences of a small grammar in which ``run`` and ``fish`` are nouns or verbs by what stands before them."""
    rng = random.Random(seed)
    nouns, verbs = ["run", "fish", "dog", "idea"], ["run", "fish", "sees", "likes"]
    rows = []
    for s in range(n):
        words = [("the", "DT"), (rng.choice(nouns), "NN"), ("they" if rng.random() < 0.3 else "will", "MD"), (rng.choice(verbs), "VB"), ("a", "DT")]
        words += [(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnr')}ness" if new or rng.random() < 0.3 else rng.choice(nouns), "NN"), (".", ".")]
        rows += [("a", f"d{s % 7}", 0, s, "en", i, w, t) for i, (w, t) in enumerate(words)]
    return rows


def shape(word):
    return "A" if word[0].isupper() else "a" if word[0].isalpha() else "0" if word[0].isdigit() else "."


def brute(rows, sentence):
    """The best tags of a sentence by trying all sequences of the choices, scored from counts anew."""
    emit, move, single = defaultdict(Counter), defaultdict(Counter), Counter()
    forms, last = Counter(), {}
    for a, d, c, s, _, i, w, t in rows:
        emit[w.lower()][t] += 1
        forms[w.lower()] += 1
        single[t] += 1
        move[last.get((a, d, c, s), START)][t] += 1
        last[a, d, c, s] = t
    names = sorted(single)
    ending = defaultdict(Counter)
    for *_, w, t in rows:
        low = w.lower()
        if forms[low] <= tagger.RARE:
            for size in tagger.ENDINGS:
                if size <= len(low):
                    ending[shape(w), size, low[len(low) - size :] if size else ""][t] += 1

    def choices(word):
        low = word.lower()
        found = emit.get(low)
        for size in tagger.ENDINGS:
            if not found and size <= len(low):
                found = ending.get((shape(word), size, low[len(low) - size :] if size else ""))
        if not found:
            return [(t, 0.0) for t in names]
        return [(t, math.log(n / found.total() / (single[t] / single.total()))) for t, n in sorted(found.items(), key=lambda x: (-x[1], x[0]))[: tagger.MOST_TAGS]]

    paths = [(0.0, [START])]
    for word in sentence:
        paths = [
            (s + math.log((move[p[-1]][t] + tagger.SMOOTHING) / (move[p[-1]].total() + tagger.SMOOTHING * len(names))) + e, [*p, t])
            for s, p in paths
            for t, e in choices(word)
        ]
    return max(paths, key=lambda x: x[0])[1][1:]


def tagged(spark, rows, sentences):
    table = local_table(spark, rows, TAGGED)
    model = learn_tags(tag_transitions(table), tag_emissions(table))
    tokens = [("a", "x", 0, s, "en", 100 * s + i, w) for s, words in enumerate(sentences) for i, w in enumerate(words)]
    df = local_table(spark, tokens, TAGGED.removesuffix(", pos string"))
    out = defaultdict(list)
    for r in tag_sentences(df, model).orderBy("token_id").collect():
        out[r.sentence_id].append(r.pos)
    return [out[s] for s in range(len(sentences))]


def test_best_path_is_that_of_all_sequences(spark):
    rows = invented(60, 3)
    rng = random.Random(4)
    words = ["the", "run", "fish", "will", "Fish", "a", "dog", ".", "xaqness", "zzz", "9"]
    sentences = [rng.choices(words, k=rng.randint(1, 5)) for _ in range(25)]
    for words, got in zip(sentences, tagged(spark, rows, sentences)):
        assert got == brute(rows, words), words


def test_held_out_accuracy_beats_the_most_frequent_tag(spark):
    train, held = invented(400, 5), invented(200, 6, new=True)
    by_sentence = defaultdict(list)
    for *_, s, _, _, w, t in held:
        by_sentence[s].append((w, t))
    sentences = [[w for w, _ in x] for x in by_sentence.values()]
    got = tagged(spark, train, sentences)
    truth = [[t for _, t in x] for x in by_sentence.values()]
    counts = defaultdict(Counter)
    for *_, w, t in train:
        counts[w][t] += 1
    plain = [[counts[w].most_common(1)[0][0] if w in counts else None for w in x] for x in sentences]
    total = sum(map(len, truth))
    right = sum(a == b for x, y in zip(got, truth) for a, b in zip(x, y)) / total
    baseline = sum(a == b for x, y in zip(plain, truth) for a, b in zip(x, y)) / total
    assert right >= 0.99 and baseline <= 0.9


def test_counts_pass_over_missing_tags(spark):
    rows = [("a", "d", 0, 0, "en", 0, "x", "A"), ("a", "d", 0, 0, "en", 1, "y", None), ("a", "d", 0, 0, "en", 2, "X", "B"), ("a", "d", 1, 0, "en", 0, "z", "B")]
    table = local_table(spark, rows, TAGGED)
    assert sorted(map(tuple, tag_transitions(table).collect())) == [("en", START, "A", 1), ("en", START, "B", 1), ("en", "A", "B", 1)]
    assert sorted(map(tuple, tag_emissions(table).collect())) == [("en", "x", "A", "B", 1), ("en", "x", "a", "A", 1), ("en", "z", "a", "B", 1)]


def test_unknown_language_and_long_sentences(spark):
    rows = invented(40, 7)
    table = local_table(spark, rows, TAGGED)
    model = learn_tags(tag_transitions(table), tag_emissions(table))
    tokens = [("a", "x", 0, 0, "en", i, "dog") for i in range(3000)] + [("a", "y", 0, 0, "de", 0, "dog"), ("a", "z", 0, 0, None, 0, "dog")]
    found = tag_sentences(local_table(spark, tokens, TAGGED.removesuffix(", pos string")), model).collect()
    assert len(found) == 3002
    assert {r.pos for r in found if r.document_id != "x"} == {None}
    assert {r.pos for r in found if r.document_id == "x"} <= {"NN", "VB", "DT", "MD", "."}


def test_tokens_are_not_shuffled(spark):
    rows = invented(40, 8)
    table = local_table(spark, rows, TAGGED)
    model = learn_tags(tag_transitions(table), tag_emissions(table))
    known = local_table(spark, [("en", "dr", True)], "language string, form string, capital boolean")
    result = tag_sentences(with_sentences(chunk_table(spark, ["The dog will run ."]), known), model)
    plan = result._jdf.queryExecution().executedPlan().toString()
    # Operators from the one that makes sentences down to the one that makes tokens again.
    above = plan[: plan.index("Generate posexplode")].splitlines()
    assert not any("Exchange hashpartitioning" in line and "token_id" in line for line in above)
    assert [r.pos for r in result.orderBy("token_id").collect()] == ["DT", "NN", "MD", "VB", "."]
    assert result.where(F.col("sentence_id") == 0).count() == 5


def test_documents_without_an_author_keep_their_numbers(spark):
    chunks = local_table(spark, [("d", None, "en", 0, "One. Two."), ("d", None, "en", 1, "Three."), ("e", "a", "en", 0, "One.")], CHUNKS)
    none = local_table(spark, [], "language string, form string, capital boolean")
    rows = with_sentences(chunks, none).orderBy("document_id", "chunk_id", "token_id").collect()
    assert [r.sentence_id for r in rows] == [0, 0, 1, 1, 2, 2, 0, 0]


def test_stored_offsets_spare_the_counting_pass(spark):
    chunks = chunk_table(spark, ["One . Dr. Two !", "three", "four ? five", ""])
    known = local_table(spark, [("en", "dr", True)], "language string, form string, capital boolean")
    offsets = sentence_offsets(chunks, known)
    assert [(r.chunk_id, r.offset) for r in offsets.orderBy("chunk_id").collect()] == [(0, 0), (1, 2), (2, 2), (3, 3)]
    rows = with_sentences(chunks, known, spark.createDataFrame(offsets.collect(), offsets.schema), 3)
    assert sorted(rows.collect()) == sorted(with_sentences(chunks, known).collect())
    # Texts are tokenised once, after they are dealt, not also for a filter before.
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.index("regexp_extract_all") < plan.index("RepartitionByExpression")


def test_rules_on_sentence_rows_are_those_of_chunks(spark):
    chunks = chunk_table(spark, ["The old House. He met Dr. Smith in 1900, slowly!"])
    known = local_table(spark, [("en", "dr", True)], "language string, form string, capital boolean")
    rows = {(r.token_id, r.token, r.lemma, r.pos) for r in rule_tags(with_sentences(chunks, known)).collect()}
    assert rows == {(r.token_id, r.token, r.lemma, r.pos) for r in annotate_chunks(chunks).collect()} and len(rows) == 14


def test_one_choice_each_is_the_same_path(spark, monkeypatch):
    rows = invented(60, 9)
    sentences = [["the", "dog", "."], ["the", "run", "will"], ["a"], ["they", "sees", "."]]
    got = tagged(spark, rows, sentences)
    assert got == [brute(rows, words) for words in sentences]
    # Without the fold, sentences of forms with one tag each still have theirs.
    monkeypatch.setattr(tagger, "best_path", lambda *_: F.transform("_tokens", lambda _: F.lit(None).cast("int")))
    alone = tagged(spark, rows, sentences)
    assert alone[0] == got[0] == ["DT", "NN", "."] and alone[2] == got[2] and alone[3] == got[3] and alone[1] == [None] * 3
