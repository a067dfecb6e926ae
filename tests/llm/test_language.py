"""Language profiles against a plain count, and predictions on odd texts."""

import zlib
from collections import Counter

from lexiloom.llm.language import UNKNOWN, Profiles, identify, identify_held_out, learn_profiles, ngrams


def brute_ngrams(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    out = Counter()
    for word in words:
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if gram.strip():
                    out[gram] += 1
    return out


def code(gram):
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


def counted(text):
    grams, counts = ngrams(text)
    return dict(zip(grams.tolist(), counts.tolist(), strict=True))


def test_ngrams():
    for text in ["The cat, the CAT!", "é", "a b", "", None, "123 !!", "straße ΣΑΣ 日本 語", "x" * 50, "ab" * (1 << 20)]:
        assert counted(text) == {code(g): n for g, n in brute_ngrams(text).items()}, (text or "")[:20]


def test_profiles_and_predictions(spark):
    rows = [(i, "the cat sat on the mat with the hat", "en") for i in range(8)]
    rows += [(20 + i, "le chat est sur la table avec le chapeau", "fr") for i in range(8)]
    rows += [(40, None, "en"), (41, "", "fr"), (42, "12 !?", None), (43, "the hat", None), (None, "la table", "fr"), (0, "the cat", "fr")]
    docs = spark.createDataFrame([(*r, 1.0, "s") for r in rows], "doc_id long, text string, lang string, score double, gram string")
    profile = learn_profiles(docs, ranks=10)
    total = Counter()
    for _, text, lang in rows:
        if lang == "en":
            total += brute_ngrams(text)
    expected = [code(g) for g, _ in sorted(total.items(), key=lambda x: (-x[1], code(x[0])))[:10]]
    assert [r.gram for r in profile.where("lang = 'en'").orderBy("rank").collect()] == expected
    plan = learn_profiles(docs, ranks=10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    found = identify(docs)
    assert found.columns == ["doc_id", "text", "lang", "gram", "lang_pred", "score"]
    by_text = {r.text: (r.lang_pred, r.score) for r in found.collect()}
    assert by_text[None] == by_text[""] == by_text["12 !?"] == (UNKNOWN, 0.0)
    assert by_text["the hat"][0] == "en" and by_text["la table"][0] == "fr"
    assert all(0 <= s <= 1 for _, s in by_text.values())
    held = identify_held_out(docs).collect()
    assert len(held) == len(rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in held)


def test_distance_by_hand():
    class Row:
        def __init__(self, lang, gram, rank):
            self.lang, self.gram, self.rank = lang, code(gram), rank

    model = Profiles([Row("a", "x", 0), Row("a", "y", 2), Row("b", "y", 0)], ranks=5)
    # Ranks of "yyyx": y 0, then x, yx.. by count and code; out-of-profile n-grams cost 5 each.
    own = sorted(brute_ngrams("yyyx").items(), key=lambda x: (-x[1], code(x[0])))[:5]
    ranks = {"a": {"x": 0, "y": 2}, "b": {"y": 0}}
    cost = {k: sum(abs(v[g] - i) if g in v else 5 for i, (g, _) in enumerate(own)) for k, v in ranks.items()}
    best = min(sorted(cost), key=cost.get)
    assert model.predict("yyyx") == (best, 1 - cost[best] / (5 * len(own)))


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert identify(docs).collect()[0].lang_pred == UNKNOWN
    assert identify(docs.limit(0)).count() == 0
