"""Lemmas by distinct forms against a walk over the tokens."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lexiloom.local import local_table
from lexiloom.operators.lemmas import form_counts, form_lemmas, with_lemmas
from lexiloom.sources.sinks import write_table
from lexiloom.sources.tables import read_table
from tests.helpers import TOKENS, token_table

LEXICON = "language string, form string, lemma string, pos string"


def chosen(entries, language, token, pos, lemma):
    mine = [(e[2], e[3]) for e in entries if e[2] is not None and token is not None and language == e[0] is not None and e[1] == token.lower()]
    same = [x for x, tag in mine if tag is not None and tag == pos]
    free = [x for x, tag in mine if tag is None]
    every = {x for x, _ in mine}
    return min(same, default=min(free, default=every.pop() if len(every) == 1 else lemma))


@pytest.mark.parametrize("share", [1e-5, 0.02, 1.0])
def test_against_brute_force(spark, share):
    rng = random.Random(11)
    words = ["lies", "Lies", "was", "saw", "SAW", "é", "", None, "x" * 100, "only", "many"]
    tags = ["NN", "VB", None]
    rows = [
        ("a", f"d{i % 3}", rng.choice(["en", "fr", None]), 0, i, rng.choice(words), f"own{i}", rng.choice(tags), "O")
        for i in range(600)
    ]
    rows += rows[:20]
    entries = [
        ("en", "lies", "lie", "VB"), ("en", "lies", "lie2", "VB"), ("en", "lies", "lies", "NN"),
        ("en", "was", "be", None), ("fr", "was", "be", "VB"), ("en", "saw", "see", "VB"), ("en", "saw", "saw", "NN"),
        ("en", "only", "one", "JJ"), ("en", "many", "a", "JJ"), ("en", "many", "b", "RB"), ("en", "", "nothing", None),
        ("en", None, "z", None), (None, "only", "z", None), ("fr", "é", None, "NN"), ("fr", "x" * 100, "long", "NN"),
    ]
    tokens = token_table(spark, rows).withColumn("form", F.lit("clash"))
    lexicon = local_table(spark, entries, LEXICON)
    lemmas = form_lemmas(form_counts(tokens), lexicon, share)
    got = with_lemmas(tokens, lemmas)
    assert got.columns == tokens.columns
    expected = sorted(((*r[:6], chosen(entries, r[2], r[5], r[7], r[6]), *r[7:], "clash") for r in rows), key=str)
    names = [field.split()[0] for field in TOKENS.split(", ")] + ["form"]
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=str) == expected


def test_empty(spark):
    tokens = token_table(spark, [("a", "d", "en", 0, 0, "Was", "was", "VB", "O")])
    nothing = local_table(spark, [("en", "was", "be", None)], LEXICON).limit(0)
    assert with_lemmas(tokens, form_lemmas(form_counts(tokens), nothing)).collect()[0]["lemma"] == "was"
    none = tokens.limit(0)
    assert with_lemmas(none, form_lemmas(form_counts(none), nothing)).count() == 0


def test_a_million_forms(spark, tmp_path):
    """A lexicon beyond any broadcast, and a third of all tokens of one form."""
    lexicon = spark.range(1_000_000).select(
        F.lit("en").alias("language"),
        F.concat(F.lit("w"), "id").alias("form"),
        F.concat(F.lit("l"), F.expr("id div 3")).alias("lemma"),
        F.lit(None).cast("string").alias("pos"),
    )
    n = F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id") % 1_200_000)
    tokens = spark.range(300_000).select(
        F.lit("en").alias("language"), F.concat(F.lit("W"), F.abs(n)).alias("token"), F.lit("NN").alias("pos"), F.lit("?").alias("lemma")
    )
    path = str(tmp_path / "lemmas")
    write_table(form_lemmas(form_counts(tokens), lexicon), path, partition_by=None, cluster=False)
    lemmas = read_table(spark, path)
    assert [r["form"] for r in lemmas.where("frequent").collect()].count("w7") == 1
    assert lemmas.where("frequent").count() < 100_000
    got = with_lemmas(tokens, lemmas)
    wanted = F.expr("substr(token, 2) >= 0 AND lemma = CASE WHEN int(substr(token, 2)) < 1000000 THEN concat('l', int(substr(token, 2)) div 3) ELSE '?' END")
    assert got.count() == 300_000 and got.where(~wanted).count() == 0


def test_columns_are_checked(spark):
    tokens = token_table(spark, [])
    with pytest.raises(ValueError, match="form_counts"):
        form_counts(tokens.drop("pos"))
    with pytest.raises(ValueError, match="with_lemmas"):
        with_lemmas(tokens.drop("lemma"), tokens)
