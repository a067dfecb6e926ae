"""Lemmas from a full lexicon: distinct forms are looked up, tokens move at most once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.schemas import require_columns

#: A form with more than this part of all tokens is frequent, so there are fewer frequent forms than its inverse.
FREQUENT_SHARE = 1e-5
#: Longer forms are never frequent, which bounds the bytes of the table of frequent forms.
LONGEST_FREQUENT = 64

_FORM = ["language", "form", "pos"]


def form_counts(tokens: DataFrame) -> DataFrame:
    """(language, form, pos, n): rows of each lower-cased token and tag, NULL ones included."""
    require_columns(tokens, {"language", "token", "pos"}, "form_counts")
    return tokens.groupBy("language", F.lower("token").alias("form"), "pos").agg(
        F.count("*").alias("n")
    )


def form_lemmas(
    counts: DataFrame, lexicon: DataFrame, frequent_share: float = FREQUENT_SHARE
) -> DataFrame:
    """(language, form, pos, lemma, frequent) of the forms in the lexicon, and of all frequent forms.

    ``lexicon`` has ``language, form, lemma, pos``; its forms are lower case and its ``pos`` may be
    NULL for an entry of any tag. The lemma is that of an entry with the token's tag, else of one
    without a tag, else the only lemma that the form has; a form with several lemmas of other tags
    has none here. Of several entries for the same case the smallest lemma counts. Entries without form
    or lemma are ignored; an empty lexicon gives frequent forms without lemma.

    The lexicon is joined by language and form, so one that is stored in buckets of these isn't
    shuffled, and neither are its entries again: the choice between them has the same partitioning.
    """
    require_columns(counts, {*_FORM, "n"}, "form_lemmas")
    require_columns(lexicon, {"language", "form", "lemma", "pos"}, "lexicon")
    total = counts.agg(F.sum("n")).scalar()
    entries = lexicon.where("form IS NOT NULL AND lemma IS NOT NULL").select(
        "language", "form", F.col("pos").alias("_pos"), F.col("lemma").alias("_lemma")
    )
    tagged = F.when(F.col("_pos") == F.col("pos"), F.col("_lemma"))
    untagged = F.when(F.col("_pos").isNull(), F.col("_lemma"))
    least, most = F.min("_lemma"), F.max("_lemma")
    chosen = (
        counts.join(entries, ["language", "form"], "left")
        .groupBy(*_FORM, "n")
        .agg(
            F.coalesce(F.min(tagged), F.min(untagged), F.when(least == most, least)).alias("lemma")
        )
    )
    often = (F.col("n") > total * F.lit(frequent_share)) & (
        F.coalesce(F.length("form"), F.lit(0)) <= LONGEST_FREQUENT
    )
    return chosen.select(*_FORM, "lemma", often.alias("frequent")).where(
        "lemma IS NOT NULL OR frequent"
    )


def with_lemmas(tokens: DataFrame, lemmas: DataFrame) -> DataFrame:
    """``tokens`` with the lemmas of :func:`form_lemmas`; tokens without one keep their own.

    Fewer forms than ``1 / FREQUENT_SHARE`` are frequent, none of them long, so their table is
    broadcast whatever the corpus, and most tokens end there without moving. Only tokens of the other
    forms are shuffled, once, and each of these forms holds no more than that share of all
    tokens, so no partition of that join is hot (but for one of a very long form, which adaptive
    execution splits). Store ``lemmas`` first: both branches read it.
    """
    require_columns(tokens, {"language", "token", "pos", "lemma"}, "with_lemmas")
    require_columns(lemmas, {*_FORM, "lemma", "frequent"}, "with_lemmas")
    known = lemmas.select(
        *[F.col(name).alias(f"_{name}") for name in _FORM], F.col("lemma").alias("_lemma"), "frequent"
    )
    often, seldom = known.where("frequent").drop("frequent"), known.where("NOT frequent").drop("frequent")
    same = (
        F.col("language").eqNullSafe(F.col("_language"))
        & F.lower("token").eqNullSafe(F.col("_form"))
        & F.col("pos").eqNullSafe(F.col("_pos"))
    )

    def chosen(joined: DataFrame) -> DataFrame:
        def value(name: str) -> Column:
            return F.coalesce("_lemma", "lemma").alias("lemma") if name == "lemma" else F.col(f"`{name}`")

        return joined.select(*[value(name) for name in tokens.columns])

    often = F.broadcast(often)
    moved = tokens.join(often, same, "left_anti").join(seldom, same, "left")
    return chosen(tokens.join(often, same)).unionByName(chosen(moved))
