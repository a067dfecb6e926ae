"""Readability formulas and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` with the denominator floored at 1."""
    return part / F.greatest(whole, F.lit(1))


def readability_score(
    language: Column, words: Column, syllables: Column, sentences: Column
) -> Column:
    """Kandel-Moles for French, Flesch-Kincaid grade for every other language."""
    sentence_length = ratio(words.cast("double"), sentences.cast("double"))
    word_syllables = ratio(syllables.cast("double"), words.cast("double"))
    # The published coefficients of both formulas.
    kandel_moles = F.lit(207.0) - F.lit(1.015) * sentence_length - F.lit(73.6) * word_syllables
    flesch_kincaid = F.lit(0.39) * sentence_length + F.lit(11.8) * word_syllables - F.lit(15.59)
    return F.when(language == "fr", kandel_moles).otherwise(flesch_kincaid)


def readability_index(language: Column) -> Column:
    return F.when(language == "fr", "Kandel-Moles").otherwise("Flesch-Kincaid Grade Level")
