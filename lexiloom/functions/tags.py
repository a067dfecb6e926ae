"""Part-of-speech tag sets and the expressions built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags that are not words, entity tags, tags shown in distributions.
NON_WORD_TAGS = ["PUNCT", "SYM", "X"]
ENTITY_TAGS = ["PROPN", "NNP", "NNPS"]
REPORTED_TAGS = ["NOUN", "VERB", "ADJ", "PROPN", "ADV", "DET", "PUNCT"]

# Penn Treebank tags by their Universal Dependencies counterpart.
PENN_BY_UNIVERSAL = {
    "NOUN": ["NN", "NNS"],
    "PROPN": ["NNP", "NNPS"],
    "VERB": ["VB", "VBD", "VBG", "VBN", "VBP", "VBZ"],
    "ADJ": ["JJ", "JJR", "JJS"],
    "ADV": ["RB", "RBR", "RBS"],
    "DET": ["DT", "PDT", "WDT"],
    "PUNCT": [".", ",", ":", ";", "''", "``", "-LRB-", "-RRB-", "HYPH", "NFP"],
}

# Tokens that end a sentence for readability and for dialog dashes.
SENTENCE_END = [".", "!", "?", "…", "...", "?!", "!?"]
DIALOG_SENTENCE_END = [".", "!", "?", "…", "?!", "!?"]


def universal_tag(pos: Column) -> Column:
    """Map Penn tags to universal ones; any other tag stays as it is."""
    mapped = None
    for universal, penn in PENN_BY_UNIVERSAL.items():
        hit = pos.isin(penn)
        mapped = F.when(hit, universal) if mapped is None else mapped.when(hit, universal)
    return mapped.otherwise(pos)


def entity_flag(pos: Column) -> Column:
    return F.when(pos.isin(ENTITY_TAGS), "ENT").otherwise("O")


def is_lexical(pos: Column) -> Column:
    """True for word tags, false for the others, NULL (so dropped by a filter) for NULL."""
    return ~pos.isin(NON_WORD_TAGS)
