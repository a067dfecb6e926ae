"""Small built-in lexicons: closed-class words and irregular forms of English and French.

They stand in for pretrained models, which are not part of this engine. A full lexicon
can be given to :func:`lexiloom.operators.annotate.annotate_chunks` as a table instead.
Entries are ``form`` or ``form:lemma``; English carries Penn tags, French universal ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.local import local_table

LEXICON_COLUMNS = "language string, form string, lemma string, pos string"
SUFFIX_COLUMNS = "language string, suffix string, pos string, cut int, ending string"

ENGLISH = {
    "DT": "the a an:a this that these:this those:that every each some any no another",
    "PDT": "all both half such",
    "WDT": "which whatever",
    "CC": "and or but nor yet",
    "IN": (
        "of in on at by for with from as into about after before over under between "
        "through during against without within upon than if because while although "
        "though since until"
    ),
    "TO": "to",
    "PRP": "i he she it we they you me:i him:he us:we them:they myself himself herself itself",
    "PRP$": "my your his its our their her:she",
    "WP": "who whom:who what",
    "WP$": "whose",
    "WRB": "when where why how",
    "EX": "there",
    "MD": "can could:can will would:will shall should:shall may might:may must",
    "VB": "be have do say go come see take make know give get tell think find",
    "VBP": "am:be are:be",
    "VBZ": "is:be has:have does:do",
    "VBD": (
        "was:be were:be had:have did:do said:say went:go came:come saw:see took:take "
        "made:make knew:know gave:give got:get told:tell thought:think found:find"
    ),
    "VBN": "been:be done:do gone:go seen:see taken:take known:know given:give",
    "VBG": "being:be having:have",
    "RB": "not never very too also then now here so only just again ever always often",
    "NNS": "men:man women:woman children:child feet:foot teeth:tooth mice:mouse people:person",
    "JJR": "better:good worse:bad more:much less:little",
    "JJS": "best:good worst:bad most:much least:little",
    "UH": "oh ah yes",
}

ENGLISH_MARKS = {
    ".": ". ! ? … ... ?! !?",
    ",": ",",
    ":": ": ; -- — – ―",
    "``": "« “ ‘",
    "''": "» ” ’ \" '",
    "-LRB-": "( [ {",
    "-RRB-": ") ] }",
    "HYPH": "-",
}

FRENCH = {
    "DET": (
        "le la:le les:le un une:un des:un ce cet:ce cette:ce ces:ce mon ma:mon mes:mon "
        "ton ta:ton tes:ton son sa:son ses:son notre nos:notre votre vos:votre "
        "leurs:leur quelque quelques:quelque chaque tout toute:tout toutes:tout tous:tout"
    ),
    "ADP": "de à en dans par pour sur avec sans sous chez entre vers du:de au:à aux:à",
    "CCONJ": "et ou mais donc or ni car",
    "SCONJ": "que si comme quand lorsque puisque",
    "PRON": "je tu il elle nous vous ils:il elles:elle on se me te lui leur qui quoi dont où",
    "AUX": (
        "être est:être sont:être était:être étaient:être fut:être suis:être sera:être "
        "été:être avoir a:avoir ai:avoir ont:avoir avait:avoir avaient:avoir eut:avoir"
    ),
    "VERB": (
        "faire fait:faire dire dit:dire aller va:aller vont:aller pouvoir peut:pouvoir "
        "pouvait:pouvoir veut:vouloir voit:voir vient:venir"
    ),
    "ADV": "ne pas plus très bien aussi encore toujours jamais ici là alors",
    "NOUN": "yeux:œil",
    "INTJ": "oh ah oui non",
}


# Word endings by tag: ``suffix`` keeps the word as lemma, ``suffix:ending`` replaces the
# suffix, ``suffix:-`` drops it. The longest suffix after at least three letters applies.
ENGLISH_SUFFIXES = {
    "RB": "ly",
    "VBG": "ing:-",
    "VBD": "ed:- ied:y",
    "JJS": "est:-",
    "JJ": "ous ful ive able ible al ic less ish",
    "NNS": "s:- ies:y sses:ss xes:x zes:z ches:ch shes:sh",
    "NN": "ss us is",
}

FRENCH_SUFFIXES = {
    "ADV": "ment",
    "ADJ": "eux euse if ive ique able ible elle el al",
    "VERB": (
        "er ir oir ait:er aient:er ant:er ons:er ez:er é:er ée:er és:er ées:er"
    ),
    "NOUN": "eaux:eau aux:al s:- x:-",
}


def entries(language: str, tagged: dict[str, str]) -> list[tuple[str, str, str, str]]:
    rows = []
    for pos, words in tagged.items():
        for word in words.split():
            # A colon between letters separates form and lemma; a lone colon is a mark.
            form, _, lemma = word.partition(":") if len(word) > 1 else (word, "", "")
            rows.append((language, form, lemma or form, pos))
    return rows


def suffix_entries(language: str, tagged: dict[str, str]) -> list[tuple[str, str, str, int, str]]:
    rows = []
    for pos, rules in tagged.items():
        for rule in rules.split():
            suffix, _, ending = rule.partition(":")
            cut = len(suffix) if ending else 0
            rows.append((language, suffix, pos, cut, ending.replace("-", "")))
    return rows


def builtin_rows() -> list[tuple[str, str, str, str]]:
    return entries("en", ENGLISH) + entries("en", ENGLISH_MARKS) + entries("fr", FRENCH)


def suffix_rows() -> list[tuple[str, str, str, int, str]]:
    return suffix_entries("en", ENGLISH_SUFFIXES) + suffix_entries("fr", FRENCH_SUFFIXES)


def suffix_pattern(language: str) -> str:
    """Regular expression whose group is the suffix that applies to a word."""
    suffixes = [row[1] for row in suffix_rows() if row[0] == language]
    return f"...({'|'.join(suffixes)})$"


def suffix_of(word: Column, language: str) -> Column:
    """The suffix that applies to a word, as :func:`suffix_pattern` finds it; '' without any.

    Ends of a word are compared with the few suffixes of their length, which costs a fraction of a
    regular expression that is tried at every letter.
    """
    suffixes = {row[1] for row in suffix_rows() if row[0] == language}
    found = F.lit("")
    for size in sorted({len(suffix) for suffix in suffixes}):
        end = F.substring(word, -size, size)
        known = end.isin(sorted(x for x in suffixes if len(x) == size))
        # Fixed value: the letters before a suffix.
        found = F.when((F.length(word) >= size + 3) & known, end).otherwise(found)
    return found


def builtin_lexicon(spark: SparkSession) -> DataFrame:
    return local_table(spark, builtin_rows(), LEXICON_COLUMNS)


def suffix_table(spark: SparkSession) -> DataFrame:
    return local_table(spark, suffix_rows(), SUFFIX_COLUMNS)
