"""Column expressions over text: cleaning, counting, chunking, tokenising, syllables.

All of them are Spark built-ins, so they run inside the JVM next to the scan and no
text crosses into a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every blank character but the space. Java's \s knows only some of them.
# Single ASCII characters are listed one by one, which Java matches with one bit test.
OTHER_BLANK = (
    r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x{85}\x{a0}"
    r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
BLANK = r"\x20" + OTHER_BLANK
_BLANK_CHARACTERS = "".join(
    map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

# The licence markers of the e-text archive, as they occur in the files.
_START_MARKER = r"\*\*\*[BLANK]*START OF (?:THE|THIS) PROJECT GUTENBERG EBOOK.*?\*\*\*"
_END_MARKER = r"\*\*\*[BLANK]*END OF (?:THE|THIS) PROJECT GUTENBERG EBOOK.*?\*\*\*"

# Vowel sets of the syllable heuristic, both cases.
VOWELS = {
    "en": "aeiouyAEIOUYİı",
    "fr": "aeiouyàâäéèêëîïôùûüœæAEIOUYÀÂÄÉÈÊËÎÏÔÙÛÜŒÆİı",
}

# A token counts as a word as soon as one character is a letter, a non-decimal
# numeral or an underscore.
WORD_CHARACTER = r"[\p{L}\p{Nl}\p{No}_]"

# Groups keep what they have matched: Java matches such a group in a loop, any other one by a
# call per repetition, which ends the executor on a few thousand parts without a blank.
TOKEN_PATTERN = (
    r"[\p{L}\p{M}]++(?:['’-][\p{L}\p{M}]++)*+"
    r"|\p{Nd}++(?:[.,]\p{Nd}++)*+"
    r"|\.\.\."
    r"|--"
    rf"|[^\p{{L}}\p{{M}}\p{{Nd}}{BLANK}]"
)

DEFAULT_CHUNK_CHARS = 4000


def unix_newlines(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def strip_blank(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANK_CHARACTERS))


def single_spaced(text: Column) -> Column:
    """Every run of blanks as one space, none outside; runs that are one already stay."""
    # Most characters are ASCII ones, or a space before one: two cheap tests leave them out.
    worth = r"[^!-~](?<=[^ -~]|[^!-~](?=[^!-~]))"
    packed = F.regexp_replace(text, rf"{worth}(?:(?<= )[{BLANK}]++|(?<=[{OTHER_BLANK}])[{BLANK}]*+)", " ")
    return F.trim(packed)


def without_head(text: Column) -> Column:
    """Drop everything up to the end of the first start marker."""
    marker = _START_MARKER.replace("BLANK", BLANK)
    return F.regexp_replace(text, rf"(?isu)\A.*?{marker}", "")


def without_tail(text: Column) -> Column:
    """Drop everything from the first end marker on."""
    marker = _END_MARKER.replace("BLANK", BLANK)
    return F.regexp_replace(text, rf"(?isu){marker}.*\z", "")


def without_boilerplate(text: Column) -> Column:
    """The stripped text between the licence markers; '' for NULL."""
    body = unix_newlines(F.coalesce(text, F.lit("")))
    return strip_blank(without_tail(without_head(body)))


def normalised(text: Column) -> Column:
    """Unix newlines, at most one blank line in a row, single spaces, no outer spaces.

    Each step reads its input once: filters on the result are pushed below it, and nested
    conditions on the same text would multiply with every step. The patterns match only
    what changes, because replacing each single space by itself is what costs.
    """
    text = unix_newlines(F.coalesce(text, F.lit("")))
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    text = F.regexp_replace(F.replace(text, F.lit("\t"), F.lit(" ")), "  +", " ")
    return F.trim(text)


def is_blank(text: Column) -> Column:
    return F.length(F.trim(text)) == 0


def word_count(text: Column) -> Column:
    """Number of pieces between runs of white space; 0 for blank text."""
    return F.when(is_blank(text), 0).otherwise(F.regexp_count(text, F.lit(r"\s+")) + 1)


def sentences(text: Column) -> Column:
    return F.when(is_blank(text), F.array().cast("array<string>")).otherwise(
        F.split(text, r"(?<=[.!?])\s+")
    )


def chunks(text: Column, max_chars: int = DEFAULT_CHUNK_CHARS) -> Column:
    """Greedy word packing as one regular-expression pass.

    On single-spaced text, a chunk is the longest run of at most ``max_chars``
    characters that ends at a word end; a longer word stands alone. The first chunk of a
    text has one character less, because the packing rule charges every word of it for a
    following space.
    """
    if max_chars < 1:
        raise ValueError("max_chars must be positive")
    packed = single_spaced(F.coalesce(text, F.lit("")))
    options = []
    if max_chars >= 2:
        options.append(rf"\A[^ ].{{0,{max_chars - 2}}}(?= |\z)")
    options.append(rf"[^ ].{{0,{max_chars - 1}}}(?= |\z)")
    options.append("[^ ]+")
    return F.regexp_extract_all(packed, F.lit("(?s)" + "|".join(options)), F.lit(0))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def syllables(token: Column, language: Column) -> Column:
    """Vowel runs of the token, at least 1 for a word and 0 for anything else."""
    runs = F.when(
        language == "fr", F.regexp_count(token, F.lit(f"[{VOWELS['fr']}]+"))
    ).otherwise(F.regexp_count(token, F.lit(f"[{VOWELS['en']}]+")))
    return F.when(token.rlike(WORD_CHARACTER), F.greatest(F.lit(1), runs)).otherwise(0)
