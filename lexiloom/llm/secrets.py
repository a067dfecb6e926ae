"""Secret scan: fixed patterns, and random strings by their characters per token."""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import arrow_rows

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's tokenizer cuts a text before merging bytes.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The base patterns and the order of the kinds.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

#: A random string has at least so many characters, and at most so many of them per token.
LEAST_RANDOM = 20
MOST_PER_TOKEN = 2.0
#: A random string inside a longer run has at least so many characters in parts that are no words.
LEAST_STRANGE = 16
#: Longer runs are tokenized in pieces of this length, which keeps the time in proportion to them.
PIECE = 512
RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
_KEYWORDS = ("passw", "secret", "token", "api")
_DIGEST = re.compile(r"[0-9a-fA-F]+")
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_INNER_IDENTIFIER = re.compile(rf"(?<![0-9A-Za-z])(?:{_UUID.pattern}|{'|'.join(f'[0-9a-fA-F]{{{n}}}' for n in DIGEST_LENGTHS)})(?![0-9A-Za-z])")
_BETWEEN_MARKS = re.compile(r"[^+/_=-]+")
#: Words, numbers and CamelCase parts joined by marks: names, paths, dates, versions.
#: A part matches in one way only, and nothing matched is given back: a failure costs the length of the run.
_PART = r"(?:[A-Z]?[a-z]++|[A-Z]++|[0-9]++)"
_NAME = re.compile(rf"[+/_=-]*+{_PART}(?:[+/_=-]++{_PART})*+[+/_=-]*+")
_ANY_PART = re.compile(_PART)
_CAMEL = re.compile(r"[a-z]*([A-Z][a-z]{2,})+[0-9]{0,4}")

#: What ends an address: blanks, quotes, commas, brackets, bars, backslashes; its path also at the marks of a query.
_STOP = r"""\s"'`<>(){}\[\],|\\"""
#: User info after ``://``, up to the last @ before the path; a password that is no port may hold the path's marks.
_USER = re.compile(rf"[^/?#{_STOP}]*@|[^/?#:@{_STOP}]*:(?![0-9]*(?:[/?#&;{_STOP}]|\Z))[^{_STOP}]*@")
_PLACE = re.compile(rf"(?:\[[0-9A-Fa-f:.]*\]|[^/?#:&;{_STOP}]*)(?::[0-9]*(?![^/?#&;{_STOP}]))?(?:/[^?#&;{_STOP}]*)?")
_QUERY = re.compile(rf"\?[^#{_STOP}]*")
_PARAMETER = re.compile(r"(?<=[?&;])([^=&;]*)=([^&;]*)")
_MAIL = re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++)@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")


@cache
def _encoding(vocabulary: bytes, pieces: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
    return tiktoken.Encoding("scan", pat_str=pieces, mergeable_ranks=ranks, special_tokens={})


def is_identifier(run: str) -> bool:
    return bool(len(run) in DIGEST_LENGTHS and _DIGEST.fullmatch(run)) or bool(_UUID.fullmatch(run))


def is_plain(run: str) -> bool:
    """Whether a run has the shape of names, paths, dates or numbers; keys of one case have it too."""
    return bool(_NAME.fullmatch(run) or _CAMEL.fullmatch(run))


def is_known(run: str) -> bool:
    """Digests, identifiers and what has the shape of a name; that shape alone says nothing about its parts."""
    return is_identifier(run) or is_plain(run)


def _tokens(run: str, encoding: tiktoken.Encoding) -> int:
    return sum(len(encoding.encode_ordinary(run[i : i + PIECE])) for i in range(0, len(run), PIECE))


def is_word(part: str, encoding: tiktoken.Encoding) -> bool:
    """Whether the vocabulary has a part of a name, in lower case, as one token, at the start of a word or inside."""
    low = part.lower()
    return len(low) <= PIECE and (len(encoding.encode_ordinary(" " + low)) == 1 or len(encoding.encode_ordinary(low)) == 1)


def is_random(run: str, encoding: tiktoken.Encoding, most_per_token: float = MOST_PER_TOKEN) -> bool:
    if len(run) < LEAST_RANDOM or is_identifier(run):
        return False
    tokens = _tokens(run, encoding)
    if len(run) > most_per_token * tokens:
        return False
    if not is_plain(run):
        return True
    # The vocabulary has few words in capitals: names are judged as in lower case.
    if len(run) > most_per_token * _tokens(run.lower(), encoding):
        return False
    return not all(is_word(m[0], encoding) for m in _ANY_PART.finditer(run))


def is_familiar(part: str, encoding: tiktoken.Encoding, most_per_token: float = MOST_PER_TOKEN) -> bool:
    """Whether a part of a run is a word of the vocabulary, CamelCase, or costs as few tokens as words do."""
    if is_word(part, encoding) or _CAMEL.fullmatch(part):
        return True
    one_case = part.isalpha() and (part.isupper() or part[1:].islower())
    return len(part) > most_per_token * _tokens(part.lower() if one_case else part, encoding)


def random_parts(run: str, encoding: tiktoken.Encoding, most_per_token: float = MOST_PER_TOKEN) -> list[tuple[int, int]]:
    """(start, end) of the random strings in a run: whole pieces of it, or what words around them leave.

    A run is cut at UUIDs and digests. A piece that is not random as a whole is judged from its first to its last part
    that is not familiar, so a key keeps its own marks; if that is not random, by the stretches without familiar parts.
    """
    out, at = [], 0
    for end, following in [*[m.span() for m in _INNER_IDENTIFIER.finditer(run)], (len(run), len(run))]:
        if end - at < LEAST_RANDOM:
            at = following
            continue
        if is_random(run[at:end], encoding, most_per_token):
            out.append((at, end))
            at = following
            continue
        stretches: list[list[tuple[int, int]]] = [[]]
        for m in _BETWEEN_MARKS.finditer(run, at, end):
            if not is_familiar(m[0], encoding, most_per_token):
                stretches[-1].append(m.span())
            elif stretches[-1]:
                stretches.append([])

        def found(parts: list[tuple[int, int]], end: int = end) -> list[tuple[int, int]]:
            if sum(b - a for a, b in parts) < LEAST_STRANGE:
                return []
            a, b = parts[0][0], parts[-1][1]
            if not run[b:end].strip("="):
                b = end
            return [(a, b)] if is_random(run[a:b], encoding, most_per_token) else []

        out += found([x for parts in stretches for x in parts]) or [x for parts in stretches for x in found(parts)]
        at = following
    return out


def _outside(a: int, b: int, spans: list[tuple[int, int]], first: int) -> Iterator[tuple[int, int]]:
    """What disjoint ``spans``, in order and from number ``first`` on, leave of a stretch."""
    for i in range(first, len(spans)):
        x, y = spans[i]
        if x >= b:
            break
        if x > a:
            yield a, x
        a = max(a, y)
    if a < b:
        yield a, b


def _merged(base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, _, b in base:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def base_spans(text: str, long: list[tuple[int, str]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; ``long`` has the places of the long words."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    for at, word in long:
        if len(word) >= LEAST_HEX:
            out += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(word) if len(m[0]) >= LEAST_HEX]
    return sorted(out)


def long_words(text: str, least: int) -> list[tuple[int, str]]:
    """(place, word) of the words of at least ``least`` characters between white space."""
    out, at = [], 0
    for word in [w for w in text.split() if len(w) >= least]:
        at = text.index(word, at)
        out.append((at, word))
        at += len(word)
    return out


def without_addresses(word: str) -> str:
    """The word with blanks in place of addresses: scheme, host and path of a URL, and mail addresses.

    User info, fragments and query values stay, each value apart from its name; the value of a parameter
    ``id`` is an identifier by its name and goes. What stands before the @ of a mail address stays after a
    colon, the place of a password, but for ``mailto:``.
    """
    if "://" not in word and "@" not in word:
        return word
    out = list(word)

    def cut(a: int, b: int) -> None:
        out[a:b] = " " * (b - a)

    at = word.find("://")
    while at >= 0:
        following = word.find("://", at + 3)
        # Addresses in addresses are cut one by one, so every character is read a fixed number of times.
        part = word[at + 3 : following if following >= 0 else len(word)]
        user = _USER.match(part)
        start = user.end() if user else 0
        place = _PLACE.match(part, start)
        cut(at, at + 3)
        cut(at + 3 + max(start - 1, 0), at + 3 + place.end())
        if query := _QUERY.match(part, place.end()):
            for m in _PARAMETER.finditer(part, query.start(), query.end()):
                cut(at + 3 + m.end(1), at + 3 + (m.end() if m[1].lower() == "id" else m.end(1) + 1))
        at = following
    rest = "".join(out)
    for m in _MAIL.finditer(rest):
        before = rest[max(0, m.start() - 7) : m.start()].lower()
        cut(m.end(1) if before.endswith(":") and before != "mailto:" else m.start(), m.end())
    return "".join(out)


def scan(text: str, encoding: tiktoken.Encoding, most_per_token: float = MOST_PER_TOKEN) -> tuple[list, list]:
    """Base spans, and all spans with those of random strings that overlap no base span."""
    long = long_words(text, LEAST_RANDOM)
    base = base_spans(text, long)
    covered = _merged(base)
    ends = [y for _, y in covered]
    more = []
    for at, word in long:
        for m in RUN.finditer(without_addresses(word)):
            first = bisect_right(ends, at + m.start())
            for a, b in _outside(at + m.start(), at + m.end(), covered, first):
                more += [(a + x, 3, a + y) for x, y in random_parts(text[a:b], encoding, most_per_token)]
    return base, sorted(base + more)


def find_secrets(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    most_per_token: float = MOST_PER_TOKEN,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, spans) per row: an array of (kind, start, end), by start and then by kind.

    Places count code points; the end is exclusive. ``assign``, ``access`` and ``hex`` are the fixed
    patterns. ``random`` adds runs of 20 or more letters, digits and ``+/_=-`` outside other spans that cost a token per two
    characters or fewer, unless they are digests, identifiers, names or parts of an address
    (see :func:`without_addresses`). Of a run that costs less, the parts are judged (see :func:`random_parts`); shorter runs
    are not. Texts of any length take time in proportion; an empty table gives no rows. Names are words, numbers and CamelCase parts joined by marks that are all tokens of
    the vocabulary, or cost fewer tokens in lower case; keys of one case are no names by their shape. Null texts count as empty; rows are judged one by one, so repeated rows get
    equal spans; other columns are not read. The vocabulary, a file of one known size on the driver,
    goes to the tasks as a broadcast variable.
    """
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("id", pa.string()), ("n_base", pa.list_(pa.int64())), ("base_sha256", pa.string()), ("spans", pa.list_(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(shared.value, PIECES)
        for batch in batches:
            counts, digests, spans = [], [], []
            for x in batch.column(1):
                base, found = scan(x.as_py() or "", encoding, most_per_token)
                counts.append([sum(k == kind for _, k, _ in base) for kind in range(3)])
                digests.append(hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base).encode()).hexdigest())
                spans.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in found])
            yield arrow_rows(schema, [batch.column(0), counts, digests, spans])

    rows = docs.select(F.col(id_column).cast("string"), F.col(text_column))
    out = rows.mapInArrow(run, "id string, n_base array<long>, base_sha256 string, spans array<struct<kind: string, start: long, end: long>>")
    return out.select(
        F.col("id").cast(docs.schema[id_column].dataType).alias(id_column),
        *[F.col("n_base")[i].alias(f"n_{KINDS[i]}") for i in range(3)],
        "base_sha256",
        "spans",
    )
