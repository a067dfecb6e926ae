"""Personal data: fixed patterns, and a skip-chain conditional random field that carries their labels to similar tokens."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import arrow_rows, stage

# The kinds in their order, the base patterns and their limits. Written so that long runs are read once:
# an address is looked up around its @, numbers from their first digit, and nothing matched is given back in vain.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS, MOST_PART = (13, 19), (9, 15), 255

#: Labels of tokens: nothing, then the kinds.
LABELS = len(KINDS) + 1
#: Distinct (features, label) patterns of tokens on which the node weights are fitted; counts are of all documents.
MOST_PATTERNS = 20_000
WORD_BUCKETS = 64
#: Potentials between tokens stay within this, so that a token's own features can outweigh one neighbour.
MOST_POTENTIAL = 4.0
#: Pairs of similar tokens with equal labels that are assumed before any is seen.
AGREED = 30.0
ROUNDS, DAMPING, SETTLED = 60, 0.3, 1e-4
#: Least marginal probability of a span that is no base span, in each of its tokens.
LEAST_PROBABILITY = 0.6
#: A phone number without its + may lack the country code and the area code.
LEAST_PHONE = 7

_ACTIVE = re.compile(r"[0-9@]")
_BLANK = re.compile(r"\s")
_PIECE = re.compile(r"\+?\(?[\w.%@-]++\)?")
_GAP = re.compile(r"[\x20().,/:-]{0,3}")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    numbers = [int(x) for x in reversed(digits)]
    return (sum(numbers[::2]) + sum(2 * x - 9 * (x > 4) for x in numbers[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        if local and (m := DOMAIN.match(text, at + 1)):
            yield at - local, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            # The next address can't begin before this @.
            done = at + 1
            at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and start; places count code points."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x[-3:] if len(x) > 3 else x) <= MOST_PART for x in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(_NOT_DIGIT.sub("", m[0])) <= PHONE_DIGITS[1]:
                out.append((3, m.start(), m.end()))
    return out


@dataclass
class Chain:
    """The tokens of a text that hold a digit or an @; all others can't be part of personal data.

    ``joined[i]`` says that only marks stand between token i and the one before. ``keys`` are (type, value) by which
    tokens count as repeated or similar.
    """

    spans: list[tuple[int, int]]
    labels: list[int]
    features: list[tuple[int, ...]]
    joined: list[bool]
    keys: list[list[tuple[int, str]]]


#: Types of keys: equal tokens, numbers that end alike, the part of an address before the @, equal runs of numbers.
KEY_TYPES = 4


def _bucket(n: int, edges: tuple[int, ...]) -> int:
    return sum(n >= x for x in edges)


_DIGITS, _LETTERS = (1, 2, 3, 4, 5, 7, 8, 10, 13, 20), (1, 3, 8)
#: Sizes of the features of a token, in their order.
FIELDS = (len(_DIGITS) + 1, len(_LETTERS) + 1, 3, 5, 4, 2, 2, 3, 10, 10, WORD_BUCKETS + 1)
BEFORE, AFTER = 8, 9
_OFFSETS = np.concatenate([[0], np.cumsum(FIELDS)[:-1]])


def _shape(piece: str, digits: int) -> int:
    if "@" in piece:
        return 1
    if piece[0] == "+":
        return 2
    if piece[0] == "(":
        return 3
    if sum(map(str.isalpha, piece)):
        return 4
    return 5 + _bucket(digits, (4, 5, 9, 13))


def tokens_of(text: str, base: list[tuple[int, int, int]]) -> Chain:
    """Tokens, what the base spans label them, their features and keys."""
    pieces: list[tuple[int, int]] = []
    at = 0
    while m := _ACTIVE.search(text, at):
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = blank.start() if (blank := _BLANK.search(text, m.end())) else len(text)
        for p in _PIECE.finditer(text, start, end):
            a, b = p.start(), p.end()
            while b > a and text[b - 1] in ".-%_":
                b -= 1
            while a < b and text[a] in ".-%_":
                a += 1
            if b > a and _ACTIVE.search(text, a, b):
                pieces.append((a, b))
        at = end
    n = len(pieces)
    words = [text[a:b] for a, b in pieces]
    numbers = [_NOT_DIGIT.sub("", w) for w in words]
    joined = [i > 0 and _GAP.fullmatch(text, pieces[i - 1][1], pieces[i][0]) is not None for i in range(n)]
    labels = [0] * n
    owner = 0
    # Spans by start; a token takes the first listed kind that overlaps it.
    by_start = sorted((a, b, kind) for kind, a, b in base)
    for i, (a, b) in enumerate(pieces):
        while owner < len(by_start) and by_start[owner][1] <= a:
            owner += 1
        found = []
        for j in range(owner, len(by_start)):
            if by_start[j][0] >= b:
                break
            if by_start[j][1] > a:
                found.append(by_start[j][2] + 1)
        labels[i] = min(found, default=0)
    shapes = [_shape(w, len(d)) for w, d in zip(words, numbers)]
    # Runs of numbers with marks only between them, told by the digits of all.
    run_digits: list[str] = [""] * n
    keys: list[list[tuple[int, str]]] = [[] for _ in range(n)]
    i = 0
    while i < n:
        j = i + 1
        while j < n and joined[j] and shapes[j] not in (1, 2, 4) and shapes[i] not in (1, 4):
            j += 1
        whole = "".join(numbers[i:j])
        for x in range(i, j):
            run_digits[x] = whole if len(whole) <= 2 * CARD_DIGITS[1] else ""
        if CARD_DIGITS[0] <= len(whole) <= CARD_DIGITS[1]:
            keys[i].append((3, whole))
        i = j
    features = []
    context = WORD_BUCKETS
    for i, (word, digits) in enumerate(zip(words, numbers)):
        letters = sum(map(str.isalpha, word))
        run = run_digits[i]
        check = 0 if not CARD_DIGITS[0] <= len(run) <= CARD_DIGITS[1] else 1 + luhn(run)
        if not joined[i]:
            # Joined tokens share the word before the first of them.
            before = text[max(0, pieces[i][0] - 40) : pieces[i][0]].split()
            context = zlib.crc32(before[-1].lower().encode("utf-8", "replace")) % WORD_BUCKETS if before else WORD_BUCKETS
        features.append(
            (
                _bucket(len(digits), _DIGITS), _bucket(letters, _LETTERS), min(word.count("@"), 2), min(word.count("."), 4),
                min(word.count("-"), 3), int(word[0] == "+"), int("(" in word or ")" in word), check,
                shapes[i - 1] if joined[i] else 0, shapes[i + 1] if i + 1 < n and joined[i + 1] else 0, context,
            )
        )
        plain = word.strip("+()").casefold()
        if len(plain) >= 4:
            keys[i].append((0, plain))
        if len(digits) >= LEAST_PHONE and not letters:
            keys[i].append((1, digits[-LEAST_PHONE:]))
        local, mark, _ = plain.partition("@")
        if len(local) >= 5 and (mark or letters):
            keys[i].append((2, local))
    return Chain(pieces, labels, features, joined, keys)


def similar_pairs(chain: Chain) -> Iterator[tuple[int, int, int]]:
    """(type, i, j) of tokens with an equal key; each is linked with the one before, so a text has few links per token."""
    last: dict[tuple[int, str], int] = {}
    for j, keys in enumerate(chain.keys):
        for key in keys:
            if key in last:
                yield key[0], last[key], j
            last[key] = j


@dataclass
class Model:
    """Weights of the field: of each feature's value by label, of joined tokens, of similar ones by type."""

    nodes: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def unary(self, features: list[tuple[int, ...]]) -> np.ndarray:
        if not features:
            return np.zeros((0, LABELS))
        return self.nodes[np.array(features) + _OFFSETS].sum(axis=1)


def fit_nodes(features: np.ndarray, labels: np.ndarray, counts: np.ndarray, steps: int = 300, decay: float = 1e-5) -> np.ndarray:
    """Multinomial logistic regression of labels on one-hot features, rows weighted by the root of their counts."""
    size = sum(FIELDS)
    nodes = np.zeros((size, LABELS))
    if not len(labels):
        nodes[: FIELDS[0], 0] = MOST_POTENTIAL
        return nodes
    at = features + _OFFSETS
    share = np.sqrt(counts)
    share = share / share.sum()
    truth = np.eye(LABELS)[labels]
    first, second = np.zeros_like(nodes), np.zeros_like(nodes)
    flat = at.ravel()
    for step in range(1, steps + 1):
        logits = nodes[at].sum(axis=1)
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        pull = np.repeat((p - truth) * share[:, None], at.shape[1], axis=0)
        slope = np.stack([np.bincount(flat, pull[:, y], size) for y in range(LABELS)], axis=1) + decay * nodes
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        nodes -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return nodes


def association(counts: np.ndarray, agreed: float = 0.0) -> np.ndarray:
    """How much more often two labels meet than by chance, as a logarithm within bounds.

    Every pair of labels is counted once more than seen, and every pair of equal ones ``agreed`` times more.
    """
    counts = counts + counts.T + 1.0 + agreed * np.eye(LABELS)
    share = counts / counts.sum()
    single = share.sum(axis=1)
    return np.clip(np.log(share / np.outer(single, single)), -MOST_POTENTIAL, MOST_POTENTIAL)


def fit(docs: DataFrame, text_column: str = "text", most_patterns: int = MOST_PATTERNS) -> Model:
    """The field's weights, learned from what the base patterns label in all documents.

    Piecewise: node weights are fitted to tokens by themselves, potentials are the association of the labels of
    joined and of similar tokens. Counts are of all documents. Node weights are fitted on at most ``most_patterns`` distinct pairs of features and
    label, by hash, with their counts. Of similar tokens, pairs of a labelled and an unlabelled one say nothing, since the
    patterns miss variants. No documents, or none with tokens, give a model that labels nothing.
    """
    schema = pa.schema([("kind", pa.int32()), ("key", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for x in batch.column(0):
                text = x.as_py()
                if not text or not _ACTIVE.search(text):
                    continue
                chain = tokens_of(text, base_spans(text))
                y = chain.labels
                for i, features in enumerate(chain.features):
                    found[0, f"{y[i]}:" + ",".join(map(str, features))] += 1
                    if chain.joined[i]:
                        found[1, f"{y[i - 1]},{y[i]}"] += 1
                for kind, i, j in similar_pairs(chain):
                    if bool(y[i]) == bool(y[j]):
                        found[2 + kind, f"{y[i]},{y[j]}"] += 1
            if found:
                yield arrow_rows(schema, [[k for k, _ in found], [key for _, key in found], list(found.values())])

    counted = docs.select(F.col(text_column).cast("string")).mapInArrow(run, "kind int, key string, n long")
    counted = stage(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "patterns")
    # Labels are few, so are their pairs; patterns are bounded.
    rows = counted.where("kind > 0").collect()
    by_hash = counted.where("kind = 0").orderBy(F.xxhash64("key"), "key").limit(most_patterns).collect()
    pairs = np.zeros((1 + KEY_TYPES, LABELS, LABELS))
    for r in rows:
        a, b = map(int, r.key.split(","))
        pairs[r.kind - 1, a, b] += r.n
    split = [r.key.split(":") for r in by_hash]
    features = np.array([list(map(int, x.split(","))) for _, x in split], np.int64).reshape(len(split), len(FIELDS))
    labels, counts = np.array([int(y) for y, _ in split], np.int64), np.array([r.n for r in by_hash], np.float64)
    # Every pattern also counts without the token before it and without the one after it: the base patterns always have
    # a number's first part, what they miss often lacks it.
    features = np.concatenate([features] + [np.where(np.arange(len(FIELDS)) == x, 0, features) for x in (BEFORE, AFTER)])
    nodes = fit_nodes(features, np.tile(labels, 3), np.tile(counts, 3))
    return Model(nodes, association(pairs[0]), np.stack([association(x, AGREED) for x in pairs[1:]]))


def marginals(unary: np.ndarray, a: np.ndarray, b: np.ndarray, potentials: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Beliefs of loopy sum-product message passing; exact where the links (a, b) are trees.

    ``potentials[e]`` is the matrix of link e, rows for labels of its first end. Messages are damped and end when they settle.
    """

    def normal(x: np.ndarray) -> np.ndarray:
        x = x - x.max(axis=1, keepdims=True)
        return x - np.log(np.exp(x).sum(axis=1, keepdims=True))

    n, e = len(unary), len(a)
    # Messages from a to b, then from b to a.
    source, target = np.concatenate([a, b]), np.concatenate([b, a])
    matrix = np.concatenate([potentials, potentials.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(e, 2 * e), np.arange(e)])
    messages = np.zeros((2 * e, unary.shape[1]))

    def beliefs() -> np.ndarray:
        got = np.stack([np.bincount(target, messages[:, y], n) for y in range(unary.shape[1])], axis=1)
        return unary + got

    for _ in range(rounds if e else 0):
        cavity = beliefs()[source] - messages[back]
        x = cavity[:, :, None] + matrix
        top = x.max(axis=1, keepdims=True)
        new = normal((top + np.log(np.exp(x - top).sum(axis=1, keepdims=True)))[:, 0])
        change = np.abs(new - messages).max()
        messages = DAMPING * messages + (1 - DAMPING) * new
        if change < SETTLED:
            break
    return np.exp(normal(beliefs())) if n else unary


def infer(chains: list[Chain], model: Model) -> list[np.ndarray]:
    """Marginals of each text's tokens; texts share no links, so many are worked out at once. Tokens of
    base spans are observed, the others get their labels from features, joined and similar tokens."""
    starts = np.cumsum([0] + [len(c.spans) for c in chains])
    unary = model.unary([f for c in chains for f in c.features])
    observed = np.array([y for c in chains for y in c.labels], np.int64)
    sure = np.flatnonzero(observed)
    unary[sure] = -50.0
    unary[sure, observed[sure]] = 0.0
    a, b, kinds = [], [], []
    for start, c in zip(starts.tolist(), chains):
        for i, joined in enumerate(c.joined):
            if joined:
                a.append(start + i - 1)
                b.append(start + i)
                kinds.append(0)
        for kind, i, j in similar_pairs(c):
            a.append(start + i)
            b.append(start + j)
            kinds.append(1 + kind)
    potentials = np.concatenate([model.chain[None], model.skip])[np.array(kinds, np.int64)].reshape(len(kinds), LABELS, LABELS)
    found = marginals(unary, np.array(a, np.int64), np.array(b, np.int64), potentials)
    return [found[x:y] for x, y in zip(starts, starts[1:])]


def _plausible(kind: int, text: str) -> bool:
    """Whether a span that no pattern finds can be of its kind at all."""
    digits = _NOT_DIGIT.sub("", text)
    if kind == 3:
        return LEAST_PHONE <= len(digits) <= PHONE_DIGITS[1] and not any(map(str.isalpha, text))
    if kind == 2:
        return CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits)
    if kind == 1:
        parts = [x for x in _NOT_DIGIT.split(text) if x]
        return len(parts) == 4 and all(len(x) <= 3 and int(x) <= MOST_PART for x in parts) and not any(map(str.isalpha, text))
    return len(text) >= 5


def added_spans(text: str, chain: Chain, found: np.ndarray, base: list[tuple[int, int, int]], least: float) -> list[tuple[int, int, int]]:
    """Runs of joined tokens of one kind, each at least as probable as ``least``, that overlap no base span."""
    best = found.argmax(axis=1)
    best[found.max(axis=1) < least] = 0
    out, i, n = [], 0, len(chain.spans)
    taken = sorted((a, b) for _, a, b in base)
    at = 0
    while i < n:
        if not best[i] or chain.labels[i]:
            i += 1
            continue
        j = i + 1
        while j < n and chain.joined[j] and best[j] == best[i] and not chain.labels[j] and best[i] != 1:
            j += 1
        a, b = chain.spans[i][0], chain.spans[j - 1][1]
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if not (at < len(taken) and taken[at][0] < b) and _plausible(int(best[i]) - 1, text[a:b]):
            out.append((int(best[i]) - 1, a, b))
        i = j
    return out


def find_personal(
    docs: DataFrame,
    model: Model | None = None,
    least: float = LEAST_PROBABILITY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row; spans are (kind, start, end) by kind and start.

    Base spans are the fixed patterns; they count and stay whatever the model says. The model (of these
    documents, unless given) adds spans: numbers and addresses written in other ways, above all those that repeat or resemble
    a base span anywhere in the document. Tokens with a digit or an @ are nodes; those joined by marks only and those
    with equal or similar text, at any distance, are linked, and loopy message passing settles their labels. A base span's tokens are observed. An added span never overlaps a base span.

    Places count code points; the end is exclusive. Null texts count as empty and have no spans; an empty table has
    no rows. Rows are judged one by one, so repeated rows get equal spans; equal scores go to the kind listed first. Texts of any length
    are read whole and in time proportional to them; one text must fit into a task. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs, text_column))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("id", pa.string()), ("n_base", pa.list_(pa.int64())), ("base_sha256", pa.string()), ("spans", pa.list_(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() or "" for x in batch.column(1)]
            bases, more = [], [[] for _ in texts]
            places, chains = [], []
            for i, text in enumerate(texts):
                active = _ACTIVE.search(text) is not None
                bases.append(base_spans(text) if active else [])
                if active:
                    places.append(i)
                    chains.append(tokens_of(text, bases[i]))
            for i, chain, found in zip(places, chains, infer(chains, shared.value)):
                more[i] = added_spans(texts[i], chain, found, bases[i], least)
            counts = [[sum(k == kind for k, _, _ in x) for kind in range(len(KINDS))] for x in bases]
            digests = [hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in x).encode()).hexdigest() for x in bases]
            spans = [[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(x + y)] for x, y in zip(bases, more)]
            yield arrow_rows(schema, [batch.column(0), counts, digests, spans])

    rows = docs.select(F.col(id_column).cast("string"), F.col(text_column).cast("string"))
    out = rows.mapInArrow(run, "id string, n_base array<long>, base_sha256 string, spans array<struct<kind: string, start: long, end: long>>")
    return out.select(
        F.col("id").cast(docs.schema[id_column].dataType).alias(id_column),
        *[F.col("n_base")[i].alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        "base_sha256",
        "spans",
    )
