"""Personal data by patterns and a skip-chain conditional random field.

Patterns find emails, IP addresses, card and phone numbers. A random field over the words that
hold a digit or an ``@`` then labels those the patterns missed: neighbouring words share
transition potentials. Mentions of a document that repeat each other, however far apart, share
skip potentials: runs of number words with the same digits, phone numbers without their first
digits, the same mailbox. Words in a pattern's span keep its label. Loopy belief propagation
carries labels along both kinds of edges; a mention whose label is likely enough, and which
repeats one that the patterns labelled so, becomes a span. Numbers that failed a pattern's test and
are repeated nowhere in a span are thus left alone.

All potentials are estimated from a bounded sample of such words, labelled by the patterns; the
features are the shape of the word and of the word before, never the match itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

from .shared import hashed_share

KINDS = ("email", "ip", "card", "phone")
SPACES = " \t\n\x0b\x0c\r"
#: Words that the field is fitted on at most, and the longest text that it is fitted on, always as a whole.
FIT_WORDS, FIT_CHARS = 20_000, 20_000
#: Likelihood from which a mention is a span, if it repeats a pattern's span of that kind.
CERTAIN = 0.5
ROUNDS, DAMPING = 20, 0.5
BATCH_BYTES = 4 << 20
#: Least digits that make two mentions alike, and most weight of an edge between such words.
SAME_DIGITS, MOST_SKIP = 7, 6.0

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# An address starts where a run of digits does, since a shorter start would match from there too.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_WORD = re.compile(r"[^ \t\n\x0b\x0c\r]*")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, sought around each ``@`` so that long runs cost no more than once."""
    least, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > least and _LOCAL.match(text[start - 1]):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        least = found.end() if found else at + 1
        at = text.find("@", least)


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by start and kind; code points, end exclusive."""
    found: list[Span] = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        # A longer part than three digits may still be a small number with zeros in front.
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    """Places of the words that hold a digit or an ``@``."""
    found, least = [], 0
    hint = _HINT.search(text)
    while hint:
        start = hint.start()
        while start > least and text[start - 1] not in SPACES:
            start -= 1
        least = _WORD.match(text, hint.end()).end()
        found.append((start, least))
        hint = _HINT.search(text, least)
    return found


def _shape(word: str) -> list[int]:
    """Numbers of the features a word has, each from a small range of its own."""
    digits = sum(map(word.count, "0123456789"))
    letters = any(c.isalpha() for c in word)
    count = 0 if not digits else 1 + sum(digits > b for b in (2, 3, 6, 9, 13, 19))
    return [
        count, 8 + min(word.count("."), 4), 13 + min(word.count("@"), 2), 16 + min(word.count("-"), 3),
        20 + ("+" in word), 22 + ("(" in word or ")" in word), 24 + letters,
    ]


SHAPES = 26
FEATURES = 2 * SHAPES + 2


def _features(text: str, places: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Indicators of each word's shape and of that before; whether it is next to that before."""
    out, near = np.zeros((len(places), FEATURES)), np.zeros(len(places), bool)
    before: list[int] = []
    for i, (a, b) in enumerate(places):
        shape = _shape(text[a:b])
        near[i] = i > 0 and not text[places[i - 1][1] : a].strip(SPACES)
        out[i, shape] = 1
        out[i, [SHAPES + s for s in before] if near[i] else [2 * SHAPES]] = 1
        out[i, 2 * SHAPES + 1] = 1
        before = shape
    return out, near


def _mailbox(word: str) -> str | None:
    """What addresses have in common that repeat each other."""
    return re.sub(r"[^a-z0-9@]", "", word[: word.index("@") + 1].lower()).lstrip("0123456789") or None


#: A run of number words: nothing but digits and what stands between their groups.
_NUMBER = re.compile(r"[^A-Za-z0-9@]*[0-9][0-9().+/-]*[^A-Za-z0-9@]*")
_IP_WORD = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])")
#: Most digits of a card and of a phone number.
CARD_DIGITS, PHONE_DIGITS = 19, 15


@dataclass
class Entity:
    """Neighbouring words ``first`` to ``last`` that are one mention, and the key it is known by."""

    first: int
    last: int
    key: str
    kind: int = -1  # of the pattern's span it lies in


def alike(one: Entity, other: Entity) -> bool:
    """Whether two mentions repeat each other: equal keys, or phone numbers of which one is the
    other without its first digits, a leading zero in place of a prefix left out."""
    if one.key == other.key:
        return True
    if 3 not in (one.kind, other.kind) or not (one.key[-1:].isdigit() and other.key[-1:].isdigit()):
        return False
    if "." in one.key or "." in other.key:
        return False
    short, long = sorted((one.key.lstrip("0"), other.key.lstrip("0")), key=len)
    return SAME_DIGITS <= len(short) and len(long) <= PHONE_DIGITS and long.endswith(short)


def entities(text: str, places: list[tuple[int, int]], spans: list[Span]) -> list[Entity]:
    """Mentions among the words: those of each pattern's span, then addresses, and of each run of
    other number words the parts that repeat a span; what is left of it is one mention."""
    found: list[Entity] = []
    used = np.zeros(len(places), bool)
    at = 0
    for start, kind, end in spans:
        at = next((i for i in range(at, len(places)) if places[i][1] > start), len(places))
        last = at
        while last < len(places) and places[last][0] < end:
            last += 1
        if last == at or used[at:last].any():
            continue
        used[at:last] = True
        key = _mailbox(text[start:end]) if kind == 0 else text[start:end] if kind == 1 else re.sub("[^0-9]", "", text[start:end])
        if key:
            found.append(Entity(at, last - 1, key, kind))
    exact = {e.key for e in found if e.kind >= 2}
    phones: dict[str, list[Entity]] = {}
    for e in found:
        if e.kind == 3 and not any(e.key == x.key for x in phones.get(e.key[-SAME_DIGITS:], ())):
            phones.setdefault(e.key[-SAME_DIGITS:], []).append(e)

    def rest(first: int, last: int) -> None:
        digits = re.sub("[^0-9]", "", text[places[first][0] : places[last][1]]) if first <= last else ""
        if len(digits) >= SAME_DIGITS:
            found.append(Entity(first, last, digits))

    i = 0
    while i < len(places):
        word = text[slice(*places[i])]
        if used[i] or ("@" not in word and not _NUMBER.fullmatch(word)):
            i += 1
            continue
        if "@" in word or (ip := _IP_WORD.search(word)):
            key = _mailbox(word) if "@" in word else ip[0]
            if key:
                found.append(Entity(i, i, key))
            i += 1
            continue
        last = i
        while last + 1 < len(places) and not used[last + 1] and not text[places[last][1] : places[last + 1][0]].strip(" ") \
                and text[places[last][1] - 1] not in ",;:.!?" and _NUMBER.fullmatch(text[slice(*places[last + 1])]):
            last += 1
        parts, left = [re.sub("[^0-9]", "", text[a:b]) for a, b in places[i : last + 1]], i
        x = i
        while x <= last:
            end, key, best = x, "", None
            while end <= last and len(key) + len(parts[end - i]) <= CARD_DIGITS:
                key += parts[end - i]
                if len(key) >= SAME_DIGITS and (key in exact or any(alike(e, Entity(x, end, key)) for e in phones.get(key[-SAME_DIGITS:], ()))):
                    best = Entity(x, end, key)
                end += 1
            if best is not None:
                rest(left, x - 1)
                found.append(best)
                x = left = best.last + 1
            else:
                x += 1
        rest(left, last)
        i = last + 1
    return sorted(found, key=lambda e: e.first)


def repeats(own: list[Entity]) -> list[tuple[int, int]]:
    """Pairs (earlier or labelled mention, mention) that are alike: each mention with the one of
    its key before it and, where that is none, with the first span of a phone it may be part of."""
    pairs, last = [], {}
    phones: dict[str, list[int]] = {}
    for i, e in enumerate(own):
        if e.kind == 3:
            phones.setdefault(e.key[-SAME_DIGITS:], []).append(i)
    for i, e in enumerate(own):
        if e.key in last:
            pairs.append((last[e.key], i))
        elif e.kind != 0 and "@" not in e.key:
            anchor = next((j for j in phones.get(e.key[-SAME_DIGITS:], []) if j != i and alike(own[j], e)), None)
            if anchor is not None:
                pairs.append((anchor, i))
        last[e.key] = i
    return pairs


def _labels(places: list[tuple[int, int]], spans: list[Span]) -> np.ndarray:
    """1 + kind of the first span that overlaps each word, else 0."""
    labels, at = np.zeros(len(places), np.int64), 0
    for i, (a, b) in enumerate(places):
        while at < len(spans) and max(s[2] for s in spans[at : at + len(KINDS)]) <= a and spans[at][2] <= a:
            at += 1
        for start, kind, end in spans[at : at + 2 * len(KINDS)]:
            if start < b and end > a:
                labels[i] = 1 + kind
                break
    return labels


@dataclass
class Graph:
    """Words of some documents with their edges: ``pairs`` of words, ``skip`` tells the kind."""

    features: np.ndarray
    labels: np.ndarray
    pairs: np.ndarray
    skip: np.ndarray


def graph(texts: list[str], places: list[list[tuple[int, int]]], spans: list[list[Span]]) -> Graph:
    """One graph of all documents; skip edges tie the words of a mention to those of the one it
    repeats, in order, so their number is at most twice that of the words."""
    features, labels, pairs, skip, offset = [np.zeros((0, FEATURES))], [np.zeros(0, np.int64)], [], [], 0
    for text, words, own in zip(texts, places, spans):
        found, near = _features(text, words)
        for i in range(len(words)):
            if near[i]:
                pairs.append((offset + i - 1, offset + i))
                skip.append(False)
        known = entities(text, words, own)
        for j, i in repeats(known):
            one, other = known[j], known[i]
            for x in range(max(one.last - one.first, other.last - other.first) + 1):
                pairs.append((offset + min(one.first + x, one.last), offset + min(other.first + x, other.last)))
                skip.append(True)
        features.append(found)
        labels.append(_labels(words, own))
        offset += len(words)
    return Graph(np.concatenate(features), np.concatenate(labels), np.array(pairs, np.int64).reshape(-1, 2), np.array(skip, bool))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis, keepdims=True)) + top


@dataclass
class Field:
    """Potentials: unary weights by feature, and log tables of the two kinds of edges."""

    weights: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, g: Graph) -> np.ndarray:
        """Likelihood of each label of each word by loopy sum-product messages."""
        n, k = len(g.labels), len(KINDS) + 1
        unary = g.features @ self.weights
        fixed = g.labels > 0
        unary[fixed] = -50.0
        unary[fixed, g.labels[fixed]] = 0.0
        a = np.concatenate([g.pairs[:, 0], g.pairs[:, 1]])
        b = np.concatenate([g.pairs[:, 1], g.pairs[:, 0]])
        tables = np.where(g.skip[:, None, None], self.skip, self.chain) if len(g.pairs) else np.zeros((0, k, k))
        tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
        back = np.roll(np.arange(len(a)), len(g.pairs))
        messages = np.zeros((len(a), k))

        def beliefs() -> np.ndarray:
            total = unary.copy()
            np.add.at(total, b, messages)
            return total

        for _ in range(ROUNDS if len(a) else 0):
            sent = (beliefs()[a] - messages[back])[:, :, None] + tables
            new = _log_sum(sent, 1)[:, 0]
            new -= _log_sum(new, 1)
            change = np.abs(new - messages).max()
            messages = DAMPING * messages + (1 - DAMPING) * new
            if change < 1e-4:
                break
        total = beliefs()
        return np.exp(total - _log_sum(total, 1)) if n else total


def fitted(g: Graph) -> Field:
    """Field whose unary weights, transitions and agreement of alike words fit the labels."""
    k = len(KINDS) + 1
    x, y = g.features, np.eye(k)[g.labels]
    w, speed, size = np.zeros((FEATURES, k)), np.zeros((FEATURES, k)), np.zeros((FEATURES, k))
    for step in range(1, 301 if len(x) else 1):
        z = x @ w
        p = np.exp(z - _log_sum(z, 1))
        slope = x.T @ (p - y) / len(x) + 1e-4 * w
        speed, size = 0.9 * speed + 0.1 * slope, 0.999 * size + 0.001 * slope**2
        w -= 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(size / (1 - 0.999**step)) + 1e-8)
    ends = g.labels[g.pairs]
    joint = np.full((k, k), 0.5)
    np.add.at(joint, tuple(ends[~g.skip].T), 1)
    joint /= joint.sum()
    # The unary weights know the word before already: transitions count half.
    chain = 0.5 * np.log(joint / (joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)))
    same = ends[g.skip]
    agree = ((same[:, 0] == same[:, 1]).sum() + 19.0) / (len(same) + 20.0)
    weight = np.clip(np.log(agree * (k - 1) / (1 - agree)), 0.0, MOST_SKIP)
    return Field(w, chain, weight * np.eye(k))


def all_spans(texts: list[str], field: Field) -> tuple[list[list[Span]], list[list[Span]]]:
    """Spans of the patterns, and with those that the field adds, for each text."""
    base, places = [base_spans(t) for t in texts], [candidates(t) for t in texts]
    g = graph(texts, places, base)
    likely = field.marginals(g)
    whole, at = [], 0
    for text, words, own in zip(texts, places, base):
        added: list[Span] = []
        known = entities(text, words, own)
        # A mention counts as repeated if a pattern's span of the kind is among those it is tied to.
        group = list(range(len(known)))
        for j, i in repeats(known):
            group[i] = group[j] if j < i else group[i]
            if j > i:
                old = group[i]
                group = [group[j] if x == old else x for x in group]
        anchors = {(tied, e.kind) for tied, e in zip(group, known) if e.kind >= 0}
        for tied, e in zip(group, known):
            if e.kind >= 0 or g.labels[at + e.first : at + e.last + 1].any():
                continue
            total = likely[at + e.first : at + e.last + 1].mean(0)
            kind = int(total.argmax()) - 1
            if kind < 0 or total[kind + 1] < CERTAIN or (tied, kind) not in anchors:
                continue
            a, b = words[e.first][0], words[e.last][1]
            while a < b and not text[a].isalnum() and text[a] not in "+(":
                a += 1
            while a < b and not text[b - 1].isalnum():
                b -= 1
            if a < b:
                added.append((a, kind, b))
        at += len(words)
        whole.append(sorted(own + added))
    return base, whole


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        rows = max(1, int(batch.num_rows * BATCH_BYTES / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, [t or "" for t in part.column("text").to_pylist()]


def fit(docs: DataFrame, text_col: str = "text", fit_chars: int = FIT_CHARS) -> Field:
    """Field from a bounded sample: the documents with such words, in the order of a hash of the
    text, as many as hold ``FIT_WORDS`` of them. Texts of up to ``fit_chars`` characters take part, as a whole; at most
    a tenth as many as ``FIT_WORDS`` come to the driver."""
    schema = "h long, words int, text string"

    def lines(batches):
        for part, texts in _texts(batches):
            count = [min(len(candidates(t)), FIT_WORDS) for t in texts]
            rows = pa.RecordBatch.from_arrays([part.column("h"), pa.array(count, pa.int32()), pa.array(texts, pa.string())], ["h", "words", "text"])
            yield rows.filter(pa.array([c > 0 for c in count], pa.bool_()))

    hashed = docs.select(F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    hinted = hashed.where((F.length("text") <= fit_chars) & F.col("text").rlike("[0-9@]"))
    # The share is one of distinct texts, as copies add nothing to the sample.
    few = hashed_share(F.col("h"), FIT_WORDS // 10, hinted.select("h").distinct().count())
    # Equal texts have one hash: however many there are, one is taken.
    found = hinted.where(few).groupBy("h").agg(F.min("text").alias("text")).mapInArrow(lines, schema)
    rows = found.orderBy("h").limit(FIT_WORDS // 10).collect()
    texts, left = [], FIT_WORDS
    for r in rows:
        if left > 0:
            texts.append(r["text"])
            left -= r["words"]
    return fitted(graph(texts, [candidates(t) for t in texts], [base_spans(t) for t in texts]))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data in every text.

    Returns one row per input row: (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans).
    The counts and the hash describe the spans of the patterns, ``spans`` lists all as
    ``kind:start:end`` by start and kind. A null text is empty and has no span. Rows that repeat
    an id each have their own row; an empty table gives an empty table; columns besides the two
    named are not read.
    """
    field = fit(docs, text_col)

    def run(batches):
        for part, texts in _texts(batches):
            base, whole = all_spans(texts, field)
            counts = [pa.array([sum(s[1] == k for s in own) for own in base], pa.int64()) for k in range(len(KINDS))]
            digests = [hashlib.sha256(written(own).encode()).hexdigest() for own in base]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array(list(map(written, whole)), pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    fields = [T.StructField("doc_id", docs.schema[id_col].dataType)]
    fields += [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    fields += [T.StructField(c, T.StringType()) for c in ("base_sha256", "spans")]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, T.StructType(fields))


def redacted(text: str, spans: str) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first counts."""
    out, at = [], 0
    for kind, a, b in (s.split(":") for s in spans.split(",") if s):
        if int(a) >= at:
            out += [text[at : int(a)], f"[{kind}]"]
            at = int(b)
    return "".join(out) + text[at:]
