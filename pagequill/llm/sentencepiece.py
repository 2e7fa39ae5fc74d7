"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces and their log scores come from a SentencePiece model file; the best segmentation of
a text is the one with the largest sum of scores. As no piece has a whitespace marker behind
another character, a text falls apart into words with their leading markers, and line breaks,
which no piece holds, stand alone; each distinct word is solved once per worker. Characters
without a piece become the pieces of their UTF-8 bytes.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

MARK = "▁"
#: What an unknown character scores below the lowest piece.
UNKNOWN_PENALTY = 10.0
#: Distinct words whose ids one worker keeps, and the longest of them.
CACHE, CACHED_CHARS = 400_000, 64
BATCH_BYTES = 4 << 20


@dataclass
class Vocabulary:
    """Pieces in the order of their ids. ``kinds``: normal, byte, control or unknown."""

    pieces: list[str]
    scores: list[float]
    kinds: list[str]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        kind = lambda i: (
            "byte" if model.is_byte(i) else "control" if model.is_control(i) else "unknown" if model.is_unknown(i) else "normal"
        )
        return cls([model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], [kind(i) for i in ids])


class DoubleArray:
    """Trie over bytes in two arrays: the child of ``s`` by byte ``c`` is ``t = base[s] + c + 1``
    if ``check[t] == s``; the child by end mark 0 holds the number of the key."""

    def __init__(self, keys: Iterable[tuple[bytes, int]]):
        self.base, self.check = [0], [-2]
        entries = sorted(keys)
        work, free = [(0, 0, len(entries), 0)], 1
        while work:
            state, low, high, depth = work.pop()
            children, at = [], low
            while at < high:
                key = entries[at][0]
                code = key[depth] + 1 if len(key) > depth else 0
                end = at + 1
                while end < high and len(entries[end][0]) > depth and entries[end][0][depth] + 1 == code:
                    end += 1
                children.append((code, at, end))
                at = end
            while free < len(self.check) and self.check[free] != -1:
                free += 1
            base = max(0, free - children[0][0])
            while any(base + c < len(self.check) and self.check[base + c] != -1 for c, _, _ in children):
                base += 1
            top = base + children[-1][0] + 1
            if top > len(self.check):
                self.base.extend([0] * (top - len(self.check)))
                self.check.extend([-1] * (top - len(self.check)))
            self.base[state] = base
            for code, a, b in children:
                self.check[base + code] = state
                if code:
                    work.append((base + code, a, b, depth + 1))
                else:
                    self.base[base] = entries[a][1]
        # No lookup from any state leaves the arrays.
        self.base.extend([0] * 258)
        self.check.extend([-1] * 258)


@dataclass
class Model:
    """Encoder and decoder for a vocabulary."""

    vocabulary: Vocabulary
    add_prefix: bool = True
    known: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        v = self.vocabulary
        normal = [i for i, k in enumerate(v.kinds) if k == "normal"]
        self.trie = DoubleArray((v.pieces[i].encode(), i) for i in normal if v.pieces[i])
        self.longest = max(len(v.pieces[i].encode()) for i in normal)
        self.unknown_score = min(v.scores[i] for i in normal) - UNKNOWN_PENALTY
        self.bytes = {int(v.pieces[i][1:-1], 16): i for i, k in enumerate(v.kinds) if k == "byte"}
        self.unknown = v.kinds.index("unknown")
        if any(MARK in v.pieces[i].lstrip(MARK) or "\n" in v.pieces[i] for i in normal):
            raise ValueError("a piece joins words or lines")
        self.words = re.compile(rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
        plain = {"normal": lambda p: p.replace(MARK, " ").encode(), "byte": lambda p: bytes([int(p[1:-1], 16)]),
                 "control": lambda p: b"", "unknown": lambda p: " ⁇ ".encode()}
        self.surface = [plain[k](p) for p, k in zip(v.pieces, v.kinds)]

    def viterbi(self, word: str) -> list[int]:
        """Ids of the best segmentation. Of equal sums that found first wins: its last piece is
        the longest."""
        data, scores, unknown = word.encode(), self.vocabulary.scores, self.unknown_score
        base, check = self.trie.base, self.trie.check
        best, starts, pieces = [-inf] * (len(data) + 1), [0] * (len(data) + 1), [-1] * (len(data) + 1)
        best[0], at = 0.0, 0
        while at < len(data):
            so_far, lead, single = best[at], data[at], False
            after = at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            state, end = 0, at
            for byte in data[at : at + self.longest]:
                child = base[state] + byte + 1
                if check[child] != state:
                    break
                state, end = child, end + 1
                leaf = base[state]
                if check[leaf] == state:
                    piece = base[leaf]
                    single |= end == after
                    if so_far + scores[piece] > best[end]:
                        best[end], starts[end], pieces[end] = so_far + scores[piece], at, piece
            if not single and so_far + unknown > best[after]:
                best[after], starts[after], pieces[after] = so_far + unknown, at, -1
            at = after
        ids, end = [], len(data)
        while end:
            start = starts[end]
            if pieces[end] >= 0:
                ids.append(pieces[end])
            else:
                ids.extend(self.bytes.get(b, self.unknown) for b in reversed(data[start:end]))
            end = start
        return ids[::-1]

    def _ids(self, word: str) -> bytes:
        found = self.known.get(word)
        if found is None:
            found = np.array(self.viterbi(word), "<u4").tobytes()
            if len(word) <= CACHED_CHARS:
                if len(self.known) >= CACHE:
                    self.known.clear()
                self.known[word] = found
        return found

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text; none for a null or empty one."""
        if not text:
            return np.zeros(0, "<u4")
        marked = (MARK if self.add_prefix else "") + text.replace(" ", MARK)
        return np.frombuffer(b"".join([self._ids(w) for w in self.words.findall(marked)]), "<u4")

    def decode(self, ids: Iterable[int]) -> str:
        """Text of the ids: markers become spaces, the first of them goes, bytes are joined."""
        surface = self.surface
        data = b"".join([surface[i] for i in ids])
        if self.add_prefix:
            data = data.removeprefix(b" ")
        return data.decode("utf-8", "replace")


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    """The model of a file, built once per process."""
    if path not in _models:
        _models[path] = Model(Vocabulary.load(path))
    return _models[path]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = max(1, int(batch.num_rows * BATCH_BYTES / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, "<u4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def encoded(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of its texts in ``out``, which replaces a column of that name.

    Null and empty texts have no ids. All other columns stay. Rows that repeat a text have the same ids; an empty
    table gives an empty table.
    """

    def run(batches):
        own = model(path)
        for batch in _batches(batches):
            ids = _lists([own.encode(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["row", out])

    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.drop(out).columns]).alias("row"), F.col(text_col).alias("text"))
    schema = T.StructType([kept.schema["row"], T.StructField(out, T.ArrayType(T.IntegerType()))])
    return kept.mapInArrow(run, schema).select("row.*", out)


def decoded(tokens: DataFrame, path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``tokens`` with the texts of its ids in ``out``, which replaces a column of that name.

    Null ids give a null text, an empty list an empty one. All other columns stay. Rows that repeat their ids have the
    same text; an empty table gives an empty table.
    """

    def run(batches):
        own = model(path)
        for batch in _batches(batches):
            texts = [None if i is None else own.decode(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", out])

    kept = tokens.select(F.struct(*[F.col(f"`{c}`") for c in tokens.drop(out).columns]).alias("row"), F.col(ids_col).alias("ids"))
    schema = T.StructType([kept.schema["row"], T.StructField(out, T.StringType())])
    return kept.mapInArrow(run, schema).select("row.*", out)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, decode its ids and describe both.

    Returns (doc_id, n_tokens, ids_crc32, decoded_sha256, restored): the checksum of the ids as
    little-endian unsigned 32-bit integers, and whether the decoded text is the text (null as
    empty). A text is not restored only if it holds U+2581 itself, which decodes to a space.
    Rows that repeat an id each have their own row; an empty table gives an empty table.
    """

    def run(batches):
        own = model(path)
        for batch in _batches(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = [own.encode(t) for t in texts]
            back = [own.decode(i.tolist()) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back], pa.string()),
                    pa.array([b == t for b, t in zip(back, texts)], pa.bool_()),
                ],
                ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "restored"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_crc32 long, decoded_sha256 string, restored boolean"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
