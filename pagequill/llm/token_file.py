"""Token ids as Parquet list columns from which parts can be read.

Documents are put in order of their ids before they are encoded, so texts and not the longer
id lists are shuffled. Spark's Parquet writer gets the layout: the token column dictionary-coded
(two bytes per token or less), the metadata columns delta-coded, small row groups, and pages of
bounded rows whose column indexes let a reader find documents by id and leave the tokens of all
others, or the whole token column, unread.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path

END_ID = 0
#: Bytes of the pieces and ids that one worker keeps, with what Python needs for each entry.
CACHE_BYTES, ENTRY_BYTES = 128 << 20, 160
#: Bytes of text that are looked up at once, at least one document, and of new pieces that are encoded at once.
TEXT_BYTES, NEW_BYTES = 4 << 20, 1 << 18
#: Longest piece that is kept, in bytes.
CACHED_BYTES = 64
ROW_GROUP, PAGE_BYTES, PAGE_ROWS = 32 << 20, 1 << 20, 2000
OUT = pa.schema(
    [("part", pa.int32()), ("doc_id", pa.int64()), ("start_in_part", pa.int64()), ("n_tokens", pa.int64()),
     ("ids", pa.list_(pa.int32()))]
)


def _bits(ascii_space: int, alnum: int, punctuation: int, high: int) -> np.ndarray:
    """A number for every byte: white space, letters and digits, other signs, bytes from 0x80."""
    kind = np.zeros(256, np.uint8)
    kind[0x21:0x7F], kind[0x80:] = punctuation, high
    kind[[c for c in range(128) if chr(c).isalnum()]] = alnum
    kind[[0x20, *range(0x09, 0x0E)]] = ascii_space
    return kind


#: A text may be cut between two bytes if the first has a bit in AFTER that the second has in BEFORE.
AFTER, BEFORE = _bits(0, 3, 1, 1), _bits(1, 0, 2, 0)
#: Last bytes, and those before the last, of the white space beyond ASCII.
WIDE_LAST, WIDE_MIDDLE = np.zeros(256, bool), np.zeros(256, bool)
WIDE_LAST[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
WIDE_MIDDLE[[0xC2, 0x9A, 0x80, 0x81]] = True


def _after_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether white space beyond ASCII may stand before each place; true for a few other signs."""
    return WIDE_LAST[data[at - 1]] & WIDE_MIDDLE[data[at - 2]]


def _pieces(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 on and the bytes of a column of texts or pieces, without nulls."""
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return places - places[0], whole[places[0] : places[-1]]


class Encoder:
    """Ids of whole texts by the tokenizers library, with repeated pieces encoded once.

    The tokenizer of ``byte_bpe_50k.json`` never joins a sign with white space behind it, nor an
    ASCII letter or digit with another ASCII sign behind it. Texts are cut there, but for white
    space beyond ASCII and inside added tokens, and the ids of the pieces follow each other. New
    pieces are encoded together and their ids told apart by the bytes they stand for.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.n_bytes = np.array([len(self.tokenizer.id_to_token(i)) for i in range(size)])
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(re.escape(t.encode()) for t in added) or rb"(?!)")
        # The pieces' numbers; their ids stand one after the other, `ends` tells where those of each piece end.
        self.known: dict[bytes, int] = {}
        self.ids, self.ends, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), 0
        self.used, self.turn = np.zeros(0, np.int32), 0

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.int32) for e in found]

    def _cut(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Where pieces begin, and the end of the last; texts begin with a new piece."""
        mark = np.zeros(len(data) + 1, bool)
        np.not_equal(AFTER[data[:-1]] & BEFORE[data[1:]], 0, out=mark[1:-1])
        high = np.flatnonzero(mark[1:-1] & (data[:-1] >= 0x80)) + 1
        mark[high[_after_wide_space(data, high)]] = False
        for token in self.added.finditer(data):
            mark[token.start() + 1 : token.end()] = False
        mark[offsets] = True
        return np.flatnonzero(mark)

    def _learn(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all new pieces one after the other, and their number for each piece."""
        offsets, data = _bytes_of(new)
        first, last = data[offsets[:-1]], data[offsets[1:] - 1]
        # These may stand one after the other as in a text.
        apart = (BEFORE[first] & 1 > 0) & (AFTER[last] & 1 > 0)
        high = np.flatnonzero(apart & (last >= 0x80))
        apart[high] = ~_after_wide_space(data, offsets[1:][high])
        counts, ids = np.zeros(len(new), np.int64), []
        order = np.concatenate([np.flatnonzero(apart), np.flatnonzero(~apart)])
        together, alone = new.filter(pa.array(apart)), new.filter(pa.array(~apart))
        for part in _small(together, NEW_BYTES):
            ends, joined = _bytes_of(part)
            found = self._plain([joined.tobytes().decode()])[0]
            at = np.searchsorted(np.cumsum(self.n_bytes[found]), ends[1:]) + 1
            ids.append((found, np.diff(at, prepend=0)))
        for part in _small(alone, NEW_BYTES):
            found = self._plain([p.decode() for p in part.to_pylist()])
            ids.append((np.concatenate(found), np.array([len(f) for f in found])))
        counts[order] = np.concatenate([n for _, n in ids])
        # Back in the order of the pieces.
        flat = np.concatenate([f for f, _ in ids])
        begin = np.zeros(len(new), np.int64)
        begin[order] = np.cumsum(counts[order]) - counts[order]
        return flat[_places(begin, counts)], counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and their number for each text."""
        offsets, data = _bytes_of(texts)
        cut, n, self.turn = self._cut(offsets, data), len(self.known), self.turn + 1
        coded = _pieces(cut, data).dictionary_encode()
        pieces = coded.dictionary
        keys = pieces.to_numpy(zero_copy_only=False)  # far faster than to_pylist()
        number = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(pieces))
        self.used[number[number >= 0]] = self.turn
        ids, ends = self.ids, self.ends
        new = np.flatnonzero(number < 0)
        if len(new):
            sizes = np.diff(_bytes_of(pieces)[0])[new]
            kept = sizes <= CACHED_BYTES
            new, n_kept = new[np.argsort(~kept, kind="stable")], int(kept.sum())
            found, counts = self._learn(pieces.take(pa.array(new)))
            number[new] = n + np.arange(len(new))
            ids, ends = np.concatenate([ids, found]), np.concatenate([ends, len(ids) + np.cumsum(counts)])
            # Long pieces stand last and are not kept.
            self.known.update(zip(keys[new[:n_kept]], range(n, n + n_kept)))
            self.ids, self.ends = ids[: len(ids) - counts[n_kept:].sum()], ends[: n + n_kept]
            self.used = np.concatenate([self.used, np.full(n_kept, self.turn, np.int32)])
            self.size += int(sizes[kept].sum())
        number = number[coded.indices.to_numpy()]
        counts = np.diff(ends, prepend=0)[number]
        flat = ids[_places(ends[number] - counts, counts)]
        before = np.concatenate([[0], np.cumsum(counts)])
        if self.size + self.ids.nbytes + ENTRY_BYTES * len(self.known) > CACHE_BYTES:
            self._forget()
        return flat, np.diff(before[np.searchsorted(cut, offsets)])

    def _forget(self) -> None:
        """Drop the half of the pieces that were not seen for longest."""
        stay = np.sort(np.argsort(-self.used, kind="stable")[: len(self.used) // 2])
        counts = np.diff(self.ends, prepend=0)
        self.ids = self.ids[_places((self.ends - counts)[stay], counts[stay])]
        self.ends, self.used = np.cumsum(counts[stay]), self.used[stay]
        pieces = list(self.known)
        self.known.clear()
        self.known.update((pieces[i], n) for n, i in enumerate(stay.tolist()))
        self.size = sum(map(len, self.known))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, counts = self.encode(pa.array(texts, pa.string()))
        return [part.astype("<u4").tobytes() for part in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


def _places(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``begin`` and the numbers after it, ``counts`` of them, for one entry after the other."""
    ends = np.cumsum(counts)
    return np.repeat(begin - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _encode(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = _encoder(path), TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in _small(whole, TEXT_BYTES):
                ids, counts = encoder.encode(batch.column("text").cast(pa.string()).fill_null(""))
                flat = np.insert(ids, np.cumsum(counts), END_ID)
                counts = counts + 1
                offsets = np.concatenate([[0], np.cumsum(counts)])
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
                columns = [pa.array(np.full(len(counts), part, np.int32)), batch.column("doc_id"),
                           pa.array(at + offsets[:-1]), pa.array(counts), lists]
                at += int(offsets[-1])
                yield pa.RecordBatch.from_arrays(columns, schema=OUT)

    return encode


def _small(rows, n_bytes: int):
    """Runs of rows of a batch or an array with about ``n_bytes``."""
    if not len(rows):
        return
    step = max(1, int(len(rows) * n_bytes / max(rows.nbytes, 1)))
    for at in range(0, len(rows), step):
        yield rows.slice(at, step)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write (part, doc_id, start_in_part, n_tokens, ids) in ascending order of the id.

    ``ids`` end with id 0. Null texts are empty; null ids come first; rows that repeat an id
    follow each other in the order of their texts. ``part`` numbers the files in that order.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # The begin of the text tells rows of one id apart, so that they need not be in one task.
    ordered = texts.repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    schema = "part int, doc_id long, start_in_part long, n_tokens long, ids array<int>"
    writer = ordered.mapInArrow(_encode(tokenizer), schema).write
    options = {
        "compression": "zstd",
        "parquet.block.size": ROW_GROUP,
        "parquet.page.size": PAGE_BYTES,
        "parquet.page.row.count.limit": PAGE_ROWS,
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": "true",
    }
    writer.options(**options).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``start`` counts the ids of all documents before.

    Where ``ids`` are not asked for, they are not read.
    """
    rows = spark.read.parquet(path)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file: this table grows with the number of files only.
    bases = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids"
    )


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        flat = lists.flatten().to_numpy().astype("<u4")
        ends = lists.value_lengths().to_numpy().cumsum()
        sums = [zlib.crc32(part.tobytes()) for part in np.split(flat, ends[:-1])] if len(lists) else []
        columns = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_table(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write the token file of ``docs`` and describe every document as read from it.

    Returns (doc_id, start, n_tokens, ids_crc32). An empty table gives an empty table.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return read_tokens(spark, path).mapInArrow(_checksums, schema)
