"""Reading a page-delimited dump.

The text source splits a file at the end tag, so one large file is read by many tasks. Each
piece up to an end tag holds one record from its first start tag on. A task adds up the sizes of the
pieces of a split as they pass, and writes the records with these sums: the dump is read once. Where
each split begins in its file follows from the sums. Only the last piece of
a file may lack its end tag; a record in it is not complete and is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..sizing import held, is_small, stored

#: Endings, in lower case, of the files that the text source decompresses.
PACKED = (".bz2", ".gz", ".deflate", ".lz4", ".snappy", ".zst")
#: Bytes of a byte order mark, which the text source leaves out.
BOM = 3


def _pieces(spark: SparkSession, paths: str | list[str], end: str) -> DataFrame:
    """Pieces of text between end tags, with the file and the split that they are from."""
    return (
        spark.read.option("lineSep", end)
        .text(paths)
        .select(
            "value",
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_block_start").alias("split"),
            (F.octet_length("value") + len(end.encode())).cast("long").alias("n_bytes"),
        )
    )


def _with_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``at``: the bytes of the pieces before a piece in its split. A task reads a split in order."""
    current, total = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        path = batch.column("path").dictionary_encode()
        split, size = batch.column("split").to_numpy(), batch.column("n_bytes").to_numpy()
        number = path.indices.to_numpy()
        before = np.cumsum(size) - size
        first = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (split[1:] != split[:-1])])
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(size)]):
            key = (path.dictionary[int(number[a])].as_py(), int(split[a]))
            total = total if key == current else 0
            before[a:b] += total - before[a]
            current, total = key, int(before[b - 1] + size[b - 1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], [*batch.schema.names, "at"])


def _unended(spark: SparkSession, ends: DataFrame, start: str, end: str) -> DataFrame | None:
    """``path`` of compressed files whose last start tag has no end tag behind it.

    The size of a compressed file says nothing about its text. Where the last piece of such a file has a start
    tag, the file is cut at its start tags, too: the last piece tells.
    """
    packed = ends.where(F.col("packed") & F.col("is_last") & F.col("last.starts"))
    names = [r["path"] for r in packed.select("path").collect()]
    if not names:
        return None
    by_start = _pieces(spark, [unquote(n) for n in names], start).withColumn("at", F.monotonically_increasing_id())
    ended = F.max_by(F.contains("value", F.lit(end)), F.struct("split", "at"))
    return by_start.groupBy("path").agg(ended.alias("ended")).where("NOT ended").select("path", F.lit(True).alias("unended"))


def _splits(spark: SparkSession, pieces: DataFrame, start: str, end: str) -> DataFrame:
    """``(path, split, split_at, open_at)``: where each split begins in its file, and the place in
    the split of an unterminated record, which only a file's last piece can be.

    The pieces of a plain file with an end tag each add up to its size, except that its
    last piece has no end tag if something follows the last record, and that a byte order mark
    is in no piece. Each case has its own difference.
    """
    of_file = Window.partitionBy("path")
    length = len(end.encode())
    ends = pieces.groupBy("path", "split").agg(
        F.sum("n_bytes").alias("split_bytes"),
        F.max("file_size").alias("file_size"),
        F.max_by(F.struct("at", "starts"), "at").alias("last"),
    )
    pattern = "(" + "|".join(PACKED).replace(".", r"\.") + ")$"
    ends = ends.withColumn("packed", F.lower("path").rlike(pattern))
    ends = ends.withColumn("is_last", F.col("split") == F.max("split").over(of_file))
    tails = _unended(spark, ends, start, end)
    if tails is None:
        ends = ends.withColumn("unended", F.lit(None).cast("boolean"))
    else:
        # One row per damaged file: no larger than the driver's own list of files.
        ends = ends.join(F.broadcast(tails), "path", "left")
    over = F.sum("split_bytes").over(of_file) - F.col("file_size")
    marked = F.coalesce(~F.col("packed") & over.isin(-BOM, length - BOM), F.lit(False))
    unended = F.when(F.col("packed"), F.coalesce("unended", F.lit(False))).otherwise(over > 0)
    before = F.sum("split_bytes").over(of_file.orderBy("split")) - F.col("split_bytes")
    return ends.select(
        "path",
        "split",
        (before + F.when(marked, BOM).otherwise(0)).alias("split_at"),
        F.when(F.col("is_last") & unended & F.col("last.starts"), F.col("last.at")).alias("open_at"),
    )


def _records(
    spark: SparkSession, paths: str | list[str], start: str, end: str, columns: list[Column] | None
) -> DataFrame:
    """``(path, offset, raw)`` of complete records, with ``columns`` over ``raw`` in its place if given."""
    at = F.instr("value", start)
    place = ["path", "file_size", "split", "n_bytes", "starts", "before_tag"]
    cut = _pieces(spark, paths, end).select(
        *place[:-2],
        (at > 0).alias("starts"),
        # NULL for a piece without a record.
        F.when(at > 0, F.octet_length(F.substr("value", F.lit(1), at - 1))).alias("before_tag"),
        F.when(at > 0, F.concat(F.substr("value", at), F.lit(end))).alias("raw"),
    )
    cut = cut.select(*place, *([F.col("raw")] if columns is None else columns))
    names = [c for c in cut.columns if c not in place]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    pieces = stored(cut.mapInArrow(_with_place, f"{schema}, at long"), "pieces")
    # One row per split. The join must know that they are few before it starts, or it shuffles the records.
    splits, few = held(_splits(spark, pieces, start, end), "splits")
    small = few is not None or is_small(splits)
    return (
        pieces.where("starts")
        .join(F.broadcast(splits) if small else splits, ["path", "split"])
        .where(~F.col("at").eqNullSafe(F.col("open_at")))
        .select("path", (F.col("split_at") + F.col("at") + F.col("before_tag")).alias("offset"), *names)
    )


def load_tag_records(
    spark: SparkSession, paths: str | list[str], start: str, end: str, complete: bool = False
) -> DataFrame:
    """``raw`` records from ``start`` to ``end``, tags included. Several paths are one corpus.

    The records are written to the scratch folder once, as only then it is known whether the last one of a file is
    terminated; ``complete=True`` leaves this out for dumps known to be whole.
    """
    if not complete:
        return _records(spark, paths, start, end, None).select("raw")
    at = F.instr("value", start)
    return _pieces(spark, paths, end).where(at > 0).select(F.concat(F.substr("value", at), F.lit(end)).alias("raw"))


def load_dump(
    spark: SparkSession,
    paths: str | list[str],
    start: str = fixed.PAGE_START,
    end: str = fixed.PAGE_END,
    complete: bool = False,
) -> DataFrame:
    """``raw`` page records of a dump."""
    return load_tag_records(spark, paths, start, end, complete)


def load_dump_offsets(
    spark: SparkSession,
    paths: str | list[str],
    start: str = fixed.PAGE_START,
    end: str = fixed.PAGE_END,
    columns: list[Column] | None = None,
) -> DataFrame:
    """``(path, offset, raw)``: records with the byte offset of their start tag in the file.

    In a compressed file that is the offset in its uncompressed text, less a byte order mark.

    The records are written to the scratch folder with their places in their splits, and only the sizes are added up
    by file, so no text is shuffled and the dump is read once. ``columns`` over ``raw`` replace
    it before anything is written; a list of titles, say, does not copy the texts.
    """
    return _records(spark, paths, start, end, columns)


def multi_path_scan(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """Page records of several dumps as one corpus."""
    return load_dump(spark, list(paths), **options)
