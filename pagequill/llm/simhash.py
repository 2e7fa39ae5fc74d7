"""Near-duplicates by SimHash with covering locality-sensitive hashing.

A fingerprint has 64 bits. To find all pairs that differ in at most three of them, every bit
gets a nonzero vector of four bits, and each nonzero vector ``v`` of four bits defines a table:
its mask keeps the bits whose vector has an odd product with ``v``. The vectors of three
differing bits span at most three dimensions, so some ``v`` is orthogonal to all of them and
its table hides the difference: such a pair always meets in a bucket (15 tables).

A crowded bucket is covered once more: within it only the hidden bits differ, and 15 masks over
those guarantee the same. At most 16 bits stay hidden then, and as fingerprints are distinct, a
bucket of the second level has at most 2**16 members by construction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

from .shared import components, field, numbered, row_key, saved, without

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Members beyond which a bucket is covered again.
CROWDED = 1024
#: Shingles whose bits are counted at once.
BLOCK = 1 << 17


def masks_over(bits: list[int]) -> list[int]:
    """Masks over the given bit positions; any ``RADIUS`` of them are hidden by one mask."""
    size = 1 << (RADIUS + 1)
    vector = {bit: i % (size - 1) + 1 for i, bit in enumerate(bits)}
    return [
        sum(1 << bit for bit in bits if (vector[bit] & v).bit_count() % 2) for v in range(1, size)
    ]


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


FIRST = masks_over(list(range(64)))
SECOND = [[m | s for s in masks_over([b for b in range(64) if not m >> b & 1])] for m in FIRST]
#: Most members of a bucket of the second level.
MOST = 1 << max(64 - m.bit_count() for row in SECOND for m in row)


def fingerprint(text: str | None) -> int:
    """SimHash of the 3-word shingles of a text; 0 for a null or empty one.

    ``bytes.lower`` and ``bytes.split`` know only ASCII letters and ASCII white space, which is
    the definition. A text of one or two words is one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    n = max(1, len(words) - SHINGLE + 1)
    starts = (ends - lengths + 1)[:n].tolist()
    stops = ends[-n:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[at : at + BLOCK], stops[at : at + BLOCK])]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([_signed(fingerprint(t)) for t in texts], dtype="int64")


def near_links(members: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that tie each member to the first of its connected group, links at most 3 bits."""
    found, rest = [], members.view(np.uint64)
    while len(rest) > 1:
        root, queue, rest = rest[0], [rest[0]], rest[1:]
        while queue and len(rest):
            near = np.bitwise_count(rest ^ queue.pop()) <= RADIUS
            if near.any():
                reached, rest = rest[near], rest[~near]
                queue.extend(reached)
                found.extend((root, x) for x in reached)
    return found


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("members")
        flat, ends = column.flatten().to_numpy(), column.value_lengths().to_numpy().cumsum()
        pairs = [p for members in np.split(flat, ends[:-1]) for p in near_links(members)]
        a, b = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64).T
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints ``fp`` as all pairs within 3 bits do."""
    first = distinct.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in FIRST])).alias("slot", "key"),
    )
    sizes = first.groupBy("slot", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = saved(first.join(sizes, ["slot", "key"]), "buckets")
    second = F.array(*[F.array(*[F.lit(_signed(m)) for m in row]) for row in SECOND])
    again = (
        shared.where(F.col("n") > CROWDED)
        .select("fp", "slot", F.posexplode(F.get(second, F.col("slot"))).alias("inner", "mask"))
        .select(
            (F.lit(len(FIRST)) + F.col("slot") * len(FIRST) + F.col("inner")).alias("slot"),
            F.col("fp").bitwiseAND(F.col("mask")).alias("key"),
            "fp",
        )
    )
    plain = shared.where(F.col("n") <= CROWDED).select("slot", "key", "fp")
    buckets = plain.unionByName(again).groupBy("slot", "key").agg(F.collect_list("fp").alias("members"))
    crowd = buckets.where(F.size("members") > 1).select("members")
    return crowd.mapInArrow(_links, "a long, b long").distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint and near-duplicate group of every document.

    Returns (doc_id, fingerprint, component_id): 16 hex digits and the smallest id among the
    documents reachable over pairs of fingerprints that differ in at most 3 bits.
    Null and empty texts have fingerprint zero, linked like any other. Rows that repeat an id
    each get a row; a null id gets one too and is never the smallest unless its group has no
    other. An empty table gives an empty table; columns besides the two named are not read.
    """
    prints = saved(
        docs.select(F.col(id_col).alias("doc_id"), _fingerprints(F.col(text_col)).alias("fp")), "prints"
    )
    distinct = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    joined = distinct.join(
        components(fingerprint_links(distinct.select("fp"))).withColumnRenamed("node", "fp"), "fp", "left"
    ).select("fp", "first", F.coalesce("component", "fp").alias("root"))
    smallest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = joined.join(smallest, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group, that with the smallest id; all columns stay.

    A null id counts as the last, and of equal ids any one row is taken. Null and empty texts are
    one group. An empty table gives an empty table.
    """
    rows = numbered(docs)
    groups = simhash_groups(rows.select(row_key(id_col).alias("key"), field(text_col).alias("text")), "key", "text")
    return without(rows, groups.where("doc_id <> component_id").select(F.col("doc_id.row").alias("number")))
