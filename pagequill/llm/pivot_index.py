"""Near-duplicate vectors by a pivot-permutation index.

A few hundred reference points, none close to another, are chosen from a bounded sample. Every
vector is described by its nearest pivots in order, and enters the inverted list of each. Two
vectors are candidates if they share enough pivots, counted on bit sets in the lists; a pair
that meets in several lists is taken in that of its smallest shared pivot. Candidates are
verified by the cosine in double precision.

Equal vectors are one row with a count before anything is compared. A list longer than a block
is compared block by block, each pair of blocks a group of its own of bounded size. A group
returns a row per vector (number of links, smallest vector of its connected part), never pairs.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, hashed_share, saved

COSINE = 0.95
#: Vectors looked at for pivots; most pivots; most cosine between two of them.
SAMPLE, PIVOTS, APART = 8192, 512, 0.85
#: Pivots that describe a vector, and how many of them candidates share at most. Fewer are asked
#: for where the links inside the sample need it, and one list of all vectors, in which every pair
#: is compared, is taken where that does not do either.
NEAREST, SHARED = 8, 3
#: Share of the sample's links that the pivots have to find.
RECALL = 0.995
#: Vectors of a list compared in one group are at most twice as many.
BLOCK = 2048


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one in double precision; scaled first, so no square overflows."""
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spread_pivots(sample: np.ndarray) -> np.ndarray:
    """Vectors of the sample in its order, each not close to those before it."""
    pivots: list[np.ndarray] = []
    for vector in sample:
        if len(pivots) == PIVOTS:
            break
        if not pivots or (np.array(pivots) @ vector).max() < APART:
            pivots.append(vector)
    return np.array(pivots)


def nearest(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Numbers of the nearest pivots of each vector, in order."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :NEAREST]


def chosen_pivots(sample: np.ndarray) -> tuple[np.ndarray, int]:
    """Pivots, and how many of them candidates have to share, so that the links inside the sample
    are found. Where no such number finds them, one pivot: all vectors share it."""
    pivots = spread_pivots(sample)
    # Up to so many pivots each vector has all of them, and a single list compares all pairs.
    if len(pivots) <= NEAREST:
        return pivots[:1], 1
    order = nearest(sample, pivots)
    own = np.zeros((len(sample), len(pivots)), np.float32)
    np.put_along_axis(own, order, 1.0, 1)
    with_at_least = np.zeros(SHARED + 1, np.int64)
    for at in range(0, len(sample), 512):
        part = slice(at, at + 512)
        i, j = np.nonzero(sample[part] @ sample[at:].T >= COSINE)
        i, j = i[i < j], j[i < j]
        for some in range(0, len(i), 1 << 16):
            a, b = at + i[some : some + (1 << 16)], at + j[some : some + (1 << 16)]
            shared = np.einsum("ij,ij->i", own[a], own[b]).astype(int)
            with_at_least += [(shared >= s).sum() for s in range(SHARED + 1)]
    for shared in range(SHARED, 0, -1):
        if with_at_least[shared] >= RECALL * with_at_least[0]:
            return pivots, shared
    return pivots[:1], 1


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _described(pivots: np.ndarray):
    words = -(-len(pivots) // 64)

    def describe(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            order = nearest(unit(_matrix(batch.column("embedding"))), pivots)
            bits = np.zeros((len(order), words * 64), bool)
            np.put_along_axis(bits, order, True, 1)
            sets = np.packbits(bits, axis=1, bitorder="little").view("<i8")
            lists = [pa.array(list(order.astype(np.int32))), pa.array(list(sets))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], [*batch.schema.names, "pivots", "bits"])

    return describe


def _smallest(shared: np.ndarray) -> np.ndarray:
    """Number of the lowest bit in each row of 64-bit words."""
    word = (shared != 0).argmax(1)
    value = shared[np.arange(len(shared)), word]
    low = value & (~value + np.uint64(1))
    return word * 64 + np.bitwise_count(low - np.uint64(1))


def _compare(least_shared: int, key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    pivot, left, right = (k.as_py() for k in key)
    node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
    own = group["block"].to_numpy()
    vectors, bits = unit(_matrix(group["embedding"])), _matrix(group["bits"]).view(np.uint64)
    rows, columns = np.flatnonzero(own == left), np.flatnonzero(own == right)
    found = []
    for at in range(0, len(rows), 512):
        part = rows[at : at + 512]
        count = np.zeros((len(part), len(columns)), np.uint8)
        for w in range(bits.shape[1]):
            count += np.bitwise_count(bits[part, w][:, None] & bits[columns, w][None, :])
        i, j = np.nonzero(count >= least_shared)
        i, j = part[i], columns[j]
        if left == right:
            i, j = i[i < j], j[i < j]
        for some in range(0, len(i), 1 << 16):
            a, b = i[some : some + (1 << 16)], j[some : some + (1 << 16)]
            good = np.einsum("ij,ij->i", vectors[a], vectors[b]) >= COSINE
            a, b = a[good], b[good]
            mine = _smallest(bits[a] & bits[b]) == pivot
            found.append(np.stack([a[mine], b[mine]]))
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    a, b = pairs
    links = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
    root = node.copy()
    while len(a):
        least = np.minimum(root[a], root[b])
        if (root[a] == least).all() and (root[b] == least).all():
            break
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
    some = links > 0
    return pa.table({"node": node[some], "links": links[some].astype(np.int64), "root": root[some]})


def _valid(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector can have links."""
    value = F.col(column)
    fine = (
        value.isNotNull()
        & (F.size(value) > 0)
        & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(value, lambda x: x != 0)
    )
    return vectors.where(F.coalesce(fine, F.lit(False)))


def links_of_all_lengths(distinct: DataFrame) -> DataFrame:
    """``vector_links`` among the vectors of each length; vectors of different lengths have no angle.

    A length that fills more than a block is indexed on its own. All others, however many there are, are groups of one
    block at most, in which every pair is compared.
    """
    sized = distinct.withColumn("size", F.size("embedding"))
    sizes = saved(sized.groupBy("size").agg(F.count("*").alias("n")), "lengths")
    # As many rows as there are lengths with more vectors than a block.
    large = sorted(r["size"] for r in sizes.where(F.col("n") > BLOCK).collect())
    parts = [vector_links(distinct.where(F.size("embedding") == n)) for n in large]

    def compare(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        return _compare(1, tuple(pa.scalar(0) for _ in range(3)), group)

    few = sized.where(~F.col("size").isin(large)) if large else sized
    few = few.withColumn("bits", F.array(F.lit(1).cast("long"))).withColumn("block", F.lit(0))
    parts.append(few.groupBy("size").applyInArrow(compare, "node long, links long, root long"))
    return reduce(DataFrame.unionByName, parts)


def vector_links(distinct: DataFrame) -> DataFrame:
    """(node, links, root) rows over distinct vectors ``(node, copies, embedding)``.

    The sum of ``links`` is the number of other vectors within reach, copies counted; the pairs
    (node, root) connect what the links do. A node without links has no row.
    """
    hashed = distinct.select("embedding", F.xxhash64("embedding").alias("h"))
    few = hashed.where(hashed_share(F.col("h"), SAMPLE, distinct.count()))
    sample = few.orderBy("h").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return distinct.select("node", F.lit(0).cast("long").alias("links"), F.col("node").alias("root"))
    pivots, shared = chosen_pivots(unit(_matrix(sample["embedding"])))

    def compare(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        return _compare(shared, key, group)

    kind = distinct.schema["embedding"].dataType.simpleString()
    schema = f"node long, copies long, embedding {kind}, pivots array<int>, bits array<long>"
    described = saved(distinct.select("node", "copies", "embedding").mapInArrow(_described(pivots), schema), "described")
    sizes = described.select(F.explode("pivots").alias("pivot")).groupBy("pivot").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")
    )
    # One row per pivot: at most PIVOTS.
    lists = described.withColumn("pivot", F.explode("pivots")).drop("pivots").join(F.broadcast(sizes), "pivot")
    lists = lists.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    groups = lists.withColumn("other", other).select(
        "pivot",
        F.least("block", "other").alias("first"),
        F.greatest("block", "other").alias("second"),
        "block", "node", "copies", "embedding", "bits",
    )
    return groups.groupBy("pivot", "first", "second").applyInArrow(compare, "node long, links long, root long")


def vector_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Near-duplicate links and group of every vector.

    Returns one row per input row: (vec_id, n_links, component_id, kept). Vectors that are null,
    empty, zero, or hold a null or non-finite component link with nothing, and vectors of different lengths not with each
    other. ``component_id`` is the smallest id
    reachable, null where there is none; rows that repeat an id are vectors like any other. An
    empty table gives an empty table; columns besides the two named are not read.
    """
    named = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))
    good = _valid(named, "embedding")
    distinct = good.groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    distinct = saved(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    links = saved(links_of_all_lengths(distinct), "vector-links")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    joined = distinct.join(counts, "node", "left").join(roots, "node", "left").select(
        "embedding", "first", F.coalesce("component", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    smallest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    known = joined.join(smallest, "root").select("embedding", "n_links", "component_id", F.lit(True).alias("known"))
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("vec_id"))
    return named.join(known, "embedding", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
