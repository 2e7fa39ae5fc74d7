"""Exact top-k search by inner product with MaxScore.

A vector is a document whose terms are the places of its components, an inverted list holds the
documents in which a place is not zero, with their integer values. For a query every list has a
bound on what it can add to a score. The terms of lowest bounds that together stay below the
score to beat are non-essential: a document in no list of the others cannot be a result. The
essential lists are traversed in whole, and the documents that are still competitive then are
probed in the non-essential lists, from the highest bound down, as long as their score so far
and the bounds that remain reach the score to beat.

Documents are dealt into shards. Each query first searches one of them: its k-th score there is
the score to beat everywhere else. A shard returns at most k documents per query, and the shards
are merged by a ranking that cuts each partition before it is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.toplist import top_per_group
from .shards import everywhere, searched, shard_of
from .shared import saved

#: Factor by which components become integers.
SCALE = 1024
#: Vectors of a shard, on average.
SHARD = 8_192
LOWEST = -(1 << 63)
HITS = "query_row long, query_id long, vec_id long, row long, score long"


@dataclass
class Shard:
    """Inverted lists of a shard; ``starts[t]`` is where the list of term ``t`` begins."""

    rows: np.ndarray
    ids: np.ndarray
    no_id: np.ndarray
    starts: np.ndarray
    docs: np.ndarray
    values: np.ndarray
    most: np.ndarray
    least: np.ndarray

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.starts[term], self.starts[term + 1])
        return self.docs[part], self.values[part]


def _ids(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids with 0 for null, and which are null."""
    return column.fill_null(0).to_numpy(), column.is_null().to_numpy()


def _components(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All components, the row of each and its place in the row."""
    lists = column.combine_chunks()
    flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy()
    doc = np.repeat(np.arange(len(sizes)), sizes)
    return flat, doc, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def inverted(table: pa.Table) -> Shard:
    flat, doc, place = _components(table["e"])
    some = flat != 0
    flat, doc, place = flat[some], doc[some], place[some]
    order = np.argsort(place, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(place))]).astype(np.int64)
    docs, values = doc[order], flat[order]
    full = starts[:-1][np.diff(starts) > 0]
    most, least = np.zeros(len(starts) - 1, np.int64), np.zeros(len(starts) - 1, np.int64)
    if len(full):
        most[np.diff(starts) > 0] = np.maximum.reduceat(values, full)
        least[np.diff(starts) > 0] = np.minimum.reduceat(values, full)
    ids, no_id = _ids(table["vec_id"])
    return Shard(table["row"].to_numpy(), ids, no_id, starts, docs, values, most, least)


def competitive(shard: Shard, query: np.ndarray, beat: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the shard that score ``beat`` or more, all if that is None, and their scores."""
    n = len(shard.rows)
    query = query[: len(shard.most)]
    terms = np.flatnonzero(query)
    reach = max(map(abs, (*shard.most.tolist(), *shard.least.tolist())), default=0) * max(map(abs, query.tolist()), default=0)
    # Sums beyond 64 bits are made of Python integers.
    kind = np.int64 if reach * max(1, len(terms)) < 1 << 62 else object
    weight, most, least = (x[terms].astype(kind) for x in (query, shard.most, shard.least))

    def listed(term: int) -> tuple[np.ndarray, np.ndarray]:
        docs, values = shard.postings(term)
        return docs, values.astype(kind, copy=False)

    bound = np.maximum(np.maximum(weight * most, weight * least), 0)
    order = np.argsort(bound, kind="stable")
    sums = np.cumsum(bound[order])
    n_rest = 0 if beat is None else int((sums < beat).sum())
    left = sums[n_rest - 1] if n_rest else 0
    score = np.zeros(n, kind)
    for i in order[n_rest:]:
        docs, values = listed(terms[i])
        if len(docs) == n:
            score += weight[i] * values
        else:
            score[docs] += weight[i] * values
    alive = np.arange(n) if beat is None else np.flatnonzero(score + left >= beat)
    for i in order[:n_rest][::-1]:
        if not len(alive):
            break
        docs, values = listed(terms[i])
        if len(docs) == n:
            score[alive] += weight[i] * values[alive]
        elif len(docs):
            at = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
            score[alive] += np.where(docs[at] == alive, weight[i] * values[at], 0)
        left -= bound[i]
        alive = alive[score[alive] + left >= beat]
    return alive, score[alive]


def best(shard: Shard, query: np.ndarray, own: int, beat: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` documents other than ``own``, as long as they score ``beat`` or more."""
    docs, score = competitive(shard, query, beat)
    other = shard.rows[docs] != own
    docs, score = docs[other], score[other]
    if len(docs) > k:
        some = score >= np.partition(score, len(score) - k)[len(score) - k]
        docs, score = docs[some], score[some]
    order = np.lexsort((shard.rows[docs], shard.ids[docs], shard.no_id[docs], -score))[:k]
    return docs[order], score[order]


def _queries(table: pa.Table):
    """(row, components, score to beat) of each query."""
    lists = table["e"].combine_chunks()
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy())
    parts = np.split(flat, ends[:-1])
    return zip(table["query_row"].to_pylist(), parts, table["beat"].to_pylist())


def _long(scores) -> list[int]:
    return [max(min(int(s), -LOWEST - 1), LOWEST) for s in scores]


def _home(k: int):
    def answer(shard: Shard, table: pa.Table) -> pa.Table:
        """The queries with the k-th score that they have here, null where there are fewer."""
        beat = []
        for own, query, _ in _queries(table):
            scores = _long(best(shard, query, own, None, k)[1])
            # The lowest number stands for any score below it, too: it bounds nothing.
            beat.append(scores[-1] if len(scores) == k and scores[-1] > LOWEST else None)
        own = table.select(["query_row", "query_id", "e"])
        return own.append_column("beat", pa.array(beat, pa.int64()))

    return answer


def _hits(k: int):
    def answer(shard: Shard, table: pa.Table) -> pa.Table:
        found = []
        for (own, query, beat), query_id in zip(_queries(table), table["query_id"].to_pylist()):
            docs, scores = best(shard, query, own, beat, k)
            for d, s in zip(docs.tolist(), _long(scores)):
                vec_id = None if shard.no_id[d] else int(shard.ids[d])
                found.append((own, query_id, vec_id, int(shard.rows[d]), s))
        names = [c.split()[0] for c in HITS.split(", ")]
        columns = list(zip(*found)) if found else [[] for _ in names]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return answer


def integers(vector: Column, scale: int = SCALE) -> Column:
    """Floor of the scaled components, computed in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: number(x.cast("double"))), F.lit(False))


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD,
) -> DataFrame:
    """The ``k`` vectors of highest integer inner product for each row that ``is_query`` picks.

    Returns (query_id, rank, vec_id, score); ``is_query`` is a condition on ``vec_id``. All rows
    are candidates but the query's own one. Equal scores are ordered by id, null ids last, and
    copies that repeat an id one after the other. Vectors that are null or hold null or non-finite
    components take no part; a missing component of a shorter vector counts as 0, so an empty vector scores 0.
    A query row that is repeated is as many queries, with ranks of their own. Where there
    are fewer than ``k`` other vectors all are returned. Scores beyond 64 bits are the largest
    or smallest of them. An empty table gives an empty table; columns besides the two named are not read.
    """
    named = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")).where(usable(F.col("v")))
    rows = named.select("vec_id", integers(F.col("v")).alias("e"), F.monotonically_increasing_id().alias("row"))
    rows = saved(rows, "integer-vectors")
    shards = max(1, -(-rows.count() // shard_rows))
    rows = rows.withColumn("shard", shard_of(F.col("row"), shards))
    asked = rows.where(is_query).select(
        "shard", F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), "e", F.lit(None).cast("long").alias("beat")
    )
    carried = "query_row long, query_id long, e array<long>, beat long"
    with_beat = saved(searched(rows, asked, shards, inverted, _home(k), carried), "scores-to-beat")
    hits = searched(rows, everywhere(with_beat, shards), shards, inverted, _hits(k), HITS)
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row")]
    ranked = top_per_group(hits, ["query_row"], order, F.lit(k), k, "rank")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
