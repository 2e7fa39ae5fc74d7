"""Ranked lexical search by range maxima over posting lists.

The documents of a shard are numbered in the order of their lengths, so that the documents of an interval are
alike in what a term can give to them, and copies stand together. Every posting list has a
sparse table of range maxima over the impacts of its documents, so the largest impact of a term in
any interval of documents, and where it stands, is known at once. For an item the sum of these
maxima bounds the score of every document in the interval. Intervals are taken best first: the one of
highest bound is split at its document of largest impact, which is scored in full, and the two
parts go back with bounds of their own. A part whose bound cannot beat the results so far
is dropped; when none is left the results are exact.

Intervals are taken from the front of the queue in small lots, and a lot is bounded, split and
scored by one array expression over its intervals and the item's terms.

Each item first looks at the documents of largest impact in every shard, by a few splits. The k-th
best of these is a score that the results reach, and the search of each shard starts with it: intervals
bounded below it are never opened.
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

#: What separates terms: all ASCII characters but letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Documents of a shard, on average.
SHARD = 16_384
#: Intervals that are split at once.
LOT = 128
#: Splits of an item in each shard by which the score to beat is found.
FIRST_SPLITS = 64
HITS = "item_row long, item_id long, doc_id long, row long, score long"


def _lowered(term: Column) -> Column:
    """A to Z in lower case; ``lower`` does the same to a term that is all ASCII, and faster."""
    return F.when(F.length(term) == F.octet_length(term), F.lower(term)).otherwise(F.translate(term, UPPER, LOWER))


def terms_of(text: Column) -> Column:
    """Terms of a text in order, in their own letters; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BETWEEN), lambda t: t != "")


def weight(n_docs: Column, df: Column) -> Column:
    return F.floor(F.lit(1000.0) * F.ln((n_docs * 2 + 2) / (df * 2 + 1)))


@dataclass
class Shard:
    """Postings by term, then document, and range maxima over all of them.

    ``best[level, i]`` is where the largest impact of the ``2**level`` postings from ``i`` on is, the first
    of equal ones; a list's ranges never reach into the next list. ``places`` has the place of each document in the
    order of the ids, and ``earliest`` its range minima.
    """

    rows: np.ndarray
    ids: np.ndarray
    no_id: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    keys: np.ndarray
    impact: np.ndarray
    best: np.ndarray
    level: np.ndarray
    places: np.ndarray
    earliest: list[np.ndarray]

    def earliest_place(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """First place, in the order of the ids, among the documents of each interval."""
        out = np.full(len(low), len(self.rows))
        level = np.frexp(np.maximum(high - low, 1))[1] - 1
        for own in np.unique(level):
            at = np.flatnonzero((level == own) & (high > low))
            table = self.earliest[own]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(own))])
        return out

    def largest(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of the largest impact of each range; any place for an empty one."""
        level = self.level[end - begin]
        one, other = self.best[level, begin], self.best[level, np.maximum(end - (1 << level), begin)]
        return np.where(self.impact[other] > self.impact[one], other, one)


def _maxima(impact: np.ndarray, longest: int) -> np.ndarray:
    """The last place of ``impact`` is behind all lists; levels go as far as the longest list."""
    tables = np.empty((max(1, longest).bit_length(), len(impact)), np.int32)
    tables[0] = np.arange(len(impact))
    for level in range(1, len(tables)):
        half = 1 << (level - 1)
        tables[level] = tables[level - 1]
        a, b = tables[level - 1][:-half], tables[level - 1][half:]
        tables[level][:-half] = np.where(impact[b] > impact[a], b, a)
    return tables


def _minima(values: np.ndarray) -> list[np.ndarray]:
    tables = [values]
    while 2 << (len(tables) - 1) <= len(values):
        half = 1 << (len(tables) - 1)
        tables.append(np.minimum(tables[-1][: len(values) - 2 * half + 1], tables[-1][half : len(values) - half + 1]))
    return tables


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].fill_null(0).to_numpy()


def indexed(n_docs: int, n_terms: int):
    """Makes the index of a shard from postings (row, doc_id, n, term, tf)."""

    def build(table: pa.Table) -> Shard:
        row, tf, n, term = (_column(table, c) for c in ("row", "tf", "n", "term"))
        rows, first, doc = np.unique(row, return_index=True, return_inverse=True)
        ids, no_id = _column(table, "doc_id")[first], table["doc_id"].is_null().to_numpy()[first]
        by_id = np.lexsort((rows, ids, no_id))
        place = np.empty(len(rows), np.int64)
        place[by_id] = np.arange(len(rows))
        order = np.lexsort((place, n[first]))
        number = np.empty(len(rows), np.int64)
        number[order] = np.arange(len(rows))
        doc = number[doc]
        by_list = np.lexsort((doc, term))
        doc, tf, n, term = doc[by_list], tf[by_list], n[by_list], term[by_list]
        length = 100 - 90 + (90 * n * n_docs) // n_terms
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * length)
        terms, starts = np.unique(term, return_index=True)
        starts = np.r_[starts, len(term)]
        keys = np.repeat(np.arange(len(terms)), np.diff(starts)) * len(rows) + doc
        # One more place, behind all lists, for ranges and searches that end there.
        keys, impact = np.r_[keys, len(terms) * len(rows)], np.r_[impact, 0]
        longest = int(np.diff(starts).max())
        level = np.maximum(np.frexp(np.arange(longest + 1))[1] - 1, 0)
        places = place[order]
        best = _maxima(impact, longest)
        return Shard(rows[order], ids[order], no_id[order], terms, starts, keys, impact, best, level, places, _minima(places))

    return build


def best_documents(
    shard: Shard, terms: np.ndarray, weights: np.ndarray, k: int, beat: int = 1, lot: int = LOT, splits: int | None = None
) -> list[tuple[int, int]]:
    """(document, score) of the ``k`` best that score ``beat`` or more, the first of equal ones first.

    With a number of ``splits`` these are the best found by then.
    """
    at = np.searchsorted(shard.terms, terms)
    there = (weights > 0) & (at < len(shard.terms))
    there[there] = shard.terms[at[there]] == terms[there]
    at, weights, n = at[there], weights[there], len(shard.rows)
    if not len(at):
        return []
    results: list[tuple[int, int, int]] = []  # (-score, place, document), best first
    base = at * n

    def bounded(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bound of each interval, and the document at which to split it."""
        where = shard.largest(begin, end)
        gain = shard.impact[where] * weights * (end > begin)
        most = gain.argmax(1)
        return gain.sum(1), shard.keys[where[np.arange(len(begin)), most]] - base[most]

    def open_(bound: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Intervals that may still hold a result."""
        if len(results) < k:
            return bound >= beat
        least, place, _ = results[-1]
        same = np.flatnonzero(bound == -least)
        better = bound > -least
        better[same] = shard.earliest_place(low[same], high[same]) < place
        return better & (bound >= beat)

    begin, end = shard.starts[at][None, :], shard.starts[at + 1][None, :]
    bound, split = bounded(begin, end)
    low, high, done = np.zeros(1, np.int64), np.full(1, n), 0
    while len(bound) and (splits is None or done < splits):
        front = np.lexsort((low, -bound))[:lot] if len(bound) > lot else np.arange(len(bound))
        rest = np.ones(len(bound), bool)
        rest[front] = False
        done += len(front)
        b, e, d, first, last = begin[front], end[front], split[front], low[front], high[front]
        key = base[None, :] + d[:, None]
        cut = np.clip(np.searchsorted(shard.keys, key), b, e)
        hit = (cut < e) & (shard.keys[cut] == key)
        score = (shard.impact[cut] * weights * hit).sum(1)
        good = score >= beat
        results = sorted([*results, *zip((-score[good]).tolist(), shard.places[d[good]].tolist(), d[good].tolist())])[:k]
        parts = np.concatenate([b, cut + hit]), np.concatenate([cut, e])
        part_bound, part_split = bounded(*parts)
        part_low, part_high = np.concatenate([first, d + 1]), np.concatenate([d, last])
        new, old = open_(part_bound, part_low, part_high), rest & open_(bound, low, high)
        begin, end = np.concatenate([begin[old], parts[0][new]]), np.concatenate([end[old], parts[1][new]])
        bound, split = np.concatenate([bound[old], part_bound[new]]), np.concatenate([split[old], part_split[new]])
        low, high = np.concatenate([low[old], part_low[new]]), np.concatenate([high[old], part_high[new]])
    return [(d, -s) for s, _, d in results]


def _hits(k: int, splits: int | None = None):
    def answer(shard: Shard, table: pa.Table) -> pa.Table:
        found = []
        items = zip(*(table[c].to_pylist() for c in ("item_row", "item_id", "terms", "beat")))
        for row, item, own, beat in items:
            terms = np.array([t["term"] for t in own], np.int64)
            weights = np.array([t["w"] for t in own], np.int64)
            for d, score in best_documents(shard, terms, weights, k, beat, splits=splits):
                doc_id = None if shard.no_id[d] else int(shard.ids[d])
                found.append((row, item, doc_id, int(shard.rows[d]), score))
        names = [c.split()[0] for c in HITS.split(", ")]
        columns = list(zip(*found)) if found else [[] for _ in names]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return answer


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shard_docs: int = SHARD,
) -> DataFrame:
    """The ``k`` documents of highest score above 0 for the terms of each item.

    Returns (item_id, rank, doc_id, score). Equal scores are ordered by id, null ids last, and rows
    that repeat an id one after the other: each row is a document of its own, and counts as one
    in all statistics. A null text has no terms; an item without a term, or
    without one that any document has, has no results. An item row that is repeated is ranked as
    often. Empty tables give an empty table; columns besides those named are not read.
    """
    wanted = items.select(
        F.monotonically_increasing_id().alias("item_row"),
        F.col(item_col).alias("item_id"),
        F.array_distinct(F.transform(terms_of(F.col(item_text_col)), _lowered)).alias("words"),
    )
    wanted = saved(wanted, "items")
    words = wanted.select(F.explode("words").alias("word")).distinct()
    # "" is no term: its posting stands for the document.
    words = words.unionByName(docs.sparkSession.range(1).select(F.lit("").alias("word")))
    words = saved(words.withColumn("term", F.monotonically_increasing_id()), "item-terms")
    named = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), terms_of(F.col(text_col)).alias("own")
    )
    tokens = named.select("row", "doc_id", F.size("own").cast("long").alias("n"), F.explode(F.array_append("own", F.lit(""))).alias("token"))
    # Terms of no item go first. Spark broadcasts the items' terms if their measured size allows it.
    found = tokens.withColumn("word", _lowered(F.col("token"))).join(words, "word")
    counted = found.groupBy("row", "doc_id", "n", "term").agg(F.count("*").alias("tf"), F.any_value(F.col("word") == "").alias("whole"))
    postings = saved(counted, "postings")
    size = postings.where("whole AND n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = size["docs"], size["terms"] or 1
    shards = max(1, -(-n_docs // shard_docs))
    postings = postings.where("NOT whole").drop("whole").withColumn("shard", shard_of(F.col("row"), shards))
    weights = postings.groupBy("term").agg(weight(F.lit(n_docs), F.count("*")).alias("w"))
    asked = wanted.select("item_row", "item_id", F.explode("words").alias("word")).join(words, "word").join(weights, "term")
    entry = F.struct("term", "w")
    asked = asked.groupBy("item_row").agg(F.max("item_id").alias("item_id"), F.collect_list(entry).alias("terms"))
    asked = saved(asked.withColumn("beat", F.lit(1).cast("long")), "weighted-items")
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]

    def first(items: DataFrame, splits: int | None) -> DataFrame:
        found = searched(postings, everywhere(items, shards), shards, indexed(n_docs, n_terms), _hits(k, splits), HITS)
        return top_per_group(found, ["item_row"], order, F.lit(k), k, "rank")

    beat = first(asked, FIRST_SPLITS).where(F.col("rank") == k).select("item_row", F.col("score").alias("least"))
    asked = asked.join(beat, "item_row", "left").withColumn("beat", F.coalesce("least", "beat")).drop("least")
    ranked = first(saved(asked, "items-with-beat"), None)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
