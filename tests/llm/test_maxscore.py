"""Exact top-k search against all integer inner products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequill.llm import maxscore

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, rank string, score int, shard string, query_row int"


def brute(rows, picked, k):
    """(query_id, rank, vec_id, score) of every query row, in Python integers."""
    good = [(i, [math.floor(x * 1024) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (query, q) in enumerate(good):
        if query is None or not picked(query):
            continue
        scores = [(-sum(x * y for x, y in zip(q, v)), i is None, i or 0, b) for b, (i, v) in enumerate(good) if b != a]
        for rank, (score, none, i, _) in enumerate(sorted(scores)[:k], 1):
            out.append((query, rank, None if none else i, max(min(-score, (1 << 63) - 1), -(1 << 63))))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0, "y", 1) for i, v in rows], SCHEMA)


def found(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("shard_rows, k", [(1000, 10), (25, 10), (7, 3)])
def test_against_all_products(spark, shard_rows, k):
    """Dense and sparse vectors, copies, ties, several lengths, a third of all rows alike."""
    rng = np.random.default_rng(shard_rows)
    dense = rng.normal(size=(60, 16)) * 0.2
    near = dense[:20] + rng.normal(size=(20, 16)) * 0.01
    sparse = np.where(rng.random((60, 16)) < 0.15, rng.integers(-3, 4, (60, 16)), 0.0)
    vectors = [*dense.tolist(), *near.tolist(), *sparse.tolist(), *([dense[3].tolist()] * 60), [], [1.0] * 3, [0.5] * 20]
    rows = list(zip(rng.permutation(1000)[: len(vectors)].tolist(), vectors))
    got = found(maxscore.exact_top_k(frame(spark, rows), F.col("vec_id") % 4 == 0, k, shard_rows=shard_rows))
    assert got == brute(rows, lambda i: i % 4 == 0, k) and len(got) > 20 * k


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, -1.0]), (0, [1.0, -1.0]), (4, [0.5, 0.5]), (None, [0.5, 0.5]), (7, [0.5, 0.5]), (8, None), (12, [NAN, 1.0]), (16, [INF, 0.0]),
        (20, [None, 1.0]), (24, []), (1, [-0.0001, 0.0]), (28, [0.0, 0.0]), (3, [2.0]), (5, [1e-300, -1e-300]),
    ]
    want = brute(rows, lambda i: i % 4 == 0, 10)
    assert found(maxscore.exact_top_k(frame(spark, rows), F.col("vec_id") % 4 == 0)) == want
    assert sum(r[0] == 0 for r in want) == 18


def test_few_and_no_rows(spark):
    rows = [(0, [1.0]), (100, [2.0])]
    got = found(maxscore.exact_top_k(frame(spark, rows), F.col("vec_id") % 100 == 0))
    assert got == [(0, 1, 100, 1024 * 2048), (100, 1, 0, 1024 * 2048)]
    for some in (rows[:1], [(1, [1.0]), (2, [1.0])], []):
        assert found(maxscore.exact_top_k(frame(spark, some), F.col("vec_id") % 100 == 0)) == []


def test_products_beyond_64_bits(spark):
    rows = [(0, [1e13, 1e13]), (1, [1e13, 1e13]), (2, [-1e13, -1e13]), (3, [1e13, 0.0]), (4, [1.0, 1.0]), (5, [1e13, -1e13])]
    assert found(maxscore.exact_top_k(frame(spark, rows), F.col("vec_id") == 0, 5)) == brute(rows, lambda i: i == 0, 5)


def test_non_essential_lists_are_only_probed():
    """The terms that cannot reach the score to beat together are not traversed, and those in between stop early."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    vectors = np.concatenate([rng.integers(-40, 41, (500, 32)), rng.integers(-40, 41, (1, 32)) * 20])
    shard = maxscore.inverted(pa.table({"row": np.arange(501), "vec_id": pa.array(range(501), pa.int64()), "e": vectors.tolist()}))
    query = vectors[500] * (np.arange(32) % 5 + 1)
    scores = vectors @ query
    for beat in (None, int(np.sort(scores)[-10]), int(np.sort(scores)[-2]), 0):
        docs, found_scores = maxscore.competitive(shard, query, beat)
        assert (found_scores == scores[docs]).all()
        assert set(docs.tolist()) == set(np.flatnonzero(scores >= beat).tolist() if beat is not None else range(501))
    looked = []
    lists = maxscore.Shard.postings
    shard_class = type("Counting", (maxscore.Shard,), {"postings": lambda self, t: looked.append(t) or lists(self, t)})
    shard.__class__ = shard_class
    maxscore.competitive(shard, query, int(scores.max()) + 1)
    assert len(looked) < 32
