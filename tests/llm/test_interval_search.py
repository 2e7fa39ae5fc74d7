"""Ranked search by intervals against the scores of all documents."""

import math
import random
import re
from collections import Counter

import pytest

from pagequill.llm import interval_search
from pagequill.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """(item_id, rank, doc_id, score) by the score of every document."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counted)
    n_terms = sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    out = []
    for item, text in items:
        scored = []
        for place, (doc, c) in enumerate(counted):
            n = sum(c.values())
            score = 0
            for w in set(terms(text)) & set(c):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                m = 100 - 90 + (90 * n * n_docs) // n_terms
                score += weight * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, place))
        out += [(item, r, None if none else d, -s) for r, (s, none, d, _) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, term string, n int, row int")
    q = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, word string, item_row int")
    got = interval_search.ranked_documents(d, q, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("shard_docs, k, lot, first", [(1000, 10, 128, 64), (40, 10, 128, 4), (30, 3, 1, 1), (15, 10, 2, 1000)])
def test_against_all_scores(spark, monkeypatch, shard_docs, k, lot, first):
    """Common and rare words, passages in several documents, a third of all documents alike."""
    monkeypatch.setattr(interval_search, "LOT", lot)
    monkeypatch.setattr(interval_search.best_documents, "__defaults__", (1, lot, None))
    monkeypatch.setattr(interval_search, "FIRST_SPLITS", first)
    rng = random.Random(shard_docs)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 30)))) for i in range(12)]
    docs = [(i, " ".join(rng.choices(words, weights, k=int(5 * 60 ** rng.random())))) for i in rng.sample(range(1000), 150)]
    docs = [(i, f"{t} {items[i % 12][1]}" if i % 9 == 0 else t) for i, t in docs]
    docs += [(2000 - i, docs[5][1]) for i in range(75)] + [(docs[5][0], docs[5][1])] * 3
    got = run(spark, docs, items, shard_docs=shard_docs, k=k)
    assert got == brute(docs, items, k) and len(got) == 12 * k


def test_odd_rows(spark):
    docs = [
        (3, "The cat; THE Cat_cat"), (3, "The cat; THE Cat_cat"), (None, "the cat"), (4, None), (5, ""), (6, "--- !"), (7, "É é İ straße 42"),
        (8, "the " * 3000), (9, "cat"), (10, "\x7f\x00cat\x00"),
    ]
    items = [(1, "the CAT"), (1, "the CAT"), (2, None), (3, ""), (4, "nowhere"), (5, "é É i̇ İ 42 STRASSE straße"), (None, "cat cat")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items, shard_docs=2) == brute(docs, items)
    assert run(spark, [], items) == run(spark, docs, []) == run(spark, [(1, None)], items) == []


def test_most_documents_are_never_scored():
    """Bounds of intervals leave most of a shard unopened."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(2)
    n = 4000
    rows = [(d, d, 100, t, 1) for t in range(6) for d in np.flatnonzero(rng.random(n) < 0.5 / 2 ** (2 * t)).tolist()]
    rows += [(d, d, 100, 9, 2) for d in (17, 900, 3500)]
    table = pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("row", "doc_id", "n", "term", "tf"), zip(*rows))})
    shard = interval_search.indexed(n, 100 * n)(table)
    looked, largest = [], interval_search.Shard.largest
    shard.__class__ = type("Counting", (interval_search.Shard,), {"largest": lambda self, a, b: looked.append(len(a)) or largest(self, a, b)})
    found = interval_search.best_documents(shard, np.array([0, 1, 2, 3, 4, 5, 9]), np.array([500, 900, 1500, 2500, 4000, 6000, 9000]), 3)
    assert {int(shard.ids[d]) for d, _ in found} <= {17, 900, 3500} and sum(looked) < n / 10


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_interval_search"](spark, sf).collect()), key=repr) == brute(docs, items)
