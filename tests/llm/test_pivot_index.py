"""Vector groups against all cosines."""

import numpy as np
import pytest

from pagequill.llm import pivot_index
from pagequill.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")


def all_pairs(ids, vectors):
    """(vec_id, n_links, component_id, kept) by brute force; pairs within 1e-12 of the bound are not tested."""
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    linked = np.eye(len(ids), dtype=bool)
    for size in {len(v) for v, g in zip(vectors, good) if g}:
        at = [i for i, g in enumerate(good) if g and len(vectors[i]) == size]
        unit = np.array([vectors[i] for i in at], np.float64)
        unit /= np.abs(unit).max(1, keepdims=True)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        linked[np.ix_(at, at)] = unit @ unit.T >= 0.95
        np.fill_diagonal(linked, True)
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in np.flatnonzero(linked[i]):
            a, b = sorted((group[i], group[j]))
            group = [a if g == b else g for g in group]
    out = []
    for i, own in enumerate(ids):
        least = min((x for x, g in zip(ids, group) if g == group[i] and x is not None), default=None)
        out.append((own, int(linked[i].sum()) - 1, least, own == least))
    return out


def frame(spark, ids, vectors, kind="float"):
    plain = [None if v is None else [None if x is None else float(x) for x in v] for v in vectors]
    rows = [(i, v, 0, "x") for i, v in zip(ids, plain)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, n_links string")


def test_odd_vectors(spark):
    vectors = [
        [1.0, 0, 0], [2.0, 0, 0], [1.0, 0.01, 0], [0.0, 1, 0], None, [], [0.0, 0, 0], [NAN, 1, 0], [INF, 0, 0],
        [None, 1.0, 0], [1.0, 0], [1.0, 0], [-1.0, 0, 0], [1e38, 0, 0], [1.0, 0, 0], [0.0, 1, 0], [-0.0, 1, 0],
    ]
    ids = [9, 4, 7, 3, 1, 2, 5, 6, 8, 10, 11, 12, 13, 14, 4, None, 20]
    got = pivot_index.vector_groups(frame(spark, ids, vectors)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(all_pairs(ids, vectors), key=repr)


@pytest.mark.parametrize("block", [2048, 60])
def test_mixed_lengths(spark, monkeypatch, block):
    """Lengths of some hundred vectors and lengths of a few, beside each other."""
    monkeypatch.setattr(pivot_index, "BLOCK", block)
    rng = np.random.default_rng(3)
    vectors = []
    for size, n in ((16, 200), (24, 150), (5, 12), (6, 3), (7, 1)):
        own = rng.normal(size=(n, size))
        vectors += [*own.tolist(), *(own[: n // 2] + rng.normal(size=(n // 2, size)) * 0.02).tolist(), *own[:2].tolist()]
    ids = rng.permutation(len(vectors)).tolist()
    got = sorted(map(tuple, pivot_index.vector_groups(frame(spark, ids, vectors, "double")).collect()))
    want = sorted(all_pairs(ids, vectors))
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.99 * there <= found <= there
    small = {i for i, v in zip(ids, vectors) if len(v) < 10}
    assert [r for r in got if r[0] in small] == [r for r in want if r[0] in small]


def test_only_invalid_or_no_vectors(spark):
    df = frame(spark, [2, 1], [None, [0.0]])
    assert sorted(map(tuple, pivot_index.vector_groups(df).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert pivot_index.vector_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [2048, 40])
def test_dense_groups_and_recall(spark, monkeypatch, block):
    monkeypatch.setattr(pivot_index, "BLOCK", block)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(60, 64))
    near = np.repeat(centres[:6], 50, axis=0)
    near = near / np.linalg.norm(near, axis=1, keepdims=True) + rng.normal(size=near.shape) * 0.022
    copies = np.repeat(centres[6:7], 120, axis=0)
    vectors = np.concatenate([near, copies, centres, rng.normal(size=(300, 64))]).astype(np.float32).tolist()
    ids = rng.permutation(len(vectors)).tolist()
    got = sorted(map(tuple, pivot_index.vector_groups(frame(spark, ids, vectors)).collect()))
    want = sorted(all_pairs(ids, vectors))
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert there > 15_000 and 0.99 * there <= found <= there
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[2:] == w[2:] for g, w in zip(got, want)) >= 0.99 * len(want)


def cone(rng, n, cosine, size=64):
    """Vectors around one direction, two of which have the given cosine on average, and copies moved a little."""
    centre = np.zeros(size)
    centre[0] = np.sqrt(cosine)
    spread = rng.normal(size=(n, size)) * np.sqrt((1 - cosine) / size)
    spread[n // 2 :] = spread[: n - n // 2] + rng.normal(size=(n - n // 2, size)) * 0.15 * np.sqrt((1 - cosine) / size)
    return centre + spread


def test_two_near_vectors(spark):
    vectors = [[1.0, 0.0], [1.0, 0.1]]
    got = sorted(map(tuple, pivot_index.vector_groups(frame(spark, [5, 3], vectors)).collect()))
    assert got == sorted(all_pairs([5, 3], vectors)) == [(3, 1, 3, True), (5, 1, 3, False)]


@pytest.mark.parametrize("cosine", [0.9, 0.94])
def test_narrow_cone_is_exact(spark, monkeypatch, cosine):
    monkeypatch.setattr(pivot_index, "BLOCK", 100)
    vectors = cone(np.random.default_rng(11), 400, cosine).tolist()
    ids = list(range(len(vectors)))
    want = sorted(all_pairs(ids, vectors))
    assert sum(r[1] for r in want) > 150
    assert sorted(map(tuple, pivot_index.vector_groups(frame(spark, ids, vectors, "double")).collect())) == want


@pytest.mark.parametrize("cosine", [0.0, 0.5, 0.7, 0.8, 0.85])
def test_pivots_find_the_links_of_cones(cosine):
    vectors = pivot_index.unit(cone(np.random.default_rng(12), 3000, cosine))
    pivots, shared = pivot_index.chosen_pivots(vectors)
    own = np.zeros((len(vectors), len(pivots)))
    np.put_along_axis(own, pivot_index.nearest(vectors, pivots), 1.0, 1)
    linked = np.triu(vectors @ vectors.T >= 0.95, 1)
    assert linked.sum() > 1000 and ((own @ own.T >= shared) & linked).sum() >= pivot_index.RECALL * linked.sum()


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want = sorted(all_pairs([r["vec_id"] for r in rows], [r["embedding"] for r in rows]))
    assert sorted(map(tuple, QUERIES["op8_pivot_index"](spark, sf).collect())) == want
