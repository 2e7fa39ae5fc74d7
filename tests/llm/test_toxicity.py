"""Toxicity scores: held-out accuracy, what a score may depend on, and odd rows."""

import random
import zlib

import numpy as np
import pytest

from pagequill.llm import toxicity

RUDE = ["wretch", "imbecile", "vermin", "dunce"]


def texts(n, seed):
    rng = random.Random(seed)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    out = []
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(40, 160))]
        label = i % 4 == 0
        if label:
            for _ in range(rng.randint(3, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(RUDE))
        out.append((" ".join(words), int(label)))
    return out


@pytest.fixture(scope="module")
def model():
    rows = texts(900, 1)
    return toxicity.fitted([t for t, _ in rows], np.array([y for _, y in rows]), 0.25)


def test_held_out_accuracy(model):
    rows = texts(300, 2)
    scores = model.scores([t for t, _ in rows])
    labels = np.array([y for _, y in rows])
    assert ((scores >= toxicity.THRESHOLD) == labels).mean() > 0.93
    assert scores[labels == 1].mean() > 0.7 and scores[labels == 0].mean() < 0.1
    assert abs(scores.mean() - 0.25) < 0.06


def test_windows_cover_all_words():
    for n in range(0, 30):
        words = [str(i).encode() for i in range(n)]
        assert {w for x in toxicity.windows(words) for w in x.split()} == set(words)


def test_long_empty_and_null_texts(model, monkeypatch):
    odd = ["", None, "x" * 300_000, "a " * 50_000, " \n\t", "é" * 7]
    whole = model.scores(odd)
    assert np.isfinite(whole).all() and (whole >= 0).all() and (whole <= 1).all()
    assert whole[0] == whole[1] == whole[4]
    monkeypatch.setattr(toxicity, "BLOCK", 64)
    assert np.allclose(model.scores(odd), whole) and np.allclose(model.scores(odd[3:4]), whole[3])


def test_a_rude_end_of_a_long_text_counts(model):
    start = " ".join(t for t, y in texts(200, 5) if not y)
    assert model.features([start])[0, -3] < model.features([start + " wretch imbecile vermin dunce wretch"])[0, -3]


def test_without_both_labels():
    assert toxicity.fitted(["a b"], np.array([0]), 0.0).scores(["x", ""]).tolist() == pytest.approx([1e-6, 1e-6])


def test_frames(spark):
    rows = [(i, t, "s", 0) for i, (t, _) in enumerate(texts(400, 3))] + [(None, "x", "s", 1), (1000, None, "s", 1), (1000, None, "s", 1)]
    labels = [(i, y, 9) for i, (_, y) in enumerate(texts(400, 3))] + [(None, 1, 0), (3, None, 0), (5, 7, 0), (7777, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string, score int")
    known = spark.createDataFrame(labels, "doc_id long, toxic int, text int")
    got = {r["doc_id"]: r for r in toxicity.toxicity_scores(docs, known).collect()}
    assert len(got) == 402 and got[1000]["score"] is not None and got[None]["held_out"] is False
    for i, r in got.items():
        assert r["predicted"] == int(r["score"] >= 0.3)
        assert i is None or r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
    # Labels of held-out rows, and rows without a usable label, change nothing.
    other = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y, 0) for i, (_, y) in enumerate(texts(400, 3))]
    again = toxicity.toxicity_scores(docs, spark.createDataFrame([*other, (7777, 1, 1)], "doc_id long, toxic int, text int"))
    assert {r["doc_id"]: r["score"] for r in again.collect()} == {i: r["score"] for i, r in got.items()}
    kept = toxicity.drop_toxic(docs, known)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["predicted"] == 0}
    assert toxicity.toxicity_scores(docs.limit(0), known.limit(0)).count() == 0


def test_labels_that_far_outnumber_the_documents(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "TOXIC_ROWS", 20)
    monkeypatch.setattr(toxicity, "ORDINARY_ROWS", 20)
    monkeypatch.setattr(toxicity, "fitted", lambda texts, y, prior: seen.append((int(y.sum()), len(y))))
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    toxicity.fit(docs, spark.range(40_000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS toxic"))
    assert seen == [(20, 40)]
