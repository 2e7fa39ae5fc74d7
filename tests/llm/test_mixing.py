"""Rates against a plain solution of the same problem, targets, and odd rows."""

import random

import numpy as np
import pytest

from pagequill.llm import mixing
from pagequill.llm.queries import MIX, QUERIES

WORDS = {"a": "red crimson scarlet rose".split(), "b": "blue navy azure sky".split(), "c": "green lime moss leaf".split()}
TARGETS = {"a": 0.4, "b": 0.3, "c": 0.3}


@pytest.fixture(scope="module")
def corpus(spark):
    rng, rows, known = random.Random(4), [], []
    for i in range(300):
        main = rng.choices("abc", (6, 2, 2))[0]
        words = [rng.choice(WORDS[main if rng.random() < 0.9 else rng.choice("abc")]) for _ in range(rng.randint(2, 7))]
        rows.append((i, " ".join(words), "x", 0.5))
        if i % 2:
            known.append((i, main, "t"))
    rows += [(None, "red blue", "x", 0.0), (700, None, "x", 0.0), (701, "", "x", 0.0), (3, "sky " * 5, "x", 0.0), (3, "sky " * 5, "x", 0.0)]
    known += [(None, "a", "t"), (5, None, "t"), (7, "zz", "t"), (9999, "b", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string, rate double")
    return docs, spark.createDataFrame(known, "doc_id long, domain string, text string")


def solved(n, p, target, floor=0.0, steps=5_000):
    """Rates of the same least squares by many plain gradient steps."""
    share = n / n.sum()
    rate = np.full(len(n), max(1.0, floor))
    inverse = np.linalg.inv((p * share[:, None]).T @ p)
    for _ in range(steps):
        pull = inverse @ ((share * rate) @ p - target)
        rate = np.maximum(floor, rate - 0.5 * (p @ pull))
    return rate


def arrays(state):
    rows = state.collect()
    return np.array([r["_n"] for r in rows], float), np.array([r["_p"] for r in rows]), np.array([r["_rate"] for r in rows])


def test_rates_match_targets_and_a_plain_solution(corpus):
    mix, state = mixing.fitted_mix(*corpus, TARGETS)
    n, p, rate = arrays(state)
    target = np.array(list(TARGETS.values()))
    assert len(n) == 305 and (rate >= 0).all() and np.allclose(p.sum(1), 1)
    assert np.abs((n * rate) @ p / n.sum() - target).max() <= mixing.TOLERANCE
    plain = solved(n, p, target)
    assert np.abs((n * plain) @ p / n.sum() - target).max() < 2 * mixing.TOLERANCE
    spread = lambda r: (n * (r - 1) ** 2).sum() / n.sum()
    assert spread(rate) < 1.1 * spread(plain) + 1e-3
    assert "Python" not in state._jdf.queryExecution().toString()


def test_rates_of_documents_are_those_of_the_table(corpus):
    mix, state = mixing.fitted_mix(*corpus, TARGETS)
    again = mix.rates(corpus[0])
    assert "Python" not in again._jdf.queryExecution().toString() and "Join" not in again._jdf.queryExecution().toString()
    key = lambda rows: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["_n"], round(r["_rate"], 9)) for r in rows)
    assert key(again.collect()) == key(state.collect())


def test_floor_and_open_budget(corpus):
    mix, state = mixing.fitted_mix(*corpus, TARGETS, floor=1.0, budget=None)
    n, p, rate = arrays(state)
    assert rate.min() >= 1.0
    got = (n * rate) @ p / n.sum()
    assert mix.met and np.abs(got / got.sum() - list(TARGETS.values())).max() <= mixing.TOLERANCE


FAR = {"a": 0.2, "b": 0.5, "c": 0.3}


def test_targets_far_from_the_corpus_are_met(corpus):
    far = np.array(list(FAR.values()))
    mix, state = mixing.fitted_mix(*corpus, FAR)
    n, p, rate = arrays(state)
    assert mix.met and rate.min() >= 0 and np.abs((n * rate) @ p / n.sum() - far).max() <= mixing.TOLERANCE
    plain = solved(n, p, far)
    spread = lambda r: (n * (r - 1) ** 2).sum() / n.sum()
    assert spread(rate) < 1.1 * spread(plain) + 1e-3
    mix, state = mixing.fitted_mix(*corpus, FAR, floor=1.0, budget=None)
    n, p, rate = arrays(state)
    got = (n * rate) @ p / n.sum()
    assert mix.met and rate.min() >= 1.0 and np.abs(got / got.sum() - far).max() < 0.01


def test_targets_out_of_reach_are_marked(corpus):
    with pytest.warns(UserWarning, match="out of reach"):
        mix, state = mixing.fitted_mix(*corpus, {"a": 0.0, "b": 0.0, "c": 1.0})
    n, p, rate = arrays(state)
    assert not mix.met and np.abs((n * rate) @ p / n.sum() - mix.reached).max() < 1e-9
    # As near as any rates can come: the least squares of many plain steps is no smaller.
    share, target = n / n.sum(), np.array([0.0, 0.0, 1.0])
    inverse = np.linalg.inv((p * share[:, None]).T @ p)
    least = lambda r: (share * r @ p - target) @ inverse @ (share * r @ p - target)
    assert least(rate) <= least(solved(n, p, target, steps=20_000)) + 1e-3


def test_posteriors_know_the_domains(corpus, spark):
    own = mixing.classifier(*corpus, list(TARGETS))
    df = spark.createDataFrame([("red rose crimson " * 9,), ("sky navy " * 9,), (None,), ("MOSS leaf lime " * 9,)], "text string")
    p = [r["_p"] for r in own.posteriors(df, "text").collect()]
    assert p[0][0] > 0.6 and p[1][1] > 0.6 and p[3][2] > 0.6 and np.allclose(p[2], own.priors)


def test_copies_follow_the_rates(corpus):
    docs, known = corpus
    got = mixing.mixed(docs, known, TARGETS)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mixed(docs, known, TARGETS).collect()))
    n_words = sum(len((r["text"] or "").split()) for r in rows)
    assert abs(n_words / sum(len((r["text"] or "").split()) for r in docs.collect()) - 1) < 0.1
    more = mixing.mixed(docs, known, TARGETS, floor=1.0, budget=None)
    assert {(r["doc_id"], r["text"]) for r in more.collect()} == {(r["doc_id"], r["text"]) for r in docs.collect()}


def test_no_rows_no_labels_and_bad_targets(corpus):
    docs, known = corpus
    assert mixing.document_rates(docs.limit(0), known, TARGETS).count() == 0
    rows = mixing.document_rates(docs, known.limit(0), {"a": 1.0}).collect()
    assert {r["rate"] for r in rows} == {1.0} and {r["p_a"] for r in rows} == {1.0}
    with pytest.raises(ValueError):
        mixing.document_rates(docs, known, {"a": 0.0})


def test_registered_query(spark):
    df = QUERIES["op1_mixing"](spark, "/root/testdata/sf0.01")
    assert df.columns == ["doc_id", "n_tokens", *(f"p_{d}" for d in MIX), "rate"]
    rows = df.collect()
    n = np.array([r["n_tokens"] for r in rows], float)
    got = [sum(r["n_tokens"] * r["rate"] * r[f"p_{d}"] for r in rows) / n.sum() for d in MIX]
    assert len(rows) == 1000 and np.abs(np.array(got) - list(MIX.values())).max() < 0.005
