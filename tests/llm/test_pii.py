"""Personal data: patterns against plain ones, messages against enumeration, repeated mentions."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from pagequill.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_patterns_on_random_texts():
    rng, parts = random.Random(2), ["a", "b.c", "@", ".", "_", "x@y.z", "1.2.3.4", "256.1.1.1", "001.002.3.4", ".5", "4111 1111 1111 1111",
             "4111111111111111", "-", " ", "+1 (017) 555-7713", "+", "(", ")", "12", "999", "é", "\n", "+44 20 7946 0958", "79927398713"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 12)))
        assert pii.base_spans(text) == plain(text), text


def test_patterns_on_the_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert all(pii.base_spans(r["text"]) == plain(r["text"]) for r in rows)
    assert sum(len(pii.base_spans(r["text"])) for r in rows) > 20


@pytest.mark.parametrize("text", ["a" * 200_000 + "@", "1" * 200_000, "@" * 100_000, "x" * 300_000, "1." * 100_000, "+" * 99_999 + "1"])
def test_long_runs_take_no_time(text):
    pii.base_spans(text)
    pii.candidates(text)


def test_candidates():
    text = " ab 1x\t@ y\n\nz9z é2"
    assert [text[a:b] for a, b in pii.candidates(text)] == ["1x", "@", "z9z", "é2"]


def test_messages_are_exact_on_a_tree():
    rng, k = np.random.default_rng(5), len(pii.KINDS) + 1
    g = pii.Graph(rng.integers(0, 2, (4, pii.FEATURES)).astype(float), np.array([0, 0, 2, 0]), np.array([[0, 1], [1, 3], [1, 2]]), np.array([False, True, False]))
    field = pii.Field(rng.normal(size=(pii.FEATURES, k)) * 0.3, rng.normal(size=(k, k)), 2.0 * np.eye(k))
    unary, want = g.features @ field.weights, np.zeros((4, k))
    for labels in itertools.product(range(k), repeat=4):
        if labels[2] == 2:
            score = sum(unary[i, x] for i, x in enumerate(labels) if i != 2)
            for (a, b), skip in zip(g.pairs, g.skip):
                score += (field.skip if skip else field.chain)[labels[a], labels[b]]
            for i, x in enumerate(labels):
                want[i, x] += np.exp(score)
    got = pii.Field(field.weights, field.chain, field.skip)
    assert np.allclose(got.marginals(g), want / want.sum(1, keepdims=True), atol=1e-3)


def corpus():
    rng = random.Random(6)
    rows = []
    for i in range(400):
        phone = f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"
        mail = f"user{i}.name@mail{i % 7}.example.com"
        rows.append(f"Section {i % 9} of 12, version 2.0, year {rng.randint(1990, 2020)}. Call {phone} or write {mail} today, {rng.randint(10, 99)} places")
    return rows


def test_repeated_mentions_are_added_and_plain_numbers_are_not():
    rows = corpus()
    field = pii.fitted(pii.graph(rows, [pii.candidates(t) for t in rows], [pii.base_spans(t) for t in rows]))
    text = "Call +1 (212) 555-7713 now. " + "word " * 500 + "Again 212-555-7713 and 555-7713, version 4.0, page 17 of 1999."
    base, whole = pii.all_spans([text, "Version 2.0, 17 of 20 pages, year 1999", ""], field)
    assert [text[a:b] for a, _, b in base[0]] == ["+1 (212) 555-7713"]
    added = [(pii.KINDS[k], text[a:b]) for a, k, b in whole[0] if (a, k, b) not in base[0]]
    assert ("phone", "555-7713") in added and all("4.0" not in x and "1999" not in x and "17" != x for _, x in added)
    assert whole[1] == whole[2] == [] and set(base[0]) <= set(whole[0])
    assert pii.redacted(text, pii.written(whole[0])).count("[phone]") >= 2


@pytest.mark.parametrize(
    "kind, first, again",
    [
        ("phone", "+1 (212) 555-7713", "212-555-7713"), ("phone", "+1 (212) 555-7713", "212 555 7713"),
        ("phone", "+1 (212) 555-7713", "(212) 555-7713"), ("phone", "+44 20 7946 0958", "020 7946 0958"),
        ("card", "4111 1111 1111 1111", "4111.1111.1111.1111"), ("phone", "+1 (212) 555-7713", "1-212-555 7713"),
        ("email", "jo.do@mail.example.com", "jo.do@mail"),
    ],
)
def test_mentions_of_several_words_and_prefixes(kind, first, again):
    rows = corpus() + [f"Paid by 5500 0000 0000 {i:04d} then" for i in range(400)]
    field = pii.fitted(pii.graph(rows, [pii.candidates(t) for t in rows], [pii.base_spans(t) for t in rows]))
    for text in (f"Use {first} now. " + "word " * 300 + f"Again {again}, version 4.0, page 17 of 1999.", f"First {again}; later {first} twice"):
        base, whole = pii.all_spans([text], field)
        added = {(pii.KINDS[k], text[a:b]) for a, k, b in whole[0]} - {(pii.KINDS[k], text[a:b]) for a, k, b in base[0]}
        assert added == {(kind, again)}, text


def test_a_mention_behind_another_number():
    text = "Call +1 (212) 555-7713. " + "word " * 20 + "rooms 17 212 555 7713 follow"
    words, spans = pii.candidates(text), pii.base_spans(text)
    mentions = [text[words[e.first][0] : words[e.last][1]] for e in pii.entities(text, words, spans)]
    assert mentions[-1] == "212 555 7713"


def test_other_numbers_are_no_mentions():
    rows = corpus()
    field = pii.fitted(pii.graph(rows, [pii.candidates(t) for t in rows], [pii.base_spans(t) for t in rows]))
    text = "Call +1 (212) 555-7713. Order 9998887776, 1 212 555 9999, 2001 2002 2003 and 7713"
    base, whole = pii.all_spans([text], field)
    assert whole == base


def test_frames(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(corpus())] + [(None, None, "x", 1), (900, "", "x", 1), (900, "", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, h int")
    got = pii.personal_data(df).collect()
    assert len(got) == len(rows)
    for r in got:
        own = plain(corpus()[r["doc_id"]]) if r["doc_id"] is not None and r["doc_id"] < 900 else []
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == i for s in own) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(pii.written(own).encode()).hexdigest()
        assert set(filter(None, pii.written(own).split(","))) <= set(filter(None, r["spans"].split(",")))
    assert pii.personal_data(df.limit(0)).count() == 0


def test_sample_of_many_copies(spark, monkeypatch):
    texts, seen = corpus()[:20], []
    monkeypatch.setattr(pii, "FIT_WORDS", 200)
    monkeypatch.setattr(pii, "fitted", lambda g: seen.append(len(g.labels)))
    df = spark.range(4000).selectExpr("CAST(id % 20 AS int) + 1 AS k").join(
        spark.createDataFrame(list(enumerate(texts, 1)), "k int, text string"), "k")
    pii.fit(df)
    assert seen == [sum(len(pii.candidates(t)) for t in texts)]
