"""Periodic runs against every stretch of words."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from pagequill.llm import periodic
from pagequill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(words):
    """All runs, by looking at every period."""
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                run = words[i : i + length]
                if not any(run[p:] == run[:-p] for p in range(1, q)):
                    out.add((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return [w.decode("utf-8", "surrogatepass") for w in (text or "").encode("utf-8", "surrogatepass").split()]


def texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        letters = "abcd"[: rng.randint(1, 4)]
        words = rng.choices(letters, k=rng.randrange(50))
        for _ in range(rng.randrange(3)):
            block = rng.choices(letters, k=rng.randint(1, 9)) * rng.randint(2, 7)
            at = rng.randrange(len(words) + 1)
            words[at:at] = block[: rng.randint(1, len(block))] * rng.randint(1, 5)
        yield rng.choice([" ", "\n", "  \t"]).join(words)


def test_runs_against_all_periods():
    for text in texts(1, 1500):
        words = words_of(text)
        assert periodic.found_runs(np.array([ord(w) for w in words], np.int64)) == brute(words), text


def test_many_texts_at_once_and_one_by_one(monkeypatch):
    """Runs end where a text ends, also if the next one goes on alike."""
    own = [*texts(2, 200), *["a a a a a"] * 5, None, "", " ", "a b " * 40, "b a " * 40]
    whole = periodic._described(own)
    monkeypatch.setattr(periodic, "TOGETHER", 1)
    assert [x for g in periodic._together(own) for x in periodic._described(g)] == whole
    for text, (runs, rest) in zip(own, whole):
        words = words_of(text)
        assert runs == brute(words) and rest == collapsed(words, runs)


@pytest.mark.parametrize("words, longest", [
    (["x"] * 100_000, (0, 100_000, 1)),
    (list("ab") * 30_000 + ["c"] + list("abc") * 20_000, (59_998, 60_003, 3)),
    ([str(i % 7919) for i in range(60_000)], (0, 60_000, 7919)),
])
def test_very_long_texts(words, longest):
    runs, _ = periodic._described([" ".join(words)])[0]
    assert max(runs, key=lambda r: r[1]) == longest and all(n >= max(6, 4 * q) for _, n, q in runs)


def test_odd_rows(spark):
    rows = [(1, "a a a a a a b"), (1, "a a a a a a b"), (None, "x y " * 6), (2, None), (3, ""), (4, " \n\t"), (5, "é é é é é é"), (6, "a a " * 5)]
    df = spark.createDataFrame([(i, t, 0, "x", "y") for i, t in rows], "doc_id long, text string, runs int, collapsed string, start string")
    got = periodic.periodic_runs(df)
    assert got.columns == ["doc_id", "runs", "collapsed"]
    want = []
    for i, text in rows:
        words = words_of(text)
        runs = brute(words)
        want.append((i, runs, collapsed(words, runs)))
    assert sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert periodic.periodic_runs(df.limit(0)).count() == 0


def planted(doc_id, words):
    """The contract's own words, one by one."""
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def test_registered_query(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = [(i, t, "en", "s", 0) for i, t in [(1000, None), (1001, ""), (None, "q " * 9), (13, "z y " * 20), (13, "z y " * 20)]]
    docs.unionByName(spark.createDataFrame(odd, docs.schema)).write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect():
        words = words_of(r["text"])
        words = words if r["doc_id"] is None else planted(r["doc_id"], words)
        runs = brute(words)
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None, None, None))
        milli = None if not runs else 1000 * best[1] // best[2]
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((r["doc_id"], len(runs), *best, milli, sha(lines), sha(collapsed(words, runs))))
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) >= 4


def test_the_strongest_run_is_compared_exactly(spark):
    runs = [(5, 10**9 + 1, 10**8), (0, 10**9, 10**8), (2, 100, 10), (9, 20, 2)]
    df = spark.createDataFrame([(runs,), ([],), (runs[1:],)], "runs array<struct<start:bigint,length:bigint,period:bigint>>")
    got = [r[0] and tuple(r[0]) for r in df.select(periodic.strongest(df["runs"])).collect()]
    assert got == [runs[0], None, runs[1]]
