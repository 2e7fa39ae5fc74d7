"""Exact duplicates against a plain grouping of the texts."""

import hashlib
import re

from pyspark.sql import functions as F

from pagequill.llm import exact_dedup as xd

SCHEMA = "doc_id long, text string, kept string, recipe int"
TEXTS = [
    (1, "a b  c"), (2, "abc"), (3, "a\tb\nc"), (4, None), (5, ""), (6, " \x0b\x0c\r"), (7, "a bc"),
    (8, "x" * 5000), (9, "x" * 2500 + "\n" + "x" * 2500), (10, "x" * 4999), (None, "abc"), (None, "only"),
    (11, "twice"), (11, "twice"), (12, "Ä ö" * 900), (13, "Äö" * 900), (14, "\U0001f600 z" * 700),
]


def expected(rows):
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    out = []
    for i, t in rows:
        same = [r for r in rows if plain(r[1]) == plain(t)]
        keep = min(same, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        out.append((i, keep, len(same), i == keep, hashlib.sha256(plain(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)


def test_groups(spark):
    got = xd.exact_groups(frame(spark, TEXTS)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(TEXTS)


def test_clashing_identifiers_are_told_apart(spark):
    weak = lambda chunk: F.ascii(chunk).cast("long")
    got = xd.exact_groups(frame(spark, TEXTS), identify=weak).collect()
    assert sorted(map(tuple, got), key=repr) == expected(TEXTS)


def test_chunks_join_to_the_text_and_meet_again_behind_an_edit(spark):
    words = " ".join(hashlib.md5(str(i).encode()).hexdigest() for i in range(2000))
    texts = spark.createDataFrame([(words,), ("inserted" + words,)], "text string")
    plain = texts.select(xd.normalised(F.col("text")).alias("p"))
    rows = plain.select("p", xd.chunks_of(F.col("p")).alias("c")).collect()
    assert all("".join(r["c"]) == r["p"] for r in rows)
    assert all(len(c) <= xd.LONGEST for r in rows for c in r["c"])
    assert len(set(rows[0]["c"]) & set(rows[1]["c"])) > 0.8 * len(rows[0]["c"])


def test_drop_copies_keeps_columns(spark):
    df = frame(spark, TEXTS)
    kept = xd.drop_copies(df)
    assert kept.columns == df.columns
    want = {r[0] for r in expected(TEXTS) if r[3] and r[0] is not None}
    assert {r["doc_id"] for r in kept.collect()} - {None} == want


def test_one_row_of_each_group_stays(spark):
    rows = [(1, "b"), (1, "c"), (0, "b"), (None, "b"), (None, "d"), (None, "d"), (7, "e"), (7, "e"), (8, "f  f"), (2, "ff")]
    kept = sorted(((r["doc_id"], r["text"]) for r in xd.drop_copies(frame(spark, rows)).collect()), key=repr)
    assert kept == sorted([(0, "b"), (1, "c"), (None, "d"), (7, "e"), (8, "f  f")], key=repr)


def test_empty_table_and_no_python(spark):
    groups = xd.exact_groups(frame(spark, []))
    assert groups.count() == 0
    assert "Python" not in groups._jdf.queryExecution().toString()
