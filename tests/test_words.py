from collections import Counter
import re

from hypothesis import HealthCheck, given, settings, strategies as st

import pagequill as pq
from pagequill.operators import words as wd

from .conftest import rows


def pages(spark, data):
    return spark.createDataFrame(data, "id long, content string")


CORPUS = [(1, "a a b"), (2, "B c, A-c! é9"), (3, "12 ..."), (3, "d"), (4, None)]


def test_counts(spark):
    df = pages(spark, CORPUS)
    assert rows(pq.word_count(df)) == [("a", 3), ("b", 2), ("c", 2)]
    assert rows(pq.page_word_count(df)) == [(1, 3), (2, 4), (3, 1), (4, 0)]
    assert rows(pq.page_max_word_count(df)) == [(1, 2), (2, 2), (3, 1), (4, 0)]
    assert rows(pq.inverted_index(df)) == [
        ("a", 1, 2), ("a", 2, 1), ("b", 1, 1), ("b", 2, 1), ("c", 2, 2), ("d", 3, 1)
    ]
    assert rows(pq.document_frequency(pq.inverted_index(df))) == [("a", 2), ("b", 2), ("c", 1), ("d", 1)]


def test_repeated_ids_add_up(spark):
    df = pages(spark, [(1, "a a b"), (1, "b b b a")])
    assert rows(pq.page_word_count(df)) == [(1, 7)]
    assert rows(pq.page_max_word_count(df)) == [(1, 5)]
    assert rows(pq.inverted_index(df)) == [("a", 1, 3), ("b", 1, 4)]
    assert rows(wd.page_stats(wd.page_terms(df))) == [(1, 7, 5)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 5), st.text("abB é.\n", max_size=30)), min_size=1, max_size=12))
def test_against_plain_counting(spark, data):
    df = pages(spark, data)
    tf, n_words, max_tf = Counter(), Counter(), Counter()
    for page, content in data:
        counts = Counter(re.findall("[a-z]+", content.lower()))
        n_words[page] += sum(counts.values())
        max_tf[page] += max(counts.values(), default=0)
        for word, n in counts.items():
            tf[word, page] += n
    assert rows(pq.inverted_index(df)) == sorted((w, p, n) for (w, p), n in tf.items())
    stats = rows(wd.page_stats(wd.page_terms(df)))
    assert stats == sorted((p, n_words[p], max_tf[p]) for p in {p for p, _ in data})


def test_posting_lists_span_id_ranges_for_all_words(spark):
    ids = [1, 2, 10, 100, 101, 110, 19, 200]
    df = spark.createDataFrame(
        [("hot", i, i) for i in ids] + [("rare", 7, 1), ("rare", 10, 2)], "word string, id long, tf long"
    )
    lists = pq.posting_lists(df, part_ids=100)
    got = sorted((r["word"], r["part"], [p["id"] for p in r["postings"]]) for r in lists.collect())
    assert got == [
        ("hot", 0, [1, 10, 19, 2]), ("hot", 1, [100, 101, 110]), ("hot", 2, [200]), ("rare", 0, [10, 7])
    ]
    whole = pq.posting_lists(df)
    assert rows(wd.posting_lines(whole), "line") == [
        ("hot 1 1 10 10 100 100 101 101 110 110 19 19 2 2 200 200",), ("rare 10 2 7 1",)
    ]


def test_posting_lists_have_one_rule_beyond_any_size(spark):
    df = spark.range(25_000).selectExpr("'the' AS word", "id", "1L AS tf")
    got = {r["part"]: len(r["postings"]) for r in pq.posting_lists(df).collect()}
    assert got == {0: 10_000, 1: 10_000, 2: 5_000}


def test_sorted_index_orders_ids_as_strings(spark):
    df = spark.createDataFrame([("b", 2, 1), ("a", 9, 1), ("a", 10, 1)], "word string, id long, tf long")
    assert [tuple(r) for r in pq.sorted_index(df).collect()] == [("a", 10, 1), ("a", 9, 1), ("b", 2, 1)]


def test_postings_without_sorting_words_in_their_rows(spark):
    """The inverted index needs no sorted words, the sorted one no cast in its comparisons."""
    df = pages(spark, CORPUS + [(None, "a b"), (None, "a"), (6, "")])
    found = pq.inverted_index(df)
    assert "sort_array" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, found.collect())) == sorted(map(str, wd.postings_of(wd.page_terms(df)).collect()))
    ordered = pq.sorted_index(found)
    sort = next(x for x in ordered._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Sort [" in x)
    assert "cast(" not in sort
    ids = [r["id"] for r in pq.sorted_index(spark.createDataFrame([("a", i, 1) for i in (2, 10, 9, 100)], "word string, id long, tf long")).collect()]
    assert ids == [10, 100, 2, 9]


def test_dealt_terms(spark, monkeypatch):
    """Dealt pages keep their rows, in partitions of a bounded size that what is made by id does not shuffle again."""
    monkeypatch.setattr(wd, "PART_PAGES", 2)
    df = pages(spark, [(i, "a b a" if i % 3 else "") for i in range(40)] + [(None, "c"), (7, "b")])
    terms = wd.page_terms(df)
    dealt = wd.dealt_terms(terms)
    assert dealt.rdd.getNumPartitions() == 21
    key = lambda found: sorted(map(str, found.select(*terms.columns).collect()))
    assert key(dealt) == key(terms)
    plan = wd.postings_of(dealt)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
