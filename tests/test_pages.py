import pagequill as pq

from .conftest import rows

BLOCKED = "t5mm8lyj25cvxe8i4i9pgokb6krbzj9"
SCHEMA = "id long, title string, redirect_title string, sha1 string, text string"
PAGES = [
    (1, "A", "", "s", "hello"),
    (2, "B", "A", "s", "#REDIRECT [[A]]"),
    (3, "C", "", BLOCKED, "#REDIRECT [[A]]"),
    (4, "D", "", "s", ""),
    (None, "E", "", "s", "#REDIRECT x"),
    (5, "A", "", "s", "#redirect x"),
]


def test_filters(spark):
    df = spark.createDataFrame(PAGES, SCHEMA)
    assert pq.drop_empty_text(df).count() == 5
    assert pq.drop_blocked_sha1(df).count() == 5
    assert pq.drop_missing_id(df).count() == 5
    assert rows(pq.indexable_pages(df), "id") == [(1,), (2,), (5,)]
    other = spark.createDataFrame([("s",), ("s",)], "sha1 string")
    assert rows(pq.drop_blocked_sha1(df, other), "id") == [(3,)]


def test_answers(spark):
    df = spark.createDataFrame(PAGES, SCHEMA)
    assert rows(pq.redirect_count(df)) == [("Answer", 2)]
    assert rows(pq.bad_doc_count(df)) == [("Answer", 1)]
    none = df.where("id > 99")
    assert rows(pq.redirect_count(none)) == []
    assert rows(pq.bad_doc_count(none)) == [("Answer", 0)]


def test_titles(spark):
    df = spark.createDataFrame(PAGES, SCHEMA)
    assert [r[0] for r in pq.title_list(df).collect()] == ["A", "B", "C", "D", "E"]
    assert rows(pq.duplicate_titles(df)) == [("A", 2)]


def directory(spark, *entries):
    df = spark.createDataFrame(list(entries), "id long, title string")
    return pq.page_directory(df)


def test_title_lookup_takes_the_first_id_as_string(spark):
    d = directory(spark, (9, "Été x"), (10, "été X"), (3, "Other"), (3, "Other"))
    assert d.count() == 3
    wanted = spark.createDataFrame([("ÉTÉ X",), ("other",), ("Oth",)], "title string")
    assert rows(pq.title_lookup(wanted, d)) == [("other", 3), ("ÉTÉ X", 10)]


def test_title_prefixes(spark):
    d = directory(spark, (9, "List of a"), (10, "list of b"), (2, "List"), (2, "List of"), (5, "Lost"), (6, ""))
    p = spark.createDataFrame([("list",), ("list of",), ("l",), ("zz",), ("",)], "prefix string")
    expected = [
        ("l", 2, 2), ("l", 10, 1), ("list", 2, 2), ("list", 10, 1), ("list of", 2, 2), ("list of", 10, 1)
    ]
    assert rows(pq.title_prefix_search(p, d, 2, 7)) == sorted(expected)
    few = pq.title_prefix_search(p, d, 2, 7, literals=["list", "list of", "l", "zz", ""])
    assert rows(few) == sorted(expected)


def test_long_prefix_lists_are_whole(spark):
    d = directory(spark, *[(i, f"Page {i}") for i in range(1500)])
    p = spark.createDataFrame([("page",)], "prefix string")
    found = rows(pq.title_prefix_search(p, d, 1200, 4), "title_rank", "id")
    assert [i for _, i in found] == [int(s) for s in sorted(map(str, range(1500)))[:1200]]


def test_page_targets(spark):
    pages = spark.createDataFrame(
        [(1, ""), (2, "Long"), (3, "Nowhere"), (4, ""), (5, "SHORT")], "id long, redirect_title string"
    )
    stats = spark.createDataFrame([(1, 100, 3), (2, 5, 1), (3, 5, 1), (4, 99, 1), (5, 2, 1)],
                                  "id long, n_words long, max_tf long")
    d = directory(spark, (1, "Long"), (4, "Short"), (5, "R"))
    assert rows(pq.page_targets(pages, stats, d)) == [(1, 1), (2, 1), (5, 4)]
