from pyspark.sql import functions as F

import pagequill as pq
from pagequill.functions import requests as rq, text as tx

from .conftest import rows


def value(spark, column, **inputs):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()])
    return df.select(column).first()[0]


def test_slices(spark):
    doc = '<page><text a="b">one</text><text>two</text></page>'
    assert value(spark, tx.tag_slice_greedy("c", "<text", "</text>"), c=doc) == "one</text><text>two"
    assert value(spark, tx.tag_slice_first("c", "<text", "</text>"), c=doc) == "one"
    assert value(spark, tx.tag_slice_exact("c", "<text>", "</text>"), c=doc) == "two"
    assert value(spark, tx.tag_slice_greedy("c", "<sha1>", "</sha1>"), c=doc) == ""


def test_slice_spans_lines_and_bad_order_is_empty(spark):
    assert value(spark, tx.tag_slice_greedy("c", "<text", "</text>"), c="<text>a\nb</text>") == "a\nb"
    assert value(spark, tx.tag_slice_first("c", "<id>", "</id>"), c="</id>1<id>") == ""
    assert value(spark, tx.tag_slice_greedy("c", "<text", "</text>"), c='<text xml:space="preserve" />') == ""


def test_page_id_is_not_the_revision_id(spark):
    raw = "<page><title>T</title><id>7</id><revision><id>9</id><text>x</text></revision></page>"
    page = pq.page_fields(spark.createDataFrame([(raw,)], "raw string")).first()
    assert (page["id"], page["title"], page["text"], page["redirect_title"]) == (7, "T", "x", "")


def test_page_without_number_has_no_id(spark):
    raw = "<page><title>T</title><id>x</id><text>x</text></page>"
    assert pq.page_fields(spark.createDataFrame([(raw,)], "raw string")).first()["id"] is None


def test_redirect_title(spark):
    assert value(spark, tx.redirect_title("c"), c='<redirect title="A &amp; B" />') == "A &amp; B"
    assert value(spark, tx.redirect_title("c"), c="<page>") == ""


def test_title_cut(spark):
    assert value(spark, tx.title_cut("c"), c="<title>Ab c</title>") == "Ab c"
    assert value(spark, tx.title_cut("c"), c="<title></title>") == ""


def test_entities_in_order(spark):
    assert value(spark, tx.entity_decode("c"), c="&amp;lt;&quot;&nbsp;x&gt;") == '<" x>'


def test_letters_and_tokens(spark):
    assert value(spark, tx.normalise_letters("c"), c="It's 5°C é") == "it s   c  "
    assert value(spark, tx.tokenize("c"), c="It's 5°C é") == ["it", "s", "c"]
    assert value(spark, tx.tokenize("c"), c="12 .") == []


def test_title_normalise(spark):
    assert value(spark, tx.title_normalise("c"), c="Été À b") == " t    b"


def test_requests(spark):
    messages = ["10 the heat tion", "-5 the the", "3 foo-bar", "2   spaced   words ", "  7 x", "alone", "-x y"]
    df = spark.createDataFrame(list(enumerate(messages)), "request_id int, msg string")
    assert rows(pq.parse_request(df)) == [
        (0, 10, 0, "the heat tion"),
        (1, 5, 1, "the the"),
        (2, 3, 0, "foo-bar"),
        (3, 2, 0, "  spaced   words"),
        (4, 7, 0, "x"),
        (5, 0, 0, ""),
        (6, 0, 0, "y"),
    ]
    assert value(spark, rq.split_terms("c"), c=" A  b a") == ["a", "b", "a"]


def test_large_limits_do_not_fail(spark):
    messages = ["99999999999 a", "-2147483648 x", "-9223372036854775808 x", "99999999999999999999999 y", "-99999999999999999999999 y"]
    df = spark.createDataFrame(list(enumerate(messages)), "request_id int, msg string")
    most = (1 << 63) - 1
    assert rows(pq.parse_request(df), "request_id", "k", "strategy") == [
        (0, 99999999999, 0), (1, 2147483648, 1), (2, most, 1), (3, most, 0), (4, most, 1)
    ]


def test_query_terms_keep_repeats(spark):
    df = pq.parse_request(spark.createDataFrame([(1, "-5 The the foo-bar")], "request_id int, msg string"))
    assert rows(pq.query_terms(df)) == [(1, 0, "the"), (1, 1, "the"), (1, 2, "foo-bar")]
