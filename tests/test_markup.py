import random
import re
import time

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import pagequill as pq

from .conftest import rows

PAGES = [
    (1, "{{Infobox\n| a=b\n}}\nBody {{x}} text\n* item\n[[File:z]]\n== H =="),
    (2, "'''Bold''' and ''it'' [[Target page|label]] [[Plain]]\n[[Category:Some cat]]"),
    (3, 'See [http://a.example/x A title]{{Cite web|title=T|url=U}}<ref name="N">z</ref><!-- c -->'),
    (4, "* {{Gutenberg|no=3567|name=Memoirs}} {{worldcat id|id=lccn-n79}} {{lang-fr|mot|links=no}}"),
    (5, "=== Deep ===\n====\n}}\nhidden"),
    (6, ""),
]


def pages(spark, data=PAGES):
    return spark.createDataFrame(data, "id long, text string")


def lines(spark, *texts):
    return pages(spark, list(enumerate(texts)))


def test_visible_lines(spark):
    assert rows(pq.visible_lines(pages(spark)), "id", "line") == sorted([
        (1, "Body {{x}} text"), (1, "* item"), (1, "== H =="),
        (2, PAGES[1][1].split("\n")[0]), (2, "[[Category:Some cat]]"),
        (3, PAGES[2][1]), (4, PAGES[3][1]), (5, "=== Deep ==="), (5, "===="),
    ])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["{{", "}}", "x", "{", "}", "|", " "]), max_size=4).map("".join),
                max_size=14))
def test_visible_lines_against_a_counter(spark, page):
    text, depth, expected = "\n".join(page), 0, []
    for pos, line in enumerate(text.split("\n")):
        opened, closed = len(re.findall(r"\{\{", line)), len(re.findall(r"\}\}", line))
        depth += (opened > closed) - (opened < closed)
        if depth == 0 and line and not line.startswith(("}}", "|", "{", "<", "[[File")):
            expected.append((pos, line))
    assert rows(pq.visible_lines(pages(spark, [(1, text)])), "pos", "line") == expected


def test_plain_text(spark):
    cases = {
        "'''Bold''' and ''it'' '''''both''''' [[T|l]] [[P]]": "Bold and it both l P",
        "[[Category:Some cat]] [http://x.y some title] [http://x.y] [note]": "Some cat some title http://x.y note",
        'a<ref name="N">z</ref>b<ref>q</ref>c<ref name="M" />d<!-- x -->e{{t|u}}f': "abcdef",
        "plain, it's": "plain, it's",
    }
    got = {r["id"]: r["plain"] for r in pq.plain_lines(lines(spark, *cases)).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_kinds(spark):
    df = pq.classify_lines(lines(spark, "* i", "== h ==", "====", "p", "[* x]", "'''* y'''", "[[* z]]"))
    assert [r[0] for r in df.orderBy("id").select("kind").collect()] == [
        "item", "heading", "heading", "paragraph", "item", "paragraph", "paragraph"
    ]


def test_headings(spark):
    df = pq.headings(lines(spark, "== H ==", "=== a=b ===", "==Open", "====", "=x"))
    assert rows(df, "id", "level", "heading") == [(0, 2, " H "), (1, 3, " a=b "), (2, 2, "Op"), (4, 1, "")]


def test_links(spark):
    df = pages(spark)
    assert rows(pq.page_links(df)) == [(2, "Plain", "Plain"), (2, "Target_page", "label")]
    assert rows(pq.page_categories(df)) == [(2, "Some cat")]
    external = pq.external_links(lines(spark, "[http://a t u] [https://b c] [http://d]"))
    assert rows(external) == [(0, "", "http://d"), (0, "http://a", "t u")]


def test_citations(spark):
    df = pq.citations(lines(spark, "x {{Cite web|title=T|a=1|a=2|b|title=Z}} {{cite book}}"))
    got = sorted((r["type"], r["title"], r["attributes"]) for r in df.collect())
    assert got == [("book", "", {}), ("web", "Z", {"a": "2", "b": ""})]


def test_library_and_language_notes(spark):
    df = pages(spark)
    assert rows(pq.library_refs(df)) == [
        (4, "gutenberg", "3567", "Memoirs", "http://www.gutenberg.org/ebooks/3567"),
        (4, "worldcat", "lccn-n79", "Worldcat reference", "http://www.worldcat.org/identities/lccn-n79"),
    ]
    notes = pq.language_notes(lines(spark, "x {{lang-fr|mot|links=no}} {{x|a|IPA b|c}} {{cite q|z}} {{a cite|z}}"))
    assert rows(notes, "template", "note") == [("lang-fr", "French: mot"), ("x", "[ac]")]
    assert rows(pq.named_refs(df)) == [(3, "N")]


def test_abstracts(spark):
    got = dict(rows(pq.abstracts(pages(spark))))
    assert got == {
        1: "Body  text", 2: "Bold and it label Plain", 3: "See A title", 4: "", 5: "", 6: ""
    }


def test_clean_text(spark):
    df = spark.createDataFrame([(1, "Title", PAGES[0][1]), (2, "Two", "")], "id long, title string, text string")
    assert rows(pq.clean_text(df), "id", "content") == [(1, "Title Body  text\n* item\n== H =="), (2, "Two ")]


def test_many_unbalanced_lines(spark):
    """Twice the lines are about twice the work, also where every line opens or closes a block."""
    def page(n):
        return "\n".join(("{{ a", "}} b", "kept", "}} c", "{{ d", "too")[i % 6] for i in range(n))

    def seconds(n):
        df = pages(spark, [(0, page(n))] * 4).repartition(4)
        best = 1e9
        for _ in range(3):
            begin = time.perf_counter()
            shown = pq.visible_lines(df).agg(F.count("*")).first()[0]
            best = min(best, time.perf_counter() - begin)
        return best, shown

    (small, few), (large, many) = seconds(8_000), seconds(32_000)
    assert many == pytest.approx(4 * few, rel=0.01) and many > 0
    assert large < 6 * small + 0.5


def test_stretches_across_blocks(spark):
    """The count is right behind more turns than a block has."""
    rng = random.Random(5)
    texts = ["\n".join(rng.choice(["{{ a", "}} b", "x", "y {{z}}"]) for _ in range(n)) for n in (127, 128, 129, 1000, 3000)]
    got = rows(pq.visible_lines(lines(spark, *texts)), "id", "pos", "line")
    want = []
    for i, text in enumerate(texts):
        depth = 0
        for pos, line in enumerate(text.split("\n")):
            depth += (line.count("{{") > line.count("}}")) - (line.count("{{") < line.count("}}"))
            if depth == 0 and not line.startswith(("}}", "{")):
                want.append((i, pos, line))
    assert got == sorted(want)
