"""Lines of a page that are shown, and what is written in them.

Every table here is made row by row: the lines of a page stay in its row, so no job of
this module shuffles, and a page id that occurs very often costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, markup as mk

#: Turns of a block, see :func:`with_shown_lines`.
BLOCK = 128


def with_shown_lines(pages: DataFrame) -> DataFrame:
    """Adds ``shown``: the page's shown lines as an array of ``(pos, line)``.

    A running count of open ``{{`` blocks hides lines. It changes only at the lines
    whose braces do not balance, the turns. Turns are taken in blocks: one fold gives the count before
    each block, and a fold inside each block the stretches (start, length) at count zero. Lines are cut out
    once at the end, so the work grows with the lines and not with the square of the turns.
    """
    lines = F.col("_lines")
    numbered = F.transform(
        F.split("text", "\n"), lambda line, i: F.struct(i.alias("pos"), line.alias("line"))
    )
    turns = F.filter(
        F.transform(lines, lambda x: F.struct(x["pos"].alias("at"), mk.brace_step(x["line"]).alias("step"))),
        lambda t: t["step"] != 0,
    )
    end = F.array(F.struct(F.size(lines).alias("at"), F.lit(0).alias("step")))
    blocks = F.sequence(F.lit(0), F.floor((F.size("_turns") - 1) / BLOCK).cast("int"))

    # A slice would walk over the whole array each time; places are looked up one by one.
    def of_block(block: Column) -> Column:
        last = F.least((block + 1) * BLOCK, F.size("_turns")) - 1
        return F.transform(F.sequence(block * BLOCK, last), lambda i: F.get("_turns", i))

    def steps(block: Column) -> Column:
        return F.aggregate(of_block(block), F.lit(0), lambda total, t: total + t["step"])

    before = F.aggregate(
        blocks, F.array(F.lit(0)), lambda known, block: F.array_append(known, F.element_at(known, -1) + steps(block))
    )
    empty = F.array().cast("array<struct<start:int,length:int>>")

    def advance(state: Column, turn: Column) -> Column:
        stretch = F.struct(state["start"].alias("start"), (turn["at"] - state["start"]).alias("length"))
        some = (state["open"] == 0) & (turn["at"] > state["start"])
        kept = F.when(some, F.array_append(state["kept"], stretch)).otherwise(state["kept"])
        return F.struct(
            turn["at"].alias("start"), (state["open"] + turn["step"]).alias("open"), kept.alias("kept")
        )

    def stretches(block: Column) -> Column:
        begin = F.when(block == 0, 0).otherwise(F.get("_turns", block * BLOCK - 1)["at"])
        start = F.struct(begin.alias("start"), F.get("_before", block).alias("open"), empty.alias("kept"))
        return F.aggregate(of_block(block), start, advance, lambda state: state["kept"])

    outside = F.flatten(F.transform(blocks, stretches))
    places = F.flatten(F.transform("_stretches", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
    cut = F.transform(places, lambda i: F.get(lines, i))
    return (
        pages.withColumn("_lines", numbered)
        .withColumn("_turns", F.concat(turns, end))
        .withColumn("_before", before)
        .withColumn("_stretches", outside)
        .withColumn("shown", F.filter(cut, lambda x: mk.is_shown_line(x["line"])))
        .drop("_lines", "_turns", "_before", "_stretches")
    )


def visible_lines(pages: DataFrame) -> DataFrame:
    """``(id, pos, line)`` of every shown line."""
    # The outer form keeps the optimizer from copying the whole fold into a pre-filter.
    return (
        with_shown_lines(pages.select("id", "text"))
        .select("id", F.inline_outer("shown"))
        .where(F.col("line").isNotNull())
    )


def plain_lines(pages: DataFrame) -> DataFrame:
    """``(id, pos, plain)``: shown lines without inline markup."""
    return visible_lines(pages).select("id", "pos", mk.plain_text("line").alias("plain"))


def classify_lines(pages: DataFrame) -> DataFrame:
    """``(id, pos, kind, plain)`` of every shown line."""
    return visible_lines(pages).select(
        "id", "pos", mk.line_kind("line").alias("kind"), mk.plain_text("line").alias("plain")
    )


def headings(pages: DataFrame) -> DataFrame:
    """``(id, pos, level, heading)``."""
    return (
        visible_lines(pages)
        .where(mk.heading_level("line") > 0)
        .select(
            "id",
            "pos",
            mk.heading_level("line").alias("level"),
            mk.heading_text("line").alias("heading"),
        )
    )


def _found(pages: DataFrame, pattern: str, name: str = "body") -> DataFrame:
    """One row per match of ``pattern`` in a shown line, its first group as ``name``."""
    return (
        visible_lines(pages)
        .where(F.col("line").rlike(pattern))
        .select("id", "pos", F.explode_outer(
            F.regexp_extract_all("line", F.lit(pattern), F.lit(1))).alias(name))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """``(id, target, label)`` of links to pages; blanks of the target become ``_``."""
    parts = F.split("body", r"\|")
    return (
        _found(pages, fixed.LINK)
        .where(~F.col("body").startswith(fixed.CATEGORY_PREFIX))
        .select(
            "id",
            F.regexp_replace(F.get(parts, F.lit(0)), r"\s", "_").alias("target"),
            F.coalesce(F.get(parts, F.lit(1)), F.col("body")).alias("label"),
        )
    )


def page_categories(pages: DataFrame) -> DataFrame:
    """``(id, category)``."""
    return (
        _found(pages, fixed.LINK)
        .where(F.col("body").startswith(fixed.CATEGORY_PREFIX))
        .select("id", F.substr("body", F.lit(len(fixed.CATEGORY_PREFIX) + 1)).alias("category"))
    )


def external_links(pages: DataFrame) -> DataFrame:
    """``(id, url, title)``; without a blank there is no url and all of it is the title."""
    blank = F.instr("body", " ")
    return (
        _found(pages, fixed.BRACKET)
        .where(F.col("body").startswith(fixed.EXTERNAL_PREFIX))
        .select(
            "id",
            F.when(blank > 0, F.substr("body", F.lit(1), blank - 1)).otherwise("").alias("url"),
            F.substr("body", blank + 1).alias("title"),
        )
    )


def citations(pages: DataFrame) -> DataFrame:
    """``(id, type, title, attributes)``; ``attributes`` maps the other keys to values.

    Of a repeated key the last value counts.
    """
    sections = F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0)))
    pairs = F.transform(
        F.filter("sections", lambda s: mk.section_key(s) != "title"),
        lambda s: F.struct(mk.section_key(s).alias("key"), mk.section_value(s).alias("value")),
    )
    last = F.filter(
        F.col("pairs"),
        lambda p, i: ~F.exists(
            F.slice(F.col("pairs"), i + 2, F.size("pairs")), lambda q: q["key"] == p["key"]
        ),
    )
    return (
        _found(pages, fixed.CITE)
        .withColumn("parts", F.split("body", r"\|"))
        .withColumn("sections", sections)
        .withColumn("pairs", pairs)
        .select(
            "id",
            F.get("parts", F.lit(0)).alias("type"),
            F.coalesce(mk.last_value(F.col("sections"), "title"), F.lit("")).alias("title"),
            F.map_from_entries(last).alias("attributes"),
        )
    )


def library_refs(pages: DataFrame) -> DataFrame:
    """``(id, kind, key, title, url)`` of Gutenberg and Worldcat notes."""
    lines = visible_lines(pages).where(F.lower("line").rlike(r"\{\{(gutenberg|worldcat)"))
    notes = lambda pattern, kind: F.transform(
        F.regexp_extract_all("line", F.lit(pattern), F.lit(1)),
        lambda b: F.struct(F.lit(kind).alias("kind"), b.alias("body")),
    )
    found = lines.select(
        "id",
        F.inline_outer(
            F.concat(notes(fixed.GUTENBERG, "gutenberg"), notes(fixed.WORLDCAT, "worldcat"))
        ),
    ).where(F.col("body").isNotNull())
    parts = F.split("body", r"\|")
    sections = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    is_book = F.col("kind") == "gutenberg"
    found = found.select(
        "id",
        "kind",
        F.when(is_book, F.coalesce(mk.last_value(sections, "no"), F.lit("0")))
        .otherwise(F.substr("body", F.greatest(F.instr("body", "id="), F.lit(0)) + 3))
        .alias("key"),
        F.when(is_book, F.coalesce(mk.last_value(sections, "name"), F.lit("")))
        .otherwise(fixed.WORLDCAT_TITLE)
        .alias("title"),
    )
    base = F.when(F.col("kind") == "gutenberg", fixed.GUTENBERG_URL).otherwise(fixed.WORLDCAT_URL)
    return found.withColumn("url", F.concat(base, F.col("key")))


def language_notes(pages: DataFrame) -> DataFrame:
    """``(id, template, language, note)`` of templates that are no citation or library note.

    Known languages read ``French: …``, all other templates ``[…]``.
    """
    names = F.create_map(*[F.lit(x) for pair in fixed.LANGUAGES.items() for x in pair])
    parts = F.split("body", r"\|")
    words = F.filter(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda p: ~p.rlike(fixed.SKIPPED_LANGUAGE_PARTS),
    )
    shown = F.array_join(words, "")
    return (
        _found(pages, fixed.TEMPLATE)
        .where(~F.col("body").rlike(r"(?i)^(cite|gutenberg|worldcat)"))
        .where(~F.get(parts, F.lit(0)).contains("cite"))
        .select(
            "id",
            F.get(parts, F.lit(0)).alias("template"),
            F.try_element_at(names, F.get(parts, F.lit(0))).alias("language"),
            shown.alias("words"),
        )
        .select(
            "id",
            "template",
            "language",
            F.when(F.col("language").isNotNull(), F.concat("language", F.lit(": "), "words"))
            .otherwise(F.concat(F.lit("["), "words", F.lit("]")))
            .alias("note"),
        )
    )


def named_refs(pages: DataFrame) -> DataFrame:
    """``(id, name)``."""
    return _found(pages, fixed.NAMED_REF, "name").select("id", "name")


def with_abstract(pages: DataFrame) -> DataFrame:
    """Adds ``abstract``: the first paragraph of the page, "" if there is none."""
    paragraphs = F.filter("shown", lambda x: mk.line_kind(x["line"]) == "paragraph")
    return (
        with_shown_lines(pages)
        .withColumn("_first", F.get(paragraphs, F.lit(0))["line"])
        .withColumn("abstract", F.coalesce(mk.plain_text("_first"), F.lit("")))
        .drop("_first", "shown")
    )


def abstracts(pages: DataFrame) -> DataFrame:
    """``(id, abstract)``: the first paragraph of each page."""
    return with_abstract(pages.select("id", "text")).select("id", "abstract")
