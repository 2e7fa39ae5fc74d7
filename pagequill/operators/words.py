"""Word statistics and the inverted index.

Input is ``pages(id, content)``; one input row is one page record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokenize

#: Page ids that one part of a posting list spans.
PART_IDS = 10_000
#: Most pages and terms of a partition of dealt pages, on average.
PART_PAGES, PART_TERMS = 1 << 12, 1 << 20


def with_counts(df: DataFrame, words: Column, name: str) -> DataFrame:
    """Adds ``name``, the distinct entries of the array ``words`` as ``(word, tf)``.

    Words are counted inside the row: sorted words form runs, and the start of each run
    gives the word and its count. Nothing is shuffled, and what leaves the row is already
    one entry per word instead of one per occurrence.
    """
    at, in_order, size = F.col("_at"), F.col("_words"), F.size("_words")
    run_starts = F.when(
        size > 0,
        F.filter(
            F.sequence(F.lit(0), size - 1),
            lambda i: (i == 0) | (F.get(in_order, i) != F.get(in_order, i - 1)),
        ),
    ).otherwise(F.array().cast("array<int>"))

    def run(start: Column, j: Column) -> Column:
        length = F.coalesce(F.get(at, j + 1), F.size(in_order)) - start
        return F.struct(F.get(in_order, start).alias("word"), length.cast("bigint").alias("tf"))

    return (
        df.withColumn("_words", F.sort_array(words))
        .withColumn("_at", run_starts)
        .withColumn(name, F.transform("_at", run))
        .drop("_at", "_words")
    )


def page_terms(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, *keep, n_words, max_tf, terms)`` per page record, ``terms`` as ``(word, tf)``."""
    words = tokenize(F.coalesce("content", F.lit("")))
    counts = F.transform("terms", lambda t: t["tf"])
    return with_counts(pages.select("id", *keep, "content"), words, "terms").select(
        "id",
        *keep,
        F.aggregate(counts, F.lit(0).cast("bigint"), lambda n, tf: n + tf).alias("n_words"),
        F.coalesce(F.array_max(counts), F.lit(0)).cast("bigint").alias("max_tf"),
        "terms",
    )


def packed_terms(page_terms: DataFrame) -> DataFrame:
    """``page_terms`` with ``words`` and ``counts``, one string and one array, in place of the terms.

    They take half as many bytes in a shuffle.
    """
    words = F.array_join(F.transform("terms", lambda t: t["word"]), " ")
    counts = F.transform("terms", lambda t: t["tf"])
    return page_terms.withColumn("words", words).withColumn("counts", counts).drop("terms")


def unpacked_terms(packed: DataFrame) -> DataFrame:
    """:func:`packed_terms` with their ``terms`` again."""
    words = F.when(F.col("words") == "", F.array().cast("array<string>")).otherwise(F.split("words", " "))
    pairs = F.arrays_zip(words.alias("word"), F.col("counts").alias("tf"))
    return packed.withColumn("terms", pairs).drop("words", "counts")


def dealt_terms(page_terms: DataFrame) -> DataFrame:
    """A stored ``page_terms`` in partitions by id, as many as keep each to a bounded number of pages and words.

    What is made of it by id, such as postings, statistics and scores, stays where it is.
    """
    size = page_terms.agg(F.count("*").alias("pages"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms")).first()
    cores = page_terms.sparkSession.sparkContext.defaultParallelism
    parts = max(cores, -(-size["pages"] // PART_PAGES), -(-size["terms"] // PART_TERMS))
    return unpacked_terms(packed_terms(page_terms).repartition(parts, "id"))


def exploded_terms(page_terms: DataFrame) -> DataFrame:
    """``(id, word, tf)``, one row per word of a page record."""
    # The outer form keeps the optimizer from copying the word count into a pre-filter.
    return page_terms.select("id", F.inline_outer("terms")).where(F.col("word").isNotNull())


def _occurrences(pages: DataFrame) -> DataFrame:
    """The columns of ``pages`` and ``word`` in place of ``content``, one row per word."""
    parts = F.split(F.lower("content"), "[^a-z]+")
    each = pages.select(*(c for c in pages.columns if c != "content"), F.explode_outer(parts).alias("word"))
    # As in tokenize; a null content has no row here.
    return each.where(F.col("word") != "")


def word_count(pages: DataFrame) -> DataFrame:
    """``(word, n)``: words that occur more than once in the corpus."""
    return (
        pages.select(F.explode_outer(tokenize("content")).alias("word"))
        .where(F.col("word").isNotNull())
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )


def page_word_count(pages: DataFrame) -> DataFrame:
    """``(id, n_words)``; pages without words count 0, repeated ids add up."""
    size = F.size(tokenize(F.coalesce("content", F.lit(""))))
    return pages.groupBy("id").agg(F.sum(size).alias("n_words"))


def page_max_word_count(pages: DataFrame) -> DataFrame:
    """``(id, max_tf)``; per record the count of its most frequent word, repeated ids add up."""
    return page_terms(pages).groupBy("id").agg(F.sum("max_tf").alias("max_tf"))


def page_stats(page_terms: DataFrame) -> DataFrame:
    """``(id, n_words, max_tf)`` from :func:`page_terms`."""
    return page_terms.groupBy("id").agg(
        F.sum("n_words").alias("n_words"), F.sum("max_tf").alias("max_tf")
    )


def postings_of(page_terms: DataFrame) -> DataFrame:
    """``(word, id, tf)`` from :func:`page_terms`."""
    return exploded_terms(page_terms).groupBy("word", "id").agg(F.sum("tf").alias("tf"))


def inverted_index(pages: DataFrame) -> DataFrame:
    """``(word, id, tf)``."""
    # Words are summed up by id anyway, before and after the shuffle: sorting them in their rows first saves nothing.
    return _occurrences(pages.select("id", "content")).groupBy("word", "id").agg(F.count("*").alias("tf"))


def document_frequency(postings: DataFrame) -> DataFrame:
    """``(word, df)``: number of pages per word."""
    return postings.groupBy("word").agg(F.count("*").alias("df"))


def sorted_index(postings: DataFrame) -> DataFrame:
    """Postings ordered by word, then by the id as a string."""
    # A column of its own, or every comparison makes both texts again.
    return postings.withColumn("_text", F.col("id").cast("string")).orderBy("word", "_text").drop("_text")


def posting_lists(postings: DataFrame, part_ids: int = PART_IDS) -> DataFrame:
    """``(word, part, postings)`` with the ``(id, tf)`` of a word in string order of the ids.

    A part spans ``part_ids`` consecutive ids, whatever the word: the list of a word on
    pages of several such ranges is in as many rows, and no row holds more than ``part_ids``
    entries however frequent the word is.
    """

    def keyed(e: Column) -> Column:
        return F.struct(e["id"].cast("string").alias("s"), e["id"].alias("id"), e["tf"].alias("tf"))

    return (
        postings.withColumn("part", F.floor(F.col("id") / part_ids).cast("bigint"))
        .groupBy("word", "part")
        .agg(F.collect_list(F.struct("id", "tf")).alias("found"))
        .withColumn("entries", F.sort_array(F.transform("found", keyed)))
        .select(
            "word",
            "part",
            F.transform("entries", lambda e: F.struct(e["id"].alias("id"), e["tf"].alias("tf"))).alias(
                "postings"
            ),
        )
    )


def posting_lines(lists: DataFrame) -> DataFrame:
    """``(word, part, line)`` with the line ``word id tf id tf …``."""
    pair = F.transform("postings", lambda p: F.concat_ws(" ", p["id"].cast("string"), p["tf"].cast("string")))
    return lists.select("word", "part", F.concat_ws(" ", "word", F.array_join(pair, " ")).alias("line"))
