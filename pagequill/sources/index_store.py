"""The index as Parquet tables.

Postings are partitioned by page: all words of a page, and of the pages that are answered by the
same result, are in one bucket, so a task that reads a bucket scores its pages in full and no
match is shuffled. Within a bucket they lie in folders by a hash of the word, so that words not
asked for are left out before a file is opened, and are sorted by word, length band and id, so
that a word, and of a frequent word the bands that can still give results, is a run of rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import titles as tl, words as wd
from ..operators.ranking import log_pico
from ..sizing import is_small
from .scratch import remove_folder
from .tables import BUCKETS, CODEC, store_by_title, store_sorted

#: Most pages and postings of a bucket, on average: a task sorts the postings of a bucket, and a search keeps a row
#: for each request and page of it. Small corpora have smaller buckets that keep all cores busy.
BUCKET_PAGES, BUCKET_POSTINGS, LEAST_BUCKET_PAGES = 1 << 12, 1 << 20, 1000
#: Postings of a file, on average.
FILE_POSTINGS = 1 << 20
#: Folders by hash of the word.
FEWEST_WORD_BUCKETS, MOST_WORD_BUCKETS = 4, 1024
#: Band of the pages that are never a result; the others have the logarithm of their length.
NO_RESULT = -1
_POSTING = "word STRING, band INT, id BIGINT, tf BIGINT, n_words BIGINT, max_tf BIGINT, result_id BIGINT, home BIGINT"


@dataclass(frozen=True)
class Index:
    """Tables that answer searches.

    Postings carry what a search needs to know about the page (``n_words``, ``max_tf``
    and ``result_id``, NULL for pages that are never returned), so a search reads the rows of
    its words and joins no table that grows with the number of pages.
    """

    paged: DataFrame  # word, band, id, tf, n_words, max_tf, result_id, home, word_bucket
    bounds: DataFrame  # word, band, n, ln_tf, by_length, by_max_tf
    vocabulary: DataFrame  # word, df
    page_stats: DataFrame  # id, n_words, max_tf
    directory: DataFrame  # id, [offset,] title, title_norm, title_range
    title_starts: DataFrame  # title_range, start
    page_targets: DataFrame  # id, result_id
    word_buckets: int

    @property
    def postings(self) -> DataFrame:
        return self.paged.select("word", "id", "tf", "n_words", "max_tf", "result_id")


def word_bucket(word: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def band(n_words: Column, result_id: Column) -> Column:
    """Length band of a page: pages of a band differ in length by less than a factor of two."""
    length = F.length(F.bin(n_words)) - 1
    return F.when(result_id.isNull(), NO_RESULT).otherwise(length).cast("int")


def postings_by_page(
    terms: DataFrame, facts: DataFrame, page_buckets: int, word_buckets: int
) -> tuple[DataFrame, DataFrame]:
    """Postings of ``page_terms`` in ``page_buckets`` partitions by ``home``, each with all of its pages.

    Page rows are dealt out with their words still inside and exploded where they are. Most pages stand for themselves
    and have one record, which says all about them: those, the first table, need no join and no sum. The second
    table has the others, which get their facts, are dealt out by their home and summed up.
    """
    own = F.when(F.col("n_words") >= fixed.MIN_WORDS, F.col("id"))
    others = facts.where((F.col("records") > 1) | ~F.col("result_id").eqNullSafe(own)).drop("records")
    small = is_small(others)

    def hinted(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    packed = wd.packed_terms(terms)
    alone = packed.join(hinted(others.select("id")), "id", "left_anti").where(F.col("id").isNotNull())
    alone = alone.repartition(page_buckets, "id").withColumn("result_id", own).withColumn("home", F.col("id"))
    moved = packed.drop("n_words", "max_tf").join(hinted(others), "id")
    moved = moved.withColumn("home", F.coalesce("result_id", "id")).repartition(page_buckets, "home")
    page = ["home", "id", "band", "n_words", "max_tf", "result_id"]

    def postings(dealt: DataFrame) -> DataFrame:
        banded = dealt.withColumn("band", band(F.col("n_words"), F.col("result_id")))
        each = wd.unpacked_terms(banded).select(*page, F.inline_outer("terms"))
        return each.where(F.col("word").isNotNull())

    def placed(each: DataFrame) -> DataFrame:
        return each.select(
            "word", "band", "id", "tf", "n_words", "max_tf", "result_id", "home",
            word_bucket("word", word_buckets).alias("word_bucket"),
        )

    return placed(postings(alone)), placed(postings(moved).groupBy(*page, "word").agg(F.sum("tf").alias("tf")))


def word_bounds(postings: DataFrame) -> DataFrame:
    """``(word, band, n, ln_tf, by_length, by_max_tf)``: pages of a band with the word, and the most that it gives there.

    Logarithms in picounits as in scores: of the count, and of the count divided by the page's length or its
    largest count.
    """
    ln_tf = log_pico(F.col("tf"))
    return postings.groupBy("word", "band").agg(
        F.count("*").alias("n"),
        F.max(ln_tf).alias("ln_tf"),
        F.max(ln_tf - log_pico(F.col("n_words"))).alias("by_length"),
        F.max(ln_tf - log_pico(F.col("max_tf"))).alias("by_max_tf"),
    )


def bucket_counts(spark: SparkSession, n_pages: int, n_postings: int) -> tuple[int, int]:
    """Numbers of page buckets and of word buckets for a corpus of that size."""
    wanted = min(spark.sparkContext.defaultParallelism, -(-n_pages // LEAST_BUCKET_PAGES))
    pages = max(1, wanted, -(-n_pages // BUCKET_PAGES), -(-n_postings // BUCKET_POSTINGS))
    files = n_postings // (pages * FILE_POSTINGS)
    return pages, min(MOST_WORD_BUCKETS, max(FEWEST_WORD_BUCKETS, 1 << files.bit_length()))


def _table(spark: SparkSession, path: str, page_buckets: int) -> DataFrame:
    """The bucketed postings below ``path`` as a table of this session's catalog.

    The column ``home`` knows how many buckets there are.
    """
    name = f"pagequill_{uuid.uuid4().hex}"
    key = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(key)
    # Partitions are those of the folders; they need not be listed in the catalog one by one.
    spark.conf.set(key, "false")
    try:
        spark.sql(
            f"CREATE TABLE {name} ({_POSTING}, word_bucket INT) USING parquet PARTITIONED BY (word_bucket) "
            f"CLUSTERED BY (home) SORTED BY (word, band, id) INTO {page_buckets} BUCKETS LOCATION '{path}'"
        )
        return spark.table(name).withMetadata("home", {BUCKETS: page_buckets})
    finally:
        spark.conf.set(key, before)


def write_index(
    pages: DataFrame,
    path: str,
    directory: DataFrame | None = None,
    page_buckets: int | None = None,
    word_buckets: int | None = None,
) -> Index:
    """Build the index of ``pages(id, title, redirect_title, content)`` below ``path``.

    A ``directory`` with offsets replaces the one made of the pages. The numbers of buckets follow
    from the size of the corpus unless given.

    Words are counted once into a table of page rows; every other table derives from it. A
    table that is read more than once is read back from its files, so a lost executor never
    sends the job back to the dump.
    """
    spark = pages.sparkSession

    wd.page_terms(pages, ("title", "redirect_title")).write.mode("overwrite").parquet(
        f"{path}/page_terms", compression=CODEC
    )
    terms = spark.read.parquet(f"{path}/page_terms")
    directory = tl.page_directory(terms) if directory is None else directory
    directory = store_by_title(directory, f"{path}/directory")

    page_stats = wd.page_stats(terms)
    records = terms.groupBy("id").agg(F.count("*").alias("records"))
    targets = tl.page_targets(terms, page_stats, directory)
    facts = page_stats.join(records, "id").join(targets, "id", "left")
    facts.write.mode("overwrite").parquet(f"{path}/page_facts")
    facts = spark.read.parquet(f"{path}/page_facts")

    size = terms.agg(F.count("*").alias("pages"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("postings")).first()
    counts = bucket_counts(spark, size["pages"], size["postings"])
    page_buckets, word_buckets = page_buckets or counts[0], word_buckets or counts[1]
    layout = [{"page_buckets": page_buckets, "word_buckets": word_buckets}]
    spark.createDataFrame(layout).write.mode("overwrite").json(f"{path}/layout")
    remove_folder(spark, f"{path}/postings")
    name = f"pagequill_{uuid.uuid4().hex}"
    for part in postings_by_page(terms, facts, page_buckets, word_buckets):
        writer = part.write.mode("append").option("compression", CODEC).partitionBy("word_bucket").bucketBy(page_buckets, "home")
        writer.sortBy("word", "band", "id").option("path", f"{path}/postings").saveAsTable(name)

    postings = _table(spark, f"{path}/postings", page_buckets)
    bounds = store_sorted(word_bounds(postings), f"{path}/bounds", ["word", "band"])
    store_sorted(bounds.groupBy("word").agg(F.sum("n").alias("df")), f"{path}/vocabulary", ["word"])
    remove_folder(spark, f"{path}/page_terms")
    return load_index(spark, path)


def load_index(spark: SparkSession, path: str) -> Index:
    """Open an index written by :func:`write_index`."""
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    facts = read("page_facts")
    layout = spark.read.schema("page_buckets INT, word_buckets INT").json(f"{path}/layout").first()
    return Index(
        paged=_table(spark, f"{path}/postings", layout["page_buckets"]),
        bounds=read("bounds"),
        vocabulary=read("vocabulary"),
        page_stats=facts.select("id", "n_words", "max_tf"),
        directory=read("directory"),
        title_starts=read("directory_ranges"),
        page_targets=facts.where(F.col("result_id").isNotNull()).select("id", "result_id"),
        word_buckets=layout["word_buckets"],
    )
