"""Title directory: lists, lookups, prefix search and redirect targets."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import title_normalise
from ..sizing import held, is_small, join_on_key, key_side
from ..sources.tables import BUCKETS, id_bucket
from .toplist import top_per_group

#: Most prefixes that are written into a scan filter.
SCAN_PREFIXES = 32


def title_list(titles: DataFrame) -> DataFrame:
    """Distinct titles in order."""
    return titles.select("title").distinct().orderBy("title")


def duplicate_titles(titles: DataFrame) -> DataFrame:
    """``(title, n)`` of titles that occur more than once."""
    return titles.groupBy("title").agg(F.count("*").alias("n")).where(F.col("n") > 1)


def page_directory(pages: DataFrame) -> DataFrame:
    """Distinct ``(id, title, title_norm)`` of indexable pages, with path and offset if there are."""
    offset = [c for c in ("path", "offset") if c in pages.columns]
    return (
        pages.select("id", *offset, "title")
        .distinct()
        .withColumn("title_norm", title_normalise("title"))
    )


def title_ids(directory: DataFrame) -> DataFrame:
    """``(title_norm, id)``: the first id, as a string, of each normalised title."""
    first = F.min(F.col("id").cast("string")).cast("bigint")
    return directory.groupBy("title_norm").agg(first.alias("id"))


def title_lookup(titles: DataFrame, directory: DataFrame) -> DataFrame:
    """``(title, id)`` of titles that equal a page's title after normalising both."""
    wanted = titles.select("title").distinct().withColumn("title_norm", title_normalise("title"))
    found = join_on_key(directory.select("title_norm", "id"), key_side(wanted, "title_norm"), "title_norm")
    return found.groupBy("title").agg(
        F.min(F.col("id").cast("string")).cast("bigint").alias("id")
    )


def title_prefix_search(
    prefixes: DataFrame,
    directory: DataFrame,
    max_k: int,
    max_length: int,
    small: bool | None = None,
    literals: list[str] | None = None,
    starts: DataFrame | None = None,
) -> DataFrame:
    """``(prefix, id, title_rank)``: the first pages, ids in string order, per title prefix.

    ``prefixes(prefix)`` holds normalised prefixes of at most ``max_length`` characters; up
    to ``max_k`` pages are returned for each. ``small`` tells whether the prefixes may be
    broadcast, by default they are measured. A few known prefixes go as ``literals`` into
    the scan of a directory sorted by title. With ``starts(title_range, start)``, the first titles of the directory's
    ranges, a prefix is looked up in the ranges that its titles lie in, and each title stays a single row. Of
    a directory without ranges titles are compared through an equality on their leading parts. There
    is no all-against-all comparison.
    """
    wanted = prefixes.where(F.col("prefix") != "").select("prefix").distinct()
    if small is None:
        small = is_small(wanted)
    if literals is not None and len(literals) <= SCAN_PREFIXES:
        fits = [F.col("title_norm").startswith(p) for p in literals if p != ""]
        directory, starts = directory.where(reduce(or_, fits, F.lit(False))), None
    if starts is not None:
        hits = _by_range(wanted, directory, starts, small)
    else:
        hits = _by_leading_parts(wanted, directory, max_length, small, literals)
    hits = hits.withColumn("id_text", F.col("id").cast("string"))
    # An id may be there with several titles: the rank counts ids, not rows.
    return top_per_group(
        hits, ["prefix"], [F.col("id_text")], F.lit(max_k), max_k, "title_rank", distinct_order=True
    ).select("prefix", "id", "title_rank")


def _by_range(wanted: DataFrame, directory: DataFrame, starts: DataFrame, small: bool) -> DataFrame:
    """``(prefix, id)`` of titles that start with a prefix, by the ranges of the directory."""
    # One row per range, of which there are at most MOST_RANGES.
    known = sorted((r["start"], r["title_range"]) for r in starts.collect())
    first, number = F.array(*[F.lit(s) for s, _ in known]), F.array(*[F.lit(n) for _, n in known])
    halvings = F.sequence(F.lit(1), F.lit(max(1, len(known).bit_length())))

    def ranges_before(key: Column, closed: bool) -> Column:
        """How many ranges start before the key (or with it), by halving."""

        def halve(state: Column, _: Column) -> Column:
            middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
            start = F.get("_first", middle)
            below = (start <= key) if closed else (start < key)
            go_on = state["low"] < state["high"]
            return F.struct(
                F.when(go_on & below, middle + 1).otherwise(state["low"]).alias("low"),
                F.when(go_on & ~below, middle).otherwise(state["high"]).alias("high"),
            )

        whole = F.struct(F.lit(0).alias("low"), F.lit(len(known)).alias("high"))
        return F.aggregate(halvings, whole, halve, lambda state: state["low"])

    # Titles are ASCII once normalised: nothing that starts with the prefix sorts behind it and this character.
    last = F.concat("prefix", F.lit("\x7f"))
    keyed = wanted.withColumn("_first", first)
    spans = keyed.select(
        "prefix", F.greatest(ranges_before(F.col("prefix"), False) - 1, F.lit(0)).alias("low"), ranges_before(last, True).alias("high")
    )
    places = F.sequence(F.col("low"), F.col("high") - 1)
    placed = spans.where(F.col("low") < F.col("high")).select("prefix", F.explode(places).alias("place"))
    placed = placed.select("prefix", F.get(number, F.col("place")).alias("title_range"))
    asked = sorted(r[0] for r in placed.select("title_range").distinct().collect())
    titles = directory.where(F.col("title_range").isin(asked)).select("title_range", "title_norm", "id")
    side = F.broadcast(placed) if small else placed
    fits = F.col("title_norm").startswith(F.col("prefix"))
    return titles.join(side, "title_range").where(fits).select("prefix", "id")


def _by_leading_parts(
    wanted: DataFrame, directory: DataFrame, max_length: int, small: bool, literals: list[str] | None
) -> DataFrame:
    """``(prefix, id)`` of titles that start with a prefix, by an equality on their leading parts."""
    if literals is not None:
        lengths = F.array(*[F.lit(n) for n in sorted({0, *map(len, literals)})])
    else:
        lengths = F.sequence(F.lit(1), F.lit(max(max_length, 1)))
    lengths = F.filter(lengths, lambda n: n <= F.length("title_norm"))
    parts = directory.select(
        F.col("id"),
        F.explode_outer(
            F.transform(lengths, lambda n: F.substring("title_norm", F.lit(1), n))
        ).alias("prefix"),
    )
    return parts.join(F.broadcast(wanted) if small else wanted, "prefix", "left_semi")


def page_targets(
    pages: DataFrame, page_stats: DataFrame, directory: DataFrame, min_words: int = fixed.MIN_WORDS
) -> DataFrame:
    """``(id, result_id)``: the page that is returned when a page is hit.

    Long pages stand for themselves. A short redirect page stands for the page with its
    target title, whatever that page's length. Other short pages have no row.
    """
    long_pages = page_stats.where(F.col("n_words") >= min_words).select("id", F.col("id").alias("result_id"))
    redirects = (
        pages.where(F.col("redirect_title") != "")
        .groupBy("id")
        .agg(F.min(title_normalise("redirect_title")).alias("title_norm"))
    )
    targets = title_ids(directory).withColumnRenamed("id", "result_id")
    short_pages = (
        page_stats.where(F.col("n_words") < min_words)
        .select("id")
        .join(redirects, "id")
        .join(targets, "title_norm")
        .select("id", "result_id")
    )
    return long_pages.unionByName(short_pages)


def fetch_pages(results: DataFrame, pages: DataFrame) -> DataFrame:
    """Page records of ``results(request_id, rank, id)``, in the order of the ranks.

    Of a store in buckets by id only the buckets of the results are read, however many ids there are.
    """
    ranked, _ = held(results.select("request_id", "rank", "id"), "results")
    columns = [c for c in pages.columns if c not in ("id", "id_bucket")]
    keys = ["id"]
    if "id_bucket" in pages.columns:
        buckets = pages.schema["id_bucket"].metadata[BUCKETS]
        ranked, keys = ranked.withColumn("id_bucket", id_bucket("id", buckets)), ["id_bucket", "id"]
        # At most as many numbers as the store has buckets.
        wanted = sorted(r[0] for r in ranked.select("id_bucket").distinct().collect())
        pages = pages.where(F.col("id_bucket").isin(wanted))
    return (
        join_on_key(pages, key_side(ranked, "id"), "id", on=keys)
        .select("request_id", "rank", "id", *columns)
        .orderBy("request_id", "rank")
    )
