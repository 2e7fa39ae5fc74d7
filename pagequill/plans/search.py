"""Search: from requests to ranked pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import title_normalise
from ..operators import lines, ranking as rk, titles as tl
from ..sizing import BROADCAST_ROWS, FILTER_ROWS, held, is_small
from ..sources.index_store import Index
from .prune import first_places


def search_batch(requests: DataFrame, index: Index, honour_strategy: bool = False) -> DataFrame:
    """``(request_id, rank, id)`` for ``requests(request_id, msg)``; ``request_id`` is unique.

    Scores are normalised by page length; with ``honour_strategy`` a request with a positive
    limit is normalised by the count of the page's most frequent word instead.

    Requests with the same words are answered once, for the largest of their limits: only
    the result rows are handed out to each of them.
    """
    parsed = _parsed(requests, honour_strategy)
    same = ["words", "strategy"]
    queries = parsed.groupBy(*same).agg(F.min("request_id").alias("request_id"), F.max("k").alias("k"))
    answers, named, _ = _answers(queries, index, honour_strategy)
    return (
        parsed.join(named.select(*same, F.col("request_id").alias("query_id")), same)
        .join(answers.withColumnRenamed("request_id", "query_id"), "query_id")
        .where(F.col("rank") <= F.col("k"))
        .select("request_id", "rank", "id")
    )


def search(msg: str, index: Index, honour_strategy: bool = False) -> DataFrame:
    """``(rank, id)`` for one request such as ``"10 some words"``, in order."""
    one = index.paged.sparkSession.sql("SELECT 0L AS request_id, :msg AS msg", args={"msg": msg})
    answers, _, max_k = _answers(_parsed(one, honour_strategy), index, honour_strategy)
    ranked = answers.select("rank", "id").orderBy("rank")
    # Spark takes limits of 32 bits; a larger one has no row to leave out that the ranks have not.
    return ranked.limit(max_k) if max_k < 1 << 31 else ranked


def _parsed(requests: DataFrame, honour_strategy: bool) -> DataFrame:
    parsed = rk.parse_request(requests)
    return parsed if honour_strategy else parsed.withColumn("strategy", F.lit(1))


def _answers(
    queries: DataFrame, index: Index, honour_strategy: bool
) -> tuple[DataFrame, DataFrame, int]:
    """``(request_id, rank, id)`` of ``queries(request_id, k, strategy, words)``.

    Also returns the queries, evaluated once, and their largest ``k``.
    """
    queries = rk.counted_terms(queries).withColumn("prefix", title_normalise("words"))
    queries, rows = held(queries, "queries")
    terms = rk.distinct_terms(queries, ("strategy",))
    prefixes = words = None
    if rows is not None:
        small = sum(len(r["terms"]) for r in rows) <= BROADCAST_ROWS
        max_k = max((r["k"] for r in rows), default=0)
        max_length = max((len(r["prefix"]) for r in rows), default=0)
        prefixes = sorted({r["prefix"] for r in rows})
        words = sorted({t["word"] for r in rows for t in r["terms"]})
    else:
        small = is_small(queries.select("words")) and is_small(terms)
        size = queries.agg(F.max("k").alias("k"), F.max(F.length("prefix")).alias("n")).first()
        max_k, max_length = size["k"], size["n"]

    def hinted(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    words = words if words is not None and len(words) <= FILTER_ROWS else None
    ks = hinted(queries.select("request_id", "k"))
    body = first_places(terms, index, ks, max_k, small, words, honour_strategy)

    wanted = queries.select("request_id", "k", "prefix")
    found = tl.title_prefix_search(wanted, index.directory, max_k, max_length, small, prefixes, index.title_starts)
    titles = hinted(wanted).join(found, "prefix").where(F.col("title_rank") <= F.col("k"))

    places = rk.merge_results(body, rk.title_places(titles))
    return rk.top_k(places.join(ks, "request_id"), F.col("k"), max_k), queries, max_k


def result_list(results: DataFrame, pages: DataFrame) -> DataFrame:
    """``(request_id, rank, id, title, abstract)`` of search results, in rank order.

    ``pages(id, title, text)`` is looked up first; abstracts are made of the pages found.
    """
    bucket = [c for c in ("id_bucket",) if c in pages.columns]
    found = tl.fetch_pages(results, pages.select("id", "title", "text", *bucket))
    paragraphs = lines.with_abstract(found)
    return paragraphs.select("request_id", "rank", "id", "title", "abstract").orderBy(
        "request_id", "rank"
    )
