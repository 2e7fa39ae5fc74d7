"""Ranked retrieval over postings.

Scores are kept as logarithms in whole picounits, so sums are exact and a page's score and
rank do not depend on the order in which a shuffle delivers its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import requests as rq
from ..functions.text import _col
from ..sizing import KeySide, is_small, join_on_key, key_side
from ..sources.tables import BUCKETS
from .toplist import top_per_group
from .words import with_counts

_PICO = 1e12


def parse_request(requests: DataFrame) -> DataFrame:
    """``(request_id, msg)`` to ``(request_id, k, strategy, words)``.

    The sign of the limit is the strategy: 1 for a negative one (length), else 0 (maximum).
    """
    # Each step is a projection of its own, so that none is computed again by the next.
    trimmed = requests.select("request_id", rq.trimmed("msg").alias("msg"))
    cut = trimmed.select("request_id", "msg", rq.leading_number("msg").alias("digits"))
    limits = cut.select("request_id", "msg", rq.limit_of("digits").alias("limit"))
    return limits.select(
        "request_id",
        F.abs("limit").alias("k"),
        F.when(F.col("limit") < 0, 1).otherwise(0).alias("strategy"),
        rq.words_behind("msg").alias("words"),
    )


def query_terms(parsed: DataFrame) -> DataFrame:
    """``(request_id, pos, word)``, repeated words kept."""
    return parsed.select("request_id", F.posexplode(rq.split_terms("words")).alias("pos", "word"))


def counted_terms(parsed: DataFrame) -> DataFrame:
    """Adds ``terms``, the distinct words of a request as ``(word, tf)``."""
    return with_counts(parsed, rq.split_terms("words"), "terms")


def distinct_terms(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(request_id, *keep, word, repeats)``."""
    counted = parsed if "terms" in parsed.columns else counted_terms(parsed)
    return (
        counted.select("request_id", *keep, F.inline_outer("terms"))
        .where(F.col("word").isNotNull())
        .withColumnRenamed("tf", "repeats")
    )


def term_weight(df: Column | str) -> Column:
    """``1 / ln(df)``; infinite for a word on a single page."""
    c = _col(df)
    return F.when(c == 1, F.lit(float("inf"))).otherwise(F.lit(1.0) / F.ln(c))


def log_pico(c: Column) -> Column:
    """Natural logarithm in whole picounits."""
    return F.floor(F.ln(c) * F.lit(_PICO) + F.lit(0.5))


def log_weight(df: Column | str) -> Column:
    """Logarithm of :func:`term_weight` in picounits, 0 where the weight is infinite."""
    c = _col(df)
    return F.when(c == 1, F.lit(0)).otherwise(log_pico(F.lit(1.0) / F.ln(c)))


def weighted_terms(terms: DataFrame | KeySide, vocabulary: DataFrame) -> DataFrame:
    """Adds ``df`` and ``ln_weight`` to terms; unknown words drop out."""
    side = terms if isinstance(terms, KeySide) else key_side(terms, "word")
    return join_on_key(vocabulary, side, "word").withColumn("ln_weight", log_weight("df"))


def terms_by_df(terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Known terms of each request, rarest first."""
    return (
        weighted_terms(terms, vocabulary)
        .select("request_id", "word", "repeats", "df")
        .orderBy("request_id", "df", "word")
    )


def term_lookup(
    terms: DataFrame | KeySide, postings: DataFrame, vocabulary: DataFrame
) -> DataFrame:
    """One row per request term and page with the word: the term's columns and the posting's."""
    side = terms if isinstance(terms, KeySide) else key_side(terms, "word")
    # The vocabulary has one row per word, so the weighted terms are no more than the terms.
    return join_on_key(postings, side.same_size(weighted_terms(side, vocabulary)), "word")


def ln_score(gain: Column, min_df: Column) -> Column:
    """Logarithm of a score of ``gain`` picounits, rounded to nine digits; infinite with a word on one page."""
    nano = F.floor(gain / F.lit(1000.0) + F.lit(0.5))
    return F.when(min_df == 1, F.lit(float("inf"))).otherwise(nano / F.lit(1e9))


def score(matches: DataFrame, denominator: str = "n_words", page: tuple[str, ...] = ()) -> DataFrame:
    """``(request_id, id, *page, times, ln_score)`` of every page with a term.

    ``times`` counts the terms found, repeated ones again. The score is the product of
    ``tf * weight`` over them, divided by the ``denominator`` column; ``ln_score`` is its
    logarithm, rounded to nine digits. ``page`` names further columns that depend on the page.
    """
    gain = F.col("repeats") * (log_pico(F.col("tf")) + F.col("ln_weight"))
    summed = matches.groupBy("request_id", *page, "id").agg(
        F.sum("repeats").alias("times"),
        F.sum(gain).alias("gain"),
        F.min("df").alias("min_df"),
        F.first(denominator).alias("parts"),
    )
    final = ln_score(F.col("gain") - log_pico(F.col("parts")), F.col("min_df"))
    return summed.select("request_id", "id", *page, "times", final.alias("ln_score"))


def score_by_length(matches: DataFrame, page_stats: DataFrame | None = None) -> DataFrame:
    """Scores divided by the page's number of words. A column ``home`` is kept, see :func:`redirect_resolve`."""
    return score(_with_stats(matches, page_stats), "n_words", _home(matches))


def score_by_max_tf(matches: DataFrame, page_stats: DataFrame | None = None) -> DataFrame:
    """Scores divided by the count of the page's most frequent word. A column ``home`` is kept."""
    return score(_with_stats(matches, page_stats), "max_tf", _home(matches))


def _home(df: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in ("home",) if c in df.columns)


def _with_stats(matches: DataFrame, page_stats: DataFrame | None) -> DataFrame:
    # One row per page is looked up in each partition; matches that lie by id are not moved, and none are sorted.
    return matches if page_stats is None else matches.join(page_stats.hint("shuffle_hash"), "id")


def rank_order() -> list[Column]:
    """More terms first, then the higher score, then the lower id."""
    return [F.desc("times"), F.desc("ln_score"), F.asc("id")]


def rank_pages(scored: DataFrame, k: int) -> DataFrame:
    """The first ``k`` scored pages of each request, with their ``rank``."""
    return top_per_group(scored, ["request_id"], rank_order(), F.lit(k), k, "rank").select(
        "request_id", "rank", "id", "times", "ln_score"
    )


def redirect_resolve(scored: DataFrame, page_targets: DataFrame) -> DataFrame:
    """Adds the ``result_id`` that stands for each page; pages without one drop out.

    ``home``, the result's id where a page has one, is dropped again: scores that lie by it are resolved
    and reduced to their results without a shuffle of them. ``page_targets`` has one row per page.
    """
    if "home" not in scored.columns:
        return scored.join(page_targets, "id")
    kept = [c for c in scored.columns if c not in ("id", "home")]
    targets = page_targets.withColumn("home", F.col("result_id"))
    buckets = scored.schema["home"].metadata.get(BUCKETS)
    small = is_small(targets)
    if small or buckets is None:
        resolved = scored.join(targets.hint("broadcast" if small else "shuffle_hash"), ["home", "id"])
    else:
        # A join by home and id would deal out all scores again; one by home alone leaves them in their buckets.
        resolved = scored.join(answered_pages(targets, buckets).hint("shuffle_hash"), "home")
        own = F.col("id") == F.col("home")
        resolved = resolved.where(F.when(own, F.col("_own")).otherwise(in_sorted("_others", "id")))
    return resolved.select("id", *kept, F.col("home").alias("result_id"))


def answered_pages(targets: DataFrame, buckets: int) -> DataFrame:
    """``(home, _own, _others)``: whether a result stands for itself, and the sorted ids of the other pages it stands for."""
    own = F.col("id") == F.col("home")
    return targets.repartition(buckets, "home").groupBy("home").agg(
        F.coalesce(F.max(own), F.lit(False)).alias("_own"),
        F.sort_array(F.collect_list(F.when(~own, F.col("id")))).alias("_others"),
    )


def in_sorted(values: Column | str, value: Column | str) -> Column:
    """Whether the sorted array ``values`` has the ``value``, by halving."""
    c, v = _col(values), _col(value)
    steps = F.filter(F.array(*[F.lit(1 << b) for b in range(30, -1, -1)]), lambda s: s <= F.size(c))
    not_above = F.aggregate(steps, F.lit(0), lambda n, s: n + F.when(F.get(c, n + s - 1) <= v, s).otherwise(0))
    return F.coalesce(F.get(c, not_above - 1) == v, F.lit(False))


def body_places(hits: DataFrame) -> DataFrame:
    """Hits ``(request_id, result_id, times, ln_score, id)`` as ``(request_id, id, place)``.

    ``place`` sorts the results of a request: first by source, then as :func:`rank_order`.
    """
    return hits.select(
        "request_id", F.col("result_id").alias("id"), place(0, -F.col("times"), -F.col("ln_score"), F.col("id"))
    )


def title_places(hits: DataFrame) -> DataFrame:
    """Title hits ``(request_id, id, title_rank)`` as ``(request_id, id, place)``."""
    return hits.select("request_id", "id", place(1, F.col("title_rank"), F.lit(0.0), F.col("id")))


def place(source: int, first: Column, second: Column, third: Column) -> Column:
    """Column ``place``, which sorts as its parts do."""
    return F.struct(
        F.lit(source).alias("source"),
        first.cast("bigint").alias("first"),
        second.cast("double").alias("second"),
        third.cast("bigint").alias("third"),
    ).alias("place")


def dedup_results(places: DataFrame) -> DataFrame:
    """One row per request and result: its first place."""
    return places.groupBy("request_id", "id").agg(F.min("place").alias("place"))


def merge_results(body: DataFrame, titles: DataFrame) -> DataFrame:
    """Places of body hits and of title hits, one per result; body hits come first."""
    return dedup_results(body.unionByName(titles))


def top_k(places: DataFrame, k: Column, max_k: int) -> DataFrame:
    """``(request_id, rank, id)``: the first ``k`` results of each request.

    A request without a body hit has no results. ``k`` may be a column; ``max_k`` is its
    largest value.
    """
    ranked = top_per_group(places, ["request_id"], [F.asc("place")], k, max_k, "rank")
    best = F.min("place.source").over(Window.partitionBy("request_id"))
    return (
        ranked.withColumn("best_source", best)
        .where(F.col("best_source") == 0)
        .select("request_id", "rank", "id")
    )
