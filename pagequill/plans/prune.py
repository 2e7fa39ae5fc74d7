"""Body hits of searches, without reading all postings of frequent words.

The index knows for each word and length band how much the word can give to a page of that band. For
a request this bounds the place of any page of a band: no page has more of its words than the
band has, nor a higher score than their largest counts and densities allow. The most promising bands are looked
up first. Their results set a bar, and of the other bands only those are looked up whose bound
reaches it, so every result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ranking as rk
from ..operators.toplist import CUT_BEFORE_SHUFFLE, top_per_group
from ..sizing import LOCAL_ROWS, held, is_small, local
from ..sources.index_store import NO_RESULT, Index, word_bucket

#: Pages with a request's most frequent word in the bands looked up first, as a multiple of its limit.
FIRST_PAGES = 4


def band_lookups(terms: DataFrame, bounds: DataFrame, word_buckets: int) -> DataFrame:
    """Terms with their weights and the bounds of each band, one row per request, word and band."""
    own = Window.partitionBy("request_id", "word")
    return (
        terms.join(bounds, "word")
        .withColumn("df", F.sum("n").over(own))
        .withColumn("ln_weight", rk.log_weight("df"))
        .where(F.col("band") != NO_RESULT)
        .withColumn("word_bucket", word_bucket("word", word_buckets))
    )


def band_places(lookups: DataFrame, by_length: Column) -> DataFrame:
    """``(request_id, band, n, best)``: the best place that a page of the band can have.

    Such a page has all of the request's words that the band has. Its score is the product of
    their counts and weights, one of the counts being divided by the page: so it is bounded by
    the largest counts, and the largest quotient in place of one of them.
    """
    quotient = F.when(by_length, F.col("by_length")).otherwise(F.col("by_max_tf"))
    summed = lookups.groupBy("request_id", "band").agg(
        F.max("n").alias("n"),
        F.sum("repeats").alias("times"),
        F.sum(F.col("repeats") * (F.col("ln_tf") + F.col("ln_weight"))).alias("gain"),
        F.min(quotient - F.col("ln_tf")).alias("less"),
        F.min("df").alias("min_df"),
    )
    score = rk.ln_score(F.col("gain") + F.col("less"), F.col("min_df"))
    lowest = F.lit(-(1 << 63)).cast("bigint")
    return summed.select("request_id", "band", "n", rk.place(0, -F.col("times"), -score, lowest).alias("best"))


def _numbers(wanted: DataFrame, rows: list | None, name: str) -> list[int]:
    """Distinct numbers in a column; at most as many as there are buckets or bands."""
    if rows is not None:
        return sorted({r[name] for r in rows})
    return sorted(r[0] for r in wanted.select(name).distinct().collect())


def scored_places(
    index: Index, wanted: DataFrame, small: bool, words: list[str] | None, max_k: int, honour_strategy: bool, rows: list | None = None
) -> DataFrame:
    """``(request_id, id, place)`` of the results of each request in the ``wanted`` lookups.

    The postings of a result are in one bucket: they are joined with a side that is broadcast,
    ``rows`` are those of ``wanted`` if they are few. Matches are
    scored and reduced to one row per result where they are read, and of these ``max_k`` per request and bucket leave. Lists
    too long to be cut there are ranked by the caller.
    """
    postings = index.paged
    for name in ("word_bucket", "band"):
        postings = postings.where(F.col(name).isin(_numbers(wanted, rows, name)))
    if words is not None:
        postings = postings.where(F.col("word").isin(words))
    side = wanted.select("request_id", "strategy", "word", "repeats", "df", "ln_weight", "band", "word_bucket")
    matches = postings.join(F.broadcast(side) if small else side, ["word_bucket", "word", "band"])
    parts = F.col("n_words")
    if honour_strategy:
        parts = F.when(F.col("strategy") == 1, F.col("n_words")).otherwise(F.col("max_tf"))
    hits = rk.score(matches.withColumn("parts_of_page", parts), "parts_of_page", ("home",))
    places = rk.dedup_results(rk.body_places(hits.withColumn("result_id", F.col("home"))))
    if max_k > CUT_BEFORE_SHUFFLE:
        return places
    return top_per_group(places, ["request_id"], [F.asc("place")], F.lit(max_k), max_k, "_rank").drop("_rank")


def first_places(
    terms: DataFrame, index: Index, ks: DataFrame, max_k: int, small: bool, words: list[str] | None, honour_strategy: bool
) -> DataFrame:
    """``(request_id, id, place)`` of at least the first ``k`` body hits of each request.

    ``terms(request_id, strategy, word, repeats)`` are the words of the requests, ``words`` all of them if
    they are few, ``ks(request_id, k)`` the limits.
    """
    bounds = index.bounds if words is None else index.bounds.where(F.col("word").isin(words))
    lookups = band_lookups(F.broadcast(terms) if small else terms, bounds, index.word_buckets)
    lookups, rows = held(lookups, "lookups", LOCAL_ROWS)
    if rows == []:
        return _nothing(ks)
    # A word has no more bands than there are lengths.
    small = rows is not None or is_small(lookups)
    if words is not None and rows is not None:
        words = sorted({r["word"] for r in rows})

    def found_in(bands: DataFrame, band_rows: list | None) -> DataFrame:
        """Places in the given bands of each request."""
        if rows is not None and band_rows is not None:
            keys = {(b["request_id"], b["band"]) for b in band_rows}
            own = [r for r in rows if (r["request_id"], r["band"]) in keys]
            return scored_places(index, local(lookups, own), small, words, max_k, honour_strategy, own)
        wanted = lookups.join(F.broadcast(bands) if small else bands, ["request_id", "band"], "left_semi")
        return scored_places(index, wanted, small, words, max_k, honour_strategy)

    chances = band_places(lookups, F.col("strategy") == 1 if honour_strategy else F.lit(True)).join(ks, "request_id")
    before = Window.partitionBy("request_id").orderBy("best", "band").rowsBetween(Window.unboundedPreceding, -1)
    chances = chances.withColumn("seen", F.coalesce(F.sum("n").over(before), F.lit(0)))
    chances = chances.withColumn("first", F.col("seen") / FIRST_PAGES < F.col("k"))
    chances, chance_rows = held(chances, "band-places", LOCAL_ROWS)
    first_rows = None if chance_rows is None else [c for c in chance_rows if c["first"]]

    found = found_in(chances.where("first"), first_rows).join(ks, "request_id")
    ranked = top_per_group(found, ["request_id"], [F.asc("place")], F.col("k"), max_k, "rank")
    first, place_rows = held(ranked.select("request_id", "id", "place", "k", "rank"), "first-places", LOCAL_ROWS)

    if chance_rows is not None and place_rows is not None:
        bars = {r["request_id"]: tuple(r["place"].values()) for r in place_rows if r["rank"] == r["k"]}
        rest_rows = [
            c for c in chance_rows
            if not c["first"] and c["k"] > 0 and (c["request_id"] not in bars or tuple(c["best"].values()) <= bars[c["request_id"]])
        ]
        rest = local(chances, rest_rows).select("request_id", "band")
    else:
        bar = first.where(F.col("rank") == F.col("k")).select("request_id", F.col("place").alias("bar"))
        rest = chances.where(~F.col("first") & (F.col("k") > 0)).join(bar, "request_id", "left")
        rest = rest.where(F.col("bar").isNull() | (F.col("best") <= F.col("bar"))).select("request_id", "band")
        rest, rest_rows = held(rest, "other-bands", LOCAL_ROWS)
    first = first.select("request_id", "id", "place")
    return first if rest_rows == [] else first.unionByName(found_in(rest, rest_rows))


def _nothing(ks: DataFrame) -> DataFrame:
    none = ks.where(F.lit(False)).select("request_id", F.lit(0).cast("bigint").alias("id"))
    zero = F.lit(0)
    return none.withColumn("place", rk.place(0, zero, zero, zero))
