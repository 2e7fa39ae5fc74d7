"""One query per operator, over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import pagequill as pq
from pagequill.functions import fixed, text as tx
from pagequill.operators import ranking as rk, words as wd
from pagequill.sizing import stored
from pagequill.sources.scratch import scratch_path
from pagequill.sources.tables import spread

from . import corpora

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Inputs -----------------------------------------------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def derived(spark: SparkSession, sf: str, text: str, *names: str) -> DataFrame:
    """Result of ``text`` over the named tables."""
    for name in names:
        table(spark, sf, name).createOrReplaceTempView(name)
    return spark.sql(text)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as pages without title; all of the text is indexed."""
    return spread(table(spark, sf, "documents")).select(
        F.col("doc_id").alias("id"),
        F.lit("").alias("title"),
        F.lit("").alias("redirect_title"),
        F.col("text").alias("content"),
    )


def dump_rows(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, corpora.WIKI_DUMP, "documents")


def html_dump_rows(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, corpora.HTML_DUMP, "pages")


def written_dump(rows: DataFrame, name: str) -> str:
    """Path of ``rows`` written as dump files."""
    path = scratch_path(rows.sparkSession, name)
    rows.select(F.col("raw").alias("value")).write.text(path)
    return path


def dump_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pq.page_fields(spread(dump_rows(spark, sf)))


def indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Indexed pages of the dump."""
    return pq.indexed_pages(spread(dump_rows(spark, sf)))


def markup_pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(derived(spark, sf, corpora.MARKUP_PAGES, "documents"))


def html_titles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("id"),
        tx.tag_slice_first("html", fixed.TITLE_OPEN, fixed.TITLE_CLOSE).alias("title"),
    )


def text_requests(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, corpora.TEXT_REQUESTS, "benchmark")


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, corpora.REQUESTS, "benchmark", "documents")


def document_matches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Matches of the text requests in the documents, and the page statistics."""
    # Words are counted once; pages lie by id in partitions of a bounded size, and their matches stay there.
    terms = wd.dealt_terms(stored(wd.page_terms(documents(spark, sf)), "page-terms"))
    postings = wd.postings_of(terms)
    wanted = rk.distinct_terms(pq.parse_request(text_requests(spark, sf)))
    return pq.term_lookup(wanted, postings, pq.document_frequency(postings)), wd.page_stats(terms)


_stores: dict[tuple[str, str, str], str] = {}


def _store(spark: SparkSession, sf: str, name: str, write: Callable[[str], object]) -> str:
    """Path of an index that is written once per session and input."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _stores:
        path = scratch_path(spark, name)
        write(path)
        _stores[key] = path
    return _stores[key]


def document_index(spark: SparkSession, sf: str) -> pq.Index:
    path = _store(spark, sf, "documents", lambda p: pq.write_index(documents(spark, sf), p))
    return pq.load_index(spark, path)


def dump_index(spark: SparkSession, sf: str) -> tuple[pq.Index, DataFrame]:
    """Index and page store of the dump, made from its files."""
    path = _store(
        spark,
        sf,
        "dump",
        lambda p: pq.index_dump(spark, written_dump(spread(dump_rows(spark, sf)), "dump-files"), p),
    )
    return pq.load_index(spark, path), pq.load_pages(spark, path)


def dump_hits(spark: SparkSession, sf: str) -> tuple[DataFrame, pq.Index]:
    """Scored pages of all requests over the dump."""
    index, _ = dump_index(spark, sf)
    terms = rk.distinct_terms(pq.parse_request(requests(spark, sf)))
    # By bucket of their home, pages are scored and resolved where their postings lie.
    postings = index.paged.select("word", "id", "tf", "n_words", "max_tf", "home")
    matches = pq.term_lookup(terms, postings, index.vocabulary)
    return pq.score_by_length(matches), index


def title_hits(spark: SparkSession, sf: str, index: pq.Index) -> DataFrame:
    parsed = pq.parse_request(requests(spark, sf)).select(
        "request_id", "k", tx.title_normalise("words").alias("prefix")
    )
    size = parsed.agg(F.max("k").alias("k"), F.max(F.length("prefix")).alias("n")).first()
    found = pq.title_prefix_search(parsed, index.directory, size["k"], size["n"], starts=index.title_starts)
    return parsed.join(found, "prefix").where(F.col("title_rank") <= F.col("k")).select(
        "request_id", "title_rank", "id"
    )


# Sources and sinks ------------------------------------------------------------------------


@query
def load_dump(spark, sf):
    return pq.load_dump(spark, written_dump(dump_rows(spark, sf), "dump-files"))


@query
def load_dump_offsets(spark, sf):
    # A record must start its file or come right behind the line break after another one.
    found = pq.load_dump_offsets(spark, written_dump(dump_rows(spark, sf), "dump-files"))
    n_bytes = F.octet_length("raw")
    behind = found.select(
        "path", (F.col("offset") + n_bytes + 1).alias("offset"), F.lit(True).alias("behind")
    )
    return found.join(behind, ["path", "offset"], "left").select(
        tx.tag_slice_first("raw", fixed.ID_OPEN, fixed.ID_CLOSE).try_cast("bigint").alias("id"),
        n_bytes.alias("n_bytes"),
        F.coalesce("behind", F.col("offset") == 0).alias("placed"),
    )


@query
def load_tag_records(spark, sf):
    path = written_dump(dump_rows(spark, sf), "dump-files")
    return pq.load_tag_records(spark, path, fixed.TITLE_OPEN, fixed.TITLE_CLOSE)


@query
def multi_path_scan(spark, sf):
    paths = [
        written_dump(dump_rows(spark, sf), "dump-files"),
        written_dump(html_dump_rows(spark, sf), "html-files"),
    ]
    return pq.multi_path_scan(spark, paths)


@query
def export_tsv(spark, sf):
    path = scratch_path(spark, "tsv")
    pq.export_tsv(pq.inverted_index(documents(spark, sf)), path, ["word", "id"], ["tf"])
    return spark.read.text(path)


@query
def write_index(spark, sf):
    path = scratch_path(spark, "index")
    return pq.write_index(documents(spark, sf), path).vocabulary


@query
def load_index(spark, sf):
    return document_index(spark, sf).postings


# Projections and text functions -----------------------------------------------------------


@query
def tag_slice_greedy(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.tag_slice_greedy("html", "<p", "</p>").alias("slice"))


@query
def tag_slice_first(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", tx.tag_slice_first("html", "<article", "</article>").alias("slice")
    )


@query
def tag_slice_exact(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", tx.tag_slice_exact("html", '<html lang="en">', "</html>").alias("slice")
    )


@query
def title_cut(spark, sf):
    records = html_titles(spark, sf).select(
        F.concat(F.lit(fixed.TITLE_OPEN), "title", F.lit(fixed.TITLE_CLOSE)).alias("raw")
    )
    return records.select(tx.title_cut("raw").alias("title"))


@query
def page_fields(spark, sf):
    return dump_pages(spark, sf)


@query
def redirect_title(spark, sf):
    return dump_pages(spark, sf).select("id", "redirect_title")


@query
def is_redirect_text(spark, sf):
    return dump_pages(spark, sf).select("id", tx.is_redirect_text("text").alias("is_redirect"))


@query
def entity_decode(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.entity_decode("html").alias("html"))


@query
def clean_text(spark, sf):
    return indexed(spark, sf).select("id", "content")


@query
def normalise_letters(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.normalise_letters("text").alias("letters"))


@query
def tokenize(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(tx.tokenize("text"), " ").alias("tokens")
    )


@query
def title_normalise(spark, sf):
    return html_titles(spark, sf).select("id", tx.title_normalise("title").alias("title_norm"))


@query
def parse_request(spark, sf):
    return pq.parse_request(requests(spark, sf))


@query
def query_terms(spark, sf):
    return pq.query_terms(pq.parse_request(requests(spark, sf)))


# Filters ----------------------------------------------------------------------------------


@query
def drop_empty_text(spark, sf):
    return pq.drop_empty_text(dump_pages(spark, sf))


@query
def drop_blocked_sha1(spark, sf):
    return pq.drop_blocked_sha1(dump_pages(spark, sf))


@query
def drop_missing_id(spark, sf):
    number = F.regexp_extract("url", "/([0-9]+)$", 1).try_cast("bigint")
    return pq.drop_missing_id(table(spark, sf, "pages").select(number.alias("id"), "url"))


@query
def indexable_pages(spark, sf):
    return pq.indexable_pages(dump_pages(spark, sf))


@query
def min_words_filter(spark, sf):
    return pq.min_words_filter(wd.page_stats(wd.page_terms(documents(spark, sf))))


# Aggregations -----------------------------------------------------------------------------


@query
def word_count(spark, sf):
    return pq.word_count(documents(spark, sf))


@query
def page_word_count(spark, sf):
    return pq.page_word_count(documents(spark, sf))


@query
def page_max_word_count(spark, sf):
    return pq.page_max_word_count(documents(spark, sf))


@query
def inverted_index(spark, sf):
    return pq.inverted_index(documents(spark, sf))


@query
def document_frequency(spark, sf):
    return pq.document_frequency(pq.inverted_index(documents(spark, sf)))


@query
def posting_lists(spark, sf):
    return wd.posting_lines(pq.posting_lists(pq.inverted_index(documents(spark, sf))))


@query
def page_directory(spark, sf):
    return pq.page_directory(pq.indexable_pages(dump_pages(spark, sf)))


@query
def title_list(spark, sf):
    return pq.title_list(html_titles(spark, sf))


@query
def duplicate_titles(spark, sf):
    return pq.duplicate_titles(html_titles(spark, sf))


@query
def redirect_count(spark, sf):
    return pq.redirect_count(dump_pages(spark, sf))


@query
def bad_doc_count(spark, sf):
    return pq.bad_doc_count(dump_pages(spark, sf))


# Joins and ranked retrieval ---------------------------------------------------------------


@query
def term_lookup(spark, sf):
    matches, _ = document_matches(spark, sf)
    return matches.select("request_id", "word", "repeats", "df", "id", "tf")


@query
def term_weight(spark, sf):
    df = pq.document_frequency(pq.inverted_index(documents(spark, sf)))
    return df.select("word", "df", F.round(pq.term_weight("df"), 9).alias("weight"))


@query
def score_by_length(spark, sf):
    return pq.score_by_length(*document_matches(spark, sf))


@query
def score_by_max_tf(spark, sf):
    return pq.score_by_max_tf(*document_matches(spark, sf))


@query
def redirect_resolve(spark, sf):
    scored, index = dump_hits(spark, sf)
    return pq.redirect_resolve(scored, index.page_targets)


@query
def title_prefix_search(spark, sf):
    return title_hits(spark, sf, dump_index(spark, sf)[0])


@query
def title_lookup(spark, sf):
    pages = pq.indexable_pages(dump_pages(spark, sf))
    wanted = pages.where(F.col("redirect_title") != "").select(F.col("redirect_title").alias("title"))
    return pq.title_lookup(wanted, pq.page_directory(pages))


@query
def fetch_pages(spark, sf):
    index, pages = dump_index(spark, sf)
    found = pq.search_batch(requests(spark, sf), index)
    return pq.fetch_pages(found, pages.select("id", "title", "sha1", "text", "id_bucket"))


@query
def search(spark, sf):
    return pq.search("10 the heat tion", document_index(spark, sf))


@query
def search_batch(spark, sf):
    index, _ = dump_index(spark, sf)
    return pq.search_batch(requests(spark, sf), index)


# Markup -----------------------------------------------------------------------------------


@query
def visible_lines(spark, sf):
    return pq.visible_lines(markup_pages(spark, sf))


@query
def plain_text(spark, sf):
    return pq.plain_lines(markup_pages(spark, sf))


@query
def classify_lines(spark, sf):
    return pq.classify_lines(markup_pages(spark, sf))


@query
def headings(spark, sf):
    return pq.headings(markup_pages(spark, sf)).select("id", "pos", "level", "heading")


@query
def page_links(spark, sf):
    return pq.page_links(markup_pages(spark, sf))


@query
def page_categories(spark, sf):
    return pq.page_categories(markup_pages(spark, sf))


@query
def external_links(spark, sf):
    return pq.external_links(markup_pages(spark, sf))


@query
def citations(spark, sf):
    found = pq.citations(markup_pages(spark, sf))
    return found.select("id", "type", "title", F.explode_outer("attributes").alias("key", "value")).select(
        "id",
        "type",
        "title",
        F.coalesce("key", F.lit("")).alias("key"),
        F.coalesce("value", F.lit("")).alias("value"),
    )


@query
def library_refs(spark, sf):
    return pq.library_refs(markup_pages(spark, sf))


@query
def language_notes(spark, sf):
    return pq.language_notes(markup_pages(spark, sf))


@query
def named_refs(spark, sf):
    return pq.named_refs(markup_pages(spark, sf))


@query
def abstracts(spark, sf):
    return pq.abstracts(markup_pages(spark, sf))


@query
def result_list(spark, sf):
    index, pages = dump_index(spark, sf)
    return pq.result_list(pq.search_batch(requests(spark, sf), index), pages)


# Windows, sorting, sets -------------------------------------------------------------------


@query
def rank_pages(spark, sf):
    return pq.rank_pages(pq.score_by_length(*document_matches(spark, sf)), 20)


@query
def top_k(spark, sf):
    matches, stats = document_matches(spark, sf)
    hits = pq.score_by_length(matches, pq.min_words_filter(stats)).withColumn("result_id", F.col("id"))
    ks = pq.parse_request(text_requests(spark, sf)).select("request_id", "k")
    max_k = ks.agg(F.max("k")).first()[0]
    return pq.top_k(rk.body_places(hits).join(ks, "request_id"), F.col("k"), max_k)


@query
def terms_by_df(spark, sf):
    terms = rk.distinct_terms(pq.parse_request(text_requests(spark, sf)))
    return pq.terms_by_df(terms, document_index(spark, sf).vocabulary)


@query
def merge_results(spark, sf):
    scored, index = dump_hits(spark, sf)
    body = rk.body_places(pq.redirect_resolve(scored, index.page_targets))
    places = pq.merge_results(body, rk.title_places(title_hits(spark, sf, index)))
    return places.select("request_id", "id", "place.source")


@query
def dedup_results(spark, sf):
    scored, index = dump_hits(spark, sf)
    best = pq.dedup_results(rk.body_places(pq.redirect_resolve(scored, index.page_targets)))
    return best.select(
        "request_id",
        "id",
        (-F.col("place.first")).alias("times"),
        (-F.col("place.second")).alias("ln_score"),
        F.col("place.third").alias("hit"),
    )


@query
def sorted_index(spark, sf):
    return pq.sorted_index(pq.inverted_index(indexed(spark, sf)))


# Streaming --------------------------------------------------------------------------------


@query
def search_stream(spark, sf):
    index, _ = dump_index(spark, sf)
    inbox, out, state = (scratch_path(spark, n) for n in ("requests", "answers", "stream-state"))
    requests(spark, sf).write.parquet(inbox)
    stream = pq.search_stream(pq.read_requests(spark, inbox, 1), index, out, state, available_now=True)
    stream.awaitTermination()
    return spark.read.parquet(out).select("request_id", "rank", "id")
