"""One query per operator over the whole of its table, and SQL to compare with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    exact_dedup,
    interval_search,
    line_dedup,
    maxscore,
    mixing,
    periodic,
    pii,
    pivot_index,
    sentencepiece,
    simhash,
    token_file,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op2_simhash(spark, sf):
    return simhash.simhash_groups(table(spark, sf, "documents"))


@query
def op5_exact_dedup(spark, sf):
    return exact_dedup.exact_groups(table(spark, sf, "documents"))


ORACLE["op5_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY plain) AS group_size
  FROM t WINDOW w AS (PARTITION BY plain ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(plain) AS text_sha256
FROM g
"""


@query
def op3_token_file(spark, sf):
    return token_file.token_table(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_line_dedup(spark, sf):
    kept = line_dedup.deduplicated(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


ORACLE["op7_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
w AS (
  SELECT doc_id, pos, line, lead(line, 1) OVER d AS second, lead(line, 2) OVER d AS third
  FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
n AS (
  SELECT *, row_number() OVER (PARTITION BY line, second, third ORDER BY doc_id, pos) AS place FROM w
  WHERE third IS NOT NULL AND trim(line || second || third, ' ') <> ''),
c AS (SELECT DISTINCT doc_id, pos + unnest([0, 1, 2]) AS pos FROM n WHERE place > 1)
SELECT l.doc_id, CAST(count(*) AS integer) AS n_lines, CAST(count(c.pos) AS integer) AS n_removed,
       md5(coalesce(string_agg(CASE WHEN c.pos IS NULL THEN line END, chr(10) ORDER BY l.pos), '')) AS kept_md5
FROM l LEFT JOIN c ON l.doc_id = c.doc_id AND l.pos = c.pos GROUP BY l.doc_id
"""


@query
def op10_warc(spark, sf):
    return warc.archived_pages(table(spark, sf, "pages"))


ORACLE["op10_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keeper FROM p),
r AS (SELECT *, strlen(html) >= 1000 AND page_id <> keeper AS again FROM k)
SELECT page_id, CAST(strlen(html) AS bigint) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN keeper END AS refers_to FROM r
"""


@query
def op8_pivot_index(spark, sf):
    return pivot_index.vector_groups(table(spark, sf, "embeddings"))


@query
def op9_sentencepiece(spark, sf):
    return sentencepiece.round_trip(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op4_toxicity(spark, sf):
    return toxicity.toxicity_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


#: Shares of tokens wanted of each domain.
MIX = {"good": 0.75, "poor": 0.2, "toxic": 0.05}


@query
def op1_mixing(spark, sf):
    labelled = mixing.domains_of(table(spark, sf, "labels"))
    return mixing.document_rates(table(spark, sf, "documents"), labelled, MIX)


@query
def op6_pii(spark, sf):
    return pii.personal_data(table(spark, sf, "documents"))


@query
def op11_maxscore(spark, sf):
    return maxscore.exact_top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE["op11_maxscore"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS double)) AS bigint)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS bigint) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS integer) AS rank, vec_id, score FROM r WHERE place <= 10
"""


@query
def op12_periodic_runs(spark, sf):
    docs = periodic.with_planted_period(table(spark, sf, "documents").select("doc_id", "text"))
    best = periodic.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = periodic.periodic_runs(docs).select("doc_id", "collapsed", "runs", best.alias("best"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_interval_search(spark, sf):
    return interval_search.ranked_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


ORACLE["op13_interval_search"] = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
d AS (SELECT doc_id, len(terms) AS n, terms FROM t WHERE len(terms) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS bigint) AS total FROM d),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS bigint) AS w
  FROM p, s GROUP BY term),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
f AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total)))) AS bigint) AS score
  FROM i JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM f WHERE score > 0)
SELECT item_id, CAST(place AS integer) AS rank, doc_id, score FROM r WHERE place <= 10
"""
