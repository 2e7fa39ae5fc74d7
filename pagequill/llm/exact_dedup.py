"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only.

A text without white space is cut where its own characters say so, in chunks of 256 to 2,048
characters. Chunks are reduced to 64-bit identifiers; a shuffle of the distinct chunks proves
that no two of them share one, and gives numbers to those that do. A document is then its
recipe, the ordered list of identifiers, about a hundredth of its text, and only recipes are
grouped and joined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import field, numbered, row_key, saved, without

SHORTEST, LONGEST = 256, 2048
#: A cut is made behind five characters of which the code points are 0, 1, 2, 0, 1 modulo 3;
#: one in some 240 places. Among characters beyond Latin-1 chunks have the longest length.
_CLASS = ["".join(rf"\x{{{c:x}}}" for c in range(0x21, 0x100) if c % 3 == k) for k in range(3)]
_CUT = "".join(f"[{_CLASS[k]}]" for k in (0, 1, 2, 0, 1))
CHUNK = rf"(?s).{{{SHORTEST},{LONGEST}}}?(?<={_CUT})|.{{1,{LONGEST}}}"


def normalised(text: Column) -> Column:
    """The text without white space; "" for null."""
    plain = F.coalesce(text, F.lit(""))
    for space in " \t\n\x0b\x0c\r":
        plain = F.replace(plain, F.lit(space), F.lit(""))
    return plain


def chunks_of(plain: Column) -> Column:
    """Content-defined chunks of a text; joined they are the text."""
    return F.regexp_extract_all(plain, F.lit(CHUNK), F.lit(0))


def _verified(cut: DataFrame, identify: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, n_chars, sha, recipe) in which equal identifiers mean equal chunks.

    All distinct chunks are moved once, to count the texts of each identifier. Texts that share
    one are numbered, and the documents holding them get recipes with those numbers.
    """
    plain = cut.select("doc_id", "n_chars", "sha", "recipe")
    texts = cut.select(F.explode("chunks").alias("chunk")).distinct().withColumn("h", identify(F.col("chunk")))
    clashes = saved(texts.groupBy("h").agg(F.count("*").alias("texts")).where("texts > 1"), "clashes")
    if clashes.isEmpty():
        return plain
    place = F.row_number().over(Window.partitionBy("h").orderBy("chunk"))
    numbered = saved(texts.join(clashes.select("h"), "h").select("h", "chunk", place.alias("k")), "numbered")
    parts = cut.select("doc_id", "sha", F.posexplode("chunks").alias("pos", "chunk"))
    parts = parts.withColumn("h", identify(F.col("chunk")))
    entry = F.struct("pos", "h", F.coalesce("k", F.lit(0)).alias("k"))
    own = (
        parts.join(numbered, ["h", "chunk"], "left")
        .groupBy("doc_id", "sha")
        .agg(F.sort_array(F.collect_set(entry)).alias("recipe"))
        .withColumnsRenamed({"doc_id": "_id", "sha": "_sha"})
    )
    same = plain["doc_id"].eqNullSafe(own["_id"]) & (plain["sha"] == own["_sha"])
    empty = F.array().cast(own.schema["recipe"].dataType)
    return (
        plain.drop("recipe")
        .join(own, same, "left")
        .select("doc_id", "n_chars", "sha", F.coalesce("recipe", empty).alias("recipe"))
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    identify: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """Group of equal texts of every document, and which of them stays.

    Texts are equal if they are after deleting white space; a null text counts as empty. The
    document with the most characters in the original text stays, then the smallest id (a null
    id last). Returns one row per input row: (doc_id, keep_id, group_size, kept, text_sha256).
    Rows that repeat an id and text have the same decision. An empty table gives an empty table;
    columns besides the two named are not read.
    """
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.length(text_col), F.lit(0)).alias("n_chars"),
        normalised(F.col(text_col)).alias("plain"),
    )
    cut = texts.select("doc_id", "n_chars", F.sha2("plain", 256).alias("sha"), chunks_of(F.col("plain")).alias("chunks"))
    cut = saved(cut.withColumn("recipe", F.transform("chunks", lambda c: identify(c))), "chunks")
    recipes = _verified(cut, identify)
    first = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id").alias("id")))
    groups = recipes.groupBy("recipe").agg(first["id"].alias("keep_id"), F.count("*").alias("group_size"))
    return recipes.join(groups, "recipe").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of ``exact_groups``; all columns stay.

    It is the row that is kept there; of rows that repeat its id and length any one. Null and empty texts are
    copies of each other. An empty table gives an empty table.
    """
    rows = numbered(docs)
    groups = exact_groups(rows.select(row_key(id_col).alias("key"), field(text_col).alias("text")), "key", "text")
    return without(rows, groups.where("not kept").select(F.col("doc_id.row").alias("number")))
