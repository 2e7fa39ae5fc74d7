"""Page records: fields, indexed text, and the counting jobs over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, text as tx
from ..functions.markup import plain_text
from .filters import drop_blocked_sha1, drop_empty_text
from .lines import with_shown_lines


def field_columns() -> list[Column]:
    """Fields of a page as columns over ``raw``."""
    return [
        tx.tag_slice_first("raw", fixed.ID_OPEN, fixed.ID_CLOSE).try_cast("bigint").alias("id"),
        tx.tag_slice_first("raw", fixed.TITLE_OPEN, fixed.TITLE_CLOSE).alias("title"),
        tx.redirect_title("raw").alias("redirect_title"),
        tx.tag_slice_greedy("raw", fixed.SHA1_OPEN, fixed.SHA1_CLOSE).alias("sha1"),
        tx.tag_slice_greedy("raw", fixed.TEXT_OPEN, fixed.TEXT_CLOSE).alias("text"),
    ]


def page_fields(raw_pages: DataFrame) -> DataFrame:
    """Raw records to ``(id, title, redirect_title, sha1, text)``; an offset is kept."""
    kept = [c for c in ("path", "offset") if c in raw_pages.columns]
    return raw_pages.select(*kept, *field_columns())


def decoded_text(pages: DataFrame) -> DataFrame:
    """Pages with the entities of their text resolved."""
    return pages.withColumn("text", tx.entity_decode("text"))


def clean_text(pages: DataFrame) -> DataFrame:
    """Adds ``content``: the title with its entities resolved, then the shown lines without markup.

    The title itself stays as it is, so that redirects to it still match.
    """
    lines = F.transform("shown", lambda s: plain_text(s["line"]))
    return (
        with_shown_lines(pages)
        .withColumn("content", F.concat_ws(" ", tx.entity_decode("title"), F.array_join(lines, "\n")))
        .drop("shown")
    )


def redirect_count(pages: DataFrame) -> DataFrame:
    """Row ``Answer n``: pages with text that starts with the redirect mark; no row for none."""
    hits = drop_blocked_sha1(drop_empty_text(pages)).where(tx.is_redirect_text("text"))
    return hits.groupBy(F.lit("Answer").alias("answer")).agg(F.count("*").alias("n"))


def bad_doc_count(pages: DataFrame) -> DataFrame:
    """Row ``Answer n``: pages without text; the row is there for none, too."""
    return pages.agg(
        F.max(F.lit("Answer")).alias("answer_seen"),
        F.count_if(F.coalesce(F.col("text"), F.lit("")) == "").alias("n"),
    ).select(F.coalesce("answer_seen", F.lit("Answer")).alias("answer"), "n")
