"""Which pages take part in which job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed


def drop_empty_text(pages: DataFrame) -> DataFrame:
    """Pages whose text is there and not empty."""
    return pages.where(F.col("text") != "")


def drop_blocked_sha1(pages: DataFrame, blocked: DataFrame | None = None) -> DataFrame:
    """Pages whose checksum is not blocked.

    ``blocked(sha1)`` replaces the built-in list, which is short enough for a filter.
    """
    if blocked is None:
        return pages.where(~F.coalesce(F.col("sha1"), F.lit("")).isin(*fixed.BLOCKED_SHA1))
    return pages.join(blocked.select("sha1").distinct(), "sha1", "left_anti").select(*pages.columns)


def drop_missing_id(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("id").isNotNull())


def indexable_pages(pages: DataFrame, blocked: DataFrame | None = None) -> DataFrame:
    """Input of every index job."""
    return drop_missing_id(drop_blocked_sha1(drop_empty_text(pages), blocked))


def min_words_filter(page_stats: DataFrame, min_words: int = fixed.MIN_WORDS) -> DataFrame:
    """Pages that are long enough to be a result themselves."""
    return page_stats.where(F.col("n_words") >= min_words)
