"""Build: from a dump to an index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.filters import indexable_pages
from ..operators.pages import clean_text, decoded_text, field_columns, page_fields
from ..operators.titles import page_directory
from ..sources.dump import load_dump_offsets
from ..sources.index_store import Index, write_index
from ..sources.scratch import scratch_scope
from ..sources.tables import read_by_id, spread, store_by_id


def indexed_pages(raw_pages: DataFrame, blocked: DataFrame | None = None) -> DataFrame:
    """Raw records to the pages that are indexed, with their ``content``."""
    return clean_text(decoded_text(indexable_pages(page_fields(raw_pages), blocked)))


def index_dump(
    spark: SparkSession, paths: str | list[str], out: str, blocked: DataFrame | None = None
) -> Index:
    """Index a dump below ``out``: the page store, the directory with offsets, all tables.

    The dump is read once: records get their offsets and are cleaned in the same pass.
    """
    with scratch_scope(spark):
        # The records are read back from files, so a lost executor does not go back to the dump.
        placed = indexable_pages(load_dump_offsets(spark, paths, columns=field_columns()), blocked)
        pages = store_by_id(decoded_text(placed).drop("path", "offset"), f"{out}/pages")
        # Clean text is made where words are counted: it is neither shuffled nor stored beside the text.
        return write_index(clean_text(spread(pages)), out, page_directory(placed))


def load_pages(spark: SparkSession, out: str) -> DataFrame:
    """The page store written by :func:`index_dump`, in buckets by id; ``content`` is made when it is asked for."""
    pages = clean_text(read_by_id(spark, f"{out}/pages"))
    return pages.select(*(c for c in pages.columns if c != "id_bucket"), "id_bucket")
