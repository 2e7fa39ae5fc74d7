"""Column functions over raw page records, titles and plain text.

All of them are built-in Spark expressions, so they run inside the scan's stage.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _opening(begin: str) -> str:
    """Pattern for a start tag; without its ``>`` the attributes are skipped."""
    return re.escape(begin) if begin.endswith(">") else re.escape(begin) + "[^>]*>"


def tag_slice_greedy(c: Column | str, begin: str, end: str) -> Column:
    """Text from the first ``begin`` tag to the last ``end`` tag, "" if either is missing."""
    return F.regexp_extract(_col(c), f"(?s){_opening(begin)}(.*){re.escape(end)}", 1)


def tag_slice_first(c: Column | str, begin: str, end: str) -> Column:
    """Text from the first ``begin`` tag to the ``end`` tag that follows it."""
    return F.regexp_extract(_col(c), f"(?s){_opening(begin)}(.*?){re.escape(end)}", 1)


def tag_slice_exact(c: Column | str, begin: str, end: str) -> Column:
    """As :func:`tag_slice_first`, with ``begin`` taken literally."""
    return F.regexp_extract(_col(c), f"(?s){re.escape(begin)}(.*?){re.escape(end)}", 1)


def title_cut(record: Column | str) -> Column:
    """Title of a ``<title>…</title>`` record."""
    c = _col(record)
    return F.substring(
        c,
        F.lit(len(fixed.TITLE_OPEN) + 1),
        F.length(c) - len(fixed.TITLE_OPEN) - len(fixed.TITLE_CLOSE),
    )


def redirect_title(raw: Column | str) -> Column:
    """Target title of a redirect page, "" for any other page."""
    return F.regexp_extract(_col(raw), fixed.REDIRECT_TITLE, 1)


def is_redirect_text(text: Column | str) -> Column:
    return _col(text).startswith(fixed.REDIRECT_TEXT)


def entity_decode(c: Column | str) -> Column:
    out = _col(c)
    for entity, char in fixed.ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def normalise_letters(c: Column | str) -> Column:
    """Lower case, every other character than a-z turned into a space."""
    return F.regexp_replace(F.lower(_col(c)), "[^a-z]", " ")


def tokenize(c: Column | str) -> Column:
    """Words of a text in order, as an array."""
    # A list of matches would be made of a copy of the text for each of them; a split is not.
    return F.filter(F.split(F.lower(_col(c)), "[^a-z]+"), lambda word: word != "")


def title_normalise(c: Column | str) -> Column:
    """Title as it is compared: lower case, other than ASCII characters as spaces."""
    return F.lower(F.regexp_replace(_col(c), r"[^\x00-\x7F]", " "))
