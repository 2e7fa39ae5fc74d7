"""Column functions over search requests such as ``-5 some words``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

#: Largest limit, which has a negative counterpart.
MOST = (1 << 63) - 1


def trimmed(msg: Column | str) -> Column:
    return F.regexp_replace(_col(msg), r"^\s+|\s+$", "")


def leading_number(msg: Column | str) -> Column:
    """Digits of the leading integer of a trimmed request, with its sign; "" if there is none."""
    return F.regexp_extract(_col(msg), r"^([+-]?[0-9]+)", 1)


def limit_of(digits: Column | str) -> Column:
    """Signed limit, 0 without digits; one beyond 64 bits is as good as the largest one."""
    c = _col(digits)
    most = F.when(c.startswith("-"), -MOST).when(c != "", MOST).otherwise(0)
    return F.greatest(F.coalesce(c.try_cast("bigint"), most), F.lit(-MOST))


def words_behind(msg: Column | str) -> Column:
    """Everything behind the first blank of a trimmed request, blanks included."""
    return F.regexp_extract(_col(msg), r"(?s)^[^ ]* (.*)$", 1)


def split_terms(words: Column | str) -> Column:
    """Query terms in order, lower case, repeated ones kept."""
    return F.filter(F.split(F.lower(_col(words)), " "), lambda w: w != "")
