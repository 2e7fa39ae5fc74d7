"""Column functions over one line of wiki markup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import _col


def occurrences(c: Column, token: str) -> Column:
    """How often ``token`` occurs in ``c``, overlaps not counted."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(token), F.lit("")))) / len(token)).cast("int")


def brace_step(line: Column) -> Column:
    """+1 if a line opens more ``{{`` than it closes, -1 if fewer, else 0."""
    return F.signum(occurrences(line, "{{") - occurrences(line, "}}")).cast("int")


def is_shown_line(line: Column) -> Column:
    """Whether a line outside of a block is shown."""
    hidden = line == ""
    for start in fixed.HIDDEN_LINE_STARTS:
        hidden = hidden | line.startswith(start)
    return ~hidden


def plain_text(line: Column | str) -> Column:
    """A line without its inline markup: labels stay, comments, notes and templates go."""
    c = _col(line)
    steps = (
        (fixed.COMMENT, ""),
        # Closed notes go first: the pattern of named notes would take the text behind them.
        (r"<ref[^>]*\/>", ""),
        (fixed.NAMED_REF, ""),
        (fixed.ANY_REF, ""),
        (r"\[\[Category:([^\]]*)\]\]", "$1"),
        (r"\[\[[^\]|]*\|([^\]|]*)[^\]]*\]\]", "$1"),
        (fixed.LINK, "$1"),
        (r"\[http://[^\] ]* ([^\]]*)\]", "$1"),
        (fixed.BRACKET, "$1"),
        (fixed.STRONG_EM, "$1"),
        (fixed.STRONG, "$1"),
        (fixed.EM, "$1"),
        (fixed.TEMPLATE, ""),
    )
    out = c
    for pattern, replacement in steps:
        out = F.regexp_replace(out, pattern, replacement)
    # Most lines hold no markup at all: one look saves them all passes.
    return F.when(c.rlike(r"[<\[]|''|\{\{"), out).otherwise(c)


def heading_level(line: Column | str) -> Column:
    """Length of the leading ``=`` run, 0 if the line is no heading."""
    return F.length(F.regexp_extract(_col(line), "^(=+)[^=]", 1))


def heading_text(line: Column | str) -> Column:
    """Heading without its marks; a heading that is not closed loses its last characters."""
    c, level = _col(line), heading_level(line)
    return F.substring(c, level + 1, F.greatest(F.length(c) - level * 2, F.lit(0)))


def line_kind(line: Column | str) -> Column:
    """``item``, ``heading`` or ``paragraph``. A line of ``=`` alone is a heading, if an empty one.

    What counts is the converted line: only a line that starts with ``*``, or with a
    bracket around one, still starts with ``*`` after conversion.
    """
    c = _col(line)
    return (
        F.when(c.rlike(r"^(\*|\[\*[^\]]*\])"), "item")
        .when(c.startswith("="), "heading")
        .otherwise("paragraph")
    )


def section_value(section: Column) -> Column:
    """Value of ``key=value``: the part between the first and the second ``=``."""
    return F.coalesce(F.get(F.split(section, "="), F.lit(1)), F.lit(""))


def section_key(section: Column) -> Column:
    return F.get(F.split(section, "="), F.lit(0))


def last_value(sections: Column, key: str) -> Column:
    """Value of the last ``key=…`` section, NULL without one."""
    values = F.transform(
        F.filter(sections, lambda s: section_key(s) == key), section_value
    )
    return F.get(values, F.size(values) - 1)
