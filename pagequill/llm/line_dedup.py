"""Repeated passages of lines, in DataFrame functions only.

Every three consecutive lines of a document are a window, known by two 64-bit hashes. Windows
that occur more than once are found by an aggregate that keeps only the first place of each, so
a window of a third of all rows shrinks before it is moved. All later occurrences are marked,
the lines they cover are merged to intervals, and a document keeps what lies between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import carried, field, saved

LINES = 3
_KEY = ("doc_id", "version")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _windows(lines: Column) -> Column:
    """(a, b) of the windows of an array of lines; none with fewer lines than a window has.

    Windows of blank lines only are null.
    """
    hashes = [F.transform(lines, lambda x: F.xxhash64(x)), F.transform(lines, lambda x: F.xxhash64(F.lit(1), x))]
    blank = F.transform(lines, lambda x: F.trim(x) == "")
    packed = F.arrays_zip(hashes[0].alias("a"), hashes[1].alias("b"), blank.alias("blank"))

    def window(at: Column) -> Column:
        own = [F.get(F.col("packed"), at + i) for i in range(LINES)]
        found = F.struct(
            F.xxhash64(*[x["a"] for x in own]).alias("a"), F.xxhash64(*[x["b"] for x in own]).alias("b")
        )
        return F.when(~(own[0]["blank"] & own[1]["blank"] & own[2]["blank"]), found)

    return packed, window


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with lines of repeated windows taken out, and two more columns before them.

    Of the occurrences of a window, that with the smallest (id, position) is the first; a null id
    comes last. Lines covered by any other occurrence are removed. As the first of equal lines
    is never covered, no line is lost altogether. Documents of fewer than three lines have no
    window and stay as they are, null texts too; windows of blank lines do not count. Rows that
    repeat an id and text are one document. All columns stay; (n_lines, n_removed) count the
    lines of the text and those removed, and replace columns of these names.
    """
    rows = carried(docs)
    text = F.coalesce(field(text_col), F.lit(""))
    keyed = rows.select(field(id_col).alias("doc_id"), F.xxhash64(text).alias("version"), _lines(text).alias("lines"))
    packed, window = _windows(F.col("lines"))
    places = F.sequence(F.lit(0), F.size("packed") - LINES)
    found = (
        keyed.where(F.size("lines") >= LINES)
        .select(*_KEY, packed.alias("packed"))
        .select(*_KEY, F.posexplode(F.transform(places, window)).alias("pos", "w"))
        .where("w IS NOT NULL")
        .select(*_KEY, "pos", "w.a", "w.b")
    )
    found = saved(found, "windows")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "version", "pos")
    first = found.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = found.join(first.drop("n"), ["a", "b"]).where(place != F.col("first"))
    starts = later.groupBy(*_KEY).agg(F.sort_array(F.collect_set("pos")).alias("s"))
    # A document's starts are no more than its lines; runs of them become intervals.
    begins = F.filter("s", lambda x, i: (i == 0) | (x > F.get(F.col("s"), i - 1) + LINES))
    ends = F.filter("s", lambda x, i: (i == F.size("s") - 1) | (F.get(F.col("s"), i + 1) > x + LINES))
    cuts = saved(starts.select(*[F.col(k).alias(f"_{k}") for k in _KEY], begins.alias("begins"), ends.alias("ends")), "cuts")
    # The cuts grow with the corpus: they are never broadcast. Lines are split behind the join.
    own = rows.select("row", field(id_col).alias("id"), F.xxhash64(text).alias("hash"))
    same = own["id"].eqNullSafe(cuts["_doc_id"]) & (own["hash"] == cuts["_version"])
    joined = own.join(cuts.hint("merge"), same, "left").withColumn("_lines", _lines(field(text_col)))
    n_lines = F.size("_lines")

    def between(i: Column) -> Column:
        begin = F.when(i == 0, 0).otherwise(F.get(F.col("ends"), i - 1) + LINES)
        stop = F.coalesce(F.get(F.col("begins"), i), n_lines)
        return F.slice("_lines", begin + 1, stop - begin)

    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("begins")), between))
    changed = F.col("begins").isNotNull()
    result = joined.withColumn("_kept", F.when(changed, kept).otherwise(F.col("_lines")))
    columns = [F.when(changed, F.array_join("_kept", "\n")).otherwise(field(c)).alias(c) if c == text_col else field(c).alias(c)
               for c in docs.columns if c not in ("n_lines", "n_removed")]
    return result.select(
        *columns, n_lines.alias("n_lines"), (n_lines - F.size("_kept")).alias("n_removed")
    )
