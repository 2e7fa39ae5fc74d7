"""Periodic runs of words by seeds that are extended along diagonals.

A run is a stretch of words with smallest period q, at least six words and four periods long, that
no neighbouring word extends. On the diagonal of lag q, words q apart, a run of period 1 has five
matches or more, and one of a period from 2**j up at least 3 * 2**j. These lengths are guaranteed,
so for each class of lags [2**j, 2**(j + 1)) k-grams of that many words are indexed, and each place
is paired with the next occurrence of its k-gram in the same document. One pair is enough: were a
k-gram of the run repeated at less than 2**j words, this distance and q would both be periods of it,
hence their divisor one of the run; and a second next occurrence is beyond the class. So there is
at most one seed per place and class, whatever repeats in a text, and none is lost.

Seeds are taken lag by lag in the order of their places. A table holds for each lag the furthest
place that an extension has covered; seeds before it are parts of a stretch already known.
K-grams of a class are made of pairs of shorter ones, as ranks, and a place whose shorter gram
occurs once in its document takes no further part, so the longer classes look at few places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import carried, field, unpacked

#: Fewest words and periods of a run.
WORDS, PERIODS = 6, 4
#: Matches on the diagonal that a run of period 1 has at least.
FIRST_GRAM = WORDS - 1
#: Words of the documents that are looked at together, at least one document.
TOGETHER = 1 << 20
RUNS = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _ranks(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs, and different ones for others."""
    if not len(high):
        return high
    return np.unique(high * (low.max() + 1) + low, return_inverse=True)[1].astype(np.int64)


def _grams(words: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(smallest lag, k, places, ranks): the k-grams of each class that occur more than once."""

    def repeated(at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        again = np.bincount(rank)[rank] > 1 if len(rank) else np.zeros(0, bool)
        return at[again], rank[again]

    def joined(at: np.ndarray, rank: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
        """Grams made of two, the second of which begins ``gap`` words behind the first."""
        whole = np.full(len(words) + gap, -1, np.int64)
        whole[at] = rank
        both = whole[at + gap] >= 0
        return repeated(at[both], _ranks(rank[both], whole[at[both] + gap]))

    at = np.arange(len(words) - 1)
    at, rank = repeated(at, _ranks(words[at], words[at + 1]))
    three = joined(at, rank, 1)
    yield 1, FIRST_GRAM, *joined(*three, FIRST_GRAM - 3)
    k, (at, rank) = 3, three
    while len(at):
        at, rank = joined(at, rank, k)
        k *= 2
        yield k // 3, k, at, rank


def _seeds(words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, places, lags) of each class, ordered by lag, then place."""
    for lag, k, at, rank in _grams(words):
        order = np.argsort(rank, kind="stable")
        same = rank[order][1:] == rank[order][:-1]
        place, gap = at[order][:-1][same], np.diff(at[order])[same]
        own = (gap >= lag) & (gap < 2 * lag)
        place, gap = place[own], gap[own]
        order = np.lexsort((place, gap))
        yield k, place[order], gap[order]


def _matches(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal words at the begin of both."""
    done, size, most = 0, 64, min(len(a), len(b))
    while done < most:
        unequal = np.flatnonzero(a[done : done + size][: most - done] != b[done : done + size][: most - done])
        if len(unequal):
            return done + int(unequal[0])
        done, size = done + size, size * 2
    return most


def found_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a row of numbers, by start, then period."""
    found, covered = [], {}
    for k, places, lags in _seeds(words):
        if not len(places):
            continue
        # Of seeds at successive places the first stands for all: they are on one stretch.
        first = np.r_[True, (np.diff(places) != 1) | (np.diff(lags) != 0)]
        for at, lag in zip(places[first].tolist(), lags[first].tolist()):
            done = covered.get(lag, 0)
            if at < done:
                continue
            end = at + k + _matches(words[at + k :], words[at + k + lag :])
            start = at - _matches(words[done:at][::-1], words[done + lag : at + lag][::-1])
            covered[lag] = end
            length = end + lag - start
            if length >= max(WORDS, PERIODS * lag):
                found.append((start, length, lag))
    found.sort(key=lambda r: (r[0], r[2]))
    return found


def _numbers(texts: list[list[bytes]]) -> np.ndarray:
    """Words as numbers; a word has another one in each text, so no gram goes on in the next text."""
    out, base = [], 0
    for words in texts:
        known: dict[bytes, int] = {}
        out.extend([known.setdefault(w, base + len(known)) for w in words])
        base += len(known)
    return np.array(out, np.int64)


def _described(texts: list[str | None]) -> list[tuple[list[tuple[int, int, int]], str]]:
    """Runs and collapsed words of each text."""
    split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    ends = np.cumsum([len(w) for w in split])
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in found_runs(_numbers(split)):
        i = int(np.searchsorted(ends, start, "right"))
        runs[i].append((start - int(ends[i]) + len(split[i]), length, period))
    out = []
    for own, words in zip(runs, split):
        if own:
            kept = np.ones(len(words), bool)
            for start, length, period in own:
                kept[start + period : start + length] = False
            words = [w for w, keep in zip(words, kept.tolist()) if keep]
        out.append((own, b" ".join(words).decode("utf-8", "surrogatepass")))
    return out


def _together(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of about ``TOGETHER`` words."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text or "") // 5
        if size >= TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    names = ("start", "length", "period")
    for batch in batches:
        at = 0
        for texts in _together(batch.column("text").to_pylist()):
            found = _described(texts)
            runs = pa.array([[dict(zip(names, r)) for r in own] for own, _ in found], kind)
            collapsed = pa.array([text for _, text in found], pa.string())
            ids = batch.column("doc_id").slice(at, len(texts))
            yield pa.RecordBatch.from_arrays([ids, runs, collapsed], ["doc_id", "runs", "collapsed"])
            at += len(texts)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Periodic runs of the words of every text, and the text with each run cut to one period.

    Returns one row per input row: (doc_id, runs, collapsed). Words are what stands between ASCII
    white space and are numbered from 0; ``runs`` holds (start, length, period) by start, then
    period, and is empty where there is no run. A word is left out of ``collapsed`` if any run contains it
    behind the run's first period; the others are joined by one blank. A null text is empty and
    has no runs. Rows that repeat an id each get a row, as does a null id. An empty table gives
    an empty table; columns besides the two named are not read.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(_work, f"doc_id {kind}, {RUNS}")


def strongest(runs: Column) -> Column:
    """The run with most periods, exactly compared; of equal ones the first start, then period."""
    better = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    first = F.get(runs, F.lit(0))
    return F.aggregate(runs, first, lambda best, run: F.when(better(run, best), run).otherwise(best))


def with_planted_period(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a periodic end in the texts of a tenth of the ids, chosen by their checksums.

    With h the checksum of the id and g = floor(h / 10), the words of texts with h % 10 = 0 repeat
    from word a = g % n on with the period 1 + floor((n - a) / (3 + g % 8)). Texts without words
    and rows without an id stay as they are.
    """
    rows = carried(docs)
    h = F.crc32(field(id_col).cast("string").cast("binary"))
    text = field(text_col)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size("own.w").cast("long")
    begin = F.pmod(F.col("own.g"), n)
    period = F.lit(1).cast("long") + F.floor((n - begin) / (F.lit(3) + F.pmod(F.col("own.g"), F.lit(8))))
    placed = F.struct(F.col("own.w").alias("w"), begin.alias("a"), period.alias("p"))

    def word(w: Column, i: Column) -> Column:
        a, p = F.col("placed.a"), F.col("placed.p")
        return F.when(i >= a, F.get(F.col("placed.w"), (a + F.pmod(i - a, p)).cast("int"))).otherwise(w)

    changed = F.when(F.col("placed").isNotNull(), F.array_join(F.transform("placed.w", word), " ")).otherwise(text)
    rows = rows.withColumn("own", F.when(h % 10 == 0, F.struct(words.alias("w"), F.floor(h / 10).alias("g"))))
    rows = rows.withColumn("placed", F.when(F.size("own.w") > 0, placed))
    return unpacked(rows.withColumn("row", F.col("row").withField(f"`{text_col}`", changed)))
