"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on passages typical of toxic documents and one on
ordinary text. A text is cut in overlapping windows of twelve words; each window is compressed
with both, and the bytes that the toxic dictionary saves say how close the window is to toxic
text. How often a document's windows save so many bytes or more makes up its features, and a
logistic curve fitted on labelled documents, which no dictionary saw, turns them into a score.

Passages for the toxic dictionary are those whose byte 5-grams occur in significantly more toxic than
ordinary documents. Both dictionaries start with the same ordinary background, so that ordinary
words cost the same in either.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

from .shared import carried, field, hashed_share, unpacked

WORDS, STEP = 12, 8
GRAM, SLOTS = 5, 1 << 20
TOXIC_BYTES = 4096
#: Bytes of the background, and standard errors by which a gram must be more frequent in toxic
#: documents. Models are fitted for each pair; that with the least loss is taken.
SETTINGS = ((8192, 7.0), (32768, 9.0), (32768, 12.0))
#: Labelled rows of each kind that a model is fitted on at most, and the longest of their texts.
TOXIC_ROWS, ORDINARY_ROWS, FIT_CHARS = 3000, 6000, 20_000
#: Share of these on which the dictionaries are trained; the rest calibrates the score.
DICTIONARY_SHARE = 0.6
#: Savings in bytes whose rates among the windows are features.
STEPS = tuple(range(1, 11))
THRESHOLD = 0.3
#: Shares of the toxic rows that a filter is to catch, and of the ordinary ones that it leaves in any case.
CAUGHT, SPARED = 0.95, 0.93
#: Windows compressed at once.
BLOCK = 100_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def windows(words: list[bytes]) -> list[bytes]:
    """Overlapping runs of words that cover all of them; one empty window for no words."""
    stops = max(1, len(words) - (WORDS - STEP))
    return [b" " + b" ".join(words[i : i + WORDS]) for i in range(0, stops, STEP)]


def _grams(data: bytes) -> np.ndarray:
    """Slot of every byte 5-gram, by position."""
    octets = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = len(octets) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for i in range(GRAM):
        h = h * np.uint64(257) + octets[i : n + i]
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)


def toxic_passages(toxic: list[bytes], ordinary: list[bytes], errors: float) -> list[bytes]:
    """Whole words around significant grams of the toxic texts."""
    n, share = [max(1, len(toxic)), max(1, len(ordinary))], []
    for texts in (toxic, ordinary):
        seen = np.zeros(SLOTS)
        for data in texts:
            seen[np.unique(_grams(data))] += 1
        share.append(seen)
    both = (share[0] + share[1]) / sum(n)
    error = np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / n[0] + 1 / n[1]))
    significant = (share[0] / n[0] - share[1] / n[1]) / error > errors
    found = []
    for data in toxic:
        hot = np.flatnonzero(significant[_grams(data)])
        if not len(hot):
            continue
        gap = np.diff(hot) > GRAM
        for a, b in zip(hot[np.r_[True, gap]].tolist(), hot[np.r_[gap, True]].tolist()):
            start, stop = data.rfind(b" ", 0, a + 2), data.find(b" ", b + GRAM - 1)
            found.append(data[max(start, 0) : stop if stop >= 0 else len(data)][:40])
    return found


def _dictionary(size: int, samples: list[bytes], segment: int) -> bytes:
    """Content of a dictionary trained on the samples; they are cycled where they are few."""
    samples = [s for s in samples if len(s) >= 8]
    if sum(map(len, samples)) < 64:
        return b"".join(samples)
    while sum(map(len, samples)) < 20 * size:
        samples = samples + samples
    return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()


@dataclass
class Model:
    """Dictionaries and a fitted curve; a few kilobytes."""

    toxic: bytes
    ordinary: bytes
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    #: Scores of the toxic and of the ordinary rows by which the curve was fitted.
    known: tuple[np.ndarray, np.ndarray] = (np.zeros(0), np.zeros(0))

    def threshold(self, caught: float = CAUGHT, spared: float = SPARED) -> float:
        """Score from which a filter rejects: it catches the share ``caught`` of the toxic rows, unless that
        takes more than the rest of ``spared`` of the ordinary ones. ``THRESHOLD`` for a model without rows.
        """
        toxic, ordinary = self.known
        if not len(toxic) or not len(ordinary):
            return THRESHOLD
        return float(max(np.quantile(toxic, 1 - caught), np.quantile(ordinary, spared)))

    def _compressors(self) -> list[zstandard.ZstdCompressor]:
        options = zstandard.ZstdCompressionParameters.from_level(
            3, min_match=4, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        kind = zstandard.DICT_TYPE_RAWCONTENT
        return [
            zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=kind), compression_params=options)
            for d in (self.ordinary, self.toxic)
        ]

    def features(self, texts: list[str | None]) -> np.ndarray:
        """A row per text: rates of savings, largest and mean saving, number of windows."""
        own = self._compressors()
        out = np.zeros((len(texts), 2 * len(STEPS) + 3))
        counts, sums = np.zeros((len(texts), len(STEPS))), np.zeros((len(texts), 3))
        sums[:, 0] = -np.inf
        run, of = [], []

        def measure():
            sizes = [np.array([len(x) for x in c.multi_compress_to_buffer(run, threads=1)]) for c in own]
            saved, row = sizes[0] - sizes[1], np.array(of)
            np.maximum.at(sums[:, 0], row, saved)
            np.add.at(sums[:, 1], row, saved)
            np.add.at(sums[:, 2], row, 1)
            for j, least in enumerate(STEPS):
                counts[:, j] += np.bincount(row[saved >= least], minlength=len(texts))
            run.clear()
            of.clear()

        for i, text in enumerate(texts):
            words = words_of(text)
            for at in range(0, max(1, len(words) - (WORDS - STEP)), BLOCK * STEP):
                part = windows(words[at : at + BLOCK * STEP + WORDS - STEP])
                run.extend(part)
                of.extend([i] * len(part))
                if len(run) >= BLOCK:
                    measure()
        if run:
            measure()
        n = np.maximum(sums[:, 2:], 1)
        rate = counts / n
        out[:, : len(STEPS)], out[:, len(STEPS) : 2 * len(STEPS)] = np.sqrt(rate), np.log1p(counts)
        out[:, -3], out[:, -2], out[:, -1] = np.maximum(sums[:, 0], -20), sums[:, 1] / n[:, 0], np.log(n[:, 0])
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return self._curved(self.features(texts)) if len(texts) else np.zeros(0)

    def _curved(self, features: np.ndarray) -> np.ndarray:
        z = (features - self.centre) / self.scale
        # Summed row by row, so that a text scores the same whatever stands beside it.
        total = (z * self.weights[1:]).sum(1) + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton steps; intercept first."""
    x = np.column_stack([np.ones(len(x)), x])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fitted(texts: list[str], labels: np.ndarray, prior: float) -> Model:
    """Model for documents of which a share ``prior`` is toxic, from labelled texts in any mix.

    Without rows of both kinds the score is the prior.
    """
    labels = np.asarray(labels)
    rank = np.zeros(len(labels))
    for kind in (0, 1):
        own = np.flatnonzero(labels == kind)
        rank[own] = (np.arange(len(own)) + 0.5) / max(1, len(own))
    train = rank < DICTIONARY_SHARE
    data = [b" " + b" ".join(words_of(t)) for t, use in zip(texts, train) if use]
    toxic = [d for d, y in zip(data, labels[train]) if y == 1]
    ordinary = [d for d, y in zip(data, labels[train]) if y == 0]
    common = [w for d in ordinary for w in windows(d.split())[::16]]
    rest, y = [t for t, use in zip(texts, train) if not use], labels[~train].astype(float)
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    size = 2 * len(STEPS) + 3
    best, least = Model(b"", b"", np.zeros(size), np.ones(size), np.r_[np.log(prior / (1 - prior)), np.zeros(size)]), np.inf
    if not 0 < y.sum() < len(y):
        return best
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    for n_bytes, errors in SETTINGS:
        background = _dictionary(n_bytes, common, 64)
        model = Model(
            background + _dictionary(TOXIC_BYTES, toxic_passages(toxic, ordinary, errors), 24),
            background + _dictionary(TOXIC_BYTES, common[1::2], 24),
            best.centre, best.scale, best.weights,
        )
        x = model.features(rest)
        model.centre, model.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        model.weights = _curve((x - model.centre) / model.scale, y, weight)
        p = model._curved(x)
        model.known = (p[y == 1], p[y == 0])
        p = np.clip(p, 1e-9, 1 - 1e-9)
        loss = -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean()
        if loss < least:
            best, least = model, loss
    return best


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_chars: int = FIT_CHARS) -> Model:
    """Model from a bounded sample of the labelled rows, chosen by a hash of their ids.

    ``labels`` has (doc_id, toxic); rows with another label than 0 or 1 are not used, and of an
    id labelled more than once the largest label counts. At most ``TOXIC_ROWS`` and
    ``ORDINARY_ROWS`` rows, of texts up to ``fit_chars`` characters, come to the driver; of an id
    with several texts one is taken. The share of toxic rows is counted over all labelled rows.
    """
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.where(F.length("text") <= fit_chars)
    # Ids are matched and chosen first, so that no text is shuffled for those not chosen.
    there = known.join(texts.select("doc_id").hint("merge"), "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id"))
    # The share is one of the labels whose document is there.
    present = {r["toxic"]: r["n"] for r in there.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    parts = [
        there.where((F.col("toxic") == kind) & hashed_share(F.col("h"), most, present.get(kind, 0))).orderBy("h", "doc_id").limit(most)
        for kind, most in ((1, TOXIC_ROWS), (0, ORDINARY_ROWS))
    ]
    # At most TOXIC_ROWS + ORDINARY_ROWS ids are broadcast, and as many texts come here.
    chosen = texts.join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id")
    found = chosen.groupBy("h", "doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    found.sort(key=lambda r: (r["h"], r["doc_id"]))
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    return fitted([r["text"] for r in found], np.array([r["toxic"] for r in found], int), prior)


def scored(docs: DataFrame, model: Model, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with the score of its texts in ``out``, which replaces a column of that name.

    A null text scores as an empty one, with a single empty window. All other columns stay.
    """

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()), dtype="float64")

    return docs.withColumn(out, score(F.col(text_col)))


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: crc32 of its id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score of every document by a model fitted on the labelled rows that are not held out.

    Returns one row per input row: (doc_id, held_out, score, predicted), where predicted is 1 from a score of
    0.3. A null id is not held out and never trained on. Rows that repeat an id are scored
    alike if their texts are. Without labels of both kinds the score is the share of toxic labels.
    An empty table gives an empty table; columns besides the two named are not read.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = fit(own.where(~held_out()), labels.where(~held_out()).select("doc_id", "toxic"))
    return scored(own, model, out="score").select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float | None = THRESHOLD) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more; None takes that of the model. The columns stay.

    A null text scores as an empty one, rows that repeat a text alike. Without labels of both kinds the score is
    the share of toxic labels. An empty table gives an empty table.
    """
    model = fit(docs.where(~held_out(id_col)), labels.where(~held_out()).select("doc_id", "toxic"), id_col, text_col)
    rows = scored(carried(docs).withColumn("text", field(text_col)), model)
    return unpacked(rows.where(F.col("toxicity") < (model.threshold() if threshold is None else threshold)))
