"""Mixing to target weights by soft membership, in DataFrame functions only.

A classifier fitted on a labelled table predicts for every document how likely it belongs to
each domain: naive Bayes over the presence of hashed words, with a temperature chosen on
labelled documents it was not fitted on. Every document then gets a nonnegative rate, such that the tokens
expected in each domain, rate times tokens times posterior summed over all documents, match the
targets. The rates solve a least-squares problem:

    minimise  1/2 (t(r) - T)' G^-1 (t(r) - T),   r_d >= floor

where ``w_d`` is the document's share of all tokens, ``t(r) = sum_d w_d r_d p_d`` the domain
shares, ``T`` the target shares and ``G = sum_d w_d p_d p_d'``. It is solved by projected gradient
steps from rates of one: the gradient of a document, for its share of the tokens, is ``p_d'G^-1 (t(r) - T)``, and a
step is a row-by-row projection onto the rates allowed. Rates at their least that the gradient would lower further stay
there; for the others the gradient is scaled by the curvature that they have together, damped by some amounts at once.
One aggregate per step returns the curvature, another where each of the damped steps would lead, a few numbers; the
driver takes the one that comes nearest. Steps end when the targets are met, when the projected gradient is gone, or
when they come no nearer; there is no other bound on their number.
As rates start at one and only move by the posteriors of their own document, the list of steps gives
the rate of any document from its posteriors.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE, carried, field, remove, saved, unpacked

#: Hashed words of the classifier.
BUCKETS = 4096
SMOOTHING = 1.0
TEMPERATURES = (0.0, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7, 1.0)
#: Largest difference from a target share that counts as met.
TOLERANCE = 5e-4
#: The projected gradient is gone when its norm is below this part of the tolerance.
GONE = 0.1
#: Amounts of damping; the largest makes a step a plain one of the gradient, or shorter.
DAMPING = (1e-9, 1e-4, 1e-2, 0.1, 1.0)
#: Steps come no nearer when so many of them one after the other lower the distance by less than this part of it.
NO_NEARER, IN_A_ROW = 1e-4, 3
#: Steps after which the rates are written, so that expressions do not grow.
WRITE_EVERY = 8


def domains_of(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from quality and toxicity labels: toxic, good or poor."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain"))


def _literal(values) -> Column:
    """An array of doubles as one constant."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def _adding(table: Column) -> Callable[[Column, Column], Column]:
    return lambda total, place: total + F.get(table, place)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def _buckets(words: Column) -> Column:
    """Distinct buckets of an array of words."""
    return F.array_distinct(F.transform(words, lambda w: F.pmod(F.xxhash64(F.lower(w)), F.lit(BUCKETS)).cast("int")))


@dataclass
class Classifier:
    """Log weights of hashed words by domain: ``BUCKETS`` numbers a domain."""

    domains: list[str]
    priors: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0

    def sums(self, df: DataFrame, buckets: str = "_buckets") -> DataFrame:
        """``df`` with ``_s1``...: what its buckets say for each domain against the first."""
        for k in range(1, len(self.domains)):
            total = F.aggregate(buckets, F.lit(0.0), _adding(_literal(self.weights[k] - self.weights[0])))
            df = df.withColumn(f"_s{k}", total / F.sqrt(F.greatest(F.size(buckets), F.lit(1))))
        return df

    def logits(self, temperature: float) -> list[Column]:
        odds = np.log(self.priors / self.priors[0])
        return [F.lit(0.0), *(F.lit(float(odds[k])) + F.col(f"_s{k}") * temperature for k in range(1, len(self.domains)))]

    def posteriors(self, df: DataFrame, text_col: str) -> DataFrame:
        """``df`` with its number of tokens ``_n`` and an array ``_p`` of domain posteriors.

        A text without words has the priors.
        """
        names = df.columns
        df = df.withColumn("_words", _words(F.col(text_col)))
        df = df.select(*names, F.size("_words").cast("long").alias("_n"), _buckets(F.col("_words")).alias("_buckets"))
        df = self.sums(df).withColumn("_z", F.array(*self.logits(self.temperature)))
        df = df.withColumn("_e", F.transform("_z", lambda z: F.exp(z - F.array_max("_z"))))
        total = F.aggregate("_e", F.lit(0.0), lambda s, e: s + e)
        return df.withColumn("_t", total).select(*names, "_n", F.transform("_e", lambda e: e / F.col("_t")).alias("_p"))


def classifier(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Fit on ``labelled(doc_id, domain)``; other domains and null labels are not used.

    Of an id labelled more than once the domain that comes last counts. A quarter of the
    labelled documents, by a checksum of the id, only chooses the temperature.
    """
    place = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")) - 1
    known = labelled.select("doc_id", place.cast("int").alias("k")).where("k >= 0").groupBy("doc_id").agg(F.max("k").alias("k"))
    texts = docs.select(F.col(id_col).alias("doc_id"), _buckets(_words(F.col(text_col))).alias("_buckets"))
    # Labels grow with the corpus: they are never broadcast.
    rows = saved(texts.join(known.hint("merge"), "doc_id"), "labelled")
    apart = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    fit, rest = rows.where(~apart), rows.where(apart)
    size = np.zeros(len(domains))
    for r in fit.groupBy("k").agg(F.count("*").alias("n")).collect():
        size[r["k"]] = r["n"]
    counts = np.full((len(domains), BUCKETS), SMOOTHING)
    pairs = fit.select("k", F.explode("_buckets").alias("b")).groupBy("k", "b").agg(F.count("*").alias("n"))
    for r in pairs.collect():  # at most BUCKETS rows a domain
        counts[r["k"], r["b"]] += r["n"]
    weights = np.log(counts / counts.sum(1, keepdims=True))
    own = Classifier(domains, (size + 1) / (size + 1).sum(), weights)
    scored = own.sums(rest)
    losses = []
    for temperature in TEMPERATURES:
        z = own.logits(temperature)
        top = F.greatest(*z) if len(z) > 1 else z[0]
        log_sum = F.log(sum((F.exp(x - top) for x in z), F.lit(0.0))) + top
        losses.append(F.avg(log_sum - F.get(F.array(*z), F.col("k"))))
    found = scored.agg(*[x.alias(f"l{i}") for i, x in enumerate(losses)]).first()
    known_losses = [x if x is not None and math.isfinite(x) else math.inf for x in found]
    own.temperature = TEMPERATURES[int(np.argmin(known_losses))] if min(known_losses) < math.inf else 0.0
    remove(rows)
    return own


def _product(pull: np.ndarray, away: np.ndarray) -> Column:
    """Product of a row's posteriors, less ``away``, with ``pull``."""
    terms = [F.get("_p", F.lit(i)) * float(y) for i, y in enumerate(pull)]
    return sum(terms, F.lit(-float(away @ pull)))


def _stepped(rate: Column, gradient: Column, move: Column, floor: Column) -> Column:
    """The rate behind a step: ``move`` lower, unless it is at the floor and the gradient points below it."""
    return F.when((rate > floor) | (gradient < 0), F.greatest(floor, rate - move)).otherwise(rate)


@dataclass
class Mix:
    """A classifier and the steps; rates of any document follow from these.

    ``reached`` has the domain shares at the rates, ``met`` whether they are those of the target.
    """

    classifier: Classifier
    floor: float
    target: np.ndarray
    #: (gradient, move) of each step, as constant and factors of the posteriors.
    steps: list[tuple[np.ndarray, np.ndarray]]
    reached: np.ndarray | None = None
    met: bool = False

    def rate(self) -> Column:
        """Rate of a row from its posteriors ``_p``: all steps one after the other."""
        start = F.lit(max(1.0, float(self.floor)))
        if not self.steps:
            return start
        floor, size = F.lit(float(self.floor)), len(self.target)
        listed = F.array(*[_literal([*gradient, *move]) for gradient, move in self.steps])

        def product(step: Column, at: int) -> Column:
            pulls = [F.get("_p", F.lit(i)) * F.get(step, F.lit(at + 1 + i)) for i in range(size)]
            return sum(pulls, F.get(step, F.lit(at)))

        return F.aggregate(listed, start, lambda rate, step: _stepped(rate, product(step, 0), product(step, size + 1), floor))

    def rates(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` with ``_n``, ``_p`` and ``_rate``, row by row without a join."""
        return self.classifier.posteriors(docs, text_col).withColumn("_rate", self.rate())


def _descended(
    state: DataFrame, total: float, away: np.ndarray, target: np.ndarray, floor: float, near: float
) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Steps for features ``_p - away``, of which the weighted sum is to be ``target``, and what it is off behind them."""
    k, low = len(target), F.lit(float(floor))
    f = [F.get("_p", F.lit(i)) - F.lit(float(away[i])) for i in range(k)]
    cells = [(i, j) for i in range(k) for j in range(i, k)]

    def square(row) -> np.ndarray:
        return np.array([[row[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)]) / total

    def vector(row, name: str) -> np.ndarray:
        return np.array([row[f"{name}{i}"] for i in range(k)]) / total

    sums = [F.sum(F.col("_n") * c).alias(f"s{i}") for i, c in enumerate(f)]
    row = state.agg(*sums, *[F.sum(F.col("_n") * f[i] * f[j]).alias(f"g{i}_{j}") for i, j in cells]).first()
    values, vectors = np.linalg.eigh(square(row))
    # In these coordinates G is one; directions in which no document differs are left out.
    some = values > 1e-9 * max(values.max(), 1e-30)
    white = vectors[:, some] / np.sqrt(values[some])
    start = max(1.0, float(floor))
    miss = start * vector(row, "s") - target
    written, live, steps, slow = None, state.withColumn("_r", F.lit(start)), [], 0
    while np.abs(miss).max() > near and slow < IN_A_ROW:
        pull = white @ (white.T @ miss)
        live = live.withColumn("_g", _product(pull, away))
        free = (F.col("_r") > low) | (F.col("_g") < 0)
        gone = F.greatest(low, F.col("_r") - F.col("_g")) - F.col("_r")
        curve = [F.sum(F.when(free, F.col("_n") * f[i] * f[j])).alias(f"g{i}_{j}") for i, j in cells]
        row = live.agg(F.sum(F.col("_n") * gone * gone).alias("gone"), *curve).first()
        if math.sqrt(row["gone"] / total) <= GONE * near:
            break
        bent = white.T @ square(row) @ white
        moves = [white @ np.linalg.solve(bent + d * np.eye(len(bent)), white.T @ miss) for d in DAMPING]
        tried = live.select("_n", "_p", *[
            _stepped(F.col("_r"), F.col("_g"), _product(m, away), low).alias(f"_r{x}") for x, m in enumerate(moves)
        ])
        row = tried.agg(*[F.sum(F.col("_n") * F.col(f"_r{x}") * c).alias(f"t{x}_{i}") for x in range(len(moves)) for i, c in enumerate(f)]).first()
        reached = [vector(row, f"t{x}_") - target for x in range(len(moves))]
        far = [float(np.linalg.norm(white.T @ m)) for m in reached]
        best, before = int(np.argmin(far)), float(np.linalg.norm(white.T @ miss))
        if far[best] >= before:
            break  # no lower value in double precision
        slow = slow + 1 if far[best] > (1 - NO_NEARER) * before else 0
        miss = reached[best]
        steps.append(tuple(np.r_[-float(away @ y), y] for y in (pull, moves[best])))
        live = live.withColumn("_r", _stepped(F.col("_r"), F.col("_g"), _product(moves[best], away), low)).drop("_g")
        if len(steps) % WRITE_EVERY == 0:
            behind, written = written, saved(live, "rates-so-far")
            live = written
            if behind is not None:
                remove(behind)
    if written is not None:
        remove(written)
    return steps, miss


def fitted_mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    floor: float = 0.0,
    budget: float | None = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[Mix, DataFrame]:
    """The mix for the target weights, and its documents (id, _n, _p, _rate) as a written table.

    ``budget`` is the number of tokens wanted in relation to those there are. None takes the
    least for which no domain has to shrink; with a floor of 1 or more, where documents of mixed
    domains need more, it takes the one at which the targets are met with the least change.
    Where the targets are out of reach the rates come as near to them as they can, ``met`` is
    false and a warning tells so. Without tokens all rates are 1 (or the floor, if larger).
    """
    domains = list(targets)
    weights = np.array([targets[d] for d in domains], float)
    if (weights < 0).any() or weights.sum() <= 0:
        raise ValueError("target weights must be nonnegative and not all zero")
    own = classifier(docs, labelled, domains, id_col, text_col)
    start = own.posteriors(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), "_text")
    state = saved(start.drop("_text"), "rates")
    shares = [F.sum(F.col("_n") * F.get("_p", F.lit(i))).alias(f"t{i}") for i in range(len(domains))]
    first = state.agg(F.sum("_n").alias("n"), *shares).first()
    mix, total = Mix(own, floor, weights / weights.sum(), []), first["n"]
    if not total:
        return mix, state.withColumn("_rate", mix.rate())
    share, nothing, now = mix.target, np.zeros(len(domains)), np.array([first[f"t{i}"] for i in range(len(domains))]) / total
    if budget is None and floor >= 1:
        # Rates times (posteriors - target shares) add to nothing at any budget that meets them.
        mix.steps, off = _descended(state, total, share, nothing, floor, TOLERANCE * floor)
        tokens = state.agg(F.sum(F.col("_n") * mix.rate())).first()[0] / total
        mix.target, mix.reached = share * tokens, share * tokens + off
        mix.met = bool(np.abs(off).max() <= TOLERANCE * tokens)
    if not mix.met:
        if budget is None:
            budget = float((now[share > 0] / share[share > 0]).max()) * max(1.0, floor)
        mix.steps, off = _descended(state, total, nothing, share * budget, floor, TOLERANCE * budget)
        mix.target, mix.reached = share * budget, share * budget + off
        mix.met = bool(np.abs(off).max() <= TOLERANCE * budget)
    if not mix.met:
        off = np.abs(mix.reached - mix.target).max() / mix.target.sum()
        warnings.warn(f"target shares are out of reach: the rates come within {off:.4f}", stacklevel=2)
    return mix, state.withColumn("_rate", mix.rate())


def document_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], **options) -> DataFrame:
    """Rate and domain posteriors of every document.

    Returns one row per input row: (doc_id, n_tokens, p_<domain>..., rate). A null text is empty:
    it has the prior posteriors and no tokens. Rows that repeat an id each count. Null ids and
    null labels train nothing. An empty table gives an empty table; columns besides the two named are
    not read. Options are those of ``fitted_mix``.
    """
    mix, state = fitted_mix(docs, labelled, targets, **options)
    shares = [F.get("_p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(mix.classifier.domains)]
    return state.select("doc_id", F.col("_n").alias("n_tokens"), *shares, F.col("_rate").alias("rate"))


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with each row as often as its rate says; the columns stay.

    The whole part of a rate is a number of copies; a hash of id and text decides with the
    probability of the rest on one more, so a rerun gives the same rows. Null and empty texts have the rate of
    the prior posteriors; rows that repeat id and text are copied alike. An empty table gives an empty table.
    """
    mix, _ = fitted_mix(docs, labelled, targets, id_col=id_col, text_col=text_col, **options)
    own = mix.rates(carried(docs).withColumn("text", field(text_col)))
    share = F.pmod(F.xxhash64(field(id_col), F.col("text"), F.lit("mix")), F.lit(1 << 30)) / (1 << 30)
    copies = (F.floor("_rate") + (share < F.col("_rate") - F.floor("_rate")).cast("int")).cast("int")
    return unpacked(own.withColumn("copy", F.explode(F.array_repeat(F.lit(0), copies))))
