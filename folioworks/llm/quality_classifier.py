"""Quality classification from positive and unlabelled text.

A logistic model over text measures (shares of character classes, of repeated
and symbol words, lengths) and shares of character-shape trigrams is fitted by
the non-negative unbiased risk of positive-unlabelled learning:

    pi * R+(positives) + max(0, R-(unlabelled) - pi * R-(positives)),

where pi is the class prior. Whenever the second part falls below zero its
gradient is followed backwards. Trusted positives are training rows labelled 1:
at most ``sample`` ids, those that hash lowest. Unlabelled text is all training
text, whatever its label. Rows labelled 0 are used nowhere.

1. A plain model of the positives against ``sample`` unlabelled rows ranks texts.
2. Every unlabelled text is measured and ranked. By ``BINS`` ranges of the ranking
   Spark sums the measures and counts the texts, in whole numbers, so that no
   order of rows or files changes a digit.
3. The prior is the least ratio of the unlabelled share to the positive share
   above any threshold over the upper part of the ranking, where both are well
   measured; the unlabelled shares are of all texts.
4. The risk is minimised over the positives and all unlabelled texts, each range
   standing with its number for its texts' mean. Within a range texts rank
   alike, so their losses are close to that of the mean.

Every text is measured once; the measures are written to the shared folder, and
the samples, the sums and the scores, a batch at a time, are made of them. Empty
and null texts are scored by their
measures like any other. With no positives or no text to learn from every score
is the prior 0.5. Texts are scored by themselves, so ties and repeated rows, also
of one id, give equal scores; of the rows that share a chosen id ``2 * sample``
at most are learned from. Texts of any length are measured whole. Null ids are
kept. An empty table gives an empty result; other columns are ignored, whatever
they are called.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, scratch, stored
from .quality_rules import CLASSES, base_counts, shape_codes

SAMPLE = 4000
STEPS = 200
RATE = 0.05
DECAY = 1e-4
SHAPES = CLASSES**3
MEASURES = 14
#: Ranges of the ranking, and how finely their sums are counted.
BINS = 128
UNIT = 1 << 12
#: Words that a share of words starts from, so that those of short texts are near the usual.
USUAL = 10
WIDTH = MEASURES + SHAPES
PART = 1 << 20


def measures(text: str | None) -> np.ndarray:
    """The feature vector of a text."""
    text = text or ""
    out = np.zeros(WIDTH, np.float32)
    counts, shapes = np.zeros(CLASSES), np.zeros(SHAPES)
    for at in range(0, len(text), PART):
        codes = shape_codes(text[max(0, at - 2) : at + PART])
        counts += np.bincount(codes[min(at, 2) :], minlength=CLASSES)
        grams = (codes[:-2].astype(np.int32) * CLASSES + codes[1:-1]) * CLASSES + codes[2:]
        shapes += np.bincount(grams, minlength=SHAPES)
    n_words, word_chars, n_symbols, dup_lines, repeated = base_counts(text)
    words = text.split()
    some = max(1, len(words))
    lines = max(1, text.count("\n") + 1)
    frequent = Counter(words).most_common(1)[0][1] if words else 0
    upper = sum(w.isupper() and len(w) > 1 for w in words)
    wordless = sum(not any(c.isalnum() for c in w) for w in words)
    out[:MEASURES] = (
        np.log1p(n_words) / 10,
        word_chars / max(1, n_words) / 10,
        n_symbols / max(1, word_chars),
        dup_lines / lines,
        repeated / max(1, n_words),
        max(0, frequent - 1) / (len(words) + USUAL),
        (len(set(words)) + 0.8 * USUAL) / (len(words) + USUAL),
        upper / some,
        wordless / some,
        np.log1p(lines) / 10,
        counts[4] / max(1, len(text)),
        counts[5] / max(1, len(text)),
        counts[1] / max(1, len(text)),
        float(not words),
    )
    out[MEASURES:] = np.sqrt(shapes / max(1.0, shapes.sum()))
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Adam:
    """Steps of Adam for one vector."""

    def __init__(self, size: int, rate: float):
        self.first, self.second, self.rate, self.n = np.zeros(size, np.float32), np.zeros(size, np.float32), np.float32(rate), 0

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.n += 1
        self.first = 0.9 * self.first + 0.1 * gradient
        self.second = 0.999 * self.second + 0.001 * gradient**2
        return self.rate * (self.first / (1 - 0.9**self.n)) / (np.sqrt(self.second / (1 - 0.999**self.n)) + 1e-8)


def _mean(rows: np.ndarray, values: np.ndarray, weights: np.ndarray | None) -> np.ndarray:
    return rows.T @ values / len(rows) if weights is None else rows.T @ (values * weights) / weights.sum()


def risk(w: np.ndarray, positives: np.ndarray, unlabelled: np.ndarray, prior: float, weights: np.ndarray | None = None) -> float:
    """The non-negative risk with logistic loss, and the decay of the weights."""
    zp, zu = positives @ w, unlabelled @ w
    as_negative = np.average(np.logaddexp(0, zu), weights=weights) - prior * np.logaddexp(0, zp).mean()
    return float(prior * np.logaddexp(0, -zp).mean() + max(0.0, as_negative) + DECAY / 2 * (w[:-1] ** 2).sum())


def fit_risk(positives: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, weights: np.ndarray | None = None) -> np.ndarray:
    """Weights (the last is the intercept) that minimise the non-negative risk with logistic loss.

    ``weights`` say how many texts each unlabelled row stands for.
    """
    w, adam = np.zeros(positives.shape[1], np.float32), _Adam(positives.shape[1], RATE)
    shares = None if weights is None else (weights / weights.mean()).astype(np.float32)
    for _ in range(steps):
        zp, zu = positives @ w, unlabelled @ w
        # Gradients of the mean losses log(1 + exp(-z)) and log(1 + exp(z)).
        as_positive = _mean(positives, _sigmoid(zp) - 1, None)
        wrong = prior * _mean(positives, _sigmoid(zp), None)
        negative = _mean(unlabelled, _sigmoid(zu), shares) - wrong
        rest = np.average(np.logaddexp(0, zu), weights=shares) - prior * np.logaddexp(0, zp).mean()
        gradient = prior * as_positive + negative if rest >= 0 else -negative
        gradient[:-1] += DECAY * w[:-1]
        w -= adam.step(gradient)
    return w


def fit_ranking(positives: np.ndarray, unlabelled: np.ndarray, steps: int = STEPS // 2) -> np.ndarray:
    """Weights of a plain model of positives against unlabelled rows."""
    w, adam = np.zeros(positives.shape[1], np.float32), _Adam(positives.shape[1], RATE)
    for _ in range(steps):
        gradient = _mean(positives, _sigmoid(positives @ w) - 1, None) + _mean(unlabelled, _sigmoid(unlabelled @ w), None)
        gradient[:-1] += DECAY * w[:-1]
        w -= adam.step(gradient)
    return w


def thresholds(positives: np.ndarray, unlabelled: np.ndarray) -> np.ndarray:
    """Bounds of the ranges: quantiles of the upper part of the positive scores, and of all scores."""
    half = BINS // 2
    return np.unique(np.concatenate([np.quantile(positives, np.linspace(0.005, 0.5, half)), np.quantile(unlabelled, np.linspace(0, 1, BINS - half + 1)[1:-1])]))


def prior_above(positives: np.ndarray, bounds: np.ndarray, counts: np.ndarray) -> float:
    """The share of positives among texts, of which ``counts`` are in the ranges between ``bounds``."""
    over_p = 1 - np.searchsorted(np.sort(positives), bounds, "left") / len(positives)
    over_u = np.cumsum(counts[::-1])[::-1][1:] / max(1, counts.sum())
    return float(np.clip((over_u / over_p)[over_p >= 0.5 - 1e-9].min(initial=1.0), 0.05, 0.98))


def estimate_prior(positives: np.ndarray, unlabelled: np.ndarray, steps: int = STEPS // 2) -> float:
    """The share of positives in unlabelled rows that are all at hand."""
    w = fit_ranking(positives, unlabelled, steps)
    bounds = thresholds(positives @ w, unlabelled @ w)
    return prior_above(positives @ w, bounds, np.bincount(np.searchsorted(bounds, unlabelled @ w, "right"), minlength=len(bounds) + 1))


class Scale:
    """Standardised features, with a column of ones."""

    def __init__(self, rows: np.ndarray):
        self.mean, self.scale = rows.mean(axis=0), np.maximum(rows.std(axis=0), 0.02)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        scaled = np.clip((rows - self.mean) / self.scale, -8, 8)
        return np.concatenate([scaled, np.ones((len(rows), 1))], axis=1).astype(np.float32)


class Model:
    """The fitted weights over standardised features; without weights all scores are the prior."""

    def __init__(self, scale: Scale | None = None, weights: np.ndarray | None = None, prior: float = 0.5):
        self.scale, self.weights, self.prior = scale, weights, prior

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Scores of a batch of measures."""
        if self.weights is None:
            return np.full(len(rows), self.prior)
        return _sigmoid(self.scale(rows) @ self.weights).astype(float)


def measured(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``features``, the packed measures, of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("features", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = [measures(t).astype(np.float16).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(features, pa.binary())], schema=schema)

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, run, "doc_id long, features binary")


def _unpacked(features: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(features), np.float16).reshape(-1, WIDTH).astype(np.float32)


def _in_bins(held, bounds_and_ranking) -> Callable:
    """Of each range of the ranking the number of texts and the sums of their standardised features, as whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, ranking = bounds_and_ranking
        sums = np.zeros((len(bounds) + 1, WIDTH + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                rows = held.value(_unpacked(batch.column("features").to_pylist()))
                np.add.at(sums, np.searchsorted(bounds, rows @ ranking, "right"), np.rint(rows * UNIT).astype(np.int64))
        bins, features = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(bins, pa.int32()), pa.array(features, pa.int32()), pa.array(sums[bins, features])], ["bin", "feature", "n"])

    return run


def learn(documents: DataFrame, labels: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """The model of the rows where ``trains`` (over ``doc_id``) holds: a bounded sample of positives, all unlabelled text."""
    with scratch(documents.sparkSession):
        return fit(stored(measured(documents, id_col, text_col)), labels, trains, id_col, label_col, sample)


def fit(rows: DataFrame, labels: DataFrame, trains: Column, id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """The same of documents that are measured."""
    context = rows.sparkSession.sparkContext
    rows = rows.where(trains)
    trusted = labels.where(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("doc_id")).where(trains)

    def sampled(ids: DataFrame) -> np.ndarray:
        # At most ``sample`` ids, and at most twice as many rows whatever ids repeat.
        chosen = ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        found = rows.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(2 * sample)
        return _unpacked(found.select("features").toArrow().column("features").to_pylist())

    positives = sampled(trusted)
    if not len(positives):
        return Model()
    unlabelled = sampled(rows.select("doc_id"))
    scale = Scale(np.concatenate([positives, unlabelled]))
    positives, unlabelled = scale(positives), scale(unlabelled)
    ranking = fit_ranking(positives, unlabelled)
    bounds = thresholds(positives @ ranking, unlabelled @ ranking)

    parts = map_rows(rows.select("features"), _in_bins(context.broadcast(scale), (bounds, ranking)), "bin int, feature int, n long")
    found = parts.groupBy("bin", "feature").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros((len(bounds) + 1, WIDTH + 1))
    sums[found.column("bin").to_numpy(), found.column("feature").to_numpy()] = found.column("n").to_numpy()
    # The last feature of a text is 1.
    counts = sums[:, -1] / UNIT
    means = (sums / np.maximum(1, counts)[:, None] / UNIT).astype(np.float32)[counts > 0]
    prior = prior_above(positives @ ranking, bounds, counts)
    return Model(scale, fit_risk(positives, means, prior, weights=counts[counts > 0]), prior)


def score_quality(documents: DataFrame, labels: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """``doc_id`` and ``score``, the probability of label 1, of every document."""
    spark = documents.sparkSession
    with scratch(spark) as kept:
        rows = stored(measured(documents, id_col, text_col))
        model = spark.sparkContext.broadcast(fit(rows, labels, trains, id_col, label_col, sample))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                scores = model.value.score(_unpacked(batch.column("features").to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

        return kept(map_rows(rows, run, "doc_id long, score double"))
