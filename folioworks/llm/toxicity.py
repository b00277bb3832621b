"""Toxicity by cumulative-link ordinal regression over sparse text features.

With grades 0 .. K the model is P(grade >= k) = sigmoid(w . x - t_k): one weight
vector for all thresholds t_1 < ... < t_K. The expected severity is the sum of
those probabilities. Features are the distinct words of a text and the first
four to seven letters of longer words, hashed, and the logarithm of their number.
Words take part if the likelihood ratio of their counts in toxic and other
training texts exceeds what chance gives among so many words, and toxic texts
hold them more often. Near copies among the training texts count once: rows that
share two minimal hashes and whose words and beginnings have a Jaccard
similarity of ``ALIKE`` or more.

Labels with grades above 1 are the grades. Labels that only say toxic or not are
graded by texts the grader has not seen: the toxic training texts are dealt into
folds, a model of toxic or not is fitted to the other folds, and the log odds it
gives a text are cut at their quantiles into grades 1 to ``GRADES``. So a grade
says how plainly toxic a text is to a model of other texts; it is not a count of
the features it is then learned from.

The fit reads at most ``sample`` labelled ids, the ones that hash lowest, and of
rows that share such an id ``2 * sample`` in all. Every text is scored whole and
by itself, so ties and repeated rows get equal results; very long texts are one
task's work each. Null and empty texts have no words, and without labels of both
kinds every text has severity 0. Null ids are kept. An empty table gives an empty
result; other columns are ignored, whatever they are called.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, per_row

SAMPLE = 10_000
GRADES = 3
STEPS = 600
FOLDS = 3
FOLD_STEPS = 200
DECAY = 1e-3
FEW = 3
ALIKE = 0.8
BEGINNINGS = (4, 5, 6, 7)
WORD = re.compile(r"[^\W\d_]+")


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the distinct words of a text and of their beginnings, sorted."""
    words = set(WORD.findall((text or "").lower()))
    begun = {w[:k] + "-" for w in words if len(w) > BEGINNINGS[0] for k in BEGINNINGS if len(w) > k}
    return np.unique(np.fromiter(map(zlib.crc32, map(str.encode, words | begun)), np.uint32))


def _alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets of hashes are near copies."""
    if min(len(x), len(y)) < ALIKE * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= ALIKE * (len(x) + len(y) - both)


def _distinct_texts(rows: list[np.ndarray], grades: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The rows without near copies of rows before them."""
    seen: dict[tuple, list[int]] = {}
    kept = []
    for i, row in enumerate(rows):
        if len(row):
            mixed = (row * np.uint32(2654435761)) ^ (row >> np.uint32(15))
            key = (int(row[0]), int(mixed.min()), int(grades[i]))
            near = seen.setdefault(key, [])
            if any(_alike(row, rows[j]) for j in near):
                continue
            near.append(i)
        kept.append(i)
    return [rows[i] for i in kept], grades[kept]


def discriminating(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Hashes of the words that toxic texts hold more often than chance gives."""
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    if not n1 or not n0:
        return np.zeros(0, np.uint32)
    found = np.concatenate([r for r, t in zip(rows, toxic, strict=True) if t])
    words, a = np.unique(found, return_counts=True)
    words, a = words[a >= FEW], a[a >= FEW].astype(float)
    # Words of toxic texts alone can discriminate; the others are only counted, for what chance gives.
    everything = np.concatenate(rows)
    at = np.searchsorted(words, everything)
    held = at < len(words)
    held[held] = words[at[held]] == everything[held]
    b = np.bincount(at[held], minlength=len(words)) - a
    share = (a + b) / (n1 + n0)
    term = lambda got, due: np.where(got > 0, got * np.log(np.maximum(got, 1e-9) / np.maximum(due, 1e-9)), 0)
    ratio = 2 * (term(a, share * n1) + term(b, share * n0) + term(n1 - a, (1 - share) * n1) + term(n0 - b, (1 - share) * n0))
    kinds = max(2, len(np.unique(everything)))
    return words[(ratio > 2 * np.log(kinds)) & (a / n1 > b / n0)]


class Ordinal:
    """The fitted model: hashed words, their weights (and that of the length) and the thresholds."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.words, self.weights, self.thresholds = words, weights[: len(words)], thresholds
        self.length = weights[len(words)] if len(weights) > len(words) else 0.0

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        """w . x of each set of hashes: a batch's sparse rows times the weights."""
        lengths = np.array([len(r) for r in rows], np.int64)
        found = np.concatenate([*rows, np.zeros(0, np.uint32)])
        at = np.minimum(np.searchsorted(self.words, found), max(0, len(self.words) - 1))
        value = np.where(self.words[at] == found, self.weights[at], 0.0) if len(self.words) else np.zeros(len(found))
        return np.bincount(np.repeat(np.arange(len(rows)), lengths), value, minlength=len(rows)) + self.length * np.log1p(lengths)

    def at_least(self, texts: list[str | None]) -> np.ndarray:
        """P(grade >= k) of each text, for k = 1 .. K."""
        if not len(self.words):
            return np.zeros((len(texts), len(self.thresholds)))
        z = self.margins([word_hashes(t) for t in texts])[:, None] - self.thresholds[None, :]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list[np.ndarray], grades: np.ndarray, words: np.ndarray, top: int = GRADES, steps: int = STEPS) -> Ordinal:
    """Weights and thresholds by gradient descent on the ordinal likelihood (Adam).

    Thresholds are a first one and positive gaps, so they stay in order.
    """
    cols = [np.append(np.searchsorted(words, r[np.isin(r, words)]), len(words)) for r in rows]
    col, row = np.concatenate(cols), np.repeat(np.arange(len(rows)), [len(c) for c in cols])
    value = np.ones(len(col))
    value[col == len(words)] = [np.log1p(len(r)) for r in rows]
    n, width = len(rows), len(words) + 1
    theta = np.concatenate([np.zeros(width), [1.0], np.zeros(top - 1)])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    reached = grades[:, None] >= np.arange(1, top + 1)[None, :]
    for t in range(1, steps + 1):
        gaps = np.exp(theta[width + 1 :])
        cuts = theta[width] + np.concatenate([[0], np.cumsum(gaps)])
        z = np.bincount(row, theta[:width][col] * value, minlength=n)[:, None] - cuts[None, :]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - reached) / n
        down = -error.sum(axis=0)
        gradient = np.concatenate([np.bincount(col, error.sum(axis=1)[row] * value, minlength=width) + DECAY / n * theta[:width], [down.sum()], gaps * np.cumsum(down[:0:-1])[::-1]])
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta -= 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-9)
    return Ordinal(words, theta[:width], theta[width] + np.concatenate([[0], np.cumsum(np.exp(theta[width + 1 :]))]))


def likelihood(model: Ordinal, rows: list[np.ndarray], grades: np.ndarray) -> float:
    """Log likelihood of grades: of all thresholds, that those reached are and those above are not."""
    z = model.margins(rows)[:, None] - model.thresholds[None, :]
    reached = grades[:, None] >= np.arange(1, len(model.thresholds) + 1)[None, :]
    return -float(np.logaddexp(0, np.where(reached, -z, z)).sum())


def held_out_odds(rows: list[np.ndarray], toxic: np.ndarray, folds: int = FOLDS) -> np.ndarray:
    """For each toxic row the log odds that a model of the other folds gives it; 0 for others."""
    odds = np.zeros(len(rows))
    fold = np.arange(len(rows)) % folds
    for k in range(folds):
        seen = np.flatnonzero(fold != k)
        hidden = np.flatnonzero((fold == k) & toxic)
        some = [rows[i] for i in seen]
        words = discriminating(some, toxic[seen]) if len(some) else np.zeros(0, np.uint32)
        if len(words) and len(hidden):
            model = fit(some, toxic[seen].astype(int), words, top=1, steps=FOLD_STEPS)
            odds[hidden] = model.margins([rows[i] for i in hidden]) - model.thresholds[0]
    return odds


def grade(toxic: np.ndarray, odds: np.ndarray, top: int = GRADES) -> np.ndarray:
    """Grades 0 .. ``top``: toxic texts by their odds, cut at the quantiles."""
    cuts = np.quantile(odds[toxic], np.arange(1, top) / top) if toxic.any() else []
    return np.where(toxic, 1 + np.searchsorted(cuts, odds, "left"), 0)


def learn(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Ordinal:
    """The model of a bounded sample of the labelled rows."""
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("grade")).dropna()
    # At most ``sample`` ids.
    chosen = F.broadcast(marked.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample))
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(chosen, "doc_id").select("doc_id", "grade", "text")
    schema = pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("words", pa.binary())])
    hashed = map_rows(rows, per_row(schema, lambda i, g, text: (i, g, word_hashes(text).tobytes()), "doc_id", "grade", "text"), "doc_id long, grade int, words binary")
    found = hashed.orderBy(F.xxhash64("doc_id"), "doc_id", "grade", "words").limit(2 * sample).select("grade", "words").toArrow()
    grades = found.column("grade").to_numpy().astype(int)
    if not len(grades):
        return Ordinal(np.zeros(0, np.uint32), np.zeros(0), np.arange(GRADES, dtype=float))
    words = [np.frombuffer(x, np.uint32) for x in found.column("words").to_pylist()]
    rows, grades = _distinct_texts(words, np.maximum(grades, 0))
    toxic = grades > 0
    words = discriminating(rows, toxic)
    top = max(GRADES, int(grades.max()))
    if not len(words):
        return Ordinal(words, np.zeros(0), np.arange(top, dtype=float))
    if grades.max() <= 1:
        grades = grade(toxic, held_out_odds(rows, toxic))
    return fit(rows, grades, words, top)


def score_toxicity(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, limit: float = 0.5) -> DataFrame:
    """``doc_id, expected_severity, p_toxic, grade, is_toxic`` of every document.

    ``grade`` is the highest grade that is likelier reached than not, and
    ``is_toxic`` tells whether P(grade >= 1) reaches ``limit``.
    """
    model = documents.sparkSession.sparkContext.broadcast(learn(documents, labels, id_col, text_col, label_col, sample))
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reached = model.value.at_least(batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), pa.array(reached.sum(axis=1)), pa.array(reached[:, 0]), pa.array((reached >= 0.5).sum(axis=1), pa.int32()), pa.array(reached[:, 0] >= limit)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "expected_severity", "p_toxic", "grade", "is_toxic"])

    return map_rows(rows, run, "doc_id long, expected_severity double, p_toxic double, grade int, is_toxic boolean")
