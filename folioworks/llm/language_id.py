"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are folded to lower-case letters, everything else to a blank, and cut
into n-grams of one to three characters that are hashed into a fixed number of
buckets. Counts by language come from all training rows. The matrix of log
probabilities (languages x buckets) is broadcast, and a batch of texts is scored
at once in numpy: the batch is a sparse matrix of texts by buckets, each text the
list of its n-grams' buckets, and is multiplied with the matrix.

Every language is learned. ``block`` languages at most are in one matrix, which
bounds what is broadcast and collected; further languages are scored in further
passes over the texts, which carry on the likeliest language so far and the sum
of the probabilities.

A text that is null or holds no letter is ``und`` with score 0. If there is
nothing to learn from, every text is ``und``. Texts do not depend on each other,
so ties and repeated rows, also of one id, give equal results; equal languages by
score go to the first in code point order. Very long texts are read in parts.
Null ids are kept. An empty table gives an empty result; other columns are
ignored, whatever they are called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import delete, map_rows, stored, stored_at

ORDERS = (1, 2, 3)
BUCKETS = 1 << 14
SMOOTHING = 0.5
BLOCK = 256
PART = 1 << 18
#: Log probabilities that are gathered at once.
CELLS = 1 << 22
UNKNOWN = "und"

_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """For each code point of the basic plane its lower-case letter, a blank for all else."""
    if not _FOLD:
        table = np.full(1 << 16, 32, np.uint32)
        for p in range(1 << 16):
            if chr(p).isalpha():
                low = chr(p).lower()
                table[p] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else p
        _FOLD.append(table)
    return _FOLD[0]


def _folded(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if len(points) and points.max() >= 1 << 16:
        return np.where(points < 1 << 16, _fold()[np.minimum(points, 0xFFFF)], points)
    return _fold()[points]


def _parts(texts: list[str]) -> Iterator[list[tuple[int, str, int]]]:
    """Number, part and length of the part's overlap with the one before, of texts, PART characters or so at a time."""
    overlap = max(ORDERS) - 1
    held, size = [], 0
    for number, text in enumerate(texts):
        for at in range(0, len(text), PART):
            part = text[max(0, at - overlap) : at + PART]
            held.append((number, part, min(at, overlap)))
            size += len(part)
            if size >= PART:
                yield held
                held, size = [], 0
    if held:
        yield held


def gram_buckets(texts: list[str], buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text number and bucket of all n-grams that hold a letter, sorted by number, some texts and one length at a time."""
    for parts in _parts(texts):
        points = _folded("".join(p for _, p, _ in parts)).astype(np.uint64)
        lengths = np.array([len(p) for _, p, _ in parts])
        ends = np.cumsum(lengths)
        end = np.repeat(ends, lengths)
        begin = np.repeat(ends - lengths + [o for _, _, o in parts], lengths)
        owner = np.repeat([n for n, _, _ in parts], lengths)
        at = np.arange(len(points))
        for order in ORDERS:
            n = len(points) - order + 1
            if n <= 0:
                continue
            code = np.full(n, order, np.uint64)
            letters = np.zeros(n, bool)
            for k in range(order):
                part = points[k : k + n]
                code = code * np.uint64(0x100000001B3) + part
                letters |= part != 32
            # Inside one part, and not wholly within what it shares with the one before.
            letters &= (at[:n] + order <= end[:n]) & (at[:n] + order > begin[:n])
            if letters.any():
                yield owner[:n][letters], ((code[letters] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % buckets


def _counted(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}

    def emit():
        for lang, row in counts.items():
            used = np.flatnonzero(row)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(used), pa.string()), "bucket": pa.array(used, pa.int32()), "n": pa.array(row[used], pa.int64())})
        counts.clear()

    for batch in batches:
        of: dict[str, list[str]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            of.setdefault(lang, []).append(text)
        for lang, texts in of.items():
            if lang not in counts and len(counts) >= 64:
                yield from emit()
            row = counts.setdefault(lang, np.zeros(buckets + 1, np.int64))
            row[buckets] += len(texts)
            for _, ids in gram_buckets(texts, buckets):
                row[:buckets] += np.bincount(ids, minlength=buckets)
    yield from emit()


class Model:
    """Languages in code point order, their log priors and log probabilities of buckets, one row a bucket."""

    def __init__(self, langs: list[str], counts: np.ndarray, texts: np.ndarray, all_texts: int):
        self.langs = langs
        grams = counts + SMOOTHING
        self.priors = np.log(texts / all_texts)
        self.matrix = np.ascontiguousarray(np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32).T)

    def totals(self, texts: list[str]) -> np.ndarray:
        """Log joint probabilities of a batch, texts by languages."""
        out = np.repeat(self.priors[None, :], len(texts), axis=0)
        step = max(1, CELLS // max(1, len(self.langs)))
        for number, ids in gram_buckets(texts, len(self.matrix)):
            for at in range(0, len(ids), step):
                rows = number[at : at + step]
                starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
                out[rows[starts]] += np.add.reduceat(self.matrix[ids[at : at + step]].astype(np.float64), starts, axis=0)
        return out


def learn(training: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS, block: int = BLOCK) -> Iterator[Model]:
    """Models of all languages of the rows with text and language, ``block`` of them at a time.

    Counts stay in Spark, one packed row a language; one block of them at a
    time goes to the driver. Bucket ``buckets`` counts the texts.
    """
    rows = training.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()
    counted = map_rows(rows, lambda batches: _counted(batches, buckets), "lang string, bucket int, n long")
    counted = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("row"))
    path, learned = stored_at(counted)
    texts = F.aggregate(F.filter("row", lambda x: x.bucket == buckets), F.lit(0).cast("long"), lambda a, x: a + x.n)
    number, all_texts = learned.agg(F.count("*"), F.sum(texts)).first()
    try:
        # Languages are dealt to blocks by a hash, half a block to each, so that none is much over.
        blocks = 1 if number <= block else math.ceil(2 * number / block)
        for at in range(blocks):
            table = learned.where(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == at).toArrow().sort_by("lang").combine_chunks()
            if not table.num_rows:
                continue
            lists = table.column("row").chunk(0)
            cells = lists.flatten()
            counts = np.zeros((len(lists), buckets + 1))
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            counts[owner, cells.field("bucket").to_numpy()] = cells.field("n").to_numpy()
            yield Model(table.column("lang").to_pylist(), counts[:, :buckets], counts[:, buckets], all_texts)
    finally:
        delete(training.sparkSession, path)


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict(texts: list[str | None], model: Model, so_far: list[tuple[str | None, float, float]] | None = None) -> list[tuple[str | None, float, float]]:
    """Likeliest language of each text, its log probability and that of all languages together.

    ``so_far`` is the result of the models of earlier languages. No language
    is likeliest for a text without letters.
    """
    known = [bool(t) and _has_letter(t) for t in texts]
    totals = model.totals([t if k else "" for t, k in zip(texts, known, strict=True)])
    best = totals.argmax(axis=1)
    top = totals[np.arange(len(texts)), best]
    whole = np.logaddexp.reduce(totals, axis=1)
    found = [(model.langs[b], float(t), float(w)) if k else (None, 0.0, 0.0) for k, b, t, w in zip(known, best, top, whole, strict=True)]
    if so_far:
        found = [(*min(b[:2], n[:2], key=lambda x: (-x[1], x[0])), float(np.logaddexp(b[2], n[2]))) if b[0] is not None else n for b, n in zip(so_far, found, strict=True)]
    return found


STATE = ("lang_pred", "top", "whole")


def identify(documents: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (posterior probability) of each document, learned from the rows where ``training`` holds."""
    context = documents.sparkSession.sparkContext
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang_pred", pa.string()), ("top", pa.float64()), ("whole", pa.float64())])

    def scored_by(held, last: bool):
        fields = [f for f in schema if f.name != "text" or not last]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                so_far = list(zip(*(batch.column(c).to_pylist() for c in STATE), strict=True)) if STATE[0] in batch.schema.names else None
                found = predict(batch.column("text").to_pylist(), held.value, so_far)
                columns = [batch.column(f.name) if f.name not in STATE else pa.array([x[STATE.index(f.name)] for x in found], f.type) for f in fields]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

        return run

    models = learn(documents.where(training), text_col, lang_col, block=block)
    model, n = next(models, None), 0
    while model is not None:
        following = next(models, None)
        text = "" if following is None else "text string, "
        # Each pass but the first reads what the one before has written.
        rows = map_rows(stored(rows) if n else rows, scored_by(context.broadcast(model), following is None), f"doc_id long, {text}lang_pred string, top double, whole double")
        model, n = following, n + 1
    if not n:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    score = F.when(F.col("lang_pred").isNull(), 0.0).otherwise(F.least(F.exp(F.col("top") - F.col("whole")), F.lit(1.0)))
    return rows.select("doc_id", F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"))
