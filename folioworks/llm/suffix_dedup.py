"""Exact repeats of long byte strings by bucket-pointer refinement.

A byte is repeated if some string of ``LENGTH`` bytes covers it that also
starts anywhere else, in the same text or another. The suffixes that start so
are put in buckets by their first q bytes, and buckets are refined by the
identifiers of the buckets that later offsets are in, over and over:

* Identifiers. The bucket of a suffix by its first 8 bytes is those bytes. The
  bucket by 2h bytes is the pair of the bucket by h bytes at its offset and the
  bucket by h bytes at the offset h further on, from 8 to 16, 32, 64 and 128
  bytes; the bucket by LENGTH bytes is the pair of those by 128 bytes at its
  offset and 72 bytes on. Every step uses again what the step before gave to
  later offsets, for all suffixes of a text at once.
* Initial buckets are those by Q = 64 bytes. Every window of LENGTH bytes
  belongs to one of its q-grams, its minimiser (the first of least hash). Equal
  windows have equal minimisers at equal offsets, so only the suffixes at
  minimisers, some one in sixty, are counted: a bucket of one is done, none of
  the windows that belong to it repeats.
* Refinement. The windows of a suffix in an open bucket are sorted by what lies
  at their offsets: first all of them together, then in runs of 16 and as
  single ones. A run's bucket is the bucket above it with the identifier of what
  all of its windows share; its own identifier is the pair of the buckets of its
  first and last window, which together cover it. Runs with equal identifiers in
  one bucket are settled, all their windows repeat; one of them stays as the
  bucket's pointer, so that others are compared to it. A run in a bucket of one
  is done. The rest is open, and refined by the next, shorter runs.

Identifiers are 64-bit mixes of pairs. Runs are settled only if bucket,
identifier and a digest of the run's bytes by another hash all agree, 192 bits
in all: no bytes of different texts are taken for equal short of a collision in
all three. Counts are combined before each shuffle, so a hot bucket costs each
task one row; hot groups, whose number is bounded, are settled by a broadcast
instead of the shuffle. Other broadcasts are bitmaps of fixed size, which only
spare rows: what lies behind them is exact.

Null texts are empty. Texts shorter than LENGTH have no repeats. Rows with the
same id and text share their spans, and each is a repeat of the other. Matches
never cross texts. Very long texts are read in parts that overlap. An empty
table gives an empty result; other columns are kept or ignored, whatever they
are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import among, bitmap, repeated
from .common import free_names, join_sized, map_rows, per_row, scratch, small_batches, stored

LENGTH = 200
Q = 64
WINDOWS = LENGTH - Q + 1
#: Lengths of the runs that open buckets are refined by, after all windows of a suffix together.
RUNS = (16, 1)
PART = 1 << 18
#: Bytes of texts that are worked on at once.
CHUNK = 1 << 17
_PLACE = np.uint64(0xFFFFFF)
_C = [np.uint64(c) for c in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Identifiers of pairs of identifiers."""
    code = left * _C[0]
    code ^= code >> np.uint64(32)
    code += right
    code *= _C[1]
    code ^= code >> np.uint64(29)
    code *= _C[2]
    return code ^ (code >> np.uint64(32))


def gram_buckets(data: np.ndarray) -> np.ndarray:
    """Buckets of all suffixes of a byte array by their first Q bytes, from those by half as many."""
    code = data.astype(np.uint64)
    for width in (1, 2, 4):
        code = (code[:-width] << np.uint64(8 * width)) | code[width:]
    width = 8
    while width < Q:
        code = pair(code[:-width], code[width:])
        width *= 2
    return code


def _wider(code: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Buckets by ``width`` bytes, 2 Q to 4 Q of them, of the suffixes ``at``, from the buckets by Q at later offsets."""
    low = pair(code[at], code[at + Q])
    later = at + (width - 2 * Q)
    return pair(low, pair(code[later], code[later + Q]))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width`` values, from block-wise minima of both directions."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _parts(texts: Iterator[tuple[int, bytes]]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Key, base and bytes of texts or overlapping parts of texts, some CHUNK bytes at a time."""
    held, size = [], 0
    for key, data in texts:
        for base in range(0, len(data) - LENGTH + 1, PART):
            part = data[base : base + PART + LENGTH - 1]
            held.append((key, base, part))
            size += len(part)
            if size > CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


class Suffixes:
    """The suffixes at the minimisers of some parts of texts, by arrays.

    ``owner`` is the number of the part; ``place``, ``first`` and ``last`` are
    the suffix and its first and last window in the bytes of all parts together;
    ``bucket`` is the suffix's bucket by Q bytes.
    """

    def __init__(self, parts: list[tuple[int, int, bytes]]):
        self.data = b"".join(p for _, _, p in parts)
        lengths = np.array([len(p) for _, _, p in parts])
        self.start = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        self.code = gram_buckets(np.frombuffer(self.data, np.uint8))
        n = len(self.data) - LENGTH + 1
        least = _sliding_min((self.code & ~_PLACE) | np.arange(len(self.code), dtype=np.uint64), WINDOWS) & _PLACE
        # Windows that cross from one part to the next belong to no text.
        whole = np.ones(n, bool)
        for end in self.start[1:].tolist():
            whole[max(0, end - LENGTH + 1) : end] = False
        begins = whole.copy()
        begins[1:] &= (least[1:] != least[:-1]) | ~whole[:-1]
        ends = whole.copy()
        ends[:-1] &= (least[1:] != least[:-1]) | ~whole[1:]
        self.first, self.last = np.flatnonzero(begins), np.flatnonzero(ends)
        self.place = least[self.first].astype(np.int64)
        self.bucket = self.code[self.place]
        self.owner = np.searchsorted(self.start, self.first, "right") - 1

    def identifiers(self, few: np.ndarray) -> np.ndarray:
        """What all windows of a suffix are told by: the buckets of the first and the last, and where the suffix lies."""
        ends = pair(_wider(self.code, self.first[few], LENGTH), _wider(self.code, self.last[few], LENGTH))
        return pair(ends, (self.place - self.first)[few].astype(np.uint64))


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _each_text(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        texts = batch.column("text")
        for key, text in zip(batch.column("k").to_pylist(), texts, strict=True):
            yield key, (text.as_py() or "").encode()


def _buckets_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for parts in _parts(_each_text(batches)):
        yield pa.RecordBatch.from_arrays([_long(Suffixes(parts).bucket)], ["key"])


def _signed(values) -> pa.Array:
    """Longs from Python integers, unsigned 64-bit ones folded."""
    return pa.array(np.array([v & 0xFFFFFFFFFFFFFFFF for v in values], np.uint64).view(np.int64))


def _digests(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))


def _spans_in(held) -> Callable:
    """Suffixes in buckets that may have others, with the identifiers and digests of all their windows together.

    ``at`` packs the first window, the number of windows and the offset of the
    minimiser from the first window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _parts(_each_text(batches)):
            found = Suffixes(parts)
            few = np.flatnonzero(among(held.value, found.bucket))
            if not len(few):
                continue
            first, last, owner = found.first[few], found.last[few], found.owner[few]
            keys, bases = np.array([k for k, _, _ in parts], np.int64), np.array([b for _, b, _ in parts], np.int64)
            at = (first - found.start[owner] + bases[owner]) << 16 | (last - first + 1) << 8 | (found.place[few] - first)
            columns = [_long(found.bucket[few]), _long(found.identifiers(few)), _long(_digests(found.data, first, last + LENGTH)), pa.array(keys[owner]), pa.array(at)]
            yield pa.RecordBatch.from_arrays(columns, ["g", "s", "d", "k", "at"])

    return run


ITEMS = "g long, s long, d long, k long, at long"
GROUP = ("g", "s", "d")


def refine(items: DataFrame, *ids: str) -> tuple[DataFrame, DataFrame]:
    """One level: the items that identifiers settle, and those that stay open.

    ``items`` has buckets ``g``, identifiers ``s`` with digests ``d`` and the
    item itself, ``ids``. Settled items share all three with another. Open are
    those alone with their identifier, and, of each settled identifier in a
    bucket that may have such, one item as its pointer.
    """
    context = items.sparkSession.sparkContext
    groups = stored(items.groupBy(*GROUP).agg(F.count("*").alias("n"), F.min(F.struct(*ids)).alias("pointer")))
    judged = join_sized(items, groups.select(*GROUP, "n"), list(GROUP), "n", items.count())
    judged = stored(judged.select(*ids, (F.col("n") > 1).alias("settled")))
    held = context.broadcast(bitmap(groups.where("n = 1").select(F.col("g").alias("key"))))

    @F.pandas_udf("boolean")
    def maybe(buckets: pd.Series) -> pd.Series:
        return pd.Series(among(held.value, buckets.to_numpy(np.int64).view(np.uint64)))

    pointers = groups.where("n > 1").where(maybe("g")).select("pointer.*")
    return judged.where("settled").select(*ids), judged.where("not settled").select(*ids).unionByName(pointers)


def _open_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the open spans of each text."""
    for batch in batches:
        found = []
        for key, text, spans in zip(batch.column("k").to_pylist(), batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            data = (text or "").encode()
            for at in spans:
                first, windows = at >> 16, at >> 8 & 0xFF
                found.append((key, at, data[first : first + windows + LENGTH - 1]))
                if len(found) > 10_000:
                    yield _span_rows(found)
                    found = []
        yield _span_rows(found)


def _span_rows(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if found else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["k", "at", "data"])


class _Runs:
    """The runs of ``length`` windows of some open spans, by arrays.

    A window's number is the minimiser's offset in it, so equal windows have
    equal numbers; run r holds the numbers from r * length on, of which a span
    may lack some. ``within``, where given, are the packed runs of the level
    before that are still open. ``bucket`` is made of the minimiser's bucket,
    the run's number and what all windows of a full run share.
    """

    def __init__(self, spans: list[int], datas: list[bytes], length: int, within: list[list[int]] | None):
        self.data = b"".join(datas)
        base = np.concatenate(([0], np.cumsum([len(d) for d in datas])))[:-1]
        at = np.array(spans, np.int64)
        first, windows, offset = at >> 16, at >> 8 & 0xFF, at & 0xFF
        owners, runs = [], []
        for i, (n, o) in enumerate(zip(windows.tolist(), offset.tolist(), strict=True)):
            wanted = [(int(x) >> 16) - (int(first[i])) for x in within[i]] if within else [0]
            counts = [int(x) >> 8 & 0xFF for x in within[i]] if within else [n]
            for start, count in zip(wanted, counts, strict=True):
                # Numbers of these windows: the minimiser's offset in the last and in the first of them.
                for r in range((o - start - count + 1) // length, (o - start) // length + 1):
                    owners.append(i)
                    runs.append((r, max(r * length, o - start - count + 1), min(r * length + length - 1, o - start)))
        self.owner = np.array(owners, np.int64)
        run, low, high = np.array(runs, np.int64).reshape(-1, 3).T
        place = (base + offset)[self.owner]
        self.code = gram_buckets(np.frombuffer(self.data, np.uint8))
        shared = _wider(self.code, place - run * length, LENGTH - length + 1)
        self.bucket = pair(pair(self.code[place], run.astype(np.uint64)), shared)
        self.first, self.last = place - high, place - low
        self.at = (first[self.owner] + self.first - base[self.owner]) << 16 | (high - low + 1) << 8


def _run_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[list[int], list[int], _Runs]]:
    for batch in batches:
        if batch.num_rows:
            spans, datas = batch.column("at").to_pylist(), batch.column("data").to_pylist()
            within = batch.column("runs").to_pylist() if "runs" in batch.schema.names else None
            yield batch.column("k").to_pylist(), spans, _Runs(spans, datas, length, within)


def _run_buckets(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, found in _run_batches(batches, length):
            yield pa.RecordBatch.from_arrays([_long(found.bucket)], ["key"])

    return run


def _runs_in(held, length: int) -> Callable:
    """Runs in buckets that may have others, with the identifiers and digests of all their windows together.

    ``at`` packs the run's first window and their number; ``suffix`` is that of
    the span it is of.
    """

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, spans, found in _run_batches(batches, length):
            few = np.flatnonzero(among(held.value, found.bucket))
            first, last, owner = found.first[few], found.last[few], found.owner[few]
            ends = pair(_wider(found.code, first, LENGTH), _wider(found.code, last, LENGTH))
            columns = [_long(found.bucket[few]), _long(ends), _long(_digests(found.data, first, last + LENGTH)), pa.array(np.array(keys, np.int64)[owner]), pa.array(found.at[few]), pa.array(np.array(spans, np.int64)[owner])]
            yield pa.RecordBatch.from_arrays(columns, [*GROUP, "k", "at", "suffix"])

    return run_all


class _Names:
    """Names of the columns that are added to a table: none of them is there already."""

    def __init__(self, documents: DataFrame):
        self.key, self.text, self.spans, self.maybe = free_names(documents, "_repeat_key", "_repeat_text", "_repeat_spans", "_repeat_maybe")


def _keyed(documents: DataFrame, names: _Names, id_col: str, text_col: str) -> DataFrame:
    """``documents`` with a hash of id and text, and the text as a string that is never null."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return documents.withColumn(names.text, text).withColumn(names.key, F.xxhash64(F.col(id_col), F.col(names.text)))


def _with_lists(rows: DataFrame, names: _Names, lists: DataFrame, context) -> tuple[DataFrame, DataFrame]:
    """Rows that may be named by ``lists`` (``k`` and ``spans``), joined to them, and all other rows."""
    held = context.broadcast(bitmap(lists.select(F.col("k").alias("key"))))

    @F.pandas_udf("boolean")
    def maybe(keys: pd.Series) -> pd.Series:
        return pd.Series(among(held.value, keys.to_numpy(np.int64).view(np.uint64)))

    marked = small_batches(rows).withColumn(names.maybe, maybe(names.key))
    lists = lists.select(F.col("k").alias(names.key), F.col("spans").alias(names.spans))
    return marked.where(F.col(names.maybe)).drop(names.maybe).join(lists, names.key, "left"), marked.where(~F.col(names.maybe)).drop(names.maybe)


def repeated_spans(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``k``, the hash of id and text, and ``spans``, the packed windows of that text that repeat."""
    spark = documents.sparkSession
    context = spark.sparkContext
    rows = documents.select(id_col, text_col)
    names = _Names(rows)
    rows = _keyed(rows, names, id_col, text_col).where(F.octet_length(names.text) >= LENGTH)
    texts = rows.select(F.col(names.key).alias("k"), F.col(names.text).alias("text"))

    with scratch(spark) as kept:
        # Initial buckets, refined by all windows of a suffix together.
        held = context.broadcast(bitmap(repeated(map_rows(texts, _buckets_only, "key long"))))
        found, opened = refine(stored(map_rows(texts, _spans_in(held), ITEMS)), "k", "at")

        # The bytes of the open spans; from here on the texts are not needed.
        lists = stored(opened.groupBy("k").agg(F.collect_set("at").alias("spans")))
        near, _ = _with_lists(rows.select(names.key, names.text), names, lists, context)
        near = near.where(F.col(names.spans).isNotNull()).select(F.col(names.key).alias("k"), F.col(names.text).alias("text"), F.col(names.spans).alias("spans"))
        spans = stored(map_rows(near, _open_spans, "k long, at long, data binary"))

        # Open buckets, refined by shorter and shorter runs of windows.
        runs = spans
        for length in RUNS:
            held = context.broadcast(bitmap(repeated(map_rows(runs, _run_buckets(length), "key long"))))
            settled, opened = refine(stored(map_rows(runs, _runs_in(held, length), f"{ITEMS}, suffix long")), "k", "at", "suffix")
            found = found.unionByName(settled.select("k", "at"))
            if length > 1:
                of = opened.groupBy("k", F.col("suffix").alias("at")).agg(F.collect_set(F.col("at")).alias("runs"))
                runs = stored(spans.join(of, ["k", "at"]))
        return kept(found.groupBy("k").agg(F.collect_set("at").alias("spans")))


def merged(spans: list[int] | None) -> list[tuple[int, int]]:
    """Maximal byte ranges that packed windows cover."""
    out: list[list[int]] = []
    for start, end in sorted((at >> 16, (at >> 16) + (at >> 8 & 0xFF) + LENGTH - 1) for at in spans or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def kept_bytes(data: bytes, ranges: list[tuple[int, int]]) -> bytes:
    ends = [0, *(end for _, end in ranges)]
    starts = [*(start for start, _ in ranges), len(data)]
    return b"".join(data[a:b] for a, b in zip(ends, starts, strict=True))


def _whole_characters(data: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``ranges`` without the characters that they cut."""
    out = []
    for start, end in ranges:
        while start < end and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def _documents_with_spans(documents: DataFrame, names: _Names, id_col: str, text_col: str) -> DataFrame:
    """``documents`` and the spans of each, null where nothing repeats."""
    lists = repeated_spans(documents, id_col, text_col)
    near, far = _with_lists(_keyed(documents, names, id_col, text_col), names, lists, documents.sparkSession.sparkContext)
    return near.unionByName(far.withColumn(names.spans, F.lit(None).cast("array<long>"))).drop(names.key)


def repeat_digests(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    names = _Names(rows)
    rows = _documents_with_spans(rows, names, "doc_id", "text")
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def row(doc_id, text, spans):
        data, ranges = text.encode(), merged(spans)
        return doc_id, len(data), sum(b - a for a, b in ranges), len(ranges), hashlib.sha256(kept_bytes(data, ranges)).hexdigest()

    return map_rows(rows.select("doc_id", names.text, names.spans), per_row(schema, row, "doc_id", names.text, names.spans), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` with the repeated bytes taken out of the texts; characters cut by a range stay whole."""
    names = _Names(documents)
    rows = _documents_with_spans(documents, names, id_col, text_col)

    @F.pandas_udf("string")
    def rest(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, spans, strict=True):
            if found is not None and len(found):
                data = text.encode()
                text = kept_bytes(data, _whole_characters(data, merged([int(x) for x in found]))).decode()
            out.append(text)
        return pd.Series(out, dtype=object)

    changed = small_batches(rows).withColumn(names.text, F.when(F.col(names.spans).isNull(), F.col(text_col)).otherwise(rest(names.text, names.spans)))
    return changed.select(*(F.col(names.text).alias(c) if c == text_col else F.col(c) for c in documents.columns))
