"""Benchmark decontamination by the q-gram lemma over diagonal bands.

Texts and benchmark items are folded byte for byte (A-Z to lower case, ASCII
white space to a blank), so positions stay those of the UTF-8 text. An item
longer than ``piece`` bytes is searched as overlapping pieces, each its own
pattern, so that a long part of an item is found as well as the whole. Shorter
quotes are found by windows of ``WINDOW`` bytes, one every ``WINDOW_STEP``,
which are patterns without edits.

What is found for certain (bytes are those of the folded text):

* an item of at most ``piece`` bytes, whole, within its edits;
* any passage of an item that holds a whole piece within its edits (one of
  ``piece + step - 1`` = 239 bytes always does);
* any verbatim passage of an item of ``WINDOW + WINDOW_STEP - 1`` = 63 bytes
  or more;
* items of fewer than q bytes, which have no q-gram: verbatim, between word
  boundaries.

A pattern of m bytes that occurs in a text with at most e edits shares at least
m - q + 1 - q e of its q-grams with the text, all on diagonals (text position
less pattern position) that span e at most. Per text:

1. all q-grams are looked up in the index of the pattern q-grams;
2. hits are counted by pattern and band of diagonals; bands are 2 (e + 1) wide
   and overlap by half, so every occurrence lies whole in one of them;
3. bands below the bound are dropped, the others are verified by an alignment
   of the pattern with the text of the band that stays inside the band.

The budget e is ``edits`` of the pattern's length. The result is one row a
document, item and region: ``doc_id, item_id, start, end`` (bytes of the text)
and ``edits``. Overlapping regions of one item are joined.

The index is broadcast in blocks of ``index_bytes`` of item text at most (and
``LEAST_BLOCK`` at least), one block at a time: what a block finds or leaves is
written before the next one is made. An item that is longer than a block is cut
into segments that overlap by a piece, so that each of its patterns lies whole in
one of them; its regions are joined over the blocks. So a benchmark of any size,
and an item of any length, is searched with the memory of a block, in one pass
over the documents for each block. Hits are
counted some ``HITS`` at a time, so a text of one q-gram over and over takes no
more memory than others. Texts of any length are searched whole, in overlapping
parts. Items without text, null or blank, are not searched, nor those of fewer
than ``least`` bytes; an item without an id is searched like others. Null and
empty texts have no hits. Repeated rows, also of one id, give repeated results;
of regions of one item that touch the joined one is given, with the most edits.
Empty tables give no regions and leave all documents. Other columns are ignored,
or kept by ``clean_documents``, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import delete, map_rows, stored, stored_at

Q = 10
EDITS = 0.085
PIECE = 160
STEP = 80
WINDOW = 48
WINDOW_STEP = 16
LEAST = 1
INDEX_BYTES = 2 << 20
PART = 1 << 20
HITS = 1 << 20
BITS = 22
#: Blocks are not made smaller than this, so that items are not cut to crumbs.
LEAST_BLOCK = 4096
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b in b"\t\n\v\f\r" else b for b in range(256))
#: Bytes of words: digits, letters and all of other scripts.
_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def grams(data: np.ndarray) -> np.ndarray:
    """The q-grams of a byte array, hashed to 64 bits; the alignment sorts out what collides."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    two = data.astype(np.uint64)
    two = (two[:-1] << np.uint64(8)) | two[1:]
    four = (two[:-2] << np.uint64(16)) | two[2:]
    eight = (four[:-4] << np.uint64(32)) | four[4:]
    n = len(data) - Q + 1
    return eight[:n] * np.uint64(0xD6E8FEB86659FD93) + four[Q - 4 : Q - 4 + n] * np.uint64(0xA0761D6478BD642F)


def folded(text: str) -> bytes:
    return text.encode().translate(_FOLD)


def segments(text: str, size: int) -> Iterator[tuple[bytes, bool]]:
    """An item's folded text in segments, and whether each is the last one.

    ``size`` is a multiple of both strides. A segment holds the patterns that
    begin in its first ``size`` bytes, the last one all that are left.
    """
    data, at = folded(text).strip(), 0
    while len(data) - at > size + PIECE:
        yield data[at : at + size + PIECE], False
        at += size
    yield data[at:], True


def _slots(code: np.ndarray) -> np.ndarray:
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


class Index:
    """Patterns of some benchmark items and their q-grams, sorted.

    An item is an id and a text, or an id and one of ``segments``.
    """

    def __init__(self, items: list[tuple], edits: float = EDITS, piece: int = PIECE, step: int = STEP):
        self.patterns: list[tuple[int | None, bytes, int]] = []
        self.short: dict[bytes, list[int | None]] = {}
        for item_id, text, *of_segment in items:
            data, last = (text, *of_segment) if of_segment else (folded(text).strip(), True)
            if len(data) < Q:
                if data:
                    self.short.setdefault(data, []).append(item_id)
                continue
            starts = range(0, max(1, len(data) - piece + step) if last else len(data) - piece, step)
            for at in starts:
                at = max(0, min(at, len(data) - piece))
                part = data[at : at + piece]
                # The lemma needs at least one shared q-gram to say anything.
                budget = min(int(edits * len(part)), (len(part) - Q) // Q)
                self.patterns.append((item_id, part, max(0, budget)))
            if len(data) > WINDOW:
                for at in range(0, len(data) - WINDOW + WINDOW_STEP if last else len(data) - piece, WINDOW_STEP):
                    at = min(at, len(data) - WINDOW)
                    self.patterns.append((item_id, data[at : at + WINDOW], 0))
        codes, owners, places = [], [], []
        for number, (_, part, _) in enumerate(self.patterns):
            code = grams(np.frombuffer(part, np.uint8))
            codes.append(code)
            owners.append(np.full(len(code), number, np.int32))
            places.append(np.arange(len(code), dtype=np.int32))
        code = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")
        self.codes = code[order]
        self.owners = np.concatenate(owners)[order] if owners else np.zeros(0, np.int32)
        self.places = np.concatenate(places)[order] if places else np.zeros(0, np.int32)
        self.maybe = np.zeros(1 << BITS, bool)
        self.maybe[_slots(self.codes)] = True
        self.budgets = np.array([e for _, _, e in self.patterns], np.int64)
        lengths = np.array([len(p) for _, p, _ in self.patterns], np.int64)
        self.needed = np.maximum(1, lengths - Q + 1 - Q * self.budgets)

    def _hits(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pattern and diagonal of every q-gram the text shares with a pattern, some HITS at a time."""
        code = grams(data)
        at = np.flatnonzero(self.maybe[_slots(code)])
        found = code[at]
        low = np.searchsorted(self.codes, found, "left")
        many = np.searchsorted(self.codes, found, "right") - low
        at, low, many = at[many > 0], low[many > 0], many[many > 0]
        if not len(at):
            return
        so_far = np.cumsum(many)
        start = 0
        while start < len(at):
            done = so_far[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(so_far, done + HITS, "right")))
            n = many[start:end]
            rows = np.repeat(low[start:end] - (so_far[start:end] - n - done), n) + np.arange(so_far[end - 1] - done)
            yield self.owners[rows].astype(np.int64), np.repeat(at[start:end], n) - self.places[rows]
            start = end

    def _bands(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Patterns and bands with their counts of hits; band b holds the hits of the half bands b and b + 1."""
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for owners, diagonals in self._hits(data):
            half = (owners << 32) | (diagonals + PIECE + Q) // (self.budgets[owners] + 1)
            new, hits = np.unique(np.concatenate([half, half - 1]), return_counts=True)
            if len(keys):
                new, place = np.unique(np.concatenate([keys, new]), return_inverse=True)
                hits = np.bincount(place, np.concatenate([counts, hits]), minlength=len(new)).astype(np.int64)
            keys, counts = new, hits
        return keys, counts

    def _short_items(self, data: bytes) -> Iterator[tuple[int | None, int, int, int]]:
        """Items without a q-gram, verbatim and between word boundaries."""
        if not self.short or not data:
            return
        is_word = _WORD[np.frombuffer(data, np.uint8)]
        edge = np.concatenate(([True], ~(is_word[1:] & is_word[:-1]), [True]))
        for length in {len(x) for x in self.short}:
            last = max(0, len(data) - length + 1)
            for at in np.flatnonzero(edge[:last] & edge[length : length + last]).tolist():
                for item_id in self.short.get(data[at : at + length], ()):
                    yield item_id, at, at + length, 0

    def _regions(self, data: bytes) -> Iterator[tuple[int, int, int, int]]:
        keys, counts = self._bands(np.frombuffer(data, np.uint8))
        enough = counts >= self.needed[keys >> 32]
        tried: set[tuple[int, int]] = set()
        for key in keys[enough].tolist():
            owner, band = key >> 32, key & 0xFFFFFFFF
            item_id, pattern, budget = self.patterns[owner]
            low = band * (budget + 1) - PIECE - Q
            found = align(pattern, data, low, low + 2 * (budget + 1) - 1, budget)
            if found and (owner, found[1]) not in tried:
                tried.add((owner, found[1]))
                yield item_id, *found

    def search(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """``item_id, start, end, edits`` of the regions of a text, joined by item."""
        data = folded(text or "")
        found = list(self._short_items(data))
        for at in range(0, max(1, len(data)), PART):
            base = max(0, at - 2 * PIECE)
            found += [(i, s + base, e + base, n) for i, s, e, n in self._regions(data[base : at + PART])]
        joined: list[list] = []
        for item_id, start, end, edits in sorted(found, key=lambda x: (x[0] is None, x[0] or 0, *x[1:])):
            if joined and joined[-1][0] == item_id and start <= joined[-1][2]:
                joined[-1][2] = max(joined[-1][2], end)
                joined[-1][3] = max(joined[-1][3], edits)
            else:
                joined.append([item_id, start, end, edits])
        return [tuple(x) for x in joined]


def align(pattern: bytes, data: bytes, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """Best alignment of the whole pattern on diagonals ``low`` .. ``high``: start, end, edits.

    ``None`` if it takes more than ``budget`` edits. Cells are kept by
    diagonal: row i, column i + low + k. Starts are carried along.
    """
    at = data.find(pattern, max(0, low), max(0, high + len(pattern)))
    if at >= 0:
        return at, at + len(pattern), 0
    width, worst = high - low + 1, budget + 1
    costs, starts = [0] * width, [low + k for k in range(width)]
    for k in range(width):
        if not 0 <= low + k <= len(data):
            costs[k] = worst
    for i, letter in enumerate(pattern):
        new, begun = [worst] * width, [0] * width
        for k in range(width):
            j = i + low + k
            if not -1 <= j < len(data):
                continue
            best, start = worst, 0
            if j >= 0 and costs[k] + (data[j] != letter) < best:
                best, start = costs[k] + (data[j] != letter), starts[k]
            if k + 1 < width and costs[k + 1] + 1 < best:
                best, start = costs[k + 1] + 1, starts[k + 1]
            if k and j >= 0 and new[k - 1] + 1 < best:
                best, start = new[k - 1] + 1, begun[k - 1]
            new[k], begun[k] = best, start
        costs, starts = new, begun
        if min(costs) > budget:
            return None
    k = min(range(width), key=lambda k: (costs[k], k))
    return (starts[k], len(pattern) + low + k, costs[k]) if costs[k] <= budget else None


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str, least: int, index_bytes: int) -> Iterator[list[tuple[int, bytes, bool]]]:
    """Segments of benchmark items in blocks of bounded size, streamed to the driver one partition at a time."""
    most = max(index_bytes, LEAST_BLOCK)
    size = (most - PIECE) // STEP * STEP
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
            found = [(item_id, *segment) for item_id, text in rows for segment in segments(text, size)]
            columns = list(zip(*found, strict=True)) if found else [[], [], []]
            types = (pa.int64(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["item_id", "data", "last"])

    block, held = [], 0
    for item_id, data, last in map_rows(items.where(F.octet_length("text") >= least), cut, "item_id long, data binary, last boolean").toLocalIterator():
        if block and held + len(data) > index_bytes:
            yield block
            block, held = [], 0
        block.append((item_id, bytes(data), last))
        held += len(data)
    if block:
        yield block


#: The index that a worker has made last, with the items it is of.
_MADE: list = [None, None]


def _index(items: list[tuple[int, bytes, bool]], edits: float) -> Index:
    if _MADE[0] is not items:
        _MADE[:] = [items, Index(items, edits)]
    return _MADE[1]


REGION = pa.schema([(n, pa.int64()) for n in ("doc_id", "item_id", "start", "end", "edits")])
_FOUND = REGION.append(pa.field("text_key", pa.int64()))


def _text_key(text: str) -> int:
    """A signed 64-bit hash of a text."""
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def _over_blocks(parts: list[DataFrame]) -> DataFrame:
    """Regions of several blocks, those of one item joined where they touch.

    Rows of one id and text have the same regions in every block, each as often
    as there are such rows, and get the joined ones as often.
    """
    of = ["doc_id", "text_key", "item_id"]
    found = reduce(DataFrame.unionAll, (part.withColumn("block", F.lit(i)) for i, part in enumerate(parts)))
    counted = found.groupBy(*of, "start", "end", "edits", "block").agg(F.count("*").alias("n"))
    by_start = Window.partitionBy(*of).orderBy("start", "end", "edits", "block")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = counted.withColumn("opens", (F.coalesce(F.col("start") > reach, F.lit(True))).cast("int"))
    runs = opens.withColumn("run", F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    joined = runs.groupBy(*of, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("edits").alias("edits"), F.max("n").alias("n"))
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), "n"))).select(*REGION.names)


def contaminated_regions(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", edits: float = EDITS, least: int = LEAST, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``doc_id, item_id, start, end, edits`` of every region that holds benchmark text."""
    context = documents.sparkSession.sparkContext
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    columns = ", ".join(f"{n} long" for n in _FOUND.names)

    def search_with(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(held.value, edits)
            for batch in batches:
                found = [(d, *x, _text_key(t)) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for x in index.search(t)]
                values = list(zip(*found, strict=True)) if found else [[]] * len(_FOUND)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], schema=_FOUND)

        return run

    blocks = _blocks(benchmark, item_col, item_text_col, least, index_bytes)
    parts, block = [], next(blocks, None)
    while block is not None:
        held, following = context.broadcast(block), next(blocks, None)
        found = map_rows(rows, search_with(held), columns)
        if parts or following is not None:
            found = stored(found)
            held.destroy()
        parts.append(found)
        block = following
    if not parts:
        return rows.limit(0).select("doc_id", *(F.lit(0).cast("long").alias(n) for n in REGION.names[1:]))
    return _over_blocks(parts) if len(parts) > 1 else parts[0].select(*REGION.names)


def clean_documents(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", edits: float = EDITS, least: int = LEAST, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The rows in which no benchmark text is found, with all their columns."""
    context = documents.sparkSession.sparkContext

    def free_of(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(held.value, edits)
            for batch in batches:
                yield batch.filter(pa.array([not index.search(t) for t in batch.column(text_col).to_pylist()], pa.bool_()))

        return run

    blocks = _blocks(benchmark, item_col, item_text_col, least, index_bytes)
    block, written = next(blocks, None), None
    while block is not None:
        held, following = context.broadcast(block), next(blocks, None)
        documents = map_rows(documents, free_of(held), documents.schema)
        if written is not None or following is not None:
            last, written, documents = written, *stored_at(documents)
            held.destroy()
            if last is not None:
                delete(documents.sparkSession, last)
        block = following
    return documents
