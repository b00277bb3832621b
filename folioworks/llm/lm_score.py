"""Language-model scores: a causal self-attention model over subword ids, and the word counts it is held against.

Texts are sequences of words (A-Z lower-cased, cut at ASCII white space) and one end.
The model's probability of a text is that of this sequence, spelled in the subword
ids of a public byte-level vocabulary, each word after a space: the product over
ids and the end of what ``attention`` gives. The ``base`` score is that of single
words, each with one added to its count.

1. Words are counted over all texts, those of training apart, and the subword
   ids of the training words with them: combined in each task, then by a shuffle.
2. The most frequent ids have slots of their own; the others share one, within which
   an id has its frequency over all training words, plus one.
3. The model is fitted on the windows of all training documents (``SHARE`` is 1; below
   that it would be a share chosen by a hash, of ``LEAST_IDS`` ids at least).
   One bucket of some ``BUCKET`` ids comes first; from where it ends all buckets go on
   in parallel, and their weights are averaged.
4. Every text is scored whole, in overlapping windows that score each id once, as
   batches of masked attention. The counts of the most frequent words, ``HOT`` at most, go to
   all tasks; a word's key has at most 65 bytes, so they are under 16 MB. Other words,
   each of which is about one in ``HOT`` of all at most, meet their counts by a join.

A null text is empty: its score is that of the end alone. Rows without an id are
scored like others and never learned from; repeated rows count again. Texts and
words of any length are taken whole. With nothing to learn from, the model is
untrained, counts are zero and the base is log10(1) a word. An empty table gives
no rows. Other columns are ignored, whatever they are called.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import attention
from .attention import END, GROUPS, MEMBERS, RARE
from .common import map_rows, scratch, stored

#: A byte-level vocabulary as ranks, and the pattern its texts are split by.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words that are counted at all tasks, and distinct words that a task holds at once.
HOT, HELD = 1 << 17, 500_000
#: Bytes of words that a task counts at once, and of texts that it looks up words for at once.
COUNTED, TOGETHER = 32 << 20, 4 << 20
#: Longer words go by a digest where they are counted, and are spelled in pieces.
LONG_KEY, LONG_WORD = 64, 256
#: The share of training documents that the attention model is fitted on, the ids it needs at least, and the ids of a bucket.
SHARE, LEAST_IDS, BUCKET = 1.0, 3_000_000, 1_000_000
#: Passes over the first bucket, and over all buckets after it.
FIRST_PASSES, PASSES = 4, 1
#: Weights that are averaged by a task before the driver has them.
MOST_PARTS = 16

_COUNTS = pa.schema([("key", pa.binary()), ("id", pa.int32()), ("c", pa.int64()), ("n", pa.int64())])
_WINDOWS = pa.schema([("bucket", pa.int32()), ("place", pa.int64()), ("slots", pa.binary())])
_SCORES = pa.schema([("doc_id", pa.int64()), ("train", pa.bool_()), ("row", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("logs", pa.float64()), ("score", pa.float64()), ("cold", pa.list_(pa.binary()))])


def key_of(word: bytes) -> bytes:
    """What a word is counted by; no word holds a space."""
    return word if len(word) <= LONG_KEY else b" " + hashlib.sha256(word).hexdigest().encode()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """As ``words_of``, the words of all texts end to end, and which text each is of."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    flat, of = words.flatten(), pc.list_parent_indices(words).to_numpy()
    # White space at a text's ends leaves an empty word there.
    there = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(there).cast(pa.binary()), of[there.to_numpy(zero_copy_only=False)]


def keys_of(words: pa.Array) -> pa.Array:
    """As ``key_of``, of all words."""
    if (pc.max(pc.binary_length(words)).as_py() or 0) <= LONG_KEY:
        return words
    return pa.array([key_of(w) for w in words.to_pylist()], pa.binary())


def ranks_of(vocabulary: str) -> dict[bytes, int]:
    with open(vocabulary, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def openings(ranks: dict[bytes, int]) -> np.ndarray:
    """Which ids open a word."""
    opens = np.zeros(len(ranks), bool)
    for token, rank in ranks.items():
        opens[rank] = token[:1] == b" "
    return opens


class Speller:
    """Subword ids of words."""

    def __init__(self, vocabulary: str):
        import tiktoken

        ranks = ranks_of(vocabulary)
        self.opens = openings(ranks)
        self.size = len(ranks)
        self.encoding = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _one(self, word: str) -> list[int]:
        spelled = self.encoding.encode_ordinary
        ids = spelled(" " + word[:LONG_WORD])
        for at in range(LONG_WORD, len(word), LONG_WORD):
            ids += spelled(word[at : at + LONG_WORD])
        return ids

    def spell(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, end to end, and how many each has."""
        joined = b" ".join(words).decode()
        apart = joined.split()
        if len(apart) == len(words) and max(map(len, apart), default=0) <= LONG_WORD:
            # Pieces never cross a space, so words can be spelled together.
            ids = np.array(self.encoding.encode_ordinary(" " + joined), np.int32)
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) == len(words):
                return ids, np.diff(np.append(starts, len(ids)))
        each = [self._one(w.decode()) for w in words]
        return np.array([i for ids in each for i in ids], np.int32), np.array([len(ids) for ids in each], np.int64)


class Layout:
    """Which slot an id has, and the log probability of an id within its slot."""

    def __init__(self, counts: dict[int, int], opens: np.ndarray):
        """``counts`` are the ids' numbers in training."""
        size = len(opens)
        number = np.zeros(size, np.int64)
        number[list(counts)] = list(counts.values())
        most = np.argsort(-number, kind="stable")[: GROUPS * MEMBERS - 2]
        # Neighbours in kind: beginnings of words, then insides, each by frequency.
        most = most[np.lexsort((-number[most], ~opens[most]))]
        self.slot = np.full(size, RARE, np.int16)
        self.slot[most] = np.arange(2, len(most) + 2)
        rare = self.slot == RARE
        self.within = np.where(rare, np.log((number + 1) / max(1, (number[rare] + 1).sum())), 0)
        self.numbers = np.zeros(GROUPS * MEMBERS)
        np.add.at(self.numbers, self.slot, number)


def _counting(vocabulary: str):
    """A ``mapInArrow`` body: how often words are in training texts and in all, and ids in training texts."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(vocabulary)
        learned, others = [], []
        ids = np.zeros(speller.size, np.int64)

        def handed():
            for words, in_training in ((learned, True), (others, False)):
                found = pa.chunked_array(words, pa.binary()).value_counts()
                words.clear()
                if not len(found):
                    continue
                distinct, n = found.field("values"), found.field("counts")
                if in_training:
                    spelled, lengths = speller.spell(distinct.to_pylist())
                    np.add.at(ids, spelled, np.repeat(n.to_numpy(), lengths))
                yield pa.RecordBatch.from_arrays([keys_of(distinct), pa.nulls(len(n), pa.int32()), n if in_training else pa.array(np.zeros(len(n), np.int64)), n], schema=_COUNTS)

        held = 0
        for batch in batches:
            for words, own in ((learned, batch.column("train")), (others, pc.invert(batch.column("train")))):
                words.append(words_in(batch.column("text").filter(own))[0])
                held += words[-1].nbytes
            if held > COUNTED:
                yield from handed()
                held = 0
        yield from handed()
        there = np.flatnonzero(ids)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(there), pa.binary()), pa.array(there, pa.int32()), pa.array(ids[there], pa.int64()), pa.array(ids[there], pa.int64())], schema=_COUNTS)

    return body


class Spelled:
    """Words as this worker has met them: their slots, counts and the rare ids' share of their probability."""

    def __init__(self, speller: Speller, layout: Layout, hot: dict[bytes, int]):
        self.speller, self.layout, self.hot = speller, layout, hot
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.length, self.first, self.count, self.rare = np.ones(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1)
        self.slots = np.array([END], np.int16)

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The numbers of distinct words; 0 is the end's."""
        if len(self.number) > HELD:
            self.clear()
        words = words.to_pylist()
        found = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        there = np.flatnonzero(found < 0)
        if len(there):
            new = [words[i] for i in there.tolist()]
            found[there] = np.arange(len(self.length), len(self.length) + len(new))
            self.number.update(zip(new, range(len(self.length), len(self.length) + len(new)), strict=True))
            ids, lengths = self.speller.spell(new)
            first = np.cumsum(lengths) - lengths
            self.rare = np.append(self.rare, np.add.reduceat(self.layout.within[ids], first))
            self.first = np.append(self.first, first + len(self.slots))
            self.length = np.append(self.length, lengths)
            self.slots = np.append(self.slots, self.layout.slot[ids])
            self.count = np.append(self.count, [self.hot.get(key_of(w), -1) for w in new])
        return found

    def sequence(self, numbers: np.ndarray) -> np.ndarray:
        """The slots of words, end to end."""
        lengths = self.length[numbers]
        ends = np.cumsum(lengths)
        return self.slots[np.repeat(self.first[numbers] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


#: What a worker has made of a broadcast, kept for its next tasks.
_HELD: dict = {}


def _spelled(known) -> Spelled:
    """``known`` broadcasts the vocabulary's path, the ids' counts and the hot words' counts."""
    if known.id not in _HELD:
        _HELD.clear()
        vocabulary, ids, hot = known.value
        speller = Speller(vocabulary)
        _HELD[known.id] = Spelled(speller, Layout(ids, speller.opens), hot)
    return _HELD[known.id]


class _Known:
    """A broadcast with a name of its own."""

    def __init__(self, spark, value):
        self.broadcast = spark.sparkContext.broadcast(value)
        self.id = self.broadcast._jbroadcast.id()

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self):
        return self.broadcast.value


def _dealt(seeds: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """A place below 2^62 for each pair of a text's seed and a window's number, spread like random ones."""
    x = seeds.astype(np.uint64) + (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(2)).astype(np.int64)


def _as_binary(rows: np.ndarray) -> pa.Array:
    """The rows' bytes, taken over as they lie."""
    rows = np.ascontiguousarray(rows)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.itemsize * rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in larger batches, so that a word that they share is looked up once; none is empty."""
    some: list[pa.RecordBatch] = []
    for batch in batches:
        some.append(batch)
        if sum(b.nbytes for b in some) > TOGETHER:
            yield from pa.Table.from_batches(some).combine_chunks().to_batches()
            some = []
    if some:
        yield from pa.Table.from_batches(some).combine_chunks().to_batches()


def _laid(spelled: Spelled, texts: pa.Array):
    """Texts end to end: their words' and ends' numbers, where each text's begin, their slots, where each text's begin; their words without the ends, and which text each is of."""
    words, of = words_in(texts)
    words = words.dictionary_encode()
    numbers = np.zeros(len(words) + len(texts), np.int64)
    # Each text before has an end.
    numbers[np.arange(len(words)) + of] = spelled.numbers(words.dictionary)[words.indices.to_numpy()]
    per_text = np.bincount(of, minlength=len(texts)) + 1
    first = np.cumsum(per_text) - per_text
    sizes = np.add.reduceat(spelled.length[numbers], first)
    return numbers, first, spelled.sequence(numbers), np.cumsum(sizes) - sizes, words, of


def _windows(known: _Known, buckets: int):
    """A ``mapInArrow`` body: the windows of training texts, each with a bucket and a place in it."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = _spelled(known)
        for batch in _together(batches):
            _, _, slots, starts, _, _ = _laid(spelled, batch.column("text"))
            begin, of = attention.places(len(slots), starts)
            place = _dealt(np.array(batch.column("dice").to_pylist(), np.int64)[of], (begin - starts[of]) // attention.SPAN)
            for at in range(0, len(begin), 4096):
                own = slice(at, at + 4096)
                rows = attention.windows(slots, starts, begin[own], of[own]).astype("<i2")
                yield pa.RecordBatch.from_arrays([pa.array(place[own] % buckets, pa.int32()), pa.array(place[own]), _as_binary(rows)], schema=_WINDOWS)

    return body


def _fitting(start, passes: int):
    """An ``applyInArrow`` body: the weights after passes over a bucket, times its windows."""

    def body(bucket: pa.Table) -> pa.Table:
        attention.keep_memory()
        bucket = bucket.sort_by([("place", "ascending"), ("slots", "ascending")])
        rows = np.frombuffer(b"".join(bucket.column("slots").to_pylist()), "<i2").reshape(-1, attention.REACH)
        steps = max(1, passes * len(rows) // attention.BATCH)
        weights = attention.fit(np.frombuffer(start.value, np.float32), rows, steps, attention.RATE if passes > PASSES else attention.RATE / 2)
        return pa.table({"n": pa.array([len(rows)], pa.int64()), "weights": pa.array([weights.tobytes()], pa.binary())})

    return body


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of weights by their windows, of all rows of a task."""
    n, total = 0, np.zeros(attention.SIZE)
    for batch in batches:
        for rows, weights in zip(batch.column("n").to_pylist(), batch.column("weights").to_pylist(), strict=True):
            n += rows
            total += rows * np.frombuffer(weights, np.float32).astype(np.float64)
    yield pa.RecordBatch.from_pydict({"n": [n], "weights": [total.tobytes()]}, pa.schema([("n", pa.int64()), ("weights", pa.binary())]))


def fitted(windows: DataFrame, start: np.ndarray, buckets: int) -> np.ndarray:
    """Weights learned from stored ``windows``, those of bucket 0 first."""
    spark = windows.sparkSession
    weights = start
    for part, passes in ((windows.where("bucket = 0"), FIRST_PASSES), (windows, PASSES)) if buckets > 1 else ((windows, FIRST_PASSES + PASSES),):
        held = spark.sparkContext.broadcast(weights.tobytes())
        grown = part.groupBy("bucket").applyInArrow(_fitting(held, passes), "n long, weights binary")
        sums = stored(grown).coalesce(MOST_PARTS).mapInArrow(_added, "n long, weights binary").collect()
        n = sum(r["n"] for r in sums)
        if n:
            weights = (sum(np.frombuffer(r["weights"]) for r in sums) / n).astype(np.float32)
    return weights


def _scoring(known: _Known, weights, tokens: int, kinds: int):
    """A ``mapInArrow`` body: every text's score, and the words whose counts are not known here."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attention.keep_memory()
        spelled, p = _spelled(known), attention.parts(np.frombuffer(weights.value, np.float32).copy())
        below = np.log10(tokens + kinds + 1)
        end = known.value[2][b" "]
        for batch in _together(batches):
            numbers, first, slots, starts, words, of = _laid(spelled, batch.column("text"))
            spelled.count[0] = end
            count = spelled.count[numbers]
            logs = np.add.reduceat(np.where(count >= 0, np.log10(np.maximum(count, 0) + 1), 0) - below, first)
            known_words = np.add.reduceat((count > 0).astype(np.int64), first)
            scores = np.add.reduceat(spelled.rare[numbers], first) + attention.text_scores(p, slots, starts)
            unknown = np.flatnonzero(count[np.arange(len(words)) + of] < 0)
            ends = np.append(0, np.cumsum(np.bincount(of[unknown], minlength=len(batch))))
            cold = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), keys_of(words.dictionary).take(words.indices.take(pa.array(unknown))))
            per_text = np.diff(np.append(first, len(numbers)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("train"), batch.column("row"), pa.array(per_text), pa.array(known_words), pa.array(logs), pa.array(scores / np.log(10)), cold], schema=_SCORES)

    return body


def _most_frequent(words: DataFrame) -> dict[bytes, int]:
    """The counts of the most frequent words, ``HOT`` at most, told by the steps of frequency that they reach."""
    step = F.floor(F.log2("n") * 16).cast("int")
    reached, least = 0, None
    # Some hundred steps, however many words.
    for r in words.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        reached += r["count"]
        if reached > HOT:
            break
        least = r["step"]
    if least is None:
        return {}
    found = words.where(step >= least).select("key", "c").toArrow()
    return dict(zip(found.column("key").to_pylist(), found.column("c").to_pylist(), strict=True))


def score_texts(documents: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, train, n_tokens, n_known, train_tokens, base_score, score`` of every row; ``training`` tells the rows to learn from."""
    spark = documents.sparkSession
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), (F.coalesce(training, F.lit(False)) & F.col(id_col).isNotNull()).alias("train"))
    with scratch(spark) as kept:
        raw = map_rows(rows.select("text", "train"), _counting(vocabulary), "key binary, id int, c long, n long")
        counts = stored(raw.groupBy("key", "id").agg(F.sum("c").alias("c"), F.sum("n").alias("n")))
        words = counts.where("id is null")
        texts_learned = rows.where("train").count()
        total = words.agg(F.sum("c").alias("tokens"), F.sum((F.col("c") > 0).cast("long")).alias("kinds")).first()
        tokens, kinds = (total["tokens"] or 0) + texts_learned, (total["kinds"] or 0) + (texts_learned > 0)
        hot = _most_frequent(words)
        hot[b" "] = texts_learned
        ids = {r["id"]: r["c"] for r in counts.where("id is not null").collect()}
        known = _Known(spark, (vocabulary, ids, hot))

        # The slots of training, about: every id and every end.
        size = sum(ids.values()) + texts_learned
        share = min(1.0, max(SHARE, LEAST_IDS / max(1, size)))
        buckets = max(1, round(share * size / BUCKET))
        dice = F.xxhash64("doc_id", "text")
        learned = rows.where(F.col("train") & (F.pmod(dice, F.lit(1 << 20)) < int(share * (1 << 20)))).select("text", dice.alias("dice"))
        windows = stored(map_rows(learned, _windows(known, buckets), "bucket int, place long, slots binary"))
        numbers = Layout(ids, openings(ranks_of(vocabulary))).numbers
        numbers[END] = texts_learned
        weights = fitted(windows, attention.first_weights(numbers), buckets)

        held = spark.sparkContext.broadcast(weights.tobytes())
        numbered = rows.withColumn("row", F.monotonically_increasing_id())
        scored = stored(map_rows(numbered, _scoring(known, held, tokens, kinds), "doc_id long, train boolean, row long, n_tokens long, n_known long, logs double, score double, cold array<binary>"))
        cold = scored.select("row", F.explode("cold").alias("key"))
        met = cold.join(words.where("c > 0").select("key", "c"), "key").groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("c") + 1)).alias("logs_more"))
        joined = scored.join(met, "row", "left")
        return kept(joined.select("doc_id", "train", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"), (F.col("logs") + F.coalesce("logs_more", F.lit(0.0))).alias("base_score"), "score"))
