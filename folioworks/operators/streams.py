"""What one compressed stream of a whole corpus would take, found in parallel; and a corpus of the same characters, shuffled.

Texts lie end to end with a blank between, in their order, and are cut at every
``BLOCK`` bytes, whatever the texts' lengths. A deflate block begins with the 32 KB
before it as its dictionary, so it finds what the stream would; bz2 sorts blocks of
that very size one by one anyway. Only lzma's window is longer than a block: its
figure is that of blocks, larger than a stream's.

The shuffled corpus is never gathered nor read again: its blocks draw their
characters from the corpus' counts without replacement. Counts are halved down a
tree of blocks, each node by a generator of its own seed, so a task finds a
block's counts by a walk from the root, blocks add up to the corpus exactly, and
reruns agree. Within a block the order is drawn at random.
"""

from __future__ import annotations

import bz2
import lzma
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import stored

#: What bz2 sorts at once at its highest level.
BLOCK = 900_000 - 19
#: What deflate looks back.
REACH = 1 << 15
#: Bytes around a stream's blocks: header, check sum, end.
GZIP_FRAME, BZ2_FRAME = 18, 14
#: Beyond so many characters a half's counts are drawn by their normal limit.
EXACT = 900_000_000

_SIZES = pa.schema([("block", pa.int64()), ("n_bytes", pa.int64()), ("gzip", pa.int64()), ("bz2", pa.int64()), ("lzma", pa.int64())])


def squeezed(data: bytes, before: bytes) -> tuple[int, int, int]:
    """Bytes of a block by compressor, without what surrounds a stream."""
    deflate = zlib.compressobj(9, zlib.DEFLATED, -15, zdict=before) if before else zlib.compressobj(9, zlib.DEFLATED, -15)
    return len(deflate.compress(data)) + len(deflate.flush()), len(bz2.compress(data)) - BZ2_FRAME, len(lzma.compress(data))


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            data = b"".join(piece["data"] for piece in row["pieces"])
            yield pa.RecordBatch.from_pylist([dict(zip(_SIZES.names, (row["block"], len(data), *squeezed(data, row["tail"] or b"")), strict=True))], _SIZES)


def placed(frame: DataFrame, text: str, order: str) -> DataFrame:
    """``start, data``: the bytes of each text and the blank after it, and how many are before them; ``order`` is a number."""
    rows = frame.select(F.col(order).alias("at"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    low, high, n = rows.agg(F.min("at"), F.max("at"), F.count("*")).first()
    # Sums of bytes by ranges of the order, then inside a range.
    width = max(1, ((high or 0) - (low or 0) + 1) // max(1, n // 1000))
    sized = rows.withColumn("range", F.coalesce(F.floor((F.col("at") - F.lit(low)) / width), F.lit(-1))).withColumn("n", (F.octet_length("text") + 1).cast("long"))
    earlier = Window.unboundedPreceding, -1
    bases = sized.groupBy("range").agg(F.sum("n").alias("n")).withColumn("group", F.floor(F.col("range") / 1000))
    # One row for a million texts or so.
    groups = bases.groupBy("group").agg(F.sum("n").alias("n")).select("group", F.coalesce(F.sum("n").over(Window.orderBy("group").rowsBetween(*earlier)), F.lit(0)).alias("base"))
    bases = bases.withColumn("inside", F.coalesce(F.sum("n").over(Window.partitionBy("group").orderBy("range").rowsBetween(*earlier)), F.lit(0))).join(groups, "group").select("range", (F.col("base") + F.col("inside")).alias("base"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("range").orderBy("at", "text").rowsBetween(*earlier)), F.lit(0))
    found = sized.withColumn("inside", inside).join(bases, "range").withColumn("start", F.col("base") + F.col("inside"))
    return found.select("start", F.encode(F.concat(F.when(F.col("start") > 0, " ").otherwise(""), "text"), "utf-8").alias("data")).withColumn("start", F.greatest(F.col("start") - 1, F.lit(0)))


def _ratios(sizes: DataFrame) -> DataFrame:
    """Rows of sizes with ``n_letters`` as ratios and bits a letter, and a row ``block`` -1 of the stream."""
    frames = {"gzip": GZIP_FRAME, "bz2": BZ2_FRAME, "lzma": 0}
    whole = sizes.agg(F.lit(-1).cast("long").alias("block"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_letters").alias("n_letters"), *((F.sum(c) + n).alias(c) for c, n in frames.items())).where("n_bytes is not null")
    alone = sizes.select("block", "n_bytes", "n_letters", *((F.col(c) + n).alias(c) for c, n in frames.items()))
    both = alone.unionByName(whole)
    ratios = [(F.col(c) / F.nullif(F.col("n_bytes"), F.lit(0))).alias(c) for c in frames]
    bits = [(F.col(c) * 8 / F.nullif(F.col("n_letters"), F.lit(0))).alias(f"{c}_bits") for c in frames]
    return both.select("block", "n_bytes", "n_letters", *ratios, *bits)


def stream_compression(frame: DataFrame, text: str, order: str, block: int = BLOCK) -> DataFrame:
    """``block, n_bytes, n_letters, gzip, bz2, lzma`` and bits a letter: a row a block, and one, ``block`` -1, of the corpus as a stream."""
    texts = placed(frame, text, order).where(F.length("data") > 0)
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.length("data") - 1) / block)
    cut = texts.withColumn("block", F.explode(F.sequence(first, last)))
    low = F.greatest(F.col("block") * block - F.col("start"), F.lit(0)).cast("int")
    high = F.least((F.col("block") + 1) * block - F.col("start"), F.length("data")).cast("int")
    pieces = cut.select("block", F.greatest("start", F.col("block") * block).alias("start"), F.substring("data", low + 1, high - low).alias("data"))
    letters = F.sum(F.char_length(T.letters(F.make_valid_utf8(F.col("data").cast("string"))))).alias("n_letters")
    blocks = stored(pieces.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("start", "data"))).alias("pieces"), letters))
    # The end of each block goes to the next one.
    reach = min(REACH, block)
    ends = pieces.where(F.col("start") + F.length("data") > (F.col("block") + 1) * block - reach)
    ends = ends.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("start", "data"))).alias("ends"))
    tail = F.expr(f"substring(unhex(array_join(transform(ends, e -> hex(e.data)), '')), -{reach})")
    tails = ends.select((F.col("block") + 1).alias("block"), tail.alias("tail"))
    sizes = blocks.join(tails, "block", "left").select("block", "pieces", "tail").mapInArrow(_sized, "block long, n_bytes long, gzip long, bz2 long, lzma long")
    return _ratios(stored(sizes.join(blocks.select("block", "n_letters"), "block")))


def _drawn(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` characters, drawn from ``good`` and ``bad`` ones, are good."""
    if good + bad < EXACT:
        return int(rng.hypergeometric(good, bad, n)) if good and n else 0
    total = good + bad
    mean = n * good / total
    spread = (mean * (bad / total) * ((total - n) / max(1, total - 1))) ** 0.5
    return int(min(max(round(rng.normal(mean, spread)), 0, n - bad), good, n))


def halved(counts: np.ndarray, n: int, seed: list[int]) -> np.ndarray:
    """Counts of ``n`` characters drawn from ``counts`` without replacement."""
    rng, left = np.random.default_rng(seed), int(counts.sum())
    out = np.zeros_like(counts)
    for i, have in enumerate(counts.tolist()):
        left -= have
        out[i] = _drawn(rng, have, left, n)
        n -= int(out[i])
    return out


class Shuffled:
    """The blocks of a shuffled corpus of ``counts`` characters, by number."""

    def __init__(self, counts: np.ndarray, size: int, seed: int):
        self.size, self.seed = size, seed
        self.blocks = -(-int(counts.sum()) // size)
        self.nodes = {(0, self.blocks): counts}

    def counts(self, block: int) -> np.ndarray:
        low, high = 0, self.blocks
        kept = {(low, high): self.nodes[low, high]}
        while high - low > 1:
            middle = (low + high) // 2
            whole = kept[low, high]
            left = self.nodes.get((low, middle))
            if left is None:
                left = halved(whole, (middle - low) * self.size, [self.seed, low, high])
            kept[low, middle] = left
            low, high = (low, middle) if block < middle else (middle, high)
            if (low, high) not in kept:
                kept[low, high] = whole - left
        # The way to the last block is most of the way to the next.
        self.nodes = kept
        return kept[low, high]

    def text(self, block: int, letters: np.ndarray) -> str:
        order = np.random.default_rng([self.seed, self.blocks, block]).permutation(np.repeat(letters, self.counts(block)))
        return order.astype(np.uint32).tobytes().decode("utf-32-le")


def shuffled_blocks(frame: DataFrame, text: str, seed: int = 42, block: int = BLOCK):
    """The shuffled corpus of ``frame``'s characters and the blanks between its texts, and its letters."""
    chars = frame.select(F.explode(F.split(F.col(text), "")).alias("c")).where("c <> ''").groupBy("c").count()
    # One row a character.
    counts = {r["c"]: r["count"] for r in chars.collect()}
    blanks = frame.count() - 1
    if blanks > 0:
        counts[" "] = counts.get(" ", 0) + blanks
    letters = sorted(counts)
    numbers = np.array([counts[c] for c in letters], np.int64)
    n_bytes = sum(len(c.encode()) * counts[c] for c in letters)
    size = max(1, block * int(numbers.sum()) // max(1, n_bytes))
    return Shuffled(numbers, size, seed), np.array([ord(c) for c in letters], np.uint32)


def shuffled_compression(frame: DataFrame, text: str, seed: int = 42, block: int = BLOCK) -> DataFrame:
    """The columns of ``stream_compression`` for the corpus of the same characters, shuffled as a whole."""
    spark = frame.sparkSession
    corpus, letters = shuffled_blocks(frame, text, seed, block)

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before = None, b""
        for batch in batches:
            for number in batch.column("block").to_pylist():
                if number and last != number - 1:
                    before = corpus.text(number - 1, letters).encode()[-REACH:]
                data = corpus.text(number, letters).encode()
                yield pa.RecordBatch.from_pylist([dict(zip(_SIZES.names, (number, len(data), *squeezed(data, before)), strict=True))], _SIZES)
                last, before = number, data[-REACH:]

    tasks = max(1, min(corpus.blocks, spark.sparkContext.defaultParallelism * 8))
    sizes = spark.range(0, corpus.blocks, 1, tasks).select(F.col("id").alias("block")).mapInArrow(sized, "block long, n_bytes long, gzip long, bz2 long, lzma long")
    # Letters lie evenly: those of a block by its bytes.
    n_letters = frame.agg(F.coalesce(F.sum(F.char_length(T.letters(F.col(text)))), F.lit(0))).first()[0]
    n_bytes = frame.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)) + F.greatest(F.count("*") - 1, F.lit(0))).first()[0]
    share = F.col("n_bytes") * (n_letters / max(1, n_bytes))
    return _ratios(stored(sizes.withColumn("n_letters", share)))
