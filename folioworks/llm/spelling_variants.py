"""Spelling variants: words one edit apart, found over forward and reversed sorted dictionaries.

Words are maximal runs of Latin letters, A-Z lower-cased. An edit puts in, takes out
or replaces one code point, so one half of the shorter word stays intact: its first
half heads both words, or its second half ends both. Words sorted forward hold
the first kind side by side, words sorted backward the second.

A block is what such a range scan runs over: words of a length n, or n + 1, that
share their first ``a`` and last ``b`` code points, and differ in the ``open`` ones
between. The whole dictionary of a length is the first block. A block of more
than ``BLOCK`` words is subdivided: pairs that agree on the first half of the open
part go to the blocks of longer prefixes, the others, whose edit lies there, to the
blocks of longer suffixes. This halves the open part, so after a few rounds it is
one code point, and a block holds at most one word of the shorter length for each
letter, and for each pair of letters one of the longer. No block is cut short,
and none is scanned whole by a task unless it is that small.

Each block takes the pairs whose common prefix ends in its own range of places,
so every pair is found once. Blocks are scanned in sorted order, many in a
batch, and each candidate is verified by the length of its common prefix and suffix.

Null texts have no words, null ids plant no misspellings; repeated rows count again.
Runs of any length are words. An empty table gives no rows. Other columns are
ignored, whatever they are called.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_sized, map_rows, scratch, stored

#: Words are counted from so many code points and occurrences on.
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: One run in so many, by document and run, has a letter taken out.
PLANTED = 31
#: A form has at least so many times the word's occurrences.
OUTWEIGHS = 10
#: Words of a block that are compared directly.
BLOCK = 24
#: Distinct words a task counts before it hands them on, candidates compared at once, and code points of them.
HELD, PAIRS, LETTERS = 200_000, 1 << 17, 1 << 23


def _counted(least: int, planted: int | None):
    """A ``mapInArrow`` body: words of the texts with their numbers, summed as far as ``HELD`` allows."""
    run = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def handed():
            out = pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())}, pa.schema([("word", pa.string()), ("n", pa.int64())]))
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                start = None if planted is None or doc_id is None else zlib.crc32(f"{doc_id}:".encode())
                own: dict[str, int] = {}
                for word in run.findall(text.encode().lower().decode()):
                    own[word] = own.get(word, 0) + 1
                for word, n in own.items():
                    if start is not None and not (h := zlib.crc32(word.encode(), start)) % planted:
                        k = h % len(word)
                        word = word[:k] + word[k + 1 :]
                        if len(word) < least:
                            continue
                    counts[word] = counts.get(word, 0) + n
            if len(counts) > HELD:
                yield handed()
        yield handed()

    return body


def vocabulary(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: int | None = None) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough; ``planted`` misspells one run in so many."""
    rows = documents.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    words = map_rows(rows, _counted(LEAST_LENGTH, planted), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _matrix(words: list[str], width: int, end: bool) -> np.ndarray:
    """Code points of words, one a row, from the first or the last on, with zeros beyond."""
    padded = [w.rjust(width, "\0") if end else w.ljust(width, "\0") for w in words]
    points = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).reshape(len(words), width)
    return points[:, ::-1] if end else points


def verified(words: list[str], left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which pairs are one edit apart and have a common prefix of ``low`` to ``high`` code points.

    ``right`` is as long as ``left``, or one longer.
    """
    width = max(map(len, words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ahead, behind = _matrix(words, width, False), _matrix(words, width, True)
    kept = np.zeros(len(left), bool)
    step = max(1, LETTERS // width)
    for at in range(0, len(left), step):
        x, y = left[at : at + step], right[at : at + step]
        prefix = np.minimum(_common(ahead[x], ahead[y]), lengths[x])
        suffix = np.minimum(_common(behind[x], behind[y]), lengths[x])
        needed = lengths[x] - (lengths[x] == lengths[y])
        there = (low[at : at + step] <= prefix) & (prefix <= high[at : at + step])
        kept[at : at + step] = there & (prefix + suffix >= needed) & (x != y)
    return kept


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many of the first columns the rows agree."""
    unlike = x != y
    return np.where(unlike.any(axis=1), unlike.argmax(axis=1), x.shape[1])


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word of the blocks, which arrive as sorted lists, how many near words they give and the best of them."""
    blocks, pairs, words, width = [], 0, 0, 0
    for batch in batches:
        for block in batch.to_pylist():
            n = len(block["words"])
            words, width = words + n, max(width, block["size"] + 1)
            if blocks and (pairs + n * n > PAIRS or words * width > LETTERS):
                yield _near(blocks)
                blocks, pairs, words, width = [], 0, n, block["size"] + 1
            blocks.append(block)
            pairs += n * n
    if blocks:
        yield _near(blocks)


def _near(blocks: list[dict]) -> pa.RecordBatch:
    words, counts, left, right, low, high = [], [], [], [], [], []
    for block in blocks:
        base, size = len(words), block["size"]
        own = block["words"]
        words += [w["word"] for w in own]
        counts += [w["n"] for w in own]
        # Sorted by length, so the shorter ones come first.
        shorter = sum(len(w["word"]) == size for w in own)
        i, j = np.triu_indices(len(own), 1)
        i, j = i[i < shorter], j[i < shorter]
        left.append(i + base)
        right.append(j + base)
        low.append(np.full(len(i), block["low"]))
        high.append(np.full(len(i), block["high"]))
    x, y, low, high = (np.concatenate(a).astype(np.int64) for a in (left, right, low, high))
    good = verified(words, x, y, low, high) if len(x) else np.zeros(0, bool)
    x, y = x[good], y[good]
    n_near: dict[str, int] = {}
    best: dict[str, tuple] = {}
    for a, b in zip(np.concatenate([x, y]).tolist(), np.concatenate([y, x]).tolist(), strict=True):
        word, other = words[a], (-counts[b], words[b])
        n_near[word] = n_near.get(word, 0) + 1
        if word not in best or other < best[word]:
            best[word] = other
    return pa.RecordBatch.from_arrays([pa.array(list(n_near), pa.string()), pa.array(list(n_near.values()), pa.int64()), pa.array([-best[w][0] for w in n_near], pa.int64()), pa.array([best[w][1] for w in n_near], pa.string())], schema=_NEAR)


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n_near, near, near_n``: how many words are one edit away, and the most frequent of them.

    ``words`` has distinct ``word`` and ``n``. Of equal counts the smaller word, by code points, is ``near``.
    """
    length = F.char_length("word")
    open_part = F.col("size") - F.col("a") - F.col("b")

    def halves(blocks: DataFrame) -> DataFrame:
        half = F.floor(open_part / 2).cast("int")
        ahead = F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"), (F.col("a") + half).alias("low"), F.col("high").alias("high"))
        behind = F.struct(F.col("a").alias("a"), (F.col("b") + open_part - half).alias("b"), F.col("low").alias("low"), (F.col("a") + half - 1).alias("high"))
        moved = blocks.select("word", "n", "size", F.explode(F.array(ahead, behind)).alias("to")).select("word", "n", "size", "to.*")
        return moved.withColumn("key", F.concat_ws(" ", "size", "a", "b", F.expr("left(word, a)"), F.expr("right(word, b)")))

    # Each word as the shorter of a pair, and as the longer.
    roles = words.withColumn("size", F.explode(F.array(length, length - 1)))
    whole = roles.select("word", "n", "size", F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("low"), F.col("size").alias("high"))
    found = []
    rows = stored(halves(whole))
    while True:
        sizes = stored(rows.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"))
        told = stored(join_sized(rows, sizes, ["key"], "members", rows.count()))
        small = (F.col("members") <= block) | (open_part <= 1)
        member = F.struct(length.alias("length"), "word", "n")
        lists = told.where(small).groupBy("key").agg(*(F.first(c).alias(c) for c in ("size", "low", "high")), F.sort_array(F.collect_list(member)).alias("words"))
        found.append(stored(map_rows(lists.select("size", "low", "high", "words"), _scanned, "word string, n_near long, near_n long, near string")))
        crowded = told.where(~small)
        if crowded.isEmpty():
            break
        rows = stored(halves(crowded))
    near = found[0]
    for more in found[1:]:
        near = near.unionByName(more)
    first = F.min(F.struct((-F.col("near_n")).alias("n"), "near"))
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select("word", "n_near", "first.near", (-F.col("first.n")).alias("near_n"))


def group_variants(words: DataFrame, outweighs: int = OUTWEIGHS, block: int = BLOCK) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of a vocabulary with distinct ``word`` and ``n``.

    ``form`` is the most frequent near word where it occurs ``outweighs`` times as
    often as the word; ``root`` is where forms lead to. Counts grow tenfold at each
    step, so the way has no circle and few steps.
    """
    with scratch(words.sparkSession) as kept:
        words = stored(words)
        told = words.join(near_words(words, block), "word", "left")
        is_form = F.col("near_n") >= outweighs * F.col("n")
        told = stored(told.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")))
        # Forms of forms: where a word's form has a form itself, that is looked up, twice as far each time.
        way = told.where("form is not null").select(F.col("word"), F.col("form").alias("root"))
        while True:
            way = stored(way)
            onward = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
            further = way.join(onward, "root", "left")
            if further.where("next is not null").isEmpty():
                break
            way = further.select("word", F.coalesce("next", "root").alias("root"))
        roots = told.join(way, "word", "left")
        return kept(roots.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
