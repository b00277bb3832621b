"""Counts of letters with those before them, over many texts as one sequence.

A task counts the letters inside its texts with numpy, for all lengths of context
in one pass, and hands on each text's ends. Counts are summed by a shuffle; the
ends, a short row a text, tell what runs over from one text to the next.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..functions import text as T
from ..sources.shared import stored

#: Letters counted at once, and distinct runs of letters that a task holds.
CHUNK, HELD = 1 << 20, 500_000
#: Between texts; no letter.
_GAP = 10


def count_runs(codes: np.ndarray, k: int, first: int = 0) -> Iterator[tuple[str, int]]:
    """Runs of k + 1 letters that end at place ``first`` or later and hold no gap, with how many there are."""
    if len(codes) <= k:
        return
    present = np.flatnonzero(np.bincount(codes))
    m = len(present)
    number = np.zeros(int(present[-1]) + 1, np.int64)
    number[present] = np.arange(m)
    place = np.arange(len(codes))
    gap = np.maximum.accumulate(np.where(codes == _GAP, place, -1))
    ends = place[(place - gap > k) & (place >= max(k, first))]
    if m ** (k + 1) >= 1 << 62:
        text = codes.astype("<u4").tobytes().decode("utf-32-le")
        yield from Counter(text[e - k : e + 1] for e in ends.tolist()).items()
        return
    ids = number[codes]
    keys = np.zeros(len(ends), np.int64)
    for back in range(k, -1, -1):
        keys = keys * m + ids[ends - back]
    if m ** (k + 1) <= 2 * len(keys) + (1 << 16):
        n = np.bincount(keys, minlength=1)
        found = np.flatnonzero(n)
        n = n[found]
    else:
        found, n = np.unique(keys, return_counts=True)
    letters = np.empty((len(found), k + 1), "<u4")
    for at in range(k, -1, -1):
        found, last = np.divmod(found, m)
        letters[:, at] = present[last]
    text = letters.tobytes().decode("utf-32-le")
    yield from zip((text[i : i + k + 1] for i in range(0, len(text), k + 1)), n.tolist(), strict=True)


def _counting(ks: tuple[int, ...], by: tuple[str, ...]):
    """A ``mapInArrow`` body: counts of runs by group, and the ends of each text."""
    most = max(ks)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = defaultdict(Counter)
        types: list[pa.DataType] = []

        def rows(keys: list[tuple], k, runs, n, at, head, tail) -> pa.RecordBatch:
            groups = [pa.array([key[i] for key in keys], t) for i, t in enumerate(types)]
            runs = [None] * len(keys) if runs is None else runs
            ctx, c = pa.array([r and r[:-1] for r in runs], pa.string()), pa.array([r and r[-1] for r in runs], pa.string())
            return pa.RecordBatch.from_arrays([*groups, pa.array(k, pa.int32()), ctx, c, pa.array(n, pa.int64()), pa.array(at, pa.int64()), pa.array(head, pa.string()), pa.array(tail, pa.string())], names=[*by, "_k", "ctx", "c", "n", "_at", "_head", "_tail"])

        def count(key: tuple, texts: list[str]) -> None:
            codes = np.frombuffer("\n".join(texts).encode("utf-32-le"), "<u4")
            for start in range(0, len(codes), CHUNK):
                before = max(0, start - most)
                part = codes[before : start + CHUNK].astype(np.int64)
                for k in ks:
                    held = counts[key, k]
                    for run, n in count_runs(part, k, start - before):
                        held[run] += n

        def handed() -> Iterator[pa.RecordBatch]:
            for (key, k), found in counts.items():
                m = len(found)
                yield rows([key] * m, [k] * m, list(found), list(found.values()), [None] * m, [None] * m, [None] * m)
            counts.clear()

        for batch in batches:
            types = [batch.schema.field(c).type for c in by]
            texts = batch.column("_letters").to_pylist()
            keys = list(zip(*(batch.column(c).to_pylist() for c in by), strict=True)) if by else [()] * len(texts)
            own, size = defaultdict(list), defaultdict(int)
            for key, text in zip(keys, texts, strict=True):
                own[key].append(text)
                size[key] += len(text)
                if size[key] >= CHUNK:
                    count(key, own.pop(key))
                    size[key] = 0
            for key, some in own.items():
                count(key, some)
            none = [None] * len(texts)
            yield rows(keys, none, None, none, batch.column("_at").to_pylist(), [t[:most] for t in texts], [t[-most:] if most else "" for t in texts])
            if sum(map(len, counts.values())) > HELD:
                yield from handed()
        yield from handed()

    return body


def counted(frame: DataFrame, text: str, ks: tuple[int, ...], order: str, by: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Counts ``_k, ctx, c, n`` inside the texts, by group, and ``_at, _head, _tail`` of each text; the texts are read once."""
    letters = frame.select(*by, F.col(order).cast("long").alias("_at"), T.letters(F.col(text)).alias("_letters")).where("_letters <> ''")
    fields = [letters.schema[c] for c in by]
    fields += [ST.StructField(n, t) for n, t in (("_k", ST.IntegerType()), ("ctx", ST.StringType()), ("c", ST.StringType()), ("n", ST.LongType()), ("_at", ST.LongType()), ("_head", ST.StringType()), ("_tail", ST.StringType()))]
    schema = ST.StructType([ST.StructField(f.name, f.dataType) for f in fields])
    rows = stored(letters.mapInArrow(_counting(ks, by), schema))
    return rows.where("_k is not null").select(*by, "_k", "ctx", "c", "n"), rows.where("_k is null").select(*by, "_at", "_head", "_tail")
