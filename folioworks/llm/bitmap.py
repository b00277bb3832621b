"""Bitmaps of hash keys: a filter of fixed size to broadcast.

A bitmap tells of a key whether it may be among the keys it was made of. It has
``BITS`` address bits at any input size; with many more keys than that it lets
more and more pass, so whatever it guards must be exact without it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26
MASK = (1 << BITS) - 1


def repeated(keys: DataFrame) -> DataFrame:
    """The values of the long column ``key`` that are there twice or more, counted before the shuffle."""
    return keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")


def bitmap(keys: DataFrame) -> np.ndarray:
    """The bitmap of the long column ``key``, as 64-bit words (8 MB)."""
    slot = F.col("key").bitwiseAND(F.lit(MASK))
    words = keys.select(F.shiftright(slot, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(key & {MASK} & 63 as int))").alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    found = np.zeros(1 << (BITS - 6), np.uint64)
    found[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return found


def among(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the unsigned keys may be in the bitmap."""
    slot = keys & np.uint64(MASK)
    return (words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1

