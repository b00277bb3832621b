"""SimHash near-duplicate detection over a byte-position inverted index.

Texts are lower-cased (A-Z), cut into words at ASCII white space and hashed by
three-word shingles; 64 majority votes give a fingerprint. Fingerprints within
``distance`` = 2 bits of each other link, and components of links are classes.

Two such fingerprints differ in at most two of eight bytes, so they share at
least six positional bytes. The inverted index posts every distinct fingerprint
under its positional bytes, four positions to a posting key: the eight
positions form four neighbouring pairs, of which two at least must agree, which
makes six keys. A posting holds the positional bytes beyond its key, so a pair
from one list has a tally of the four bytes of the key and of those further
positions that agree. Pairs whose tally reaches six, the guaranteed least, are
kept and verified by counting bits.

Long posting lists do not emit pairs: within a list only the 32 bits beyond the
key can differ, so each fingerprint is posted again under the 33 values that
lie at most one bit off there. Two fingerprints are within two bits exactly if
such a value is common to them, and one value has 33 fingerprints at most. This
finds the same links in linear space; no list is cut short.

Nulls and texts without words have the fingerprint zero. Rows of one doc_id
are kept apart as rows; their classes are told apart by ``root``, the smallest
fingerprint of a class, as two classes can have the same smallest doc_id. Rows
without an id are of classes like others; a class of such rows alone has no
``component_id``. Texts of any length are hashed whole, their votes counted in
parts. An empty table gives an empty result. Columns other than the id and the
text are ignored, whatever they are called.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import among, bitmap
from .common import free_names, join_sized, map_rows, per_row, scratch, small_batches, stored
from .components import connected_components

SHINGLE = 3
DISTANCE = 2
SEED = 42
LONG_LIST = 64
POSITIONS = 8
PAIR_KEYS = list(combinations(range(4), 2))


def fingerprint(text: str | None) -> int:
    """The SimHash of one text, unsigned."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return digest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :], strict=False)], np.uint64)
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        part = hashes[i : i + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes), bitorder="little").tobytes(), "little")


def _signed(doc_id, text, *keys):
    value = fingerprint(text)
    return doc_id, value - (1 << 64) if value >> 63 else value, *keys


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: dict | None = None) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long; then ``keys``, longs by name."""
    keys = keys or {}
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *(c.alias(n) for n, c in keys.items()))
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "fp", *keys)])
    return map_rows(rows, per_row(schema, _signed, "doc_id", "text", *keys), ", ".join(f"{n} long" for n in schema.names))


def _posting_key(i: int, j: int, number: int):
    """Positional bytes of pairs i and j, with the key's number on top."""
    part = lambda k: F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))
    return F.lit(number << 32).cast("long") + F.shiftleft(part(i), 16) + part(j)


def _other_bits(i: int, j: int) -> list[int]:
    """Zero and the 32 single bits outside pairs i and j, as signed longs."""
    bits = [1 << (16 * k + n) for k in range(4) if k not in (i, j) for n in range(16)]
    return [0, *(b - (1 << 64) if b >> 63 else b for b in bits)]


def links(distinct: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """Pairs (x < y) of distinct fingerprints that the classes rest on.

    Short posting lists give every pair within the distance; long ones give
    for each shared value the pairs with its smallest fingerprint, which
    connects the same fingerprints.
    """
    keys = F.array(*(_posting_key(i, j, n) for n, (i, j) in enumerate(PAIR_KEYS)))
    posted = stored(distinct.select("fp", F.explode(keys).alias("key")))
    sizes = posted.groupBy("key").count().where("count > 1")
    lists = posted.join(sizes, "key")
    short = lists.where(F.col("count") <= long_list).groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    pairs = F.flatten(
        F.transform("fps", lambda x, i: F.transform(F.slice("fps", i + 2, long_list), lambda y: F.struct(x.alias("x"), y.alias("y"))))
    )
    near = short.select("key", F.explode(pairs).alias("p")).select("key", "p.x", "p.y")
    masks = F.array(*(F.array(*(F.lit(b).cast("long") for b in _other_bits(i, j))) for i, j in PAIR_KEYS))
    number = F.shiftright("key", 32).cast("int")
    spread = lists.where(F.col("count") > long_list).select("key", "fp", F.explode(F.element_at(masks, number + 1)).alias("mask"))
    hubs = spread.groupBy("key", F.col("fp").bitwiseXOR(F.col("mask")).alias("hub")).agg(F.sort_array(F.collect_set("fp")).alias("fps"))
    far = hubs.where(F.size("fps") > 1).select("key", F.element_at("fps", 1).alias("x"), F.explode(F.slice("fps", 2, 33)).alias("y"))
    differ = F.col("x").bitwiseXOR(F.col("y"))
    agree = [(F.shiftrightunsigned(differ, 8 * n).bitwiseAND(F.lit(0xFF)) == 0).cast("int") for n in range(POSITIONS)]
    # Of each key, how many positions beyond its own four agree.
    beyond = F.array(*(sum(agree[n] for n in range(POSITIONS) if n // 2 not in pair) for pair in PAIR_KEYS))
    tallied = near.union(far).withColumn("tally", F.lit(POSITIONS // 2) + F.element_at(beyond, number + 1))
    counted = tallied.where(F.col("tally") >= POSITIONS - DISTANCE)
    return counted.where(F.bit_count(differ) <= DISTANCE).select("x", "y").distinct()


def simhash_classes(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_list: int = LONG_LIST) -> DataFrame:
    """One row a document: ``doc_id``, ``fp`` and ``component_id``, the smallest doc_id of its class."""
    with scratch(documents.sparkSession) as kept:
        return kept(_rooted(fingerprints(documents, id_col, text_col), long_list).select("doc_id", "fp", "component_id"))


def one_of_each_class(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_list: int = LONG_LIST) -> DataFrame:
    """The rows of ``documents`` without the others of their classes, with all their columns.

    A class keeps its first row by id (null last), fingerprint, and hashes of
    the text and of the whole row, so a rerun chooses the same one; rows alike in
    every column count as one. Only rows that may have to go are shuffled, which
    a bitmap of fixed size tells.
    """
    spark = documents.sparkSession
    text = F.col(text_col).cast("string")
    hashes = {"text_hash": F.xxhash64(text), "row_hash": F.xxhash64(*(F.col(c) for c in documents.columns))}
    added = free_names(documents, "_dup_id", "_dup_text", "_dup_row", "_dup_first", "_dup_here", "_dup_maybe", "_dup_body")
    id_of, text_of, row_of, first, here_hash, is_maybe, body_hash = added
    names = {"doc_id": id_of, "text_hash": text_of, "row_hash": row_of}
    with scratch(spark) as kept:
        classes = _rooted(fingerprints(documents, id_col, text_col, hashes), long_list)
        rows = stored(classes.groupBy("root", "fp", *names).agg(F.count("*").alias("n")))
        order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp", "text_hash", "row_hash")
        firsts = rows.groupBy("root").agg(F.min(order).alias("first"), F.sum("n").alias("all"), F.count("*").alias("kinds")).where(F.col("all") > 1)
        known = join_sized(rows, firsts, ["root"], "kinds", rows.count()).withColumn(first, order == F.col("first"))
        # Rows that go, and those that stay once though they are there twice.
        marked = known.where(~F.col(first) | (F.col("n") > 1)).select(*(F.col(c).alias(x) for c, x in names.items()), first).distinct()
        marked = kept(marked)
    held = spark.sparkContext.broadcast(bitmap(marked.select(F.col(row_of).alias("key"))))

    @F.pandas_udf("boolean")
    def maybe(keys: pd.Series) -> pd.Series:
        return pd.Series(among(held.value, keys.to_numpy(np.int64).view(np.uint64)))

    here = small_batches(documents).withColumn(here_hash, hashes["row_hash"]).withColumn(is_maybe, maybe(here_hash))
    same = (F.col(here_hash) == F.col(row_of)) & (F.col(body_hash) == F.col(text_of)) & F.col(id_col).cast("long").eqNullSafe(F.col(id_of))
    near = here.where(F.col(is_maybe)).withColumn(body_hash, hashes["text_hash"]).join(marked, same, "left")
    once = near.where(F.col(first)).dropDuplicates([id_of, text_of, row_of])
    stay = here.where(~F.col(is_maybe)).select(documents.columns).union(near.where(F.col(first).isNull()).select(documents.columns))
    return stay.union(once.select(documents.columns))


def _rooted(prints: DataFrame, long_list: int) -> DataFrame:
    """Fingerprints with ``root`` and ``component_id`` of their classes."""
    prints = stored(prints)
    least = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")))
    roots = connected_components(links(least.select("fp"), long_list), "x", "y").withColumnRenamed("node", "fp")
    rooted = stored(least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    components = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("prints"))
    classes = stored(join_sized(rooted, components, ["root"], "prints", rooted.count()))
    return join_sized(prints, classes.select("fp", "root", "component_id", "rows"), ["fp"], "rows", prints.count()).drop("rows")
