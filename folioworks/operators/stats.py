"""Descriptive and information-theoretic statistics of text tables.

Inputs are frames with a text column and, where order matters, columns to order
by. Counts are combined before each shuffle; ranks of whole vocabularies are
top-k plans; windows are partitioned, or run over rows already counted.
"""

from __future__ import annotations

import bz2
import gzip
import lzma
import random
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .grams import counted
from .streams import shuffled_compression, stream_compression


def _all():
    """A window over all rows; for counts that are few already."""
    return Window.partitionBy(F.lit(1))


def tokens(frame: DataFrame, text: str = "text", tokenizer: Callable[[Column], Column] = T.spaced_words, *keep: str) -> DataFrame:
    """``word``, a row each, beside the columns to keep."""
    return frame.select(*keep, F.explode(tokenizer(F.col(text))).alias("word"))


def counts(frame: DataFrame, key: str, *by: str) -> DataFrame:
    return frame.groupBy(*by, key).agg(F.count("*").alias("n"))


def top(counted: DataFrame, key: str, k: int) -> DataFrame:
    """The k highest counts; of equals the smaller keys."""
    return counted.orderBy(F.desc("n"), F.asc(key)).limit(k)


def top_within(counted: DataFrame, key: str, k: int, *by: str) -> DataFrame:
    """The k highest counts in each group, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.desc("n"), F.asc(key))
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def shares(counted: DataFrame, *by: str, percent: bool = True, of: DataFrame | None = None) -> DataFrame:
    """Counts with their share of the total, or of their group's; ``of`` are the counts that make the total, if not these."""
    whole = of if of is not None else counted
    part = F.col("n") * (100.0 if percent else 1.0) / F.col("_total")
    name = "pct" if percent else "share"
    if by:
        return counted.join(whole.groupBy(*by).agg(F.sum("n").alias("_total")), list(by)).withColumn(name, part).drop("_total")
    # One row of a sum.
    return counted.crossJoin(F.broadcast(whole.agg(F.sum("n").alias("_total")))).withColumn(name, part).drop("_total")


def vocabulary(word_counts: DataFrame) -> DataFrame:
    """One row: tokens, types, their ratio, words met once and twice and their shares."""
    sums = word_counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("types"), F.count_if(F.expr("n = 1")).alias("hapax"), F.count_if(F.expr("n = 2")).alias("dis"))
    return sums.select(
        F.coalesce("tokens", F.lit(0)).alias("tokens"),
        "types",
        "hapax",
        "dis",
        (F.col("types") / F.col("tokens")).alias("ttr"),
        (F.col("hapax") / F.nullif(F.col("types"), F.lit(0))).alias("hapax_of_types"),
        (F.col("hapax") / F.col("tokens")).alias("hapax_of_tokens"),
    )


def longest_hapax(word_counts: DataFrame, k: int = 10) -> DataFrame:
    once = word_counts.where("n = 1").select("word", F.char_length("word").alias("length"))
    return once.orderBy(F.desc("length"), "word").limit(k)


def _ranked_value(counted: DataFrame, value: str) -> DataFrame:
    """The upper median of a value from its counts: the value at place n div 2 of the sorted rows."""
    upto = Window.partitionBy(F.lit(1)).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(_all()))
    return placed.where("upto > all div 2").agg(F.min(value).alias("upper_median"))


def spread(frame: DataFrame, value: str) -> DataFrame:
    """One row: n, least, greatest, mean and upper median of a whole-number column.

    The median comes from counts of the distinct values, not from sorted rows.
    """
    counted = frame.groupBy(value).agg(F.count("*").alias("n"))
    sums = counted.agg(F.sum("n").alias("n"), F.min(value).alias("least"), F.max(value).alias("greatest"), (F.sum(F.col(value) * F.col("n")) / F.sum("n")).alias("mean"))
    return sums.crossJoin(F.broadcast(_ranked_value(counted, value)))


def histogram(frame: DataFrame, value: str, first: int, last: int) -> DataFrame:
    """Counts of the values first .. last, zeros too."""
    axis = frame.sparkSession.range(first, last + 1).select(F.col("id").alias(value))
    counted = frame.where(F.col(value).between(first, last)).groupBy(F.col(value).cast("long").alias(value)).agg(F.count("*").alias("n"))
    return axis.join(counted, value, "left").select(value, F.coalesce("n", F.lit(0)).alias("n"))


def moments(frame: DataFrame, value: str) -> DataFrame:
    """Mean, population variance and deviation, and their ratio."""
    sums = frame.agg(F.avg(value).alias("mean"), F.var_pop(value).alias("variance"), F.stddev_pop(value).alias("deviation"))
    return sums.withColumn("variation", F.col("deviation") / F.col("mean"))


def entropy(counted: DataFrame, *by: str) -> DataFrame:
    """Shannon entropy in bits of counts ``n``, in all or by group, and the bits of equal use (``h0``)."""
    # H = log2 N - (sum of n log2 n) / N needs one pass over the counts.
    sums = counted.groupBy(*by).agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log2("n")).alias("weighted"), F.count("*").alias("distinct"))
    return sums.select(*by, "total", "distinct", (F.log2("total") - F.col("weighted") / F.col("total")).alias("entropy"), F.log2("distinct").alias("h0"))


def conditional_entropy(grams: DataFrame, *by: str) -> DataFrame:
    """Entropy of ``c`` given ``ctx``, from counts ``n`` of both."""
    within = grams.groupBy(*by, "ctx").agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log2("n")).alias("weighted"))
    sums = within.groupBy(*by).agg(F.sum("total").alias("n_grams"), F.sum(F.col("total") * F.log2("total") - F.col("weighted")).alias("bits"))
    return sums.select(*by, "n_grams", (F.col("bits") / F.col("n_grams")).alias("entropy"))


def character_counts(frame: DataFrame, text: str, *by: str) -> DataFrame:
    """Counts of ``c``, the characters of a text."""
    chars = frame.select(*by, F.explode(F.split(text, "")).alias("c")).where("c <> ''")
    return chars.groupBy(*by, "c").agg(F.count("*").alias("n"))


def presence(counted: DataFrame, marks: str) -> DataFrame:
    """Of each of some characters, whether and how often the counts ``c, n`` have it."""
    wanted = counted.sparkSession.createDataFrame([(m,) for m in marks], "c string")
    found = wanted.join(counted.where(F.col("c").isin(*marks)), "c", "left")
    return found.select("c", F.col("n").isNotNull().alias("present"), F.coalesce("n", F.lit(0)).alias("n"))


def _grams(chars: str, k: int) -> Column:
    """Structs of each character that has k before it (``c``), and those (``ctx``).

    ``chars`` is a column of characters, computed before: inside the lambda an
    expression would be evaluated again for every place.
    """
    array = F.col(chars)
    places = F.when(F.size(array) > k, F.sequence(F.lit(k), F.size(array) - 1))
    return F.transform(places, lambda i: F.struct(F.concat(*(F.get(array, i - j) for j in range(k, 0, -1))).alias("ctx"), F.get(array, i).alias("c")))


def letter_grams(frame: DataFrame, text: str, k: int, *by: str) -> DataFrame:
    """Counts of ``ctx, c`` within each text's letters."""
    chars = frame.select(*by, F.filter(F.split(T.letters(F.col(text)), ""), lambda c: c != "").alias("chars"))
    rows = chars.select(*by, F.explode(_grams("chars", k)).alias("g"))
    return rows.groupBy(*by, "g.ctx", "g.c").agg(F.count("*").alias("n"))


def _carried_over(ends: DataFrame, k: int, order: str, *by: str) -> DataFrame:
    """``ends`` with ``start``, the last k letters of the ``tail`` column's values before each row, in the order of a whole number."""
    before = lambda over: F.right(F.concat(*(F.coalesce(F.lag("tail", i).over(over), F.lit("")) for i in range(k, 0, -1))), F.lit(k))
    return ends.withColumn("start", before(Window.partitionBy(*(by or [F.lit(1)])).orderBy(order)))


def _tails(rows: DataFrame, k: int, order: list[str], *by: str) -> DataFrame:
    """By group, the last k letters of its rows' tails in order: of its last k rows at most."""
    backwards = Window.partitionBy(*by).orderBy(*(F.desc(c) for c in order))
    lasts = rows.select(*by, "tail", F.row_number().over(backwards).alias("place")).where(F.col("place") <= k)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(-F.col("place"), "tail"))), lambda x: x.tail), "")
    return lasts.groupBy(*by).agg(F.right(joined, F.lit(k)).alias("tail"))


def running_letter_grams(frame: DataFrame, text: str, k: int, order: str, bucket: int = 1000, group: int = 1000, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts of ``ctx, c`` over the letters of all texts as one sequence, or one a group, in the order of a whole number."""
    return running_letter_counts(frame, text, (k,), order, bucket, group, by)[k]


def running_letter_counts(frame: DataFrame, text: str, ks: tuple[int, ...], order: str, bucket: int = 1000, group: int = 1000, by: tuple[str, ...] = ()) -> dict[int, DataFrame]:
    """The same for several numbers of letters before each, from one pass over the texts; with 0 ``ctx`` is empty.

    Contexts inside a text are counted where the text is read. Those that run
    over from one text to the next need only each text's first and last
    letters: these short rows are put in buckets of the order column, and
    buckets in groups. What comes before a text is found from its neighbours in
    the bucket, for a bucket's first texts from the ends of the buckets before,
    for a group's first buckets from the ends of the groups before. No task
    orders all texts, nor all buckets.
    """
    inside, edges = counted(frame, text, ks, order, by)
    most = max(ks)
    edges = edges.select(*by, F.col("_at").alias("at"), F.floor(F.col("_at") / bucket).alias("bucket"), F.col("_head").alias("head"), F.col("_tail").alias("tail"))
    edges = edges.withColumn("group", F.floor(F.col("bucket") / group))
    before = lambda over: F.right(F.concat(*(F.coalesce(F.lag("tail", i).over(over), F.lit("")) for i in range(most, 0, -1))), F.lit(most))
    near = edges.withColumn("near", before(Window.partitionBy(*by, "group", "bucket").orderBy("at", "head", "tail"))) if most else edges
    buckets = _carried_over(_tails(edges, most, ["at", "head", "tail"], *by, "group", "bucket"), most, "bucket", *by, "group") if most else edges
    groups = _carried_over(_tails(buckets, most, ["bucket"], *by, "group"), most, "group", *by) if most else edges

    def joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        same = reduce(lambda x, y: x & y, (F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in keys))
        return left.alias("l").join(right.alias("r"), same).select("l.*", "r.start")

    if most:
        starts = joined(buckets.withColumnRenamed("start", "here"), groups, [*by, "group"]).select(*by, "group", "bucket", F.right(F.concat("start", "here"), F.lit(most)).alias("start"))
        reached = joined(near, starts, [*by, "group", "bucket"]).select(*by, F.concat("start", "near").alias("left"), "head")

    def of(k: int) -> DataFrame:
        rows = inside.where(F.col("_k") == k).select(*by, "ctx", "c", "n")
        if k:
            run = reached.select(*by, F.concat(F.right("left", F.lit(k)), F.left("head", F.lit(k))).alias("run"))
            across = run.select(*by, F.filter(F.split("run", ""), lambda c: c != "").alias("chars")).select(*by, F.explode(_grams("chars", k)).alias("g"))
            rows = rows.union(across.select(*by, "g.ctx", "g.c", F.lit(1).cast("long").alias("n")))
        return rows.groupBy(*by, "ctx", "c").agg(F.sum("n").alias("n"))

    return {k: of(k) for k in ks}


def bigram_ratios(grams: DataFrame, singles: DataFrame, k: int = 15) -> DataFrame:
    """The most frequent pairs with observed over expected; ``singles`` are counts of ``c``."""
    total = singles.agg(F.sum("n").alias("all"))
    left = singles.select(F.col("c").alias("ctx"), F.col("n").alias("n1"))
    right = singles.select("c", F.col("n").alias("n2"))
    best = grams.orderBy(F.desc("n"), "ctx", "c").limit(k)
    rows = best.join(left, "ctx").join(right, "c").crossJoin(F.broadcast(total))
    return rows.select(F.concat("ctx", "c").alias("pair"), "n", (F.col("n") / (F.col("n1") / F.col("all") * F.col("n2") / F.col("all") * (F.col("all") - 1))).alias("ratio"))


def missing_bigrams(grams: DataFrame, singles: DataFrame, common: int = 10, least: float = 10, k: int = 10) -> DataFrame:
    """Pairs of the most common characters that never meet though ``least`` were expected.

    The product is of ``common`` characters with themselves.
    """
    best = singles.orderBy(F.desc("n"), "c").limit(common)
    total = singles.agg(F.sum("n").alias("all"))
    pairs = best.select(F.col("c").alias("ctx"), F.col("n").alias("n1")).crossJoin(F.broadcast(best.select("c", F.col("n").alias("n2"))))
    absent = pairs.join(grams.select("ctx", "c"), ["ctx", "c"], "left_anti").crossJoin(F.broadcast(total))
    rows = absent.select(F.concat("ctx", "c").alias("pair"), (F.col("n1") / F.col("all") * F.col("n2") / F.col("all") * F.col("all")).alias("expected"))
    return rows.where(F.col("expected") > least).orderBy(F.desc("expected"), "pair").limit(k)


def position_counts(words: DataFrame, places: int = 8) -> DataFrame:
    """Counts of ``c`` by its place in the word, 1 .. ``places``."""
    rows = words.select(F.posexplode(F.split(F.left("word", F.lit(places)), "")).alias("at", "c")).where("c <> ''")
    return rows.groupBy((F.col("at") + 1).alias("place"), "c").agg(F.count("*").alias("n"))


def edge_words(frame: DataFrame, text: str, tokenizer: Callable[[Column], Column] = T.words) -> DataFrame:
    """Counts of words by where they stand in their line: initial, middle or final."""
    lines = frame.select(tokenizer(F.col(text)).alias("w")).withColumn("size", F.size("w"))
    each = F.concat(
        F.when(F.col("size") >= 1, F.array(F.struct(F.lit("initial").alias("place"), F.try_element_at("w", F.lit(1)).alias("word")))).otherwise(F.array().cast("array<struct<place:string,word:string>>")),
        F.when(F.col("size") >= 2, F.array(F.struct(F.lit("final").alias("place"), F.try_element_at("w", F.lit(-1)).alias("word")))).otherwise(F.array().cast("array<struct<place:string,word:string>>")),
        F.transform(F.when(F.col("size") >= 3, F.slice("w", 2, F.greatest(F.col("size") - 2, F.lit(0)))).otherwise(F.array().cast("array<string>")), lambda x: F.struct(F.lit("middle").alias("place"), x.alias("word"))),
    )
    rows = lines.select(F.explode(each).alias("x")).select("x.place", "x.word")
    return rows.groupBy("place", "word").agg(F.count("*").alias("n"))


def letter_ends(word_counts: DataFrame) -> DataFrame:
    """Counts of first and last characters over all tokens."""
    both = F.array(F.struct(F.lit("initial").alias("place"), F.left("word", F.lit(1)).alias("c")), F.struct(F.lit("final").alias("place"), F.right("word", F.lit(1)).alias("c")))
    rows = word_counts.select("n", F.explode(both).alias("x"))
    return rows.groupBy("x.place", "x.c").agg(F.sum("n").alias("n"))


def vocabulary_only_in(words: DataFrame, key: str, here: str, there: str) -> DataFrame:
    """Distinct words of one group that the other lacks."""
    ours = words.where(F.col(key) == here).select("word").distinct()
    return ours.join(words.where(F.col(key) == there).select("word"), "word", "left_anti")


def group_summary(frame: DataFrame, key: str, page: str, chars: str, words: str) -> DataFrame:
    """Pages, lines, characters and words by a key; null is ``unknown``."""
    return frame.groupBy(F.coalesce(F.col(key), F.lit("unknown")).alias(key)).agg(
        F.count_distinct(page).alias("n_pages"), F.count("*").alias("n_lines"), F.sum(chars).alias("n_chars"), F.sum(words).alias("n_words")
    )


def _compressors() -> dict[str, Callable[[bytes], bytes]]:
    return {"gzip": gzip.compress, "bz2": bz2.compress, "lzma": lzma.compress}


def compression(frame: DataFrame, text: str, *by: str, shuffled: bool = False, seed: int = 42, salt: str | None = None) -> DataFrame:
    """Compressed size over size of each text, or of its characters shuffled, by compressor.

    Texts are shuffled by ``seed`` and, if named, the number in the column ``salt``.
    """

    @F.pandas_udf("struct<gzip:double,bz2:double,lzma:double>")
    def ratios(texts: pd.Series, salts: pd.Series) -> pd.DataFrame:
        rows = []
        for value, more in zip(texts, salts, strict=True):
            chars = list(value or "")
            if shuffled:
                random.Random(seed + int(more)).shuffle(chars)
            data = "".join(chars).encode()
            rows.append({name: len(squash(data)) / len(data) if data else None for name, squash in _compressors().items()})
        return pd.DataFrame(rows, columns=["gzip", "bz2", "lzma"], dtype=float)

    return frame.select(*by, F.octet_length(text).alias("n_bytes"), F.char_length(T.letters(F.col(text))).alias("n_letters"), ratios(text, F.col(salt) if salt else F.lit(0)).alias("r")).select(
        *by, "n_bytes", "n_letters", "r.*", *((F.col(f"r.{k}") * F.col("n_bytes") * 8 / F.nullif(F.col("n_letters"), F.lit(0))).alias(f"{k}_bits") for k in ("gzip", "bz2", "lzma"))
    )


def corpus_compression(frame: DataFrame, text: str, order: str, shuffled: bool = False, seed: int = 42) -> DataFrame:
    """Compression of all texts in order, or of their characters shuffled: a row a block, and one, ``block`` -1, of the corpus as one stream."""
    return shuffled_compression(frame, text, seed) if shuffled else stream_compression(frame, text, order)


def overview(frame: DataFrame, page: str, chars: str, words: str) -> DataFrame:
    """One row: lines, pages, characters and words, and their averages."""
    sums = frame.agg(F.count("*").alias("lines"), F.count_distinct(page).alias("pages"), F.coalesce(F.sum(chars), F.lit(0)).alias("characters"), F.coalesce(F.sum(words), F.lit(0)).alias("words"))
    ratio = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0))
    return sums.select("*", ratio("lines", "pages").alias("lines_per_page"), ratio("characters", "lines").alias("chars_per_line"), ratio("words", "lines").alias("words_per_line"))


def letter_entropies(frame: DataFrame, text: str, order: str, highest: int = 4) -> DataFrame:
    """One row: ``h0``, ``h1`` and the conditional entropies ``h2`` .. of the letters of all texts as one sequence."""
    found = running_letter_counts(frame, text, tuple(range(highest)), order)
    rows = entropy(found[0]).select(F.col("total").alias("letters"), "h0", F.col("entropy").alias("h1"))
    for k in range(1, highest):
        rows = rows.crossJoin(F.broadcast(conditional_entropy(found[k]).select(F.col("entropy").alias(f"h{k + 1}"))))
    return rows


def summary(frame: DataFrame, text: str, page: str, order: str | None = None) -> dict:
    """The headline figures of a corpus, for a report: overview, vocabulary, letters, compression; in the order of ``order`` or ``page``."""
    order = order or page
    sized = frame.select("*", F.char_length(text).alias("_chars"), F.size(T.spaced_words(F.col(text))).alias("_words"))
    words = vocabulary(counts(tokens(frame, text), "word")).first().asDict()
    letters = letter_entropies(frame, text, order).first()
    squeezed = corpus_compression(frame, text, order).where("block = -1").first()
    best = {r.c: r.n for r in top(character_counts(frame.select(T.letters(F.col(text)).alias(text)), text), "c", 20).collect()}
    return overview(sized, page, "_chars", "_words").first().asDict() | words | (letters.asDict() if letters else {}) | {"compression": squeezed.asDict() if squeezed else None, "top_letters": best}
