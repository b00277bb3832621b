"""Mixing sources to target weights, with DataFrame operations only.

A document's tokens are its words. Each source's documents, laid end to end,
are a token stream that is packed into blocks of ``block`` words. The mix is a
sequence of slots, cut into output shards of ``shard`` slots; each slot takes
one block.

* Targets: sources in code point order (null last) weigh 1, 2, 3, repeating.
  The targets share the words of the whole table by weight, none above three
  times its source's words; what a capped source leaves is shared by weight.
* Draws: each slot draws its source from the weights by a hash of its number,
  which makes multinomial counts of the sources in every shard.
* Streams: a source's slots are numbered through all shards. Slot k takes
  block ``perm(k mod blocks)`` of the source, ``perm`` being a keyed Feistel
  network over the block numbers, walked until it is back among them.
* Ends: a stream ends when its target is reached, so its last block may be cut;
  what the draws leave short of the target is drawn in a last shard. Each pass
  of a stream takes every word of the source once and no stream has more than
  three passes, so no document is taken more than three times.

Prefix sums over a hot source are split. Rows that are alike in source, id and
text are counted first; they have one place together, and are numbered in it by
the file part they come from. Places are summed in cells of a hash of id and
text, cells in groups of cells, and each window is one cell, one group of cells,
or one source's groups. Shards are summed the same way. Up to ``MOST_SOURCES``
sources one task orders them; beyond that they are ranked by ranges, the common
level of the targets is found by sums, and what is joined is not broadcast.
Everything depends on hashes of ids, texts and numbers alone, so reruns agree;
rows that are alike may trade places.

Null texts have no words and are not taken, nor are very long ones treated
otherwise: a document fills as many blocks as it needs. Repeated and null doc_ids
are separate rows. An empty table gives an empty result. Other columns are
ignored, whatever they are called.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, stored

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 64
SHARD = 4096
CAP = 3
CELL_ROWS = 1_000
#: Cells or shards that one window of a prefix sum orders.
GROUP = 4_096
ROUNDS = 8
#: Steps of a walk back among n numbers; fewer than 17 are outside if n is up to 256, one in 16 at most if it is larger.
WALK = 17
#: Slots that a task draws: so many at most, and so many at least if there are cores to spare.
MOST_SLOTS, LEAST_SLOTS = 2_000_000, 20_000
SEED = 7
MOST_SOURCES = 20_000
#: Sources up to which a slot finds its own among the bounds of all by counting.
FEW_SOURCES = 64


def sizes(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *others: str) -> DataFrame:
    """``doc_id``, ``source``, ``size`` and other columns of every document."""
    words = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words.alias("size"), *others)


def before(frame: DataFrame, by: str, at: str, value: str, name: str, places: int) -> DataFrame:
    """``frame`` with ``name``, the sum of ``value`` at the places before ``at`` (a whole number) of the same ``by``.

    There is one row a place, and ``places`` of them in a ``by`` at most. Windows
    cover ``GROUP`` places, or the groups.
    """
    if places <= GROUP:
        earlier = Window.partitionBy(by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        return frame.withColumn(name, F.coalesce(F.sum(value).over(earlier), F.lit(0)).cast("long"))
    group = GROUP
    grouped = frame.withColumn("_group", F.floor(F.col(at) / group))
    earlier = Window.unboundedPreceding, -1
    sums = grouped.groupBy(by, "_group").agg(F.sum(value).alias("_sum"))
    bases = sums.select(F.col(by).alias("_by"), F.col("_group").alias("_at"), F.coalesce(F.sum("_sum").over(Window.partitionBy(by).orderBy("_group").rowsBetween(*earlier)), F.lit(0)).alias("_base"))
    inside = grouped.withColumn("_inside", F.coalesce(F.sum(value).over(Window.partitionBy(by, "_group").orderBy(at).rowsBetween(*earlier)), F.lit(0)))
    joined = inside.join(bases, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_group") == F.col("_at")))
    return joined.withColumn(name, (F.col("_base") + F.col("_inside")).cast("long")).drop("_by", "_at", "_base", "_inside", "_group")


def _weighed(by_source: DataFrame, sources: int) -> DataFrame:
    """``by_source`` with ``weight``: 1, 2, 3, repeating, in code point order, null last."""
    order = F.col("source").asc_nulls_last()
    if sources <= MOST_SOURCES:
        return by_source.withColumn("weight", (F.row_number().over(Window.orderBy(order)) - 1) % 3 + 1)
    parts = math.ceil(sources / MOST_SOURCES)
    ranged = stored(by_source.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id()))
    ranked = ranged.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1)
    # One row a part.
    first = ranged.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first"))
    return ranked.join(F.broadcast(first), "_part").withColumn("weight", ((F.col("_first") + F.col("_rank")) % 3 + 1).cast("int")).drop("_part", "_rank", "_first")


def targets(sized: DataFrame, cap: int = CAP) -> DataFrame:
    """``source``, ``source_size``, ``weight`` and ``target``: water filled up to the caps.

    A source is capped if its cap is below its weight times the common level,
    and the level is what the caps leave of all words, by the weights of the
    rest. From the level without caps on, the sources that a level caps give the
    next level, until no more are capped. Only sums leave Spark.
    """
    by_source = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    sources = by_source.count()
    weighed = stored(_weighed(by_source, sources))
    most = F.lit(cap) * F.col("source_size")
    level, capped = None, -1
    while True:
        over = F.lit(False) if level is None else most < F.lit(level) * F.col("weight")
        total, held, weight, n = weighed.agg(F.sum("source_size"), F.sum(F.when(over, most).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))), F.count_if(over)).first()
        if n == capped or not weight:
            break
        level, capped = (total - held) / weight, n
    target = F.least(F.lit(level).cast("double") * F.col("weight"), most.cast("double"))
    return weighed.select("source", "source_size", "weight", F.when(F.col("source_size") > 0, target).otherwise(0.0).alias("target"))


def _round(at: Column, key: Column, wide: Column, high: Column, rounds: list[int]) -> Column:
    """One pass of a Feistel network over the numbers below ``wide * high``; the rounds backwards undo it.

    A number is a pair of a left and a right part below ``wide`` and ``high``,
    and each round adds a hash of one part to the other.
    """
    start = F.struct((at % wide).cast("long").alias("left"), F.floor(at / wide).cast("long").alias("right"))
    sign = 1 if rounds == sorted(rounds) else -1

    def add(pair: Column, r: Column) -> Column:
        to_left = F.pmod(pair.left + sign * F.pmod(F.xxhash64(key, F.lit(SEED), r, pair.right), wide), wide)
        to_right = F.pmod(pair.right + sign * F.pmod(F.xxhash64(key, F.lit(SEED), r, pair.left), high), high)
        even = r % 2 == 0
        return F.struct(F.when(even, to_left).otherwise(pair.left).alias("left"), F.when(even, pair.right).otherwise(to_right).alias("right"))

    return F.aggregate(F.array(*map(F.lit, rounds)), start, add, lambda pair: pair.right * wide + pair.left)


def permuted(frame: DataFrame, number: str, name: str, backwards: bool = False) -> DataFrame:
    """``frame`` with ``name``, a keyed permutation of ``number`` in 0 .. ``blocks`` - 1.

    ``wide`` is the root of ``blocks``, rounded up. A number that a pass takes
    beyond ``blocks`` is passed on until it is back below.
    """
    rounds = list(range(ROUNDS))[:: -1 if backwards else 1]
    key, wide, size = F.col("key"), F.col("wide"), F.col("blocks")
    high = F.ceil(size / wide).cast("long")
    step = lambda at: _round(at, key, wide, high, rounds)
    once = frame.withColumn(name, step(F.col(number)))
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.col(name), lambda at, _: F.when(at < size, at).otherwise(step(at)))
    return once.withColumn(name, F.when(F.col(name) < size, F.col(name)).otherwise(walk))


def _longs(numbers: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'bigint({n})' for n in numbers)})") if numbers else F.array().cast("array<bigint>")


def plan_streams(sized: DataFrame, block: int = BLOCK, aims: DataFrame | None = None) -> DataFrame:
    """One row a source with text: its words, blocks, target and number of slots (``slots``); ``aims`` are the targets, if at hand.

    ``short_at`` is the place, in each pass, of the source's last block, which
    may be short; slot k starts at word pass * source_size + place * block, less
    what the short block lacks if that came before.
    """
    planned = (aims or targets(sized)).withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    planned = planned.withColumn("key", F.coalesce(F.xxhash64("source"), F.lit(0).cast("long")))
    planned = planned.where("source_size > 0").withColumn("last", F.col("blocks") - 1).withColumn("wide", F.ceil(F.sqrt(F.col("blocks"))).cast("long"))
    planned = permuted(planned, "last", "short_at", backwards=True)
    planned = planned.withColumn("goal", F.round("target").cast("long")).withColumn("lacks", F.col("blocks") * block - F.col("source_size"))
    passes, over = F.floor(F.col("goal") / F.col("source_size")).cast("long"), F.col("goal") % F.col("source_size")
    # Words of the places 0 .. p of a pass; the last place is the first whose end reaches what is over.
    even = F.ceil(over / block).cast("long")
    place = F.when(even <= F.col("short_at"), even).otherwise(F.ceil((over + F.col("lacks")) / block).cast("long"))
    return planned.withColumn("slots", passes * F.col("blocks") + place)


def _small(by_source: DataFrame, sources: int) -> DataFrame:
    """``by_source``, broadcast unless there are too many sources."""
    return by_source if sources > MOST_SOURCES else F.broadcast(by_source)


def _keys_by_range(drawn: DataFrame, planned: DataFrame, total: int, sources: int) -> DataFrame:
    """``shard, slot, key``: the source in whose range of the summed weights each draw ``at`` lies.

    Ranges are split at multiples of the mean weight, so draws and ranges meet
    by an equal number; both sides together make twice the draws at most.
    """
    width = max(1, total // sources)
    # Keys are hashes; their order is summed in groups of like first bits.
    bits = max(0, 64 - math.ceil(math.log2(max(1, sources / GROUP) + 1)))
    rows = planned.where("slots > 0").select("key", "slots", F.shiftright("key", bits - 1).alias("_bits") if 0 < bits < 64 else F.lit(0).alias("_bits"))
    earlier = Window.unboundedPreceding, -1
    bases = rows.groupBy("_bits").agg(F.sum("slots").alias("_n")).select("_bits", F.coalesce(F.sum("_n").over(Window.orderBy("_bits").rowsBetween(*earlier)), F.lit(0)).alias("_base"))
    inside = rows.withColumn("_inside", F.coalesce(F.sum("slots").over(Window.partitionBy("_bits").orderBy("key").rowsBetween(*earlier)), F.lit(0)))
    ranges = inside.join(bases, "_bits").withColumn("low", F.col("_base") + F.col("_inside")).withColumn("high", F.col("low") + F.col("slots"))
    split = ranges.withColumn("range", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))))
    met = drawn.withColumn("range", F.floor(F.col("at") / width)).join(_small(split.select("range", "low", "high", "key"), sources), "range")
    return met.where("low <= at and at < high").select("shard", "slot", "key")


def draw_slots(planned: DataFrame, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """``shard, slot, source, k, block, words``: every slot of the mix with the block it takes.

    ``words`` is how much of the block it takes, from its start; that is the
    whole block but for the slot that ends a stream.
    """
    spark = planned.sparkSession
    known = ["source", "key", "blocks", "wide", "slots", "source_size", "goal", "lacks", "short_at"]
    total, sources = planned.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    tasks = max(1, math.ceil(total / MOST_SLOTS), min(spark.sparkContext.defaultParallelism, math.ceil(total / LEAST_SLOTS)))
    at = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(max(1, total)))
    drawn = spark.range(0, total, 1, tasks).select(F.col("id").alias("slot"), F.floor(F.col("id") / shard).alias("shard"), at.alias("at"))
    if sources > FEW_SOURCES:
        drawn = _keys_by_range(drawn, planned, total, sources)
    else:
        weights = planned.select("key", "slots").orderBy("key").collect()
        bounds = [0, *accumulate(w.slots for w in weights)]
        picked = F.size(F.filter(_longs(bounds), lambda b: b <= F.col("at")))
        drawn = drawn.select("shard", "slot", F.element_at(_longs([w.key for w in weights]), picked).alias("key"))

    counts = drawn.groupBy("key", "shard").agg(F.count("*").alias("n"))
    starts = before(counts, "key", "shard", "n", "start", math.ceil(total / shard))
    within = Window.partitionBy("key", "shard").orderBy("slot")
    ranked = drawn.withColumn("rank", F.row_number().over(within) - 1)
    numbered = ranked.join(starts.select("key", "shard", "start"), ["key", "shard"]).select("shard", "slot", "key", (F.col("start") + F.col("rank")).alias("k"))
    numbered = numbered.join(_small(planned.select(*known), sources), "key").where("k < slots")

    # What the draws leave short of the streams' ends makes a last shard.
    made = counts.groupBy("key").agg(F.sum("n").alias("made"))
    short = planned.select(*known).join(made, "key", "left").withColumn("made", F.coalesce("made", F.lit(0)))
    topped = short.where("made < slots").withColumn("k", F.explode(F.sequence(F.col("made"), F.col("slots") - 1))).drop("made")
    topped = topped.withColumn("shard", F.lit(math.ceil(total / shard)).cast("long")).withColumn("slot", F.lit(None).cast("long"))

    slots = numbered.unionByName(topped).withColumn("place", F.col("k") % F.col("blocks"))
    slots = permuted(slots, "place", "block")
    start = F.floor(F.col("k") / F.col("blocks")) * F.col("source_size") + F.col("place") * block - F.when(F.col("place") > F.col("short_at"), F.col("lacks")).otherwise(0)
    left = F.col("goal") - start
    return slots.select("shard", "slot", "source", "k", "block", F.least(F.lit(block), left).cast("long").alias("words"))


def _in_places(sized: DataFrame, places: DataFrame, alike: list[str]) -> DataFrame:
    """Rows of the places that hold several, each with the ``offset`` of its own.

    Rows of one place are numbered by file part, then in it, so a place that
    holds a large share of all rows is no window.
    """
    same = lambda a, b: reduce(lambda x, y: x & y, (F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in alike))
    crowded = places.where("n > 1")
    rows = sized.alias("s").join(crowded.alias("c"), same("s", "c")).select("s.row", "s.doc_id", "s.source", "s.size", "c.place", "c.offset")
    rows = rows.withColumn("file_part", F.shiftright("row", 33))
    counts = rows.groupBy("place", "file_part").agg(F.count("*").alias("n"))
    starts = before(counts, "place", "file_part", "n", "start", counts.agg(F.coalesce(F.max("file_part"), F.lit(0))).first()[0] + 1).select(F.col("place").alias("in_place"), F.col("file_part").alias("in_part"), "start")
    numbered = rows.withColumn("rank", F.row_number().over(Window.partitionBy("place", "file_part").orderBy("row")) - 1)
    numbered = numbered.join(starts, (F.col("place") == F.col("in_place")) & (F.col("file_part") == F.col("in_part")))
    return numbered.select("row", "doc_id", "source", "size", (F.col("offset") + (F.col("start") + F.col("rank")) * F.col("size")).alias("offset"))


def pack_blocks(sized: DataFrame, block: int = BLOCK, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``row, doc_id, source, size, block, start, words``: the parts of blocks that documents fill.

    ``sized`` has a number of each row, ``row``, and a hash of its text, ``text_hash``.
    """
    alike = ["source", "doc_id", "size", "text_hash"]
    places = sized.where("size > 0").groupBy(*alike).agg(F.count("*").alias("n"), F.min("row").alias("row"))
    cells = max(1, math.ceil(sized.count() / cell_rows))
    places = places.withColumn("cell", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(cells))).withColumn("words", F.col("n") * F.col("size"))
    bases = before(places.groupBy("source", "cell").agg(F.sum("words").alias("words")), "source", "cell", "words", "base", cells)
    inside = Window.partitionBy("source", "cell").orderBy("doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    offsets = places.withColumn("inside", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    joined = offsets.alias("o").join(bases.alias("b"), F.col("o.source").eqNullSafe(F.col("b.source")) & (F.col("o.cell") == F.col("b.cell")))
    # A place is known by the first of its rows.
    laid = stored(joined.select(*(F.col(f"o.{c}") for c in alike), "o.n", "o.row", F.col("o.row").alias("place"), (F.col("base") + F.col("inside")).alias("offset")))
    placed = laid.where("n = 1").select("row", "doc_id", "source", "size", "offset")
    if not laid.where("n > 1").isEmpty():
        placed = placed.unionByName(_in_places(sized, laid, alike))
    first, last = F.floor(F.col("offset") / block), F.floor((F.col("offset") + F.col("size") - 1) / block)
    parts = placed.withColumn("block", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("offset") - F.col("block") * block, F.lit(0))
    end = F.least(F.col("offset") + F.col("size") - F.col("block") * block, F.lit(block))
    return parts.select("row", "doc_id", "source", "size", "block", start.alias("start"), (end - start).alias("words"))


def mix_sources(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, shard: int = SHARD, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row a document: ``doc_id, source, size, source_size, target, taken``.

    ``draw_slots`` holds the mix itself: which block each slot of each shard takes.
    """
    with scratch(documents.sparkSession) as kept:
        sized = sizes(documents.withColumn("_text_hash", F.xxhash64(F.col(text_col).cast("string"))), id_col, text_col, source_col, "_text_hash")
        sized = stored(sized.withColumnRenamed("_text_hash", "text_hash").withColumn("row", F.monotonically_increasing_id()))
        aims = targets(sized)
        planned = stored(plan_streams(sized, block, aims))
        slots = draw_slots(planned, block, shard)
        uses = slots.groupBy("source", "block").agg(F.count_if(F.col("words") >= block).alias("whole"), F.collect_list(F.when(F.col("words") < block, F.col("words"))).alias("cuts"))
        parts = pack_blocks(sized, block, cell_rows)
        both = parts.alias("p").join(uses.alias("u"), F.col("p.source").eqNullSafe(F.col("u.source")) & (F.col("p.block") == F.col("u.block")))
        cut_words = F.aggregate("cuts", F.lit(0).cast("long"), lambda a, c: a + F.greatest(F.lit(0).cast("long"), F.least(c - F.col("start"), F.col("p.words"))))
        taken = both.groupBy("row").agg(F.sum(F.col("whole") * F.col("p.words") + cut_words).alias("taken"))
        all_targets = aims.select("source", "source_size", "target")
        rows = sized.alias("d").join(_small(all_targets.alias("t"), all_targets.count()), F.col("d.source").eqNullSafe(F.col("t.source")))
        rows = rows.select("d.row", "d.doc_id", "d.source", "d.size", "source_size", "target").join(taken, "row", "left")
        return kept(rows.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))
