"""Chat formatting: every participant's view of a dialogue, with training masks.

For each participant of a conversation the dialogue is rendered once, with that
speaker's turns as the assistant and everybody else as a named user. Context
roles (``system``) are rendered as they are and get no view of their own.

A rendering is a list of segments: each turn gives a header and a body. Only
bodies of the viewing participant carry mask 1; headers and all other bodies
carry 0. ``text`` is the concatenation of the segments, ``segment_chars`` their
lengths in code points and ``segment_mask`` their masks.

Long dialogues come in parts: part k holds the turns numbered 256 k to
256 k + 255, turns without a number are part -1 and come first. A part of more
rows than that, as numbers may be missing or repeat, is divided into pieces of
256 rows. A view's parts, put together by ``part`` and ``piece``, are the whole
rendering.

Turns are ordered by number, role, text; repeated rows stay. No task orders a
whole conversation, however its turns are numbered: parts of more than ``CROWD``
rows are sorted by ranges over all tasks, equal rows too, and a row's place is the
number of its part's rows in the ranges before, and its own place in its range.

A null text is empty, a null role is ``unknown``, rows of a null conversation form
one conversation. Texts of any length are rendered whole. Markers inside texts
and roles are left as they are; the lengths of the segments, not the markers, say
where a turn ends. Other columns are ignored, whatever they are called. A
conversation of context roles alone has no view; an empty table gives none.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

PART = 256
#: Rows of one part that a task may order.
CROWD = 4096
MOST_RANGES = 20_000
CONTEXT = ("system",)
END = "<|end|>\n"


def _placed(turns: DataFrame) -> DataFrame:
    """Turns with their ``place`` in their part, from 1."""
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    ranked = lambda rows: rows.withColumn("place", F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)))
    crowded = stored(turns.groupBy("conv_id", "part").agg(F.count("*").alias("rows")).where(F.col("rows") > CROWD))
    if crowded.isEmpty():
        return ranked(turns)
    names = turns.columns
    same = F.col("t.conv_id").eqNullSafe(F.col("c.conv_id")) & (F.col("t.part") == F.col("c.part"))
    told = turns.alias("t").join(crowded.alias("c"), same, "left").select("t.*", "c.rows")
    tasks = math.ceil(crowded.agg(F.sum("rows")).first()[0] / CROWD)
    # Equal rows are spread by a number of their own, written down, so that they fill several ranges and a lost task gives the same.
    salted = stored(told.where("rows is not null").select(*names).withColumn("salt", F.rand(0)))
    spread = salted.repartitionByRange(min(tasks, MOST_RANGES), "conv_id", "part", *order, "salt")
    ranges = stored(spread.withColumn("range", F.spark_partition_id()))
    counts = ranges.groupBy("conv_id", "part", "range").agg(F.count("*").alias("n"))
    # One row a part and range.
    earlier = Window.partitionBy("conv_id", "part").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = ranges.withColumn("rank", F.row_number().over(Window.partitionBy("conv_id", "part", "range").orderBy(*order)))
    same = F.col("i.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("i.part") == F.col("s.part")) & (F.col("i.range") == F.col("s.range"))
    hot = inside.alias("i").join(starts.alias("s"), same).select(*(f"i.{c}" for c in names), (F.col("start") + F.col("rank")).cast("int").alias("place"))
    return ranked(told.where("rows is null").select(*names)).unionByName(hot)


def rotate_perspectives(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", part: int = PART, context: tuple[str, ...] = CONTEXT) -> DataFrame:
    """``conv_id, perspective, part, piece, n_turns, text, segment_chars, segment_mask`` of every view."""
    turns = conversations.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("part", F.coalesce(F.floor(F.col("turn") / part), F.lit(-1)).cast("long"))
    placed = _placed(turns).withColumn("piece", F.floor((F.col("place") - 1) / part).cast("long"))
    pieces = placed.groupBy("conv_id", "part", "piece").agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))

    speakers = turns.where(~F.col("role").isin(*context)).select("conv_id", F.col("role").alias("perspective")).distinct()
    parts = turns.select("conv_id", "part").distinct()
    views = parts.join(speakers, parts.conv_id.eqNullSafe(speakers.conv_id)).select(parts.conv_id, "part", "perspective")
    seen = pieces.join(views, pieces.conv_id.eqNullSafe(views.conv_id) & (pieces.part == views.part)).select(pieces.conv_id, "perspective", pieces.part, "piece", "turns")

    def header(t):
        role = F.when(t.role == F.col("perspective"), F.lit("assistant")).when(t.role.isin(*context), t.role)
        return F.concat(F.lit("<|"), F.coalesce(role, F.concat(F.lit("user name="), t.role)), F.lit("|>\n"))

    def segments(t):
        mine = (t.role == F.col("perspective")).cast("int")
        return F.array(F.struct(header(t).alias("text"), F.lit(0).alias("mask")), F.struct(F.concat(t.text, F.lit(END)).alias("text"), mine.alias("mask")))

    rendered = seen.withColumn("n_turns", F.size("turns")).withColumn("segments", F.flatten(F.transform("turns", segments)))
    return rendered.select(
        "conv_id",
        "perspective",
        "part",
        "piece",
        "n_turns",
        F.array_join(F.col("segments.text"), "").alias("text"),
        F.transform(F.col("segments.text"), F.char_length).alias("segment_chars"),
        F.col("segments.mask").alias("segment_mask"),
    )
