"""Conversation structure repair: the cheapest edits that make the roles of a dialogue alternate.

Repaired role initials must read ``(s?(ua)+)?``. Edits are Keep (0), Rerole to user
or assistant (3), Delete (4) and Insert of an empty user or assistant turn (3);
a turn whose text breaks off costs 3 more unless it is deleted. Blank turns and
repeats must be deleted. Of the cheapest edits those with the smallest string of
initials win.

Window functions flag each turn; turns are collected in order and folded by
``aggregate()``, which carries four structs (cost, audit, plan), one for each
thing that the kept turns may end with: nothing, a system, a user or an assistant
turn. ``least`` picks among them; what cannot be is null, which it passes over.
Equal costs never meet with one audit the beginning of the other, as both hold
one letter for every turn and an Insert more would cost more; so the choice made
at every turn is the right one at the end, and the audit tells the roles.

No task holds a whole conversation, however many turns it has: equal turns are
counted first, turns are sorted by ranges over all tasks, and pieces of ``PIECE``
turns are folded from each of the four starts. The 4 x 4 structs of neighbouring
pieces are put together range by range, then over the ranges of a conversation,
of which there are as many as partitions at most. The winning path goes back the
same way. Only the digest of the repaired text has to see it in order: a task
reads the texts of a conversation's pieces as a stream, a batch at a time.

Turns are ordered by number (null first), role, text. A null conversation is one
like others; null roles and texts are one space, so such turns are blank or have
no role that can stay. Gaps count numbers alone. A conversation whose turns are
all dropped has zeros and the digest of nothing; an empty table gives no rows.
Repeated rows are repeats. Texts of any length are judged whole. Other columns
are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_sized, map_rows, scratch, stored

PIECE = 256
#: Turns that a range is meant to hold, and the most ranges.
RANGE, MOST_RANGES = 16_384, 20_000
REROLE, DELETE, INSERT, BROKEN = 3, 4, 3, 3
#: What the kept turns end with: nothing, system, user, assistant.
STATES = range(4)
NOTHING, SYSTEM, USER, ASSISTANT = STATES
_LAST_SIGN = r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z"


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults planted by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops a turn, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes
    its role user. Nulls count as one space there, and become one in role and text.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat_ws(":", word("conv_id"), word("turn"))), F.lit(20))
    text = F.when(fault == 1, "").when(fault == 2, F.translate(word("text"), ".!?", "")).otherwise(word("text"))
    role = F.when(fault == 4, "user").otherwise(word("role"))
    copies = F.array_repeat(F.lit(0), F.when(fault == 3, 2).when(fault == 0, 0).otherwise(1))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", F.explode("copies")).drop("col")


def _flagged(turns: DataFrame) -> DataFrame:
    """Distinct turns with their number of ``copies``, and what is wrong with the first of them."""
    conv = F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n"))
    distinct = turns.withColumn("conv", conv).groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    same = F.unhex(F.sha2(F.to_json(F.struct("conv", "role", "text")), 256))
    entries = stored(distinct.withColumn("same", same))
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    firsts = entries.groupBy("same").agg(F.min(place).alias("first"), F.count("*").alias("times"))
    told = join_sized(entries, firsts, ["same"], "times", entries.count())
    last = F.regexp_extract("text", _LAST_SIGN, 1)
    fault = F.when(last == "", "blank").when(place > F.col("first"), "duplicate").when(~last.isin(".", "!", "?"), "truncated").otherwise("")
    return told.select("conv", "turn", "role", "text", "copies", fault.alias("fault"), F.substring("role", 1, 1).alias("initial"))


def _ranged(flagged: DataFrame) -> DataFrame:
    """Turns with ``range``, ``rank`` in their conversation's part of it, ``piece`` and the initial before."""
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    flagged = stored(flagged)
    ranges = max(1, min(MOST_RANGES, math.ceil(flagged.count() / RANGE)))
    spread = stored(flagged.repartitionByRange(ranges, "conv", *order).withColumn("range", F.spark_partition_id()))
    inside = Window.partitionBy("conv", "range").orderBy(*order)
    ranked = spread.withColumn("rank", F.row_number().over(inside)).withColumn("before", F.lag("initial").over(inside))
    return ranked.withColumn("piece", F.floor((F.col("rank") - 1) / PIECE).cast("int"))


def _unlike(before: Column, after: Column) -> Column:
    """1 where two neighbouring initials may not stand together."""
    return (~F.concat(before, after).isin("su", "ua", "au")).cast("long")


def _added(state: str, cost: str, audit: str, plan: str) -> str:
    """SQL of ``state`` with more edits; null stays null. The state is computed once, however long its SQL."""
    grown = f"named_struct('cost', s.cost + {cost}, 'audit', concat(s.audit, {audit}), 'plan', concat(s.plan, {plan}))"
    return f"transform(array({state}), s -> if(s is null, null, {grown}))[0]"


def _four(states: list[str]) -> str:
    return f"named_struct({', '.join(f"'s{k}', {s}" for k, s in zip(STATES, states, strict=True))})"


def _step() -> str:
    """SQL of the four states after turn ``t`` and its copies, of ``p`` before it.

    The plan has one letter for the turn: K kept, U or A given that role, D deleted;
    before it u or a for each inserted turn. Inserts come as late as they can, as
    D sorts before I.
    """
    broken = f"if(t.fault = 'truncated', {BROKEN}, 0)"
    begun = f"least(p.s{NOTHING}, p.s{SYSTEM}, p.s{ASSISTANT})"
    before_user = f"least({begun}, {_added(f'p.s{USER}', f'{INSERT}', "'I'", "'a'")})"
    before_assistant = f"least(p.s{USER}, {_added(begun, f'{INSERT}', "'I'", "'u'")})"

    def taken(state: str, initial: str, letter: str) -> str:
        keep = f"t.initial = '{initial}'"
        return _added(state, f"{broken} + if({keep}, 0, {REROLE})", f"if({keep}, 'K', 'R')", f"if({keep}, 'K', '{letter}')")

    ways = {SYSTEM: _added(f"if(t.initial = 's', p.s{NOTHING}, null)", broken, "'K'", "'K'"), USER: taken(before_user, "u", "U"), ASSISTANT: taken(before_assistant, "a", "A")}
    after = []
    for k in STATES:
        gone = _added(f"p.s{k}", f"{DELETE}", "'D'", "'D'")
        free = f"if(t.fault in ('blank', 'duplicate'), {gone}, least({gone}, {ways[k]}))" if k in ways else gone
        after.append(_added(free, f"{DELETE} * (t.copies - 1)", "repeat('D', cast(t.copies - 1 as int))", "''"))
    return _four(after)


_STATE = "struct<cost:bigint,audit:string,plan:string>"
_NEVER = f"cast(null as {_STATE})"


def _start(state: int) -> str:
    return _four(["named_struct('cost', 0L, 'audit', '', 'plan', '')" if k == state else _NEVER for k in STATES])


def _after_part() -> str:
    """SQL of the four states after part ``t``, of which ``ends`` are known; the plan notes the state after each part."""
    def joined(k: int) -> str:
        ways = []
        for i in STATES:
            old, more = f"p.s{i}", f"t.ends[{i}].s{k}"
            way = f"named_struct('cost', {old}.cost + {more}.cost, 'audit', concat({old}.audit, {more}.audit), 'plan', concat({old}.plan, '{k}'))"
            ways.append(f"if({old} is null or {more} is null, null, {way})")
        return f"least({', '.join(ways)})"

    return _four([joined(k) for k in STATES])


def _folded(items: str, step: str) -> Column:
    """The four states after all ``items``, from each of the four starts."""
    return F.expr(f"transform(array({', '.join(_start(k) for k in STATES)}), start -> aggregate({items}, start, (p, t) -> {step}))")


def _lines(turn: Column, edits: Column) -> Column:
    """The lines that a turn and the turns inserted before it give."""
    inserted = F.transform(F.filter(F.split(F.substring(edits, 1, 1 << 30), ""), lambda c: c.isin("u", "a")), lambda c: F.when(c == "u", "user:").otherwise("assistant:"))
    edit = F.substring(edits, -1, 1)
    role = F.when(edit == "K", turn.role).when(edit == "U", "user").when(edit == "A", "assistant")
    own = F.when(role.isNotNull(), F.array(F.concat(role, F.lit(":"), turn.text))).otherwise(F.array().cast("array<string>"))
    return F.concat(inserted, own)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each conversation's lines; its pieces arrive in order, one after the other."""
    now, digest, some = None, None, False

    def row():
        return pa.RecordBatch.from_pydict({"conv": [now], "repaired_sha256": [digest.hexdigest()]})

    for batch in batches:
        for conv, text in zip(batch.column("conv").to_pylist(), batch.column("lines").to_pylist(), strict=True):
            if conv != now:
                if now is not None:
                    yield row()
                now, digest, some = conv, hashlib.sha256(), False
            digest.update((b"\n" if some else b"") + text.encode())
            some = True
    if now is not None:
        yield row()


def repair_conversations(turns: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """One row a conversation: its faults, the cheapest edits, and the digest of what they give.

    ``turns`` has ``conv_id, turn, role, text``. Conversations of ``originals`` that
    have no turns left are returned too. ``gaps`` are numbers missing between the
    first and the last; ``illegal`` are neighbouring turns whose role initials are
    none of su, ua, au.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    conversations = (turns if originals is None else originals).select("conv_id").distinct()
    with scratch(turns.sparkSession) as kept:
        rows = stored(_ranged(_flagged(turns)))
        has = F.col("fault") == ""
        counted = rows.groupBy("conv").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
            F.sum(F.when(F.col("fault") == "blank", F.col("copies")).otherwise(0)).alias("blank"),
            F.sum(F.when(F.col("fault") == "duplicate", F.col("copies")).when(has | (F.col("fault") == "truncated"), F.col("copies") - 1).otherwise(0)).alias("duplicate"),
            F.sum((F.col("fault") == "truncated").cast("long")).alias("truncated"),
            F.sum(F.col("copies") - 1 + F.coalesce(_unlike(F.col("before"), F.col("initial")), F.lit(0))).alias("inside"),
        )
        turn = F.struct("rank", "initial", "fault", "copies", "role", "text")
        pieces = rows.groupBy("conv", "range", "piece").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        folded = stored(pieces.withColumn("ends", _folded("turns", _step())))
        part = F.struct("piece", "ends")
        parts = folded.groupBy("conv", "range").agg(
            F.sort_array(F.collect_list(part)).alias("parts"),
            F.min_by(F.element_at("turns", 1).initial, "piece").alias("first"),
            F.max_by(F.element_at("turns", -1).initial, "piece").alias("last"),
        )
        ranges = stored(parts.select("conv", "range", "first", "last", _folded("parts", _after_part()).alias("ends")))
        part = F.struct("range", "ends", "first", "last")
        whole = ranges.groupBy("conv").agg(F.sort_array(F.collect_list(part)).alias("parts"))
        ends = whole.select("conv", "parts", F.expr(f"aggregate(parts, {_start(NOTHING)}, (p, t) -> {_after_part()})").alias("end"))
        # The way to the end: as it is, or with the turns that are missing there.
        ways = ((NOTHING, ""), (SYSTEM, "ua"), (USER, "a"), (ASSISTANT, ""))
        best = F.expr(f"least({', '.join(_added(f'end.s{k}', f'{INSERT * len(tail)}', f"'{'I' * len(tail)}'", f"'|{tail}'") for k, tail in ways)})")
        met = F.zip_with(F.slice("parts", 1, F.size("parts") - 1), F.slice("parts", 2, F.size("parts")), lambda x, y: _unlike(x.last, y.first))
        met = F.aggregate(F.when(F.size("parts") > 1, met), F.lit(0).cast("long"), lambda a, x: a + x)
        chosen = stored(ends.select("conv", "parts.range", best.alias("best"), F.coalesce(met, F.lit(0)).alias("met")))

        # Back: the states before and after each range, then each piece.
        path = F.substring_index(F.col("best.plan"), "|", 1)
        steps = F.transform("range", lambda r, i: F.struct(
            r.alias("range"), F.when(i == 0, "0").otherwise(F.substr(path, i, F.lit(1))).alias("before"), F.substr(path, i + 1, F.lit(1)).alias("after"),
            F.when(i == F.size("range") - 1, F.substring_index(F.col("best.plan"), "|", -1)).otherwise("").alias("tail")))
        by_range = chosen.select("conv", F.inline(steps))

        # The plan of the way from ``before`` to ``after``.
        ways = ", ".join(f"ends[cast(before as int)].s{k}.plan" for k in STATES)
        taken = F.expr(f"element_at(array({ways}), cast(after as int) + 1)").alias("path")
        told = ranges.join(by_range, ["conv", "range"]).withColumn("path", taken)
        steps = F.transform(F.sequence(F.lit(1), F.length("path")), lambda i: F.struct(
            (i - 1).alias("piece"), F.when(i == 1, F.col("before")).otherwise(F.substr("path", i - 1, F.lit(1))).alias("before"), F.substr("path", i, F.lit(1)).alias("after"),
            F.when(i == F.length("path"), F.col("tail")).otherwise("").alias("tail")))
        by_piece = told.select("conv", "range", F.inline(steps))
        told = folded.join(by_piece, ["conv", "range", "piece"]).withColumn("path", taken)
        edits = F.regexp_extract_all("path", F.lit("[ua]*[KUAD]"), 0)
        tail = F.transform(F.filter(F.split("tail", ""), lambda c: c != ""), lambda c: F.when(c == "u", "user:").otherwise("assistant:"))
        lines = F.concat(F.flatten(F.zip_with("turns", edits, _lines)), tail)
        texts = told.select("conv", "range", "piece", lines.alias("lines")).where(F.size("lines") > 0).withColumn("lines", F.array_join("lines", "\n"))
        in_order = texts.repartition("conv").sortWithinPartitions("conv", "range", "piece").select("conv", "lines")
        digests = map_rows(in_order, _digests, "conv string, repaired_sha256 string")

        conv = F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n"))
        edited = chosen.select("conv", "met", F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"))
        joined = conversations.withColumn("conv", conv).join(counted, "conv", "left").join(edited, "conv", "left").join(digests, "conv", "left")
        numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in (*((n, F.col(n)) for n in ("gaps", "blank", "duplicate", "truncated")), ("illegal", F.col("inside") + F.col("met")), ("cost", F.col("cost")))]
        nothing = hashlib.sha256().hexdigest()
        return kept(joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")))
