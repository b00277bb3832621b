"""op11: the fold against a search over all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest

from folioworks.llm import conversation_repair as repair
from folioworks.llm import queries

TURNS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]  # every conversation is returned
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def searched(turns):
    """The least (cost, audit), by a search over every order of edits."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    faults, seen = [], set()
    for _, role, text in turns:
        left = text.strip(SPACE)
        faults.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, lines = heapq.heappop(heap)
        if at == len(turns) and state in ("", "a"):
            break
        if (at, state) in done:
            continue
        done.add((at, state))
        steps = []
        for role in ("user", "assistant"):
            if (state, role[0]) in after:
                steps.append((3, "I", at, after[state, role[0]], (*lines, f"{role}:")))
        if at < len(turns):
            _, role, text = turns[at]
            steps.append((4, "D", at + 1, state, lines))
            if faults[at] not in ("blank", "duplicate"):
                more = 3 if faults[at] == "truncated" else 0
                if (state, role[:1]) in after:
                    steps.append((more, "K", at + 1, after[state, role[:1]], (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if (state, new[0]) in after:
                        steps.append((more + 3, "R", at + 1, after[state, new[0]], (*lines, f"{new}:{text}")))
        for more, letter, *rest in steps:
            heapq.heappush(heap, (cost + more, audit + letter, *rest))
    numbers = [t[0] for t in turns if t[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(turns, turns[1:], strict=False))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def rows_of(seed: int, conversations: int) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["Yes.", "No", "  ", "", None, "Why?\n", "Ünd so…", "it breaks", "x" * 50 + "!", "Yes.", "a: b\nc."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "admin", "User"]
    rows = []
    for conv in range(conversations):
        turns = [rng.choice([i, i, i, i, rng.randint(0, 9), None]) for i in range(rng.randint(1, 12))]
        rows += [(conv, t, rng.choice(roles[:4]) if rng.random() < 0.6 else rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"Line {rng.random()}.") for t in turns]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Hello."), (None, None, None, None), (5000, None, "user", "Hm")]
    return rows + rows[:5] * 2


def answers(frame):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[n] for n in names) for r in frame.collect()}


@pytest.mark.parametrize(("piece", "size"), [(256, 16_384), (2, 40)])
def test_cheapest_edits(spark, monkeypatch, piece, size):
    monkeypatch.setattr(repair, "PIECE", piece)
    monkeypatch.setattr(repair, "RANGE", size)
    rows = rows_of(7, 60)
    rng = random.Random(3)
    # One conversation of more turns than any piece or range, in parts all of one number or none.
    rows += [(77, rng.choice([None, 4, i // 3]), rng.choice(["user", "assistant", "system"]), rng.choice(["Hm", "Ok.", f"Line {i}.", f"Stop {i}"])) for i in range(700)]
    table = spark.createDataFrame(rows, TURNS).repartition(3)
    got = answers(repair.repair_conversations(repair.damage(table), table))
    assert got == {conv: searched(turns) for conv, turns in damaged(rows).items()}


def test_query_on_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert answers(queries.op11_conversation_repair(spark, sf)) == {conv: searched(turns) for conv, turns in damaged(rows).items()}


def test_empty_table_and_clashing_names(spark):
    extra = ", ".join(f"{n} string" for n in ("conv", "range", "piece", "ends", "copies", "fault", "same", "rank", "lines", "audit"))
    empty = spark.createDataFrame([], f"{TURNS}, {extra}")
    assert repair.repair_conversations(repair.damage(empty), empty).count() == 0
    one = spark.createDataFrame([(1, 1, "assistant", "Well.", *"abcdefghij")], f"{TURNS}, {extra}")
    assert answers(repair.repair_conversations(one))[1][5:7] == (3, "IK")
