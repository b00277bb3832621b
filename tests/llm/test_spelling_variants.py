"""op12: blocks of two sorted dictionaries against all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from folioworks.llm import queries
from folioworks.llm.spelling_variants import group_variants, vocabulary

DOCS = "doc_id long, text string"


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def words_of(rows, planted=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if doc_id is not None and (h := zlib.crc32(f"{doc_id}:{run}".encode())) % planted == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def compared(counts):
    """Every pair; pairs of words that share no piece of a word cut in two cannot be near, so only others are looked at."""
    pieces, near = {}, {w: [] for w in counts}
    for w in counts:
        for part in {w[k : k + 3] for k in range(len(w) - 2)}:
            pieces.setdefault(part, []).append(w)
    for w in counts:
        others = {x for k in (0, len(w) - 3) for x in pieces[w[k : k + 3]]}
        near[w] += [x for x in others if one_edit(w, x)]
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (counts[w], len(near[w]), forms[w], counts.get(forms[w]), root)
    return out


def answers(frame):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in frame.collect()}


def hard_rows():
    rng = random.Random(11)
    parts = ["an", "the", "ti", "on", "er", "ê", "Wh", "st", "ÿ", "ou"]
    rows = []
    for i in range(120):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(2, 5))) for _ in range(rng.randint(0, 90))]
        rows.append((i, " ".join(words)))
    # A hot block: thousands of words with one beginning, and chains of forms.
    crowd = ["aaaaaaa" + "".join(rng.choice("abcd") for _ in range(4)) for _ in range(1500)]
    rows.append((None, " ".join(crowd * 2)))
    rows += [(500, "colours " * 600 + "colourz " * 50 + "xolourz " * 4), (501, "x" * 30_000 + " " + "x" * 30_000 + "," + "x" * 29_999 + "y " + "x" * 29_999 + "y"), (502, None), (503, ""), (504, "1234 ---\n"), (505, "naïveté×÷ĀĀ NAÏVETÉ naÏvetÉ abcdefg漢abcdefg ABCDEFG")]
    return rows + rows[:6]


def test_variants(spark):
    rows = hard_rows()
    table = spark.createDataFrame(rows, DOCS).repartition(5)
    for block in (24, 3):
        assert answers(group_variants(vocabulary(table, planted=31), block=block)) == compared(words_of(rows))


def test_short_alphabet(spark):
    """Words of two letters, where every block is crowded and a leaf is full."""
    rng = random.Random(2)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(7, 9))): rng.randint(2, 400) for _ in range(700)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    got = answers(group_variants(frame, block=2))
    assert {w: v[1] for w, v in got.items()} == {w: len(x) for w, x in near.items()}


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_on_the_small_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert answers(queries.op12_spelling_variants(spark, f"/root/testdata/{sf}")) == compared(words_of(rows))


def test_empty_table_and_clashing_names(spark):
    extra = ", ".join(f"{n} string" for n in ("word", "n", "size", "key", "a", "b", "low", "high", "near", "root"))
    assert group_variants(vocabulary(spark.createDataFrame([], f"{DOCS}, {extra}"))).count() == 0
    one = spark.createDataFrame([(1, "abcdefg ABCDEFG", *"0123456789")], f"{DOCS}, {extra}")
    assert answers(group_variants(vocabulary(one))) == {"abcdefg": (2, 0, None, None, "abcdefg")}
