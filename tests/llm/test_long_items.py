"""Benchmark items longer than a block of the index."""

from __future__ import annotations

import random

import pytest

from folioworks.llm.decontaminate import LEAST_BLOCK, PIECE, STEP, WINDOW_STEP, Index, _blocks, clean_documents, contaminated_regions, segments


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(words))


@pytest.mark.parametrize("length", [0, 5, 47, 159, 160, 161, 400, 401, 479, 480, 481, 1000, 1337, 4000])
@pytest.mark.parametrize("size", [80, 240, 3920])
def test_segments_hold_the_same_patterns_as_the_whole(length, size):
    text = prose(random.Random(length), 900)[:length].strip()
    cut = list(segments(text, size))
    assert [last for _, last in cut] == [False] * (len(cut) - 1) + [True]
    assert all(len(data) <= size + PIECE for data, _ in cut)
    assert size % STEP == size % WINDOW_STEP == 0
    whole, parts = Index([(1, text)]), Index([(1, *segment) for segment in cut])
    assert sorted(parts.patterns) == sorted(whole.patterns)
    assert parts.short == whole.short


def test_blocks_of_one_long_item_are_bounded(spark):
    text = prose(random.Random(3), 60_000)
    bench = spark.createDataFrame([(1, text), (2, "a short item of some words"), (3, None)], "item_id long, text string")
    blocks = list(_blocks(bench, "item_id", "text", 1, 65_536))
    assert len(blocks) >= len(text) // 65_536
    assert all(sum(len(data) for _, data, _ in block) <= 65_536 for block in blocks)
    assert max(len(Index(block).codes) for block in blocks) < 6 * 65_536


def test_long_items_give_what_one_block_gives(spark):
    rng = random.Random(4)
    item, other = prose(rng, 2200), prose(rng, 40)
    size = (LEAST_BLOCK - PIECE) // STEP * STEP
    assert len(item) > 2 * size + PIECE
    across = item[size - 300 : size + 300]
    rows = [
        (1, prose(rng, 20) + " " + item + " " + prose(rng, 20)),
        (2, "Said: " + across + " and no more"),
        (2, "Said: " + across + " and no more"),
        (2, prose(rng, 30) + item[2 * size - 40 : 2 * size + 90].upper()),
        (3, across + prose(rng, 50) + across + " " + other),
        (4, prose(rng, 300)),
        (5, None),
        (None, item[-250:]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (None, other)], "item_id long, text string")
    whole = sorted(map(str, contaminated_regions(docs, bench).collect()))
    assert len(whole) == 8 and sum("doc_id=2" in r for r in whole) == 3
    assert sorted(map(str, contaminated_regions(docs, bench, index_bytes=LEAST_BLOCK).collect())) == whole
    assert [r.doc_id for r in clean_documents(docs, bench, index_bytes=LEAST_BLOCK).orderBy("doc_id").collect()] == [4, 5]
