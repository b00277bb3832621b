"""Compression of a corpus in parallel against one stream; the shuffled corpus against its counts."""

from __future__ import annotations

import bz2
import gzip
from collections import Counter

import numpy as np
import pytest

from folioworks.operators import streams as R

DOCS = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def stream(spark):
    rows = spark.read.parquet(DOCS).select("doc_id", "text").collect()
    return " ".join(r.text or "" for r in sorted(rows, key=lambda r: (r.doc_id, r.text or ""))).encode()


def test_blocks_are_the_stream(spark, stream):
    docs = spark.read.parquet(DOCS)
    rows = {r.block: r for r in R.stream_compression(docs, "text", "doc_id").collect()}
    whole = rows.pop(-1)
    assert len(rows) == -(-len(stream) // R.BLOCK) >= 3
    assert whole.n_bytes == len(stream) == sum(r.n_bytes for r in rows.values())
    assert whole.gzip * len(stream) == pytest.approx(len(gzip.compress(stream)), rel=1e-3)
    assert whole.bz2 * len(stream) == pytest.approx(len(bz2.compress(stream)), rel=5e-3)
    assert [rows[k].n_bytes for k in sorted(rows)] == [len(stream[i : i + R.BLOCK]) for i in range(0, len(stream), R.BLOCK)]


def test_short_blocks_cut_texts_anywhere(spark):
    texts = ["é" * 7, None, "", "abc", "x" * 40]
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    data = " ".join(t or "" for t in texts).encode()
    rows = {r.block: r for r in R.stream_compression(frame, "t", "i", block=5).collect()}
    assert rows[-1].n_bytes == len(data) and len(rows) == -(-len(data) // 5) + 1
    before = b""
    for k in range(len(rows) - 1):
        block = data[5 * k : 5 * k + 5]
        assert round(rows[k].gzip * len(block)) == R.squeezed(block, before)[0] + R.GZIP_FRAME
        before = block
    assert R.stream_compression(frame.limit(0), "t", "i").collect() == []
    assert R.shuffled_compression(frame.limit(0), "t").collect() == []


def test_shuffled_blocks_add_up(spark, stream):
    corpus, letters = R.shuffled_blocks(spark.read.parquet(DOCS), "text", block=100_000)
    found = [corpus.text(k, letters) for k in range(corpus.blocks)]
    assert sum(map(Counter, found), Counter()) == Counter(stream.decode())
    again, letters = R.shuffled_blocks(spark.read.parquet(DOCS), "text", block=100_000)
    assert [again.text(k, letters) for k in (5, 3, 4)] == [found[5], found[3], found[4]]
    # Each block is a sample of all.
    share = Counter(stream.decode())["e"] / len(stream.decode())
    assert all(t.count("e") / len(t) == pytest.approx(share, rel=0.03) for t in found)


def test_shuffled_baseline(spark, stream):
    docs = spark.read.parquet(DOCS)
    first, second = (R.shuffled_compression(docs, "text").orderBy("block").collect() for _ in range(2))
    assert first == second and first[0].block == -1 and first[0].n_bytes == len(stream)
    letters = np.array(list(stream.decode()))
    np.random.default_rng(1).shuffle(letters)
    mixed = "".join(letters).encode()
    assert first[0].gzip * len(stream) == pytest.approx(len(gzip.compress(mixed)), rel=1e-3)
    assert first[0].bz2 * len(stream) == pytest.approx(len(bz2.compress(mixed)), rel=5e-3)


def test_large_counts_are_drawn_near_their_mean():
    counts = np.array([3_000_000_000, 0, 1, 500_000_000], np.int64)
    left = R.halved(counts, 1_000_000_000, [1, 2])
    assert left.sum() == 1_000_000_000 and (left <= counts).all() and abs(left[0] - 857_142_857) < 10**6
