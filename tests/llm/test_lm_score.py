"""op13: counts against plain ones, the model against its formula, scores against both."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioworks.llm import attention, lm_score, queries

DOCS = "doc_id long, text string"


def words_of(text):
    return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]


def base_of(rows, trains):
    """(doc_id, n_tokens, n_known, train_tokens, base_score) by counting."""
    counts, ends = Counter(), 0
    for doc_id, text in rows:
        if trains(doc_id):
            counts.update(words_of(text))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = []
    for doc_id, text in rows:
        seen = [counts[w] for w in words_of(text)] + [ends]
        out.append((doc_id, len(seen), sum(c > 0 for c in seen), n, sum(math.log10((c + 1) / (n + v + 1)) for c in seen)))
    return sorted(out, key=str)


def trains(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def held(frame, rows, rule=trains):
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in frame), key=str)
    want = base_of(rows, rule)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want])


def test_gradient():
    rng = np.random.default_rng(1)
    slots = rng.integers(2, 90, 120).astype(np.int16)
    slots[[2, 90, 119]] = attention.END
    starts = np.array([0, 3, 91])
    rows = attention.windows(slots, starts, *attention.places(len(slots), starts))
    weights = attention.first_weights().astype(np.float64)
    loss, gradient = attention.loss_and_gradient(weights, rows)
    found = attention.log_probabilities(attention.parts(weights), rows)
    assert loss == pytest.approx(-found.sum() / 120, rel=1e-5)
    for i in rng.choice(np.flatnonzero(np.abs(gradient) > 1e-3), 20):
        step = np.zeros_like(weights)
        step[i] = 1e-5
        slope = (attention.loss_and_gradient(weights + step, rows)[0] - attention.loss_and_gradient(weights - step, rows)[0]) / 2e-5
        assert gradient[i] == pytest.approx(slope, rel=1e-3, abs=1e-6)


def plain(p, slots):
    """The log probability of one text, slot by slot, by the formula."""
    total, before = 0.0, [attention.END] * (attention.BEFORE + 3)
    padded = before + slots
    for n, target in enumerate(slots):
        begin = n // attention.SPAN * attention.SPAN
        inputs = range(begin, n + attention.BEFORE + 1)
        x = np.array([p["now"][padded[i + 2]] + p["last"][padded[i + 1]] + p["older"][padded[i]] + p["place"][i - begin] for i in inputs], np.float64)
        weight = np.exp((x[-1] @ p["query"]) @ (x @ p["key"]).T / math.sqrt(attention.WIDTH))
        mixed = x[-1] + weight @ (x @ p["value"]) / weight.sum()
        top = mixed + np.maximum(mixed @ p["inner"] + p["inner_bias"], 0) @ p["outer"]
        group = np.exp(top @ p["group"] + p["group_bias"])
        g = target // attention.MEMBERS
        member = np.exp(top @ p["member"][g] + p["member_bias"][g])
        total += math.log(group[g] / group.sum() * member[target % attention.MEMBERS] / member.sum())
    return total


def test_windows_score_each_slot_once():
    rng = np.random.default_rng(3)
    texts = [[*rng.integers(2, 1024, n).tolist(), attention.END] for n in (0, 1, 39, 40, 41, 130)]
    p = attention.parts(attention.first_weights(seed=4))
    slots = np.array([s for t in texts for s in t], np.int16)
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    assert np.allclose(attention.text_scores(p, slots, starts), [plain(p, t) for t in texts], rtol=1e-4)


def test_layout_and_spelling():
    speller = lm_score.Speller(lm_score.VOCABULARY)
    words = [b"the", b"onnershan", "été".encode(), b"x" * 700, "a b".encode(), b"!!", "漢字".encode(), b"it's"]
    ids, lengths = speller.spell(words)
    assert speller.encoding.decode(ids.tolist()) == "".join(" " + w.decode() for w in words)
    apart = [speller.spell([w]) for w in words]
    assert np.array_equal(ids, np.concatenate([a[0] for a in apart])) and lengths.tolist() == [a[1][0] for a in apart]
    counts = {int(i): 5 for i in range(3000)}
    layout = lm_score.Layout(counts, speller.opens)
    rare = layout.slot == attention.RARE
    assert np.exp(layout.within[rare]).sum() == pytest.approx(1) and not layout.within[~rare].any()
    assert sorted(layout.slot[~rare].tolist()) == list(range(2, 1024))


def test_scores(spark, monkeypatch):
    """Words that all tasks know and words that a join brings; nulls, repeats, no ids, long texts."""
    monkeypatch.setattr(lm_score, "HOT", 40)
    monkeypatch.setattr(lm_score, "LEAST_IDS", 0)
    monkeypatch.setattr(lm_score, "BUCKET", 3000)
    rng = np.random.default_rng(0)
    parts = ["an", "the", "ti", "on", "er", "Re", "wh", "st", "ê"]
    rows = [(i, " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(rng.integers(0, 160)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n "), (1003, "É\u0000😀 a b\x1c漢字 ﬁ"), (None, "no id here"), (1004, "w" * 5000 + " " + "z" * 70), (1005, "w" * 5000), (1006, rows[5][1] * 300), *rows[:4]]
    table = spark.createDataFrame(rows, DOCS).repartition(4)
    rule = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2
    got = lm_score.score_texts(table, rule).collect()
    held(got, rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    alike = {}
    for r, text in ((r, dict(rows)[r["doc_id"]]) for r in got):
        alike.setdefault(" ".join(words_of(text)), set()).add(round(r["score"], 2))
    assert all(len(v) == 1 for v in alike.values())
    again = lm_score.score_texts(table, rule).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_query_on_the_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_lm_scoring(spark, "/root/testdata/sf0.01").collect()
    held(got, rows)
    ahead = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in ahead} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    # The model foretells texts that it has not seen better than the counts of words do.
    assert sum(r["score"] for r in ahead) > sum(r["base_score"] for r in ahead)


def test_empty_table_and_clashing_names(spark):
    extra = ", ".join(f"{n} string" for n in ("key", "row", "train", "cold", "score", "n", "c", "id", "logs", "bucket"))
    assert lm_score.score_texts(spark.createDataFrame([], f"{DOCS}, {extra}"), F.lit(True)).count() == 0
    row = (3, "a b a", *"0123456789")
    held(lm_score.score_texts(spark.createDataFrame([row], f"{DOCS}, {extra}"), F.lit(True)).collect(), [row[:2]], lambda _: True)
    held(lm_score.score_texts(spark.createDataFrame([row], f"{DOCS}, {extra}"), F.lit(False)).collect(), [row[:2]], lambda _: False)


def test_fitted_on_all_training_documents(spark, monkeypatch):
    """Every training document's windows reach the fit, however many ids there are."""
    monkeypatch.setattr(lm_score, "LEAST_IDS", 0)
    monkeypatch.setattr(lm_score, "BUCKET", 500)
    seen = []

    def counted(windows, start, buckets):
        seen.append(windows.count())
        return start

    monkeypatch.setattr(lm_score, "fitted", counted)
    rows = [(i, "on the one " * 5) for i in range(60)]
    lm_score.score_texts(spark.createDataFrame(rows, DOCS), F.col("doc_id") % 2 == 0).collect()
    assert seen == [30]


def test_windows_of_a_batch_are_made_together():
    """The same windows as text by text, places that depend on the text alone, and no Arrow batch for each text."""
    import pyarrow as pa

    class Known:
        id, value = -7, (lm_score.VOCABULARY, {i: 5 for i in range(3000)}, {b" ": 1})

    texts = ["on the one " * n for n in (0, 1, 7, 30, 31)] + [None, "É\u0000😀 a b\x1c漢字", "w" * 900]
    dice = [-(1 << 63), (1 << 63) - 1, *range(2, len(texts))]
    batch = lambda rows: pa.RecordBatch.from_pydict({"text": pa.array([texts[i] for i in rows], pa.string()), "dice": pa.array([dice[i] for i in rows], pa.int64())})
    of = lambda rows: list(lm_score._windows(Known, 5)(iter([batch(rows)])))
    found = of(range(len(texts)))
    assert len(found) == 1
    apart = [r for i in range(len(texts)) for b in of([i]) for r in b.to_pylist()]
    assert found[0].to_pylist() == apart and len({r["place"] for r in apart}) == len(apart)
    assert all(r["bucket"] == r["place"] % 5 and 0 <= r["place"] < 1 << 62 for r in apart)
    speller = lm_score.Speller(lm_score.VOCABULARY)
    slot, end = lm_score.Layout(Known.value[1], speller.opens).slot, np.array([attention.END], np.int16)
    want = [np.concatenate([*([slot[speller.spell(w)[0]]] if (w := lm_score.words_of(t)) else []), end]) for t in texts]
    rows = [np.frombuffer(r["slots"], "<i2") for r in apart]
    assert np.array_equal(np.concatenate([r[-attention.SPAN :][r[-attention.SPAN :] >= 0] for r in rows]), np.concatenate(want))


def test_words_of_many_texts_at_once():
    """The same words and keys as text by text, and small batches that share their look-ups."""
    import pyarrow as pa

    texts = [None, "", " \t\n ", "  A b\x0bÀ\x1cc\r", "x", "É\u0000😀 a b\x1c漢字 ﬁ\u00a0ÀZ", "w" * 65 + " " + "W" * 64, "on the one"]
    words, of = lm_score.words_in(pa.array(texts, pa.string()))
    want = [[w for w in words_of(t)] for t in texts]
    assert words.to_pylist() == [w.encode() for own in want for w in own]
    assert of.tolist() == [i for i, own in enumerate(want) for _ in own]
    assert lm_score.keys_of(words).to_pylist() == [lm_score.key_of(w) for w in words.to_pylist()]
    assert lm_score.words_in(pa.array([], pa.string()))[0].to_pylist() == []

    class Known:
        id, value = -8, (lm_score.VOCABULARY, {i: 5 for i in range(3000)}, {b" ": 1})

    batch = lambda rows: pa.RecordBatch.from_pydict({"text": pa.array([texts[i] for i in rows], pa.string()), "dice": pa.array(list(rows), pa.int64())})
    of = lambda *batches: list(lm_score._windows(Known, 5)(iter(map(batch, batches))))
    apart, (whole,) = of(range(3), range(0), range(3, 5), range(5, 8)), of(range(8))
    assert len(apart) == 1 and apart[0].equals(whole)
    assert of(range(0)) == of() == []


def test_counts_in_parts(monkeypatch):
    """Counts that a task hands on in parts add up, of training texts and of others."""
    from collections import Counter

    import pyarrow as pa

    monkeypatch.setattr(lm_score, "COUNTED", 64)
    texts = ["on the one " * 3, "The x" + "y" * 70, None, "one", "ONE two"]
    trains = [True, False, True, True, False]
    batches = (pa.RecordBatch.from_pydict({"text": pa.array([t], pa.string()), "train": [own]}) for t, own in zip(texts, trains, strict=True))
    parts = [r for b in lm_score._counting(lm_score.VOCABULARY)(batches) for r in b.to_pylist()]
    learned, all_texts = Counter(), Counter()
    for r in parts:
        if r["key"] is not None:
            learned[r["key"]] += r["c"]
            all_texts[r["key"]] += r["n"]
    want = [lm_score.words_of(t) for t in texts]
    assert all_texts == Counter(lm_score.key_of(w) for own in want for w in own)
    assert +learned == Counter(lm_score.key_of(w) for own, train in zip(want, trains, strict=True) for w in own if train)
    ids = lm_score.Speller(lm_score.VOCABULARY).spell([w for own, train in zip(want, trains, strict=True) for w in own if train])[0]
    found = Counter()
    for r in parts:
        if r["key"] is None:
            found[r["id"]] += r["c"]
    assert found == Counter(ids.tolist())
