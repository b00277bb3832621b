"""Operators do the whole job: nothing is left out at a size."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from folioworks.llm import source_mix
from folioworks.llm.decontaminate import Index, clean_documents, contaminated_regions
from folioworks.llm.quality_rules import Rules, good_documents, quality_verdicts
from folioworks.llm.simhash import one_of_each_class
from folioworks.llm.suffix_dedup import remove_repeats
from folioworks.llm.toxicity import _distinct_texts


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n))


# 8. Decontamination


@pytest.mark.parametrize("size", [300, 110, 63])
def test_every_verbatim_quote_of_63_bytes_is_found(size):
    rng = random.Random(size)
    item = words(rng, 80)[:size].strip().ljust(size, "x")
    index = Index([(1, item)])
    for at in range(0, size - 63 + 1):
        text = words(rng, 20) + " " + item[at : at + 63] + " " + words(rng, 20)
        assert {x[0] for x in index.search(text)} == {1}, at


def test_short_items_and_items_without_an_id_are_searched(spark):
    docs = spark.createDataFrame([(1, "They said: Twelve apples\nfell, and then"), (2, "category"), (3, "a CAT sat"), (4, "so 7+5=12, it is"), (5, None), (6, ""), (7, "an unnamed passage of text")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "twelve apples fell"), (2, "cat"), (3, "7+5=12"), (None, "unnamed passage"), (None, "of"), (4, None), (5, " \n")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated_regions(docs, bench).collect()}
    assert got == {(1, 1), (3, 2), (4, 3), (7, None)}
    assert sorted(r.doc_id for r in clean_documents(docs, bench).collect()) == [2, 5, 6]


# 9. Quality rules


def test_junk_of_40_to_99_words_fails_and_prose_stays(spark):
    rng = random.Random(4)
    common = ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "as"]

    def prose(n: int) -> str:
        return " ".join(rng.choice(common) if rng.random() < 0.5 else words(rng, 1) for _ in range(n))

    rows = [(i, prose(rng.randint(40, 300)), "en") for i in range(200)]
    rows += [(1000 + n, words(rng, n), "en") for n in range(40, 100, 5)]
    got = {r.doc_id: r for r in quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(r.common_distance is not None for r in got.values())
    assert not any(got[1000 + n].kept for n in range(40, 100, 5))
    assert all(got[i].kept for i in range(200))


# The pipeline


def test_rows_of_one_id_are_chosen_by_their_class(spark):
    rng = random.Random(10)
    one, two, three, four = (words(rng, 200) for _ in range(4))
    rows = [
        (1, one, "en", "a", 1),
        # An unrelated text, and a copy of document 1 beside it.
        (7, two, "en", "a", 1),
        (7, one, "en", "b", 1),
        # Two unrelated texts.
        (8, three, "en", "a", 1),
        (8, four, "en", "a", 1),
        # A copy of one of them; a repeated row; rows of one text that differ elsewhere.
        (9, four, "en", "a", 1),
        (7, two, "en", "a", 1),
        (8, three, "en", "c", 1),
        # A copy without an id goes, as one of its class has one.
        (None, four, "en", "a", 1),
    ]
    got = []
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(parts)
        kept = corpus_pipeline.near_duplicates(spark, docs, "")
        assert kept.columns == docs.columns
        got.append(sorted(map(tuple, kept.collect()), key=str))
    assert got[0] == got[1]
    assert sorted((r[0], r[1]) for r in got[0] if r[0]) == sorted([(1, one), (7, two), (8, three), (8, four)])
    assert not [r for r in got[0] if r[0] is None]


#: Names that the filters give to columns of their own, in either case.
OWN_NAMES = ["_repeat_key", "_REPEAT_TEXT", "_repeat_spans", "_repeat_maybe", "_language", "_language_reference", "_dup_id", "_dup_text", "_Dup_Row", "_dup_first", "_dup_here", "_dup_maybe", "_dup_body", "k", "spans", "fp", "n", "root"]


def good_of_rare_languages(documents):
    return good_documents(documents, Rules(most_broadcast=1))


@pytest.mark.parametrize("filtered", [good_of_rare_languages, one_of_each_class, remove_repeats], ids=lambda f: f.__name__)
def test_columns_of_any_name_are_kept(spark, filtered):
    rng = random.Random(5)
    shared = words(rng, 60)
    texts = [f"{words(rng, 40)} {shared if i % 3 == 0 else ''} {words(rng, 40)}" for i in range(30)]
    rows = [(i, t, "en" if i % 4 else "fr") for i, t in enumerate(texts + texts[:5])] + [(None, None, None), (99, "", "en"), (100, texts[0], None)]
    types = "doc_id long, text string, lang string"
    plain = spark.createDataFrame(rows, types)
    wide = spark.createDataFrame([(*r, *(None if r[0] is None else f"{name}{r[0]}" for name in OWN_NAMES)) for r in rows], ", ".join([types, *(f"`{name}` string" for name in OWN_NAMES)])).repartition(3)
    got = filtered(wide)
    assert got.columns == wide.columns
    found = got.collect()
    assert all(r[name] == (None if r.doc_id is None else f"{name}{r.doc_id}") for r in found for name in OWN_NAMES)
    if filtered is one_of_each_class:
        assert sorted(r.doc_id for r in found) == [*range(30), 99]
    elif filtered is remove_repeats:
        assert len(found) == len(rows) and not [r for r in found if shared in (r.text or "")]
    else:
        assert sorted(str(r[:3]) for r in found) == sorted(str(r[:3]) for r in filtered(plain).collect())


# 7. Mixing sources


def test_mix_has_no_bound_of_sources(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(i, words(rng, rng.choice([0, 3, 70, 900])), f"s{i % 40}" if i % 7 else None) for i in range(300)] + [(1000, words(rng, 9000), "big"), (1001, "", "no words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    due = sorted(map(tuple, source_mix.mix_sources(docs, shard=50).collect()))
    planned = source_mix.plan_streams(source_mix.sizes(docs)).cache()
    slots = sorted(map(str, source_mix.draw_slots(planned, shard=50).collect()))
    monkeypatch.setattr(source_mix, "MOST_SOURCES", 10)
    assert sorted(map(tuple, source_mix.mix_sources(docs, shard=50).collect())) == due
    assert sorted(map(str, source_mix.draw_slots(planned, shard=50).collect())) == slots


# 3. Toxicity


def test_only_near_copies_are_left_out_of_the_fit():
    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(1, 2**32, 4000, dtype=np.uint32))
    mixed = (pool * np.uint32(2654435761)) ^ (pool >> np.uint32(15))
    # Every row has the hash that is least and the one that is least mixed.
    shared = np.array([pool[0], pool[mixed.argmin()]])
    rows = [np.unique(np.append(rng.choice(pool, 100, replace=False), shared)) for _ in range(30)]
    copies = [np.delete(r, 50) for r in rows if r[50] not in shared]
    kept, toxic = _distinct_texts(rows + copies, np.array([i % 2 == 0 for i in range(30)] + [bool(i % 2 == 0) for i, r in enumerate(rows) if r[50] not in shared]))
    assert len(kept) == 30 and all((a == b).all() for a, b in zip(kept, rows, strict=True)) and toxic.sum() == 15
