"""The operators of the llm subpackage against brute force, and on hard tables."""

from __future__ import annotations

import hashlib
import html
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from folioworks.llm import queries
from folioworks.llm.chat_format import rotate_perspectives
from folioworks.llm.components import connected_components
from folioworks.llm.decontaminate import Index, align, clean_documents, contaminated_regions
from folioworks.llm.html_extract import extract, extract_main_text, winning_paths
from folioworks.llm.language_id import gram_buckets, identify
from folioworks.llm.quality_classifier import DECAY, estimate_prior, fit_risk, risk, score_quality
from folioworks.llm.quality_rules import Rules, base_counts, good_documents, js_distance, quality_verdicts
from folioworks.llm.simhash import fingerprint, links, simhash_classes
from folioworks.llm.source_mix import draw_slots, mix_sources, plan_streams, sizes, targets
from folioworks.llm.suffix_dedup import LENGTH, merged, remove_repeats, repeat_digests
from folioworks.llm.toxicity import fit, likelihood, score_toxicity, word_hashes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Column names that the operators use inside.
CLASH = ["fp", "k", "at", "key", "n", "size", "block", "path", "host", "g", "s", "count", "data", "spans", "row", "component_id", "kept", "score", "root", "label", "part", "piece", "words", "target", "node"]


def prose(rng: random.Random, n: int) -> str:
    syllables = ["an", "the", "ti", "on", "er", "re", "wh", "st", "ed", "ou", "in", "ha"]
    common = ["the", "of", "and", "to", "in", "is"]
    words = [rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(words)


def hard_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    shared = prose(rng, 80)
    long = prose(rng, 40_000)
    rows = [(i, prose(rng, rng.randint(5, 300)), "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [(100 + i, shared + " " + prose(rng, 30 * i), "en", "s0", 1) for i in range(6)]
    rows += [(200, long, "en", "s1", 1), (201, long, "en", "s1", 1), (202, long[:-5], "en", None, None)]
    rows += [(300, None, None, None, None), (301, "", "en", "s2", 0), (302, " \n\t ", "xx", "s2", 3), (303, "###", None, "s9", 3), (304, "É\u0000😀 漢字 ﬁ", "zz", "s9", 9)]
    rows += [(0, rows[0][1], "en", "s0", 1)] * 2 + [(None, "an id is missing here", "en", "s0", 1), (400, "dup dup", "en", "s0", 1), (400, "other text", "en", "s0", 1)]
    return rows


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(hard_rows(), DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 40)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, hard_rows()[3][1][:150]), (2, None), (3, ""), (None, "x" * 60)], "item_id long, text string")


DOCUMENT_OPERATORS = {
    "language": lambda d, l, b: identify(d, F.col("doc_id") % 2 == 0),
    "quality_rules": lambda d, l, b: quality_verdicts(d),
    "simhash": lambda d, l, b: simhash_classes(d),
    "repeats": lambda d, l, b: repeat_digests(d),
    "quality_classifier": lambda d, l, b: score_quality(d, l, F.col("doc_id") % 5 > 0),
    "toxicity": lambda d, l, b: score_toxicity(d, l),
    "mix": lambda d, l, b: mix_sources(d),
}


@pytest.mark.parametrize("name", DOCUMENT_OPERATORS)
def test_one_row_a_document_whatever_the_rows(spark, hard, labels, benchmark, name):
    operator = DOCUMENT_OPERATORS[name]
    got = operator(hard, labels, benchmark).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == Counter(r[0] for r in hard_rows())


@pytest.mark.parametrize("name", DOCUMENT_OPERATORS)
def test_empty_tables(spark, labels, benchmark, name):
    empty = spark.createDataFrame([], DOCS)
    assert DOCUMENT_OPERATORS[name](empty, labels.limit(0), benchmark.limit(0)).collect() == []


@pytest.mark.parametrize("name", DOCUMENT_OPERATORS)
def test_extra_columns_change_nothing(spark, hard, labels, benchmark, name):
    few = hard.where("doc_id < 20 or doc_id >= 300")
    plain = DOCUMENT_OPERATORS[name](few, labels, benchmark)
    wide = DOCUMENT_OPERATORS[name](few.select("*", *(F.lit("x").alias(c) for c in CLASH)), labels, benchmark)
    assert sorted(map(str, plain.collect())) == sorted(map(str, wide.collect()))


def test_filters_keep_all_columns_and_hard_rows(spark, hard, benchmark):
    wide = hard.select("*", *(F.lit(1).alias(c) for c in CLASH))
    for frame in (good_documents(wide), clean_documents(wide, benchmark), remove_repeats(wide)):
        assert frame.columns == wide.columns
        frame.collect()
    assert clean_documents(hard, benchmark.limit(0)).count() == hard.count()
    assert contaminated_regions(hard, benchmark.limit(0)).collect() == []


# 1. Chat formatting


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")


def test_perspectives_rotate_and_mask(spark):
    rows = [(1, 0, "system", "S", "x"), (1, 1, "ann", "hi", "x"), (1, 2, "bob", "yo", "x"), (1, 3, "cy", None, "x")]
    got = {r.perspective: r for r in rotate_perspectives(turns(spark, rows)).collect()}
    assert set(got) == {"ann", "bob", "cy"}
    assert got["bob"].text == "<|system|>\nS<|end|>\n<|user name=ann|>\nhi<|end|>\n<|assistant|>\nyo<|end|>\n<|user name=cy|>\n<|end|>\n"
    for name, row in got.items():
        assert sum(row.segment_chars) == len(row.text)
        at, learnt = 0, ""
        for n, mask in zip(row.segment_chars, row.segment_mask, strict=True):
            learnt += row.text[at : at + n] * mask
            at += n
        assert learnt == {"ann": "hi<|end|>\n", "bob": "yo<|end|>\n", "cy": "<|end|>\n"}[name]


def test_long_and_odd_conversations_come_in_whole_parts(spark):
    rows = [(7, i, "ab"[i % 2], str(i), "x") for i in range(700)] + [(7, 3, "a", "3", "x")] * 300 + [(None, None, None, None, "x"), (8, 0, "system", "only", "x")]
    got = rotate_perspectives(turns(spark, rows)).collect()
    parts = sorted((r for r in got if r.conv_id == 7 and r.perspective == "a"), key=lambda r: (r.part, r.piece))
    said = "".join(r.text for r in parts).replace("<|assistant|>\n", "").replace("<|user name=b|>\n", "").split("<|end|>\n")[:-1]
    assert said == [r[3] for r in sorted((r for r in rows if r[0] == 7), key=lambda r: (r[1], r[2], r[3]))]
    assert max(r.n_turns for r in got) <= 256
    assert [r.perspective for r in got if r.conv_id is None] == ["unknown"]
    assert not [r for r in got if r.conv_id == 8]
    assert rotate_perspectives(turns(spark, rows).limit(0)).collect() == []


def test_crowded_parts_are_ordered_alike(spark, monkeypatch):
    """Parts with a large share of all rows, also of equal rows, give what one window gives."""
    rng = random.Random(5)
    rows = [(1, None, rng.choice("ab"), prose(rng, 2), "x") for _ in range(700)] + [(1, None, "a", "same", "x")] * 500 + [(None, 3, "b", None, "x")] * 300
    rows += [(2, i, "ab"[i % 2], str(i), "x") for i in range(40)]
    frame = turns(spark, rows).repartition(3)
    due = sorted(map(str, rotate_perspectives(frame).collect()))
    monkeypatch.setattr("folioworks.llm.chat_format.CROWD", 50)
    assert sorted(map(str, rotate_perspectives(frame).collect())) == due
    wide = frame.select("*", *(F.lit("x").alias(c) for c in ("piece", "place", "rows", "range", "salt", "rank", "start", "perspective", "turns", "n_turns")))
    assert sorted(map(str, rotate_perspectives(wide).collect())) == due


# 2. HTML extraction

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="sidebar"><p>Side words here</p></div><article class="post-17"><h1>Head &amp; tail</h1><p><b>One
 two.<br><p>Three &lt;x&gt;&nbsp;four</p><div class="ad">Buy now</div><p>Five <a href="#">six</a></p><form><p>Mail</p></form><section class="comments"><p>First!</p></section></article><footer>&copy; us</footer>"""


def test_article_text_only():
    assert extract(PAGE, None) == "Head & tail\n\nOne two.\n\nThree <x> four\n\nFive six"
    assert extract(PAGE, "html>body>article.post-#") == extract(PAGE, None)
    assert extract(PAGE, "html>body>div.gone") == extract(PAGE, None)


@pytest.mark.parametrize("source", [None, "", "<", "<p", "<p>a", "<article><p>a<", "<script>x", "<!-- x", "plain words", "</p></div>", "<b><i>x</b></i>", "<div hidden>x</div>"])
def test_broken_pages(source):
    text = extract(source, None)
    assert isinstance(text, str) and "<" not in text.strip("<")


@pytest.mark.parametrize(
    ("body", "due"),
    [
        ("<div class='layout has-sidebar'><main><h2>A</h2><p>long words here</p></main><aside><p>side</p></aside></div>", "A\n\nlong words here"),
        ("<div id='content-1'><header><h1>T</h1></header><p>one<p>two<ul><li>x<li>y</ul></div><div id='comments'><p>me too</p></div>", "one\n\ntwo\n\nx\n\ny"),
        ("<article><header><h1>T</h1></header><p>a<br>b</p><table><tr><td>1<td>2</table></article><div role='complementary'>r</div>", "T\n\na b\n\n1\n\n2"),
        ("<article><p>kept</p><div class='share-buttons'>share</div><div style='display: none'>gone</div><noscript><p>off</p></noscript><p>end <b", "kept\n\nend"),
    ],
)
def test_layouts(body, due):
    assert extract(f"<html><body><nav>menu</nav>{body}", None) == due


def test_hosts_vote_and_pages_follow(spark):
    good = "<html><body><div class='main-{0}'><p>" + "word " * 60 + "</p></div><div class='extra'><p>{1}</p></div></body></html>"
    rows = [(i, f"https://A.example.org:80/{i}", good.format(i, "short"), "x") for i in range(5)]
    rows += [(9, "https://a.example.org/9", "<html><body><div class='main-9'><p>tiny</p></div><div class='extra'><p>" + "spam " * 90 + "</p></div></body></html>", "x")]
    rows += [(10, None, None, "x"), (10, "nonsense", "<p>alone</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, path string")
    assert {r.host: r.path for r in winning_paths(pages).collect()}["a.example.org"] == "html>body>div.main-#"
    for few in (100, 0):
        got = sorted((r.page_id, r.text, r.n_chars) for r in extract_main_text(pages, most_hosts=few).collect())
        assert (9, "tiny", 4) in got and (10, "", 0) in got and (10, "alone", 5) in got and len(got) == len(rows)
    assert extract_main_text(pages.limit(0)).collect() == []


def test_pages_table_against_its_articles(spark):
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    got = {r.page_id: r.text for r in queries.QUERIES["op2_html_extract"](spark, "/root/testdata/sf0.001").collect()}
    for row in pages:
        body = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", body)]
        assert got[row.page_id] == "\n\n".join(b for b in blocks if b)


# 3. Toxicity


def test_toxic_words_are_learnt_and_ordered(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        bad = [w for w in ("vilest", "grossly", "scummish") if i % 4 == 0 and rng.random() < 0.7]
        words = prose(rng, 60).split() + bad
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(i % 4 == 0), len(bad)))
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    marks = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] < 250], "doc_id long, toxic int")
    got = {r.doc_id: r for r in score_toxicity(docs, marks).collect()}
    late = [r for r in rows if r[0] >= 250]
    assert sum(got[r[0]].is_toxic == (r[3] > 0) for r in late) / len(late) > 0.97
    by_count = defaultdict(list)
    for r in late:
        by_count[r[3]].append(got[r[0]].expected_severity)
    means = [np.mean(by_count[k]) for k in sorted(by_count)]
    assert means == sorted(means) and all(0 <= r.expected_severity <= 3 for r in got.values())


def test_thresholds_are_ordered_and_weights_shared():
    words = np.array([3, 7], np.uint32)
    rows = [np.array(x, np.uint32) for x in ([1], [3], [3, 7], [7], [1, 2])] * 20
    model = fit(rows, np.array([0, 1, 3, 2, 0] * 20), words)
    assert (np.diff(model.thresholds) > 0).all()
    assert len(word_hashes(None)) == 0


def test_likelihood_is_at_its_most():
    """No small step of weights or thresholds raises the ordinal likelihood, computed apart."""
    rng = np.random.default_rng(2)
    words = np.array([3, 7, 9], np.uint32)
    rows = [np.array(sorted({int(rng.integers(20, 99)), *words[rng.random(3) < 0.4].tolist()}), np.uint32) for _ in range(400)]
    held = np.array([[w in r for w in words] for r in rows], float)
    grades = np.clip(held @ [1, 2, 3] + rng.integers(-1, 2, 400), 0, 3).astype(int)
    model = fit(rows, grades, words, steps=3000)

    def by_hand(weights, length, cuts):
        total = 0.0
        for row, g in zip(rows, grades, strict=True):
            z = sum(w for w, k in zip(weights, words, strict=True) if k in row) + length * np.log(1 + len(row))
            for k, t in enumerate(cuts, 1):
                p = 1 / (1 + np.exp(-(z - t)))
                total += np.log(p if g >= k else 1 - p)
        return total

    best = by_hand(model.weights, model.length, model.thresholds)
    assert best == pytest.approx(likelihood(model, rows, grades), rel=1e-6)
    for i in range(3):
        for d in (-0.3, 0.3):
            step = np.eye(3)[i] * d
            assert by_hand(model.weights + step, model.length, model.thresholds) < best
            assert by_hand(model.weights, model.length, model.thresholds + step / 3) < best


def test_given_grades_are_learnt_as_they_are(spark):
    rng = random.Random(3)
    bad = ["vilest", "grossly", "scummish"]
    rows = [(i, prose(rng, 50) + " " + " ".join(bad[: i % 4]), i % 4) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in score_toxicity(docs, spark.createDataFrame([(r[0], r[2]) for r in rows[:300]], "doc_id long, toxic int")).collect()}
    assert sum(got[r[0]].grade == r[2] for r in rows[300:]) > 95
    assert all(abs(got[r[0]].expected_severity - r[2]) < 0.6 for r in rows[300:])


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.01"
    docs, marks = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = score_toxicity(docs, marks.where("doc_id % 2 = 0")).join(marks.where("doc_id % 2 = 1"), "doc_id").collect()
    clean = [r for r in got if not r.toxic]
    assert sum(r.is_toxic for r in clean) / len(clean) < 0.05
    assert sum(r.is_toxic for r in got if r.toxic) / sum(r.toxic for r in got) > 0.4


# 4. Language identification


def test_held_out_languages(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES["op4_language_id"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_no_letters_is_undetermined(spark):
    docs = spark.createDataFrame([(1, "abc abc", "aa"), (2, "123 ##", "aa"), (3, None, "bb"), (4, "xyz xyz", "bb"), (5, "xy", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in identify(docs, F.lit(True)).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5)] == ["aa", "und", "und", "bb", "bb"]
    assert got[2].score == 0
    assert {r.lang_pred for r in identify(docs, F.lit(False)).collect()} == {"und"}


def grams_by_hand(texts):
    found = Counter()
    for i, text in enumerate(texts):
        letters = "".join(c.lower() if c.isalpha() else " " for c in text)
        found.update((i, letters[a : a + n]) for n in (1, 2, 3) for a in range(len(letters) - n + 1) if letters[a : a + n].strip())
    return found


@pytest.mark.parametrize("part", [1 << 18, 97, 5])
def test_grams_by_hand_in_parts_of_any_length(monkeypatch, part):
    texts = [prose(random.Random(3), 80) + "é漢 x", "", "a", "- b -", prose(random.Random(4), 30)]
    monkeypatch.setattr("folioworks.llm.language_id.PART", part)
    got = Counter()
    for numbers, ids in gram_buckets(texts, 1 << 40):
        assert (np.diff(numbers) >= 0).all()
        got.update(zip(numbers.tolist(), ids.tolist(), strict=True))
    due = grams_by_hand(texts)
    assert sorted(got.values()) == sorted(due.values())
    assert Counter(i for i, _ in got.elements()) == Counter(i for i, _ in due.elements())


@pytest.mark.parametrize("block", [1, 2, 256])
def test_naive_bayes_by_hand_in_any_blocks(spark, block):
    """Every language counts, however many there are beyond a block."""
    rng = random.Random(6)
    rows = [(i, prose(random.Random(i % 5), 8) + rng.choice(["", " ka", " zu"]) + f" {chr(97 + i % 5) * 3}", f"l{i % 5}") for i in range(40)] + [(90, "12", "l1"), (91, None, "l0"), (92, "aaa", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in identify(docs, F.col("doc_id") < 30, block=block).collect()}
    trained = [r for r in rows if r[0] < 30]
    langs = sorted({r[2] for r in trained})
    buckets = 1 << 14
    counts = {x: Counter() for x in langs}
    for _, text, lang in trained:
        for _, ids in gram_buckets([text]):
            counts[lang].update(ids.tolist())
    for doc_id, text, _ in rows:
        if not text or not any(c.isalpha() for c in text):
            assert got[doc_id].lang_pred == "und" and got[doc_id].score == 0
            continue
        ids = [int(x) for _, part in gram_buckets([text]) for x in part]
        logs = [np.log(sum(r[2] == x for r in trained) / len(trained)) + sum(np.log((counts[x][i] + 0.5) / (counts[x].total() + 0.5 * buckets)) for i in ids) for x in langs]
        assert got[doc_id].lang_pred == langs[int(np.argmax(logs))]
        assert got[doc_id].score == pytest.approx(1 / sum(np.exp(x - max(logs)) for x in logs), rel=1e-3)


# 5. Suffix-array repeats


def repeats_by_hand(rows):
    """Every document's removed ranges, from all strings of LENGTH bytes."""
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i : i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    out = []
    for (doc_id, *_), data in zip(rows, texts, strict=True):
        ranges = []
        for i in range(len(data) - LENGTH + 1):
            if seen[data[i : i + LENGTH]] > 1:
                if ranges and i <= ranges[-1][1]:
                    ranges[-1][1] = i + LENGTH
                else:
                    ranges.append([i, i + LENGTH])
        kept, at = b"", 0
        for a, b in ranges:
            kept, at = kept + data[at:a], b
        out.append((doc_id, len(data), sum(b - a for a, b in ranges), len(ranges), hashlib.sha256(kept + data[at:]).hexdigest()))
    return sorted(out, key=str)


def repeat_cases():
    rng = random.Random(11)
    a, b = prose(rng, 90), prose(rng, 120)
    rows = [(1, a), (2, a), (3, prose(rng, 50) + a[:400] + prose(rng, 30)), (4, prose(rng, 20) + a[100:300] + b), (5, b[5:] + " x"), (6, a[:199]), (7, "ab" * 400), (8, "z" * 250), (9, "é" * 300 + a[50:260]), (10, None), (11, ""), (12, prose(rng, 300)), (12, prose(rng, 300)), (1, a)]
    for i in range(60):
        cut = rng.randint(0, 200)
        middle = list(b)
        for _ in range(rng.randint(0, 3)):
            middle[rng.randrange(len(middle))] = "#"
        rows.append((100 + i, prose(rng, rng.randint(0, 30)) + "".join(middle)[cut : cut + rng.randint(150, 500)] + prose(rng, 10)))
    return rows


def test_repeats_against_all_strings(spark):
    rows = repeat_cases()
    got = repeat_digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == repeats_by_hand(rows)


def test_repeats_in_parts(spark, monkeypatch):
    """Texts longer than a part, and parts worked on together, by the windows that their suffixes have."""
    from folioworks.llm import suffix_dedup

    texts = [(i, prose(random.Random(i), n).encode()) for i, n in enumerate((700, 90, 3, 400))]

    def windows():
        found = Counter()
        for parts in suffix_dedup._parts(iter(texts)):
            got = suffix_dedup.Suffixes(parts)
            for owner, first, last, place, bucket in zip(got.owner, got.first, got.last, got.place, got.bucket, strict=True):
                key, base, _ = parts[owner]
                for window in range(first, last + 1):
                    found[key, base + int(window - got.start[owner]), base + int(place - got.start[owner]), int(bucket)] += 1
        return found

    whole = windows()
    assert len(whole) == sum(max(0, len(t) - LENGTH + 1) for _, t in texts) == whole.total()
    monkeypatch.setattr(suffix_dedup, "PART", 500)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 800)
    assert windows() == whole


def test_buckets_are_those_of_the_bytes():
    from folioworks.llm import suffix_dedup

    data = (b"abcdefgh" * 40 + bytes(range(200)) + b"abcdefgh" * 40)[:800]
    code = suffix_dedup.gram_buckets(np.frombuffer(data, np.uint8))
    wide = suffix_dedup._wider(code, np.arange(len(data) - LENGTH + 1), LENGTH)
    for found, width in ((code, suffix_dedup.Q), (wide, LENGTH)):
        of: dict = {}
        for i, bucket in enumerate(found.tolist()):
            assert of.setdefault(data[i : i + width], bucket) == bucket
        assert len(set(of.values())) == len(of)


def test_removed_text_keeps_whole_characters(spark):
    shared = "é漢" * 100
    rows = [(1, "a" + shared + "b"), (2, "cc" + shared + "d"), (3, None)]
    got = {r.doc_id: r.text for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "ab", 2: "ccd", 3: None}
    assert merged(None) == []


# 6. Quality classifier


def test_a_repeated_id_does_not_take_the_sample(spark, monkeypatch):
    """Ids are made distinct before the sample is bounded."""
    from folioworks.llm import quality_classifier as Q

    chosen = []
    unpacked = Q._unpacked
    monkeypatch.setattr(Q, "_unpacked", lambda rows: chosen.append(len(rows)) or unpacked(rows))
    rng = random.Random(16)
    docs = spark.createDataFrame([(i, prose(rng, 60)) for i in range(300)], "doc_id long, text string")
    first = spark.range(200).orderBy(F.xxhash64("id")).first()[0]
    labels = spark.createDataFrame([(i, 1) for i in range(200)] + [(first, 1)] * 5000, "doc_id long, quality int")
    Q.learn(docs, labels, F.lit(True), sample=200)
    assert chosen[:2] == [200, 200]


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES["op6_quality_classifier"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    good = [r for r in got if r.quality == 1]
    bad = [r for r in got if r.quality == 0]
    assert sum(r.predicted for r in good) / len(good) > 0.95
    assert sum(1 - r.predicted for r in bad) / len(bad) > 0.6
    assert all(0 <= r.score <= 1 for r in got)


def test_prior_and_risk_on_known_mixtures():
    rng = np.random.default_rng(0)
    one = np.ones((3000, 1), np.float32)
    positives = np.hstack([rng.normal(2, 1, (3000, 1)), one]).astype(np.float32)
    mixed = np.hstack([np.where(rng.random((3000, 1)) < 0.7, rng.normal(2, 1, (3000, 1)), rng.normal(-3, 1, (3000, 1))), one]).astype(np.float32)
    assert abs(estimate_prior(positives, mixed) - 0.7) < 0.06
    w = fit_risk(positives, mixed, 0.7)
    assert w[0] > 0 and 1 / (1 + np.exp(-(w[0] * -3 + w[1]))) < 0.1 < 0.9 < 1 / (1 + np.exp(-(w[0] * 2.5 + w[1])))


def test_risk_is_at_its_least():
    """No small step from the fitted weights lowers the risk as defined, computed apart."""
    rng = np.random.default_rng(1)
    one = np.ones((500, 1))
    p = np.hstack([rng.normal(1, 1, (500, 2)), one]).astype(np.float32)
    u = np.hstack([np.where(rng.random((500, 1)) < 0.5, rng.normal(1, 1, (500, 2)), rng.normal(-1, 1, (500, 2))), one]).astype(np.float32)

    def by_hand(w, prior):
        positive = sum(np.log1p(np.exp(-float(x @ w))) for x in p) / len(p)
        as_negative = sum(np.log1p(np.exp(float(x @ w))) for x in p) / len(p)
        unlabelled = sum(np.log1p(np.exp(float(x @ w))) for x in u) / len(u)
        return prior * positive + max(0, unlabelled - prior * as_negative)

    w = fit_risk(p, u, 0.5, steps=600)
    assert risk(w, p, u, 0.5) == pytest.approx(by_hand(w, 0.5) + DECAY / 2 * float(w[:-1] @ w[:-1]), rel=1e-4)
    assert all(by_hand(w + 0.3 * step, 0.5) > by_hand(w, 0.5) - 1e-3 for step in np.vstack([np.eye(3), -np.eye(3)]))
    # A row that stands for k rows is as good as k rows.
    k = rng.integers(1, 4, len(u))
    assert np.allclose(fit_risk(p, u, 0.5, weights=k), fit_risk(p, np.repeat(u, k, axis=0), 0.5), atol=2e-2)


def test_every_unlabelled_text_counts(spark, monkeypatch):
    """Numbers and sums by range are those of all texts, whatever the partitions; the sample only sets the ranges."""
    from folioworks.llm import quality_classifier as Q

    rng = random.Random(15)
    rows = [(i, prose(rng, rng.randint(0, 80)) + " ###" * (i % 3)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1) for i in range(0, 300, 3)], "doc_id long, quality int")
    seen = []
    fit = Q.fit_risk
    monkeypatch.setattr(Q, "fit_risk", lambda p, u, prior, weights: seen.append((u, weights, prior)) or fit(p, u, prior, weights=weights))
    for parts in (1, 7):
        model = Q.learn(docs.repartition(parts), marks, F.lit(True), sample=40)
        means, counts, _ = seen[-1]
        assert counts.sum() == 300
        whole = model.scale(np.array([Q.measures(t) for _, t in rows], np.float16).astype(np.float32))
        assert np.allclose((means * counts[:, None]).sum(axis=0), whole.sum(axis=0), atol=0.5)
    assert (seen[0][0] == seen[1][0]).all() and (seen[0][1] == seen[1][1]).all() and seen[0][2] == seen[1][2]


# 7. Mixing


def test_targets_are_shared_by_weight_below_the_caps(spark):
    rows = [(i, " ".join(["w"] * n), s) for i, (n, s) in enumerate([(10, "a"), (5, "b"), (1, "c"), (84, "d"), (0, "e"), (7, None)])]
    sized = sizes(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = {r.source: r for r in targets(sized).collect()}
    assert [got[s].weight for s in ("a", "b", "c", "d", "e", None)] == [1, 2, 3, 1, 2, 3]
    held, rest = {"e": 0.0}, {s: (r.source_size, r.weight) for s, r in got.items() if s != "e"}
    total = 107.0
    while True:
        level = (total - sum(held.values())) / sum(w for _, w in rest.values())
        over = [s for s, (n, w) in rest.items() if level * w > 3 * n]
        if not over:
            break
        for s in over:
            held[s] = 3.0 * rest.pop(s)[0]
    held |= {s: level * w for s, (_, w) in rest.items()}
    assert {s: round(r.target, 6) for s, r in got.items()} == {s: round(t, 6) for s, t in held.items()}


@pytest.mark.parametrize(("block", "shard"), [(4, 8), (64, 4096), (7, 3)])
def test_mix_takes_targets_and_never_over_three_times(spark, block, shard):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(0, 60)), "hot" if i % 3 else f"s{i % 7}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(docs, block=block, shard=shard).collect()
    taken, goal = Counter(), {}
    for r in got:
        assert r.size == len((rows[r.doc_id][1]).split()) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        goal[r.source] = r.target
    assert all(abs(taken[s] - t) <= 1 for s, t in goal.items())
    again = mix_sources(docs.repartition(7), block=block, shard=shard).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_slots_take_every_block_once_a_pass(spark):
    rows = [(i, "w " * (i % 9 + 1), f"s{i % 3}") for i in range(90)]
    planned = plan_streams(sizes(spark.createDataFrame(rows, "doc_id long, text string, source string")), 4)
    streams = {r.source: r for r in planned.collect()}
    slots = draw_slots(planned, 4, 16).collect()
    by_source = defaultdict(list)
    for s in slots:
        by_source[s.source].append(s)
    for source, found in by_source.items():
        found.sort(key=lambda s: s.k)
        assert [s.k for s in found] == list(range(streams[source].slots))
        n = streams[source].blocks
        for at in range(0, len(found), n):
            one = [s.block for s in found[at : at + n]]
            assert len(set(one)) == len(one) and set(one) <= set(range(n))
        assert [s.block for s in found[:n]] != sorted(s.block for s in found[:n])


def mixed_rows():
    rng = random.Random(21)
    rows = [(i, prose(rng, rng.randint(0, 40)), f"s{i % 9}" if i % 3 else "hot") for i in range(200)]
    rows += [(None, "one two three", "hot")] * 70 + [(None, None, "hot"), (7, "one two three", None), (7, "one two three", None), (8, "w " * 700, "s1")]
    return rows


def test_taken_words_by_hand(spark, monkeypatch):
    """Each slot's words, laid over the packed documents one by one; rows that are alike share one place."""
    from folioworks.llm import source_mix as M

    block = 8
    monkeypatch.setattr(M, "GROUP", 3)
    docs = spark.createDataFrame(mixed_rows(), "doc_id long, text string, source string").repartition(5)
    sized = sizes(docs.withColumn("text_hash", F.xxhash64("text")), "doc_id", "text", "source", "text_hash").withColumn("row", F.monotonically_increasing_id()).cache()
    words, owner_size = defaultdict(dict), {}
    for part in M.pack_blocks(sized, block, 20).collect():
        for at in range(part.start, part.start + part.words):
            assert words[part.source].setdefault(part.block * block + at, part.row) == part.row
        owner_size[part.row] = part.size
    for source, of in words.items():
        assert sorted(of) == list(range(len(of))), source
        assert all(n == owner_size[row] for row, n in Counter(of.values()).items())
    assert sum(map(len, words.values())) == sum(len((r[1] or "").split()) for r in mixed_rows())
    taken = Counter()
    for slot in draw_slots(plan_streams(sized, block), block, 16).collect():
        for at in range(slot.words):
            if slot.block * block + at in words[slot.source]:
                taken[words[slot.source][slot.block * block + at]] += 1
    due = Counter((r.doc_id, r.source, r["size"], taken[r.row]) for r in sized.collect())
    assert due == Counter((r.doc_id, r.source, r["size"], r.taken) for r in mix_sources(docs, block=block, shard=16, cell_rows=20).collect())


def test_many_sources_and_groups_change_nothing(spark, monkeypatch):
    from folioworks.llm import source_mix as M

    docs = spark.createDataFrame(mixed_rows(), "doc_id long, text string, source string")
    plain = sorted(map(str, mix_sources(docs, block=8, shard=16).collect()))
    for name, value in (("MOST_SOURCES", 3), ("FEW_SOURCES", 2), ("GROUP", 2)):
        monkeypatch.setattr(M, name, value)
        assert sorted(map(str, mix_sources(docs.repartition(3), block=8, shard=16).collect())) == plain, name


def test_permutations_are_whole_and_stir(spark):
    from folioworks.llm.source_mix import permuted

    sizes_ = [*range(1, 40), 97, 256, 257, 1000, 100_000]
    rows = spark.createDataFrame([(n, 11 * n) for n in sizes_], "blocks long, key long")
    rows = rows.withColumn("wide", F.ceil(F.sqrt("blocks")).cast("long")).withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    there = permuted(rows, "at", "to")
    got = there.groupBy("blocks").agg(F.count_distinct("to").alias("n"), F.min("to").alias("low"), F.max("to").alias("high"), F.count_if(F.col("at") == F.col("to")).alias("same")).collect()
    assert all(r.n == r.blocks and r.low == 0 and r.high == r.blocks - 1 for r in got)
    assert max(r.same for r in got if r.blocks >= 97) < 10
    assert permuted(there, "to", "back", backwards=True).where("back <> at").isEmpty()


def test_targets_by_sums_settle_as_by_hand(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([0, 1, 2, 30, 400]), f"h{i:03d}") for i in range(120)] + [(1, "w w", None)]
    got = targets(sizes(spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()
    by_name = sorted(got, key=lambda r: (r.source is None, r.source or ""))
    assert [r.weight for r in by_name] == [i % 3 + 1 for i in range(121)]
    low, high = 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(3 * r.source_size, level * r.weight) for r in got) < sum(r.source_size for r in got) else (low, level)
    assert all(r.target == pytest.approx(min(3 * r.source_size, low * r.weight), rel=1e-6) for r in got)


# 8. Decontamination


def best_edits(pattern: bytes, data: bytes) -> int:
    """Least edits of the pattern against any part of the data."""
    row = [0] * (len(data) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(data, 1):
            new.append(min(row[j - 1] + (p != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_search_finds_all_within_budget():
    rng = random.Random(8)
    items = [(i, prose(rng, 22)) for i in range(6)]
    index = Index(items)
    for trial in range(120):
        item = rng.randrange(6)
        text = list(items[item][1])
        for _ in range(trial % 14):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice([["q"], [], ["q", text[at]]])
        doc = prose(rng, 15) + " " + "".join(text) + " " + prose(rng, 15)
        found = {x[0] for x in index.search(doc)}
        for number, (item_id, _) in enumerate(items):
            due = [best_edits(p, doc.encode()) <= e for i, p, e in index.patterns if i == item_id]
            assert (item_id in found) == any(due), (trial, number)


def test_regions_are_spans_of_the_text(spark):
    rng = random.Random(9)
    item, long = prose(rng, 20), prose(rng, 120)
    docs = spark.createDataFrame([(1, "É " + item.upper() + " end"), (2, prose(rng, 100)), (3, long[100:500]), (4, item.replace(" ", "\n")), (5, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, long), (9, "short")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in contaminated_regions(docs, bench).collect()}
    assert set(got) == {(1, 7), (3, 8), (4, 7)}
    assert ("É " + item.upper() + " end").encode()[got[1, 7].start : got[1, 7].end].decode().lower() == item
    assert [r.doc_id for r in clean_documents(docs, bench).orderBy("doc_id").collect()] == [2, 5]
    one_by_one = contaminated_regions(docs, bench, index_bytes=1)
    assert {(r.doc_id, r.item_id) for r in one_by_one.collect()} == set(got)


@pytest.mark.parametrize("hits", [1 << 20, 50, 1])
def test_hits_are_counted_in_parts_of_any_size(monkeypatch, hits):
    rng = random.Random(31)
    items = [(i, prose(rng, 30)) for i in range(4)] + [(9, "a " * 60)]
    index = Index(items)
    text = prose(rng, 40) + items[1][1] + " a a" * 70 + items[3][1][20:]
    data = text.encode()
    due = Counter()
    for number, (_, pattern, budget) in enumerate(index.patterns):
        for i in range(len(pattern) - 9):
            for j in range(len(data) - 9):
                if pattern[i : i + 10] == data[j : j + 10]:
                    half = (j - i + 160 + 10) // (budget + 1)
                    due[number, half] += 1
                    due[number, half - 1] += 1
    monkeypatch.setattr("folioworks.llm.decontaminate.HITS", hits)
    keys, counts = index._bands(np.frombuffer(data, np.uint8))
    assert {(k >> 32, k & 0xFFFFFFFF): n for k, n in zip(keys.tolist(), counts.tolist(), strict=True)} == due


def test_one_gram_over_and_over_takes_bounded_memory():
    import tracemalloc

    index = Index([(1, "a " * 80)])
    tracemalloc.start()
    assert index.search("a " * 40_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6


def test_regions_of_hard_tables(spark, hard, benchmark):
    wide = hard.select("*", *(F.lit("x").alias(c) for c in [*CLASH, "item_id", "start", "end", "edits"]))
    plain = sorted(map(str, contaminated_regions(hard, benchmark).collect()))
    assert plain and sorted(map(str, contaminated_regions(wide, benchmark).collect())) == plain
    ids = sorted(map(str, clean_documents(hard, benchmark).select("doc_id").collect()))
    for size in (1, 100):
        assert sorted(map(str, contaminated_regions(wide, benchmark, index_bytes=size).collect())) == plain
        assert sorted(map(str, clean_documents(wide, benchmark, index_bytes=size).select("doc_id").collect())) == ids


def test_alignment_counts_edits():
    assert align(b"abcdefgh", b"xxabcdefghyy", 0, 4, 1) == (2, 10, 0)
    assert align(b"abcdefgh", b"xxabcXefghyy", 0, 4, 1) == (2, 10, 1)
    assert align(b"abcdefgh", b"xxabdefghyy", 0, 4, 1)[2] == 1
    assert align(b"abcdefgh", b"xxaXbcXdefgh", 0, 4, 1) is None


# 9. Quality rules


def test_base_counts_by_hand():
    assert base_counts("") == (0, 0, 0, 0, 0)
    eight = "a b c d e f g h"
    assert base_counts(f"{eight} x {eight}") == (17, 17, 0, 0, 16)
    assert base_counts("a\na\n \n\na #*$") == (4, 6, 3, 1, 0)
    assert base_counts("é\x0bü") == (2, 2, 0, 0, 0)


def test_repeated_words_by_hand():
    rng = random.Random(6)
    for _ in range(60):
        words = [rng.choice("ab") for _ in range(rng.randint(0, 40))]
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        due = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        assert base_counts(" ".join(words))[4] == len(due)


def test_junk_fails_and_prose_stays(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng, 150), "en") for i in range(60)]
    rows += [(100, " ".join(w + "%%%" for w in prose(rng, 150).split()), "en"), (101, prose(rng, 150).upper(), "en"), (102, " | ".join(["qqqqqq" + str(i) for i in range(150)]), "en"), (103, "few words", "en"), (104, prose(rng, 10) * 20, "en")]
    got = {r.doc_id: r for r in quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].kept for i in range(60))
    assert not any(got[i].kept for i in range(100, 105))
    assert [got[i].base_failed for i in (100, 103, 104)] == [False, True, True]
    assert got[103].class_distance is None and Rules().least_words == 20


def test_a_language_of_one_row_is_judged_by_the_others(spark):
    rng = random.Random(15)
    rows = [(i, prose(rng, 150), "en") for i in range(60)] + [(100, " ".join(["%1$$#"] * 300), "zz"), (101, " ".join(f"%{i}$$#" for i in range(300)), "zy"), (102, prose(rng, 150), "zx"), (103, prose(rng, 45), "zw")]
    got = {r.doc_id: r for r in quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got[100].kept and not got[101].kept and got[101].class_distance > 0.5
    assert got[102].kept and got[103].kept and got[102].common_distance is None


def test_distance_is_a_metric_between_zero_and_one():
    p, q = np.array([0.5, 0.5, 0]), np.array([0, 0, 1.0])
    assert js_distance(p, p) == 0 and js_distance(p, q) == pytest.approx(1) and js_distance(p, q) == js_distance(q, p)


def shares(counts):
    total = sum(counts.values())
    return {k: n / total for k, n in counts.items()} if total else {}


def distance_by_hand(p, q):
    def divergence(x, m):
        return sum(v * np.log2(v / m[k]) for k, v in x.items() if v)

    keys = set(p) | set(q)
    m = {k: (p.get(k, 0) + q.get(k, 0)) / 2 for k in keys}
    return max(0, (divergence(p, m) + divergence(q, m)) / 2) ** 0.5


@pytest.mark.parametrize("most", [512, 2, 1])
def test_verdicts_by_hand_for_any_number_of_languages(spark, most):
    """References, distances and verdicts from plain counts; each language has its own reference, without the row itself."""
    import re
    import unicodedata

    rng = random.Random(14)
    other = str.maketrans("aeiouthns", "öäüßéxzqk")
    rows = [(i, prose(rng, rng.randint(15, 200)).translate(other if i % 4 == 1 else {}) + (" #1." if i % 9 == 0 else ""), ["aa", "bb", "cc", None, ""][i % 5]) for i in range(50)]
    rows += [(90, "", "dd"), (91, prose(rng, 60), "ee"), (92, prose(rng, 60).upper(), "ee"), (93, None, "aa")]
    kinds = {"Ll": 0, "Lu": 1, "Lt": 1, "L": 2, "M": 3, "N": 4, "P": 5, "S": 6, "Z": 7}

    def classes(text):
        return Counter(7 if c in "\t\n\v\f\r" else kinds.get(unicodedata.category(c), kinds.get(unicodedata.category(c)[0], 8)) for c in text)

    def short(text):
        return Counter(re.findall(r"\b[^\W\d_]{1,5}\b", text.lower()))

    by_class, by_word = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang in rows:
        for key in {lang or "", ""}:
            by_class[key].update(classes(text or ""))
            by_word[key].update(short(text or ""))
    rules = Rules(most_broadcast=most)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality_verdicts(frame, rules).collect()}
    for doc_id, text, lang in rows:
        text, lang = text or "", lang or ""
        n, r = len(text.split()), got[doc_id]
        due_class = due_word = None
        if n >= 20:
            others, pooled = ({k: c - classes(text)[k] for k, c in by_class[x].items()} for x in (lang, ""))
            share = shares(pooled)
            due_class = distance_by_hand(shares(classes(text)), shares({k: others.get(k, 0) + 2000 * share[k] for k in pooled}))
        if n >= 40:
            top = dict(sorted(by_word[lang].items(), key=lambda x: (-x[1], x[0]))[:40])
            mine = short(text)
            top, whole = {w: c - mine[w] for w, c in top.items()}, by_word[lang].total() - mine.total()
            if whole >= 500:
                due_word = distance_by_hand(
                    {**{w: mine[w] / mine.total() for w in top}, None: 1 - sum(mine[w] for w in top) / mine.total()},
                    {**{w: c / whole for w, c in top.items()}, None: 1 - sum(top.values()) / whole},
                )
        assert r.class_distance == (None if due_class is None else pytest.approx(due_class, abs=1e-6))
        assert r.common_distance == (None if due_word is None else pytest.approx(due_word, abs=1e-6))
        root = max(1, n) ** 0.5
        assert r.kept == (not r.base_failed and (due_class or 0) <= 0.10 + 1.1 / root and (due_word or 0) <= 0.25 + 2.0 / root)
    kept = {r.doc_id for r in good_documents(frame, rules).collect()}
    assert kept == {i for i, r in got.items() if r.kept}


# 10. SimHash


def fingerprint_by_hand(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_by_hand(spark):
    for text in [None, "", " \n", "One", "One two", "A b c", "a b c a b c É", *(r[1] for r in hard_rows()[:20])]:
        assert fingerprint(text) == fingerprint_by_hand(text)
    native = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first().h
    assert fingerprint("A b C") == native % (1 << 64)


def roots_by_hand(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("long_list", [0, 3, 64])
def test_links_join_all_within_two_bits(spark, long_list):
    rng = random.Random(13)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(240):
        x = rng.choice(prints)
        for _ in range(rng.randint(0, 3)):
            x ^= 1 << rng.randrange(64)
        prints.append(x)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = links(spark.createDataFrame([(s,) for s in signed], "fp long"), long_list)
    assert edges.where(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) > 2).isEmpty()
    got = {r.node: r.root for r in connected_components(edges, "x", "y").collect()}
    due = roots_by_hand(prints)
    groups = defaultdict(set)
    for s, d in zip(signed, due, strict=True):
        groups[d].add(s)
    for group in groups.values():
        assert {got.get(s, s) for s in group} == {min(group)}


def test_classes_have_the_smallest_id(spark):
    rows = [(5, "a b c d"), (3, "A b  c d"), (9, "x y z"), (7, None), (2, " "), (None, "a b c d")]
    got = {r.doc_id: r.component_id for r in simhash_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {5: 3, 3: 3, None: 3, 9: 9, 7: 2, 2: 2}


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 50)] + [(2000, 2000), (3001, 3000), (3000, 3001)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert {got[i] for i in range(301)} == {0} and {got[1000 + i] for i in range(50)} == {1000} and got[3001] == 3000 and 2000 not in got
    assert connected_components(spark.createDataFrame([], "x long, y long"), "x", "y").collect() == []


# The queries and the pipeline


def test_queries_have_the_contract_columns(spark):
    due = {
        "op2_html_extract": ["page_id", "url", "text", "n_chars"],
        "op4_language_id": ["doc_id", "held_out", "lang_pred", "score"],
        "op5_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op6_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
        "op7_source_mix": ["doc_id", "size", "source_size", "target", "taken"],
        "op9_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
        "op10_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
    }
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    for name, columns in due.items():
        got = queries.QUERIES[name](spark, "/root/testdata/sf0.001").columns
        assert [c for c in got if c in columns] == [c for c in columns if c in got] and set(columns) <= set(got), name


def test_near_duplicates_row_by_row(spark):
    """One row of each class, whatever ids repeat or are missing; other classes stay whole. By hand, over all pairs."""
    rng = random.Random(17)
    base = [prose(rng, 60) for _ in range(6)]
    near = base[0].replace(base[0].split()[5], "other", 1)
    rows = [(1, base[0]), (1, base[1]), (2, base[0]), (3, near), (None, base[0]), (None, base[2]), (None, base[2]), (None, base[3]), (7, base[3]), (1, base[1]), (5, None), (6, ""), (None, " "), (9, base[4]), (9, base[4] + "  "), (9, base[5])]
    rows = [(i, t, "en" if n % 2 else None, "s", n if n < 9 else None) for n, (i, t) in enumerate(rows)]
    rows += [(9, base[5], None, "s", None)] * 3
    root = roots_by_hand([fingerprint_by_hand(r[1]) for r in rows])
    due = set()
    for group in set(root):
        due.add(min(((r[0] is None, r[0] or 0) for r, g in zip(rows, root, strict=True) if g == group)) + (group,))
    for parts in (1, 4):
        frame = spark.createDataFrame(rows, DOCS).select("*", *(F.lit("x").alias(c) for c in ("root", "fp", "first", "n", "last", "all", "row_hash", "text_hash"))).repartition(parts)
        got = corpus_pipeline.STAGES[1][1](spark, frame, "")
        assert got.columns == frame.columns
        kept = got.collect()
        assert len(kept) == len(due)
        assert {(r.doc_id is None, r.doc_id or 0) for r in kept} == {d[:2] for d in due}
        prints = [fingerprint_by_hand(r.text) for r in kept]
        assert len(set(roots_by_hand(prints))) == len(kept)
    first = spark.createDataFrame(rows, DOCS)
    assert sorted(map(str, corpus_pipeline.STAGES[1][1](spark, first, "").collect())) == sorted(map(str, corpus_pipeline.STAGES[1][1](spark, first.repartition(7), "").collect()))
    assert corpus_pipeline.STAGES[1][1](spark, first.limit(0), "").collect() == []


def test_pipeline_stages_on_hard_tables(spark, hard, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, hard_rows()[3][1][:150]), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    wide = hard.select("*", *(F.lit("x").alias(c) for c in CLASH))
    for frame in (hard, wide, hard.limit(0)):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == frame.columns
                docs = spark.createDataFrame(out.collect(), docs.schema)
            else:
                assert out.count() == docs.count()


def test_pipeline_stage_by_stage_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = docs.collect()
    (_, quality), (_, near), (_, repeats), (_, clean), (_, mixed) = corpus_pipeline.STAGES

    good = quality(spark, docs, folder).collect()
    verdict = {r.doc_id: r.kept for r in quality_verdicts(docs).collect()}
    assert {r.doc_id for r in good} == {r.doc_id for r in rows if verdict[r.doc_id]}
    assert all(len((r.text or "").split()) >= 20 for r in good)

    frame = spark.createDataFrame(good, docs.schema)
    one = near(spark, frame, folder).collect()
    ids = [r.doc_id for r in good]
    root = roots_by_hand([fingerprint_by_hand(r.text) for r in good])
    groups = defaultdict(set)
    for i, d in zip(ids, root, strict=True):
        groups[d].add(i)
    assert sorted(r.doc_id for r in one) == sorted(min(g) for g in groups.values())

    frame = spark.createDataFrame(one, docs.schema)
    rest = repeats(spark, frame, folder).collect()
    due = {r[0]: r[1] - r[2] for r in repeats_by_hand([(r.doc_id, r.text) for r in one])}
    assert len(rest) == len(one)
    for r in rest:
        assert 0 <= len(r.text.encode()) - due[r.doc_id] <= 3 * 8 and r.n_chars == len(r.text)

    frame = spark.createDataFrame(rest, docs.schema)
    left = clean(spark, frame, folder).collect()
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in rest if any(x in " ".join(r.text.lower().split()) for x in items)}
    assert not holds & {r.doc_id for r in left}
    assert len(left) >= len(rest) - 3 * max(1, len(holds))

    out = mixed(spark, spark.createDataFrame(left, docs.schema), folder).collect()
    assert {r.doc_id: r["size"] for r in out} == {r.doc_id: len(r.text.split()) for r in left}
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, out))


def test_json_round_trip_of_masks(spark):
    rows = [(1, 0, "ann", "hi", "x"), (1, 1, "bob", "yo", "x")]
    got = rotate_perspectives(turns(spark, rows)).toJSON().collect()
    assert all(len(json.loads(r)["segment_chars"]) == 4 for r in got)
