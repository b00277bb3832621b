"""Cleaners, alphabet, alignment, statistics, rules and streams on small inputs."""

from __future__ import annotations

import json
import logging
import math
import random
import re
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioworks import errors, logs
from folioworks.functions import charset
from folioworks.functions import text as T
from folioworks.operators import mismatch as X
from folioworks.operators import quality as Q
from folioworks.operators import stats as S
from folioworks.operators import verification as V
from folioworks.streaming.lines import cleaned, once_per_id, windowed_counts, write_batches


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, t string")


def column(spark, expression, *values):
    return [r.x for r in texts(spark, *values).select("i", expression.alias("x")).orderBy("i").collect()]


# raw, stripped, clean, extracted, normalised, uncertain, illegible, alternatives, high, letters, words
GOLDEN = [
    ("fachys{comment here}.ykal", "fachys.ykal", "fachys.ykal", "fachys.ykal", "fachys.ykal", "FFFF", 10, 2),
    ("test.[a:b].word", "test.a.word", "test.a.word", "test.a.word", "test..word", "FFTF", 8, 3),
    ("<%>start.text<->continue<$>", "start.textcontinue", "start.textcontinue", "start.text continue", "start.textcontinue", "FFFF", 17, 2),
    ("uncertain?reading!illegible", "uncertain?reading!illegible", "uncertainreadingillegible", "uncertain?reading!illegible", "uncertainreadingillegible", "TTFF", 25, 1),
    ("x.[:ch]y", "x.y", "x.y", "x.[:ch]y", "x.y", "FFTF", 2, 2),
    ("x.[a:]y", "x.ay", "x.ay", "x.[a:]y", "x.y", "FFTF", 3, 2),
    ("x.[a:b:c]y", "x.ay", "x.ay", "x.ay", "x.y", "FFTF", 3, 2),
    ("@140;", "@140;", "@140;", "@140;", "@140;", "FFFT", 0, 0),
    ("word{comment{nested}}.word", "word}.word", "word}.word", "word}.word", "word}.word", "FFFF", 6, 2),
    ("a*b.cI", "a*b.cI", "ab.ci", "a*b.cI", "ab.cI", "FTFF", 4, 2),
    ("{unclosed.text", "{unclosed.text", "{unclosed.text", "{unclosed.text", "{unclosed.text", "FFFF", 12, 2),
    ("<f>tag", "tag", "tag", "<f>tag", "tag", "FFFF", 3, 1),
    (" a \t  b ", "a b", "a b", "a b", "a b", "FFFF", 2, 2),
]


def test_cleaners(spark):
    raws = [g[0] for g in GOLDEN]
    t = F.col("t")
    for at, cleaner in enumerate((T.strip_markup, T.clean_for_analysis, T.extract_text, T.normalize_for_comparison), 1):
        assert column(spark, cleaner(t), *raws) == [g[at] for g in GOLDEN], cleaner.__name__
    flags = F.concat(*(F.when(f(t), "T").otherwise("F") for f in (T.is_uncertain, T.is_illegible, T.has_alternatives, T.has_high_codes)))
    assert column(spark, flags, *raws) == [g[5] for g in GOLDEN]
    checked = charset.checked_text(T.clean_for_analysis(t))
    assert list(zip(column(spark, charset.letter_count(checked), *raws), column(spark, charset.word_count(checked), *raws), strict=True)) == [(g[6], g[7]) for g in GOLDEN if g]
    assert column(spark, T.extract_text(t, clean=False), "a[b:c]d", "abc@123;def") == ["a[b:c]d", "abc@123;def"]
    assert column(spark, T.normalize_for_comparison(t), None, "") == ["", ""]


def strip_by_hand(s: str) -> str:
    s = re.sub(r"\{[^}]*\}", "", s)
    s = re.sub(r"\[([^:\]]*):([^\]]*)\]", r"\1", s)
    return re.sub(r"\s+", " ", re.sub(r"<[^>]*>", "", s)).strip()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="abI.,?!*{}[]<>:@;1- \n", max_size=30), min_size=20, max_size=40))
def test_cleaners_against_python(spark, values):
    got = texts(spark, *values).select("i", T.strip_markup(F.col("t")).alias("s"), T.clean_for_analysis(F.col("t")).alias("c")).orderBy("i").collect()
    for value, row in zip(values, got, strict=True):
        assert row.s == strip_by_hand(value)
        assert row.c == re.sub(r"\s+", " ", re.sub(r"[?!*]", "", strip_by_hand(value)).replace("I", "i")).strip()


def test_tokenizers(spark):
    assert column(spark, T.words(F.col("t")), "a.b, c d ,,e1", "") == [["a", "b", "c d", "e1"], []]
    assert column(spark, T.words(F.col("t"), letters_only=True), "a.b c.é,e1") == [["a", "é"]]
    assert column(spark, T.spaced_words(F.col("t")), " a.b,c d\n") == [["a", "b", "c", "d"]]
    assert column(spark, T.fill_template(F.col("t"), {"A": "1"}), "{{A}}-{{B}}") == ["1-{{B}}"]


def test_alphabet(spark):
    t = F.col("t")
    row = texts(spark, "aaa.bb.c", "FACHYS.YKAL", "fachys€ykal", "fachys.€.ykal.£.ataiin", "w9-=").select("i", charset.validate(t).alias("v"), charset.validate(t, strict=True).alias("s")).orderBy("i").collect()
    assert row[0].v.char_frequencies == {"a": 3, "b": 2, "c": 1} and row[1].v.is_valid and row[1].v.char_count == 10
    assert row[2].v.is_valid and not row[2].s.is_valid and row[2].s.n_errors == 1 and [tuple(p) for p in row[2].v.unknown_positions] == [(6, "€")]
    assert row[3].v.word_count == 5 and row[3].v.unknown_chars == ["£", "€"]
    assert row[4].v.unknown_chars == ["w"]
    assert column(spark, charset.compound_counts(t), "chedy.chol.chey", "CTHey.ckhol.cphol.cfhey", "daiin.ol.ar") == [{"ch": 3}, {"cth": 1, "ckh": 1, "cph": 1, "cfh": 1}, {}]
    assert column(spark, charset.is_clean(t), "abc.d, e@12;'", "w", "a\n", "A", "") == [True, False, False, False, True]
    assert column(spark, charset.unclean_characters(t), "zwAé") == [["A", "w", "é"]]
    assert column(spark, charset.is_valid_word(t), "daiin", "word", "", "DAIIN") == [True, False, True, True]
    known = {r.t: (r.category, r.frequency) for r in charset.describe(texts(spark, "a", "CH", ".", "?", "w", "-", "cfh", "f"), "t").collect()}
    assert known == {"a": ("basic", "high"), "CH": ("compound", "high"), ".": ("special", "high"), "?": ("editorial", "n/a"), "w": ("unknown", "unknown"), "-": ("unknown", "unknown"), "cfh": ("compound", "rare"), "f": ("rare", "low")}
    assert charset.character_table(spark).count() == 31


@pytest.mark.parametrize(
    ("zl", "it", "status", "agreement", "score"),
    [
        (None, None, "both_missing", None, None),
        (None, "a", "zl_missing", None, None),
        ("a", None, "it_missing", None, None),
        ("", "", "exact_match", True, 1.0),
        ("fachys.ykal.ar", "fach?ys.ykal.ar", "normalized_match", True, 1.0),
        ("fachys.ykal.ar", "completely.different.text", "content_mismatch", False, 0.102564),
        ("fachys.ykal.ar.ataiin.shol.shory", "fachys.ykal.ar.ataiin.shol.shary", "high_similarity", True, 0.96875),
        ("a[b:c]d", "abd", "content_mismatch", False, 0.8),
        ("a", "{x}", "content_mismatch", False, 0.0),
    ],
)
def test_comparison(spark, zl, it, status, agreement, score):
    row = X.compare(spark.createDataFrame([("f1r:1", zl, it)], "line_id string, zl_text string, it_text string")).first()
    assert (row.status, row.eva_agreement) == (status, agreement) and (row.similarity_score == score if score is None else abs(row.similarity_score - score) < 1e-5)


def test_similarity_keeps_order_and_junk_rule(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("abcde") for _ in range(250))
    pairs = [("tide", "diet"), ("diet", "tide"), (long, "x" + long[1:]), ("", "a")]
    got = [r[0] for r in spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").orderBy("i").select(X.similarity("a", "b")).collect()]
    assert got == [SequenceMatcher(None, a, b).ratio() if a and b else 0.0 for a, b in pairs]


def test_alignment(spark):
    rows = [("f1r:1", "zl", 1, "old"), ("f1r:1", "zl", 5, "new"), ("f1r:1", "gc", 1, "g"), ("f10r:1", "it", 1, ""), ("f2r:1", "zl", 1, "abc"), ("f2r:1", "it", 1, "xyz")]
    aligned = X.align(spark.createDataFrame(rows, "line_id string, source_id string, line_no int, text string"))
    compared = X.compare(aligned).cache()
    got = {r.line_id: r for r in X.records(compared).collect()}
    assert got["f1r:1"].zl_text == "new" and got["f1r:1"].sources_present == ["zl", "gc"] and got["f1r:1"].sources_missing == ["it", "cd", "fg"]
    assert got["f10r:1"].status == "zl_missing" and got["f10r:1"].it_text == "" and got["f10r:1"].line_number == 1
    assert got["f2r:1"].notes == ["Low similarity: 0.00%"] and got["f2r:1"].page_id == "f2r"
    stats = X.statistics(compared).first()
    assert (stats.total_lines, stats.content_mismatches, stats.zl_only_lines, stats.it_only_lines, stats.both_eva_present, stats.agreement_rate) == (3, 1, 1, 1, 1, 0.0)
    assert X.statistics(compared.limit(0)).first().agreement_shown == "N/A"


def entropy_by_hand(counts):
    total = sum(counts.values())
    return -sum(n / total * math.log2(n / total) for n in counts.values())


def test_letter_contexts_run_over_texts(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("ab c.é1") for _ in range(rng.randint(0, 6)))) for i in range(60)]
    frame = spark.createDataFrame(rows, "i long, t string").repartition(5)
    letters = [c for _, t in rows for c in t if c.isalpha()]
    for k in (1, 2, 3):
        due = Counter((tuple(letters[j - k : j]), letters[j]) for j in range(k, len(letters)))
        for bucket in (4, 1000):
            got = {(tuple(r.ctx), r.c): r.n for r in S.running_letter_grams(frame, "t", k, "i", bucket).collect()}
            assert got == due
        by_context = Counter()
        for (context, _), n in due.items():
            by_context[context] += n
        h = -sum(n / sum(due.values()) * math.log2(n / by_context[c]) for (c, _), n in due.items())
        assert abs(S.conditional_entropy(S.running_letter_grams(frame, "t", k, "i")).first().entropy - h) < 1e-9
    singles = S.character_counts(frame.select(T.letters(F.col("t")).alias("t")), "t")
    row = S.entropy(singles).first()
    assert abs(row.entropy - entropy_by_hand(Counter(letters))) < 1e-9 and row.h0 == math.log2(len(set(letters)))


def test_counts_spreads_and_histograms(spark):
    frame = spark.createDataFrame([(v,) for v in (1, 1, 2, 3, 9, 9)], "v long")
    row = S.spread(frame, "v").first()
    assert (row.n, row.least, row.greatest, row.upper_median) == (6, 1, 9, 3) and abs(row["mean"] - 25 / 6) < 1e-9
    assert [(r.v, r.n) for r in S.histogram(frame, "v", 1, 4).orderBy("v").collect()] == [(1, 2), (2, 1), (3, 1), (4, 0)]
    assert abs(S.moments(frame, "v").first().variance - (177 / 6 - (25 / 6) ** 2)) < 1e-9
    words = S.counts(S.tokens(texts(spark, "a b a", "c.a b"), "t"), "word")
    row = S.vocabulary(words).first()
    assert (row.tokens, row.types, row.hapax, row.dis) == (6, 3, 1, 1)
    assert [r.word for r in S.top(words, "word", 2).collect()] == ["a", "b"] and [r.word for r in S.longest_hapax(words).collect()] == ["c"]


def test_edge_words(spark):
    got = {(r.place, r.word): r.n for r in S.edge_words(texts(spark, "a", "a.b", "a.m.n.b", "", ".,"), "t").collect()}
    assert got == {("initial", "a"): 3, ("final", "b"): 2, ("middle", "m"): 1, ("middle", "n"): 1}


def test_missing_pairs(spark):
    frame = spark.createDataFrame([(0, "ab" * 100)], "i long, t string")
    singles = S.character_counts(frame, "t")
    got = S.missing_bigrams(S.running_letter_grams(frame, "t", 1, "i"), singles).collect()
    assert [(r.pair, r.expected) for r in got] == [("aa", 50.0), ("bb", 50.0)]
    best = S.bigram_ratios(S.running_letter_grams(frame, "t", 1, "i"), singles, 1).first()
    assert best.pair == "ab" and abs(best.ratio - 100 / (0.25 * 199)) < 1e-9


def test_compression(spark):
    real, mixed = (S.corpus_compression(texts(spark, "abcd" * 200, "abcd" * 200), "t", "i", shuffled=s).first() for s in (False, True))
    assert 0 < real.gzip < mixed.gzip <= 1 and real.n_letters == 1600
    assert S.corpus_compression(spark.createDataFrame([], "i long, t string"), "t", "i").collect() == []


GOOD = {"page_id": "f1r", "line_number": 1, "line_index": 1, "line_id": "f1r:1", "text": "x", "source": "s"}


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        ({}, None),
        ({"extra": 1, "quire": None, "currier_language": None, "char_count": 0}, None),
        ({"page_id": "bad!"}, ("page_id", "pattern")),
        ({"line_number": 0}, ("line_number", "minimum")),
        ({"line_number": "1"}, ("line_number", "type")),
        ({"text": None}, ("text", "type")),
        ({"line_type": "odd"}, ("line_type", "enum")),
        ({"currier_language": "C"}, ("currier_language", "enum")),
        ({"has_uncertain": "true"}, ("has_uncertain", "type")),
        ({"source": ...}, ("", "required:source")),
    ],
)
def test_line_schema(spark, change, rule):
    record = {k: v for k, v in {**GOOD, **change}.items() if v is not ...}
    ok, said = Q.validate_records(spark, record, "transcription_lines")
    assert ok == (rule is None) and (rule is None or said == [f"Record 0: {rule[1]} at [{rule[0]}]"])


def test_mismatch_schema(spark):
    good = {"page_id": "f1r", "line_number": 1, "line_id": "f1r:1", "status": "ok", "similarity_score": 0.5, "notes": ["a"]}
    assert Q.validate_records(spark, good, "mismatch_index") == (True, [])
    bad = [good | {"similarity_score": 1.5}, good | {"notes": [1]}, good | {"status": "exact_match"}, good | {"similarity_score": None, "notes": []}]
    ok, said = Q.validate_records(spark, bad, "mismatch_index")
    assert said == ["Record 0: maximum at [similarity_score]", "Record 1: items at [notes]", "Record 2: enum at [status]"]
    with pytest.raises(errors.SchemaError):
        Q.validate_records(spark, bad, "mismatch_index", raise_on_error=True)


def test_presence_is_not_null(spark):
    raw = spark.createDataFrame([(json.dumps({k: None for k in Q.REQUIRED_FIELDS}),), ("{}",)], "json string")
    assert [len(r.missing) for r in Q.missing_fields(raw).collect()] == [len(Q.REQUIRED_FIELDS)]


def test_invariants(spark):
    fields = "page_id string, line_number int, line_index int, line_id string, text string, text_clean string, has_uncertain boolean, has_illegible boolean, has_high_ascii boolean, at long"
    rows = [
        ("f1r", 1, 1, "f1r:1", "a?b", "ab", True, False, False, 1),
        ("f1r", 2, 3, "f1r:2", "a!b", "a!b", False, False, False, 2),
        ("f2r", 1, 1, "f2r:1", "@12;", "", False, False, True, 3),
        ("f1v", 1, 1, "f1v:9", "x", "x<", False, False, True, 4),
        ("f1v", 1, 2, "f1v:9", "x", "w", False, False, False, 5),
    ]
    frame = spark.createDataFrame(rows, fields)
    for bucket in (2, 100):
        assert [r.record_id for r in Q.order_violations(frame, "at", bucket).collect()] == ["f1v:9"]
    got = Counter(r.invariant for r in Q.invariant_failures(frame, "at", 4, 3).collect())
    assert got == {"TEXT_CLEAN_NO_MARKERS": 1, "TEXT_CLEAN_NO_MARKUP": 1, "TEXT_CLEAN_CHARSET": 3, "HAS_ILLEGIBLE_CONTRACT": 1, "LINE_ID_FORMAT": 2, "LINE_ID_UNIQUE": 1, "LINE_INDEX_SEQUENTIAL": 1, "ORDERING": 1, "RECORD_COUNT": 1, "HIGH_ASCII_FLAG": 1, "HIGH_ASCII_PRESERVED": 1}
    ok, said = Q.summarize(Q.text_failures(frame), 2)
    assert not ok and said[-1] == f"... and {Q.text_failures(frame).count() - 2} more"
    assert Q.report_errors({}) and not Q.report_errors(dict.fromkeys(Q.REPORT_FIELDS, "x"))


def test_profiles(spark):
    content = "#=IVTFF Eva- 2.0\n<f1r>\n<f1r.P.1;H> fachys.yk€al\n<f1v>\n<f1r>\n<f1v.P.2;C>   dain"
    row = V.profile(spark.createDataFrame([("a", content), ("b", "nothing")], "file string, value string")).orderBy("file").collect()
    assert (row[0].structure.page_count, row[0].structure.line_count, row[0].transcribers, row[0].looks_like_ivtff) == (2, 2, ["C", "H"], True)
    assert row[0].characters.unknown == ["€"] and "f" in row[0].characters.known and row[0].errors == []
    assert len(row[1].errors) == 2
    found = spark.createDataFrame([("a", "1")], "file string, sha256 string")
    assert [r.matches for r in V.against_hashes(found, spark.createDataFrame([("a", "1"), ("z", "2")], "file string, sha256 string")).orderBy("file").collect()] == [True, False]
    assert column(spark, V.mentions(F.col("t"), "Concordance"), "a CONCORDANCE", "x") == [True, False]


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([("a", "ch?edy", "2024-01-01 00:00:01"), ("a", "ch?edy", "2024-01-01 00:00:01"), ("b", "ol!", "2024-01-01 01:30:00"), ("c", "ar", "2024-01-01 05:00:00")], "id string, text string, ts string")
    rows.withColumn("ts", F.to_timestamp("ts")).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    write_batches(cleaned(once_per_id(stream(), "id", "ts")), str(tmp_path / "out"), str(tmp_path / "c1")).processAllAvailable()
    got = {r.id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(got) == 3 and got["a"].text_clean == "chedy" and got["a"].has_uncertain and got["b"].has_illegible
    query = windowed_counts(stream(), "ts", "id").writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).start()
    query.processAllAvailable()
    assert {(r.id, r.n) for r in spark.table("counts").collect()} == {("a", 2), ("b", 1), ("c", 1)}
    for q in spark.streams.active:
        q.stop()


def test_errors_and_logs(capsys):
    error = errors.ParseError("bad", 3, "x" * 200, file="f")
    assert str(error) == f"bad (line_number=3, line_content={'x' * 100!r}, file='f')" and isinstance(error, ValueError)
    assert str(errors.BuildError("plain")) == "plain"
    import io

    out = io.StringIO()
    logs.configure("INFO", "json", out)
    logs.get_logger("t", run=1).info("hello", lines=3)
    assert json.loads(out.getvalue()) | {"time": 0} == {"time": 0, "level": "INFO", "logger": "folioworks.t", "message": "hello", "run": 1, "lines": 3}
    out = io.StringIO()
    logs.configure("WARNING", "text", out)
    logs.get_logger("t").info("no")
    logs.get_logger("t").warning("yes", a=1)
    assert out.getvalue().endswith("WARNING folioworks.t: yes [a=1]\n")
    logging.getLogger("folioworks").handlers.clear()


def test_summary(spark):
    got = S.summary(texts(spark, "ab ab", "ba"), "t", "i")
    assert (got["lines"], got["tokens"], got["types"], got["h0"], got["h1"], got["top_letters"]) == (2, 3, 2, 1.0, 1.0, {"a": 3, "b": 3})
    empty = S.summary(spark.createDataFrame([], "i long, t string"), "t", "i")
    assert empty["lines"] == empty["tokens"] == 0 and empty["h1"] is None


def test_order_of_positions_far_apart(spark, monkeypatch):
    """No window holds more than a range of lines, however far apart the positions lie."""
    monkeypatch.setattr(Q, "RANGE", 100)
    lines = [("f1r", i + 1, i) for i in range(499)] + [("f1r", 3, 499)]
    frame = spark.createDataFrame([(f"{p}:{n}", p, n, at * 10**10) for p, n, at in lines], "line_id string, page_id string, line_index int, at long").repartition(3)
    got = Q.order_violations(frame, "at")
    assert [(r.record_id, r.position) for r in got.collect()] == [("f1r:3", 499 * 10**10)]
    largest = {}
    monkeypatch.setattr(Q, "stored", lambda rows: largest.setdefault("rows", rows))
    Q.order_violations(frame, "at")
    sizes = [r["count"] for r in largest["rows"].groupBy("bucket").count().collect()]
    assert len(sizes) == 5 and max(sizes) < 300


def test_texts_are_read_once_for_all_orders(spark):
    """Letters and runs of several lengths come from one pass, and are those of the whole sequence."""
    texts = ["ab é", None, "c", "", "abcabéß", "x" * 30, "漢a😀b"]
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(value):
        calls.add(1)
        return value

    frame = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", seen("t").alias("t"))
    got = S.running_letter_counts(frame, "t", (0, 1, 2, 3), "i", 2, 2)
    whole = "".join(c for t in texts for c in t or "" if c.isalpha())
    for k, counts in got.items():
        want = Counter((whole[i - k : i], whole[i]) for i in range(k, len(whole)))
        assert {(r.ctx, r.c): r.n for r in counts.collect()} == want
    assert calls.value <= 2 * len(texts)


def test_runs_of_letters_in_chunks():
    from folioworks.operators import grams

    codes = np.frombuffer("abab\nba".encode("utf-32-le"), "<u4").astype(np.int64)
    assert dict(grams.count_runs(codes, 1)) == {"ab": 2, "ba": 2}
    assert dict(grams.count_runs(codes, 1, 3)) == {"ab": 1, "ba": 1}
    many = np.arange(0x4E00, 0x4E00 + 30_000, dtype=np.int64)
    assert len(dict(grams.count_runs(many, 4))) == 29_996
