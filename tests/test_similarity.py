"""Bounds of the similarity, and verdicts by them, against the matcher itself."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

from folioworks.operators import mismatch as X


def pairs() -> list[tuple[str, str]]:
    rng = random.Random(9)
    out = [("", ""), ("a", ""), ("", "b"), ("a.b+c", "a.b+c$"), ("漢字é", "字漢é"), ("aaaa", "aa")]
    for _ in range(20_000):
        a = "".join(rng.choice("abcde .é") for _ in range(rng.randint(0, 30)))
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "é", "."])
        out.append((a, "".join(b)))
    long = "".join(rng.choice("abcdefghij") for _ in range(600))
    return [*out, (long, long[:590] + "x"), (long, long[5:])]


def test_bounds_hold(spark):
    rows = pairs()
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(rows)], "i int, a string, b string").repartition(4)
    got = frame.select("i", X.ratio_bounds(frame.a, frame.b).alias("x")).collect()
    assert len(got) == len(rows)
    for i, x in got:
        a, b = rows[i]
        matcher = SequenceMatcher(None, a, b)
        assert (x.by_length, x.by_letters) == (matcher.real_quick_ratio(), matcher.quick_ratio()) if a and b else x == (0, 0)
        assert matcher.ratio() <= x.by_letters + 1e-12 or not (a and b)


def test_verdicts_are_those_of_scores(spark):
    rows = [(f"f1r:{i}", a, b) for i, (a, b) in enumerate(pairs()[:3000])] + [("f2r:1", None, "x"), ("f2r:2", "x", None), ("f2r:3", None, None), ("f2r:4", "a?b", "ab")]
    aligned = spark.createDataFrame(rows, "line_id string, zl_text string, it_text string")
    told = lambda frame: {r.line_id: (r.status, r.eva_agreement) for r in frame.collect()}
    verdicts = told(X.verdicts(aligned))
    assert verdicts == told(X.compare(aligned)) and {"high_similarity", "content_mismatch"} <= {s for s, _ in verdicts.values()}
    assert X.statistics(X.verdicts(aligned)).first() == X.statistics(X.compare(aligned)).first()
