"""Quality rules: base counts and divergence from a language reference.

Words are runs of characters other than ASCII white space. A document fails
the base rules if it has too few words or repeats itself; beyond those, its
histograms of character classes and of common words are compared to those of
its language by the Jensen-Shannon distance (base 2, so from 0 to 1).

References come from all rows: each language's class counts, and counts of its
``common`` most frequent short words; of equal counts the words that sort first.
Every language has a reference of its own, rows of no language use the pooled
one. References of the ``most_broadcast`` languages with most rows are
broadcast, which is bounded by the parameters; rows of further languages, none
of which is frequent, are joined to theirs.

No row is judged by itself: its own counts are taken out of its reference, and
out of the pooled one, of which ``shrink_chars`` characters are mixed into the
classes of each language. So a language of one row is judged by all the others'
text. Its common words say nothing then: they count from ``least_short_words``
short words of other rows on.

Minimum-length guards: a histogram of a short text says little, so each
distance counts only from a number of words on, and the distance allowed is a
floor plus a slack that shrinks with the square root of the words. Common words
are compared from as many words on as the histogram has common words (40);
texts of 20 to 39 words are judged by the base rules and their classes.

Nulls are texts without words, which fail. Lines are parts between line feeds.
Rows are judged one by one against the references, so repeated rows, also of one
id, get equal verdicts; they count in the references as often as they are there.
Whole texts of any length are judged, by one task each. An empty table gives an
empty result. ``quality_verdicts`` ignores other columns, ``good_documents``
keeps them, whatever they are called.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, map_rows, scratch, stored

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SHORT_WORD = re.compile(r"\b[^\W\d_]{1,5}\b")
FLUSH = 50_000
PART = 1 << 20
VOCABULARY_PARTS = 64
POOLED = ""
#: Character classes: lower, upper, other letter, mark, number, punctuation, symbol, separator, other.
CLASSES = 9


@dataclass(frozen=True)
class Rules:
    least_words: int = 20
    most_repeated_percent: int = 30
    class_words: int = 20
    class_floor: float = 0.10
    class_slack: float = 1.1
    common_words: int = 40
    common_floor: float = 0.25
    common_slack: float = 2.0
    common: int = 40
    #: Characters of all text that a language's classes are taken with, and the short words of others that its common words need.
    shrink_chars: int = 2000
    least_short_words: int = 500
    most_broadcast: int = 512


def _class_of(point: int) -> int:
    if point in (9, 10, 11, 12, 13):
        return 7
    kind = unicodedata.category(chr(point))
    if kind[0] == "L":
        return {"Ll": 0, "Lu": 1, "Lt": 1}.get(kind, 2)
    return {"M": 3, "N": 4, "P": 5, "S": 6, "Z": 7}.get(kind[0], 8)


_TABLE: list[np.ndarray] = []


def shape_codes(text: str) -> np.ndarray:
    """The class of each character; points beyond the basic plane count as other."""
    if not _TABLE:
        _TABLE.append(np.array([_class_of(p) for p in range(1 << 16)], np.uint8))
    return _TABLE[0][np.minimum(np.frombuffer(text.encode("utf-32-le"), "<u4"), 0xFFFF)]


def class_counts(text: str) -> np.ndarray:
    """Counts of the character classes."""
    return sum((np.bincount(shape_codes(text[at : at + PART]), minlength=CLASSES) for at in range(0, len(text), PART)), np.zeros(CLASSES, np.int64))


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of eight words that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    sums = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        sums = sums * np.uint64(0x9E3779B97F4A7C15) + (ids[k : k + n] ^ (ids[k : k + n] >> np.uint64(29)))
    order = np.sort(sums)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    steps = np.zeros(len(words) + 1, np.int64)
    found = np.flatnonzero(np.isin(sums, twice))
    np.add.at(steps, found, 1)
    np.add.at(steps, found + WINDOW, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def _emit(counts: dict[str, tuple[np.ndarray, Counter]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for lang, (classes, words) in counts.items():
        for is_class, keys, numbers in ((True, [str(i) for i in range(CLASSES + 1)], classes.tolist()), (False, list(words), list(words.values()))):
            n = len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(([lang] * n, keys, [is_class] * n, numbers), schema, strict=True)], schema=schema)
    counts.clear()


def _count_languages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language, flushed whenever they grow large; class ``CLASSES`` counts the rows."""
    schema = pa.schema([("lang", pa.string()), ("key", pa.string()), ("is_class", pa.bool_()), ("n", pa.int64())])
    counts: dict[str, tuple[np.ndarray, Counter]] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            classes, words = counts.setdefault(lang or POOLED, (np.zeros(CLASSES + 1, np.int64), Counter()))
            classes[CLASSES] += 1
            if text:
                classes[:CLASSES] += class_counts(text)
                words.update(SHORT_WORD.findall(text.lower()))
        if sum(len(w) + CLASSES for _, w in counts.values()) > FLUSH:
            yield from _emit(counts, schema)
    yield from _emit(counts, schema)


def _reference(entries: list[dict]) -> tuple[np.ndarray, dict[str, float], int, int]:
    """Class shares, shares of common words, and of how many characters and short words, of rows ``is_class, key, share, total``."""
    classes, words, totals = np.zeros(CLASSES), {}, {True: 0, False: 0}
    for entry in entries:
        totals[entry["is_class"]] = entry["total"]
        if entry["is_class"]:
            classes[int(entry["key"])] = entry["share"]
        else:
            words[entry["key"]] = entry["share"]
    return classes, words, totals[True], totals[False]


def _others(share: np.ndarray, total: int, mine: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """Shares of ``total`` things without the ``n`` of a document itself, and how many these are."""
    left = max(0, total - n)
    return np.maximum(0, share * total - mine) / max(1, left), left


def references(documents: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang") -> tuple[dict, DataFrame | None]:
    """By language: class shares, and its common words' shares of its short words. The pooled language is ``""``.

    The first result holds the pooled reference and those of the languages with
    most rows. The second has the others as ``lang`` and ``reference``, if any.
    """
    rows = documents.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counted = map_rows(rows, _count_languages, "lang string, key string, is_class boolean, n long")
    with scratch(documents.sparkSession) as kept:
        counted = stored(counted.groupBy("lang", "key", "is_class").agg(F.sum("n").alias("n")).where("n > 0"))
        is_rows = F.col("is_class") & (F.col("key") == str(CLASSES))
        sizes = counted.where(is_rows & (F.col("lang") != POOLED)).select("lang", F.col("n").alias("size"))
        frequent = [r.lang for r in sizes.orderBy(F.desc("size"), "lang").limit(rules.most_broadcast).collect()]
        pooled = counted.groupBy(F.lit(POOLED).alias("lang"), "key", "is_class").agg(F.sum("n").alias("n"))
        both = counted.where(F.col("lang") != POOLED).unionByName(pooled).where(~is_rows)
        totals = both.groupBy("lang", "is_class").agg(F.sum("n").alias("total"))
        # The most frequent of each of some parts of the vocabulary, then of those.
        common = both.where("not is_class").withColumn("part", F.pmod(F.xxhash64("key"), F.lit(VOCABULARY_PARTS)))
        for parts in (["lang", "part"], ["lang"]):
            rank = Window.partitionBy(*parts).orderBy(F.desc("n"), "key")
            common = common.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= rules.common).drop("rank")
        common = common.drop("part")
        top = common.unionByName(both.where("is_class")).join(totals, ["lang", "is_class"])
        # At most ``common`` words and all classes a language.
        entry = F.struct("is_class", (F.col("n") / F.col("total")).alias("share"), "key", "total")
        lists = kept(top.groupBy("lang").agg(F.sort_array(F.collect_list(entry), asc=False).alias("reference")))
        chosen = F.col("lang").isin([POOLED, *frequent])
        found = {r.lang: _reference(r.reference) for r in lists.where(chosen).collect()}
        # Languages whose rows hold no text have no reference and use the pooled one.
        return found, None if len(frequent) < rules.most_broadcast else lists.where(~chosen)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence of two histograms of sum 1."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, parts / 2)))


def judge(text: str | None, lang: str | None, refs: dict, rules: Rules) -> tuple:
    """Base counts, base_failed, both distances (null below their guards) and the verdict."""
    text = text or ""
    n, chars, symbols, dup_lines, repeated = counts = base_counts(text)
    failed = n < rules.least_words or 100 * repeated > rules.most_repeated_percent * n
    nothing = np.zeros(CLASSES), {}, 0, 0
    pooled = refs.get(POOLED) or nothing
    classes, common, n_chars, n_short = refs.get(lang or POOLED) or pooled
    by_class = by_word = None
    if n >= rules.class_words:
        mine = class_counts(text)
        size = int(mine.sum())
        share, left = _others(classes, n_chars, mine, size)
        # A small language is taken with some of all text.
        all_share, all_left = _others(pooled[0], pooled[2], mine, size)
        if all_left:
            share, left = (share * left + all_share * rules.shrink_chars) / (left + rules.shrink_chars), left + rules.shrink_chars
        if left and size:
            by_class = js_distance(mine / size, share)
    if n >= rules.common_words and common:
        words = SHORT_WORD.findall(text.lower())
        seen = Counter(words)
        mine = np.array([seen[w] for w in common], float)
        share, left = _others(np.array(list(common.values())), n_short, mine, len(words))
        if left >= rules.least_short_words:
            mine = np.append(mine, len(words) - mine.sum()) / max(1, len(words)) if words else np.append(0 * mine, 1.0)
            by_word = js_distance(mine, np.append(share, max(0.0, 1 - share.sum())))
    root = max(1, n) ** 0.5
    good = not failed and (by_class or 0) <= rules.class_floor + rules.class_slack / root and (by_word or 0) <= rules.common_floor + rules.common_slack / root
    return (*counts, failed, by_class, by_word, good)


def _judged(documents: DataFrame, rules: Rules, text_col: str, lang_col: str, body: Callable, schema) -> DataFrame:
    """``documents`` through ``body``, which gets a batch and the verdicts of its rows."""
    refs, others = references(documents, rules, text_col, lang_col)
    held = documents.sparkSession.sparkContext.broadcast(refs)
    language, reference = free_names(documents, "_language", "_language_reference")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column(text_col).to_pylist(), batch.column(lang_col).to_pylist()
            if reference in batch.schema.names:
                own = batch.column(reference).to_pylist()
                batch = batch.drop_columns([reference])
                verdicts = [judge(t, x, {POOLED: held.value.get(POOLED), x: _reference(o)} if o else held.value, rules) for t, x, o in zip(texts, langs, own, strict=True)]
            else:
                verdicts = [judge(t, x, held.value, rules) for t, x in zip(texts, langs, strict=True)]
            yield body(batch, verdicts)

    if others is None:
        return map_rows(documents, run, schema)
    known = F.coalesce(F.col(lang_col).isin(list(refs)), F.lit(True))
    others = others.select(F.col("lang").alias(language), F.col("reference").alias(reference))
    rare = documents.where(~known).join(others, F.col(lang_col) == F.col(language), "left").drop(language)
    return map_rows(documents.where(known), run, schema).unionByName(map_rows(rare, run, schema))


def quality_verdicts(documents: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row a document: counts, ``base_failed``, ``class_distance``, ``common_distance``, ``kept``."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = pa.schema([*((n, pa.int64()) for n in names), ("base_failed", pa.bool_()), ("class_distance", pa.float64()), ("common_distance", pa.float64()), ("kept", pa.bool_())])

    def body(batch: pa.RecordBatch, verdicts: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*verdicts, strict=True)) if verdicts else [()] * len(schema)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, schema, strict=True))], ["doc_id", *schema.names])

    return _judged(rows, rules, "text", "lang", body, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, class_distance double, common_distance double, kept boolean")


def good_documents(documents: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose verdict is ``kept``, with all their columns."""
    return _judged(documents, rules, text_col, lang_col, lambda batch, verdicts: batch.filter(pa.array([v[-1] for v in verdicts], pa.bool_())), documents.schema)
