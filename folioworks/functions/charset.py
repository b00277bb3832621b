"""The EVA alphabet: its characters and what texts hold of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import BRACES, HIGH_CODE, TAGS

# The alphabet and its marks.
BASIC = "acdehiklmnopqrsty"
RARE = "fgxjvbuz"
SINGLE = "abcdefghijklmnopqrstuvxyz"
COMPOUNDS = ("ch", "sh", "cth", "ckh", "cph", "cfh")
SEPARATORS = "., "
LINE_MARKERS = "-="
EDITORIAL = "?!*[]:{}'<>@;%$~"
CLEAN = SINGLE + SEPARATORS + "@;0123456789" + "'"
# How often each character is met; those not named here are "high".
MEDIUM = "lrtmn"
LOW = ("p", "f", "cth", "ckh")
SELDOM = ("g", "x", "j", "v", "b", "u", "z", "cph", "cfh")

# ``\\z`` because ``$`` also matches before a last line feed.
_IN_CLEAN = r"^[a-vx-z., @;0-9']*\z"


def character_table(spark: SparkSession) -> DataFrame:
    """``char, category, frequency`` of the 25 letters and six compound glyphs."""

    def row(char: str) -> tuple[str, str, str]:
        category = "compound" if len(char) > 1 else "basic" if char in BASIC else "rare"
        return char, category, "rare" if char in SELDOM else "low" if char in LOW else "medium" if char in MEDIUM else "high"

    return spark.createDataFrame([row(c) for c in (*SINGLE, *COMPOUNDS)], "char string, category string, frequency string")


def category(char: Column) -> Column:
    """Kind of a character or glyph: basic, rare, compound, special, editorial or unknown."""
    low = F.lower(char)
    return (
        F.when(low.isin(*BASIC), "basic")
        .when(low.isin(*RARE), "rare")
        .when(low.isin(*COMPOUNDS), "compound")
        .when(char.isin(*SEPARATORS), "special")
        .when(char.isin(*EDITORIAL), "editorial")
        .otherwise("unknown")
    )


def describe(frame: DataFrame, char_col: str) -> DataFrame:
    """``frame`` with ``category`` and ``frequency`` of its characters (a broadcast of 31 rows)."""
    known = character_table(frame.sparkSession).withColumnRenamed("char", "_char").drop("category")
    joined = frame.withColumn("_low", F.lower(char_col)).join(F.broadcast(known), F.col("_low") == F.col("_char"), "left").drop("_low", "_char")
    other = F.when(F.col(char_col).isin(*SEPARATORS), "high").when(F.col(char_col).isin(*EDITORIAL), "n/a").otherwise("unknown")
    return joined.withColumn("category", category(F.col(char_col))).withColumn("frequency", F.coalesce("frequency", other))


def is_valid_word(word: Column) -> Column:
    return F.lower(word).rlike(r"^[a-vx-z]*\z")


def characters(text: Column) -> Column:
    """The characters of a text as an array; none for an empty one."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def is_clean(text: Column) -> Column:
    return text.rlike(_IN_CLEAN)


def unclean_characters(text: Column) -> Column:
    """Characters outside the set that clean text may hold, sorted."""
    return F.array_sort(F.array_distinct(F.filter(characters(text), lambda c: ~c.rlike(_IN_CLEAN))))


def has_markup(text: Column) -> Column:
    return text.rlike(r"[<>{}]")


def has_uncertainty_marks(text: Column) -> Column:
    return text.rlike(r"[?!*]")


def checked_text(text: Column) -> Column:
    """The text that ``validate`` counts on: comments, tags and codes out, first alternatives in."""
    text = F.regexp_replace(F.regexp_replace(text, BRACES, ""), TAGS, "")
    text = F.regexp_replace(text, HIGH_CODE, "")
    return F.regexp_replace(text, r"\[([^:\]]+):[^\]]+\]", "$1")


def letter_count(checked: Column) -> Column:
    return F.char_length(F.regexp_replace(F.lower(checked), "[^a-vx-z]+", "")).cast("long")


def word_count(checked: Column) -> Column:
    return F.regexp_count(checked, F.lit(r"[^.,\s]+")).cast("long")


def compound_counts(text: Column, lower: bool = True) -> Column:
    """Occurrences of each compound glyph, those found only; each glyph is counted on its own."""
    text = F.lower(text) if lower else text
    counts = F.create_map(*(x for c in COMPOUNDS for x in (F.lit(c), F.regexp_count(text, F.lit(c)).cast("long"))))
    return F.map_filter(counts, lambda _, n: n > 0)


def unknown_text(checked: Column) -> Column:
    """The characters of a text that are no letter, digit, mark or white space, in one pass over it."""
    # U+212A is the one other character whose lower case is a letter of the alphabet.
    return F.regexp_replace(checked, r"[a-vx-zA-VX-Z\u212A0-9., \t\n\r\-=?!*\[\]:{}'<>@;%$~]+", "")


def unknown_characters(checked: Column) -> Column:
    """Those characters, distinct and sorted."""
    return F.array_sort(F.array_distinct(characters(unknown_text(checked))))


def unknown_positions(checked: Column) -> Column:
    """``pos, char`` of those characters.

    The characters and the ones sought are bound to a lambda's variable, as
    they would be computed again for every character otherwise.
    """
    held = F.array(F.struct(characters(checked).alias("all"), F.array_join(unknown_characters(checked), "").alias("odd")))

    def found(x: Column) -> Column:
        at = F.transform(x["all"], lambda c, i: F.struct(i.alias("pos"), c.alias("char")))
        return F.filter(at, lambda y: F.contains(x["odd"], y.char))

    return F.element_at(F.transform(held, found), 1)


def letter_frequencies(checked: Column) -> Column:
    """Count of each letter in a text, those found only."""
    low = F.lower(checked)
    counts = F.create_map(*(x for c in SINGLE for x in (F.lit(c), F.regexp_count(low, F.lit(c)).cast("long"))))
    return F.map_filter(counts, lambda _, n: n > 0)


#: Parts of a validation that cost a pass over the text each.
DETAILS = ("unknown_chars", "unknown_positions", "char_frequencies", "compound_counts")


def validate_checked(checked: Column, strict: bool = False, details: tuple[str, ...] = DETAILS) -> Column:
    """A struct of counts, the details named, and validity (which only ``strict`` can deny), of ``checked_text``.

    ``checked`` should be a column of its own, computed in an earlier projection:
    it is used by every part.
    """
    n_unknown = F.char_length(unknown_text(checked)).cast("long")
    made = {"unknown_chars": unknown_characters, "unknown_positions": unknown_positions, "char_frequencies": letter_frequencies, "compound_counts": lambda c: compound_counts(c, lower=False)}
    return F.struct(
        (n_unknown == 0 if strict else F.lit(True)).alias("is_valid"),
        letter_count(checked).alias("char_count"),
        word_count(checked).alias("word_count"),
        n_unknown.alias("n_unknown"),
        *(made[d](checked).alias(d) for d in DETAILS if d in details),
        (n_unknown if strict else F.lit(0).cast("long")).alias("n_errors"),
    )


def validate(text: Column, strict: bool = False) -> Column:
    """The same of a text as it is."""
    return validate_checked(checked_text(text), strict)
