"""Markup cleaners, flags and tokenizers as Column expressions.

Four cleaners are kept apart because they treat the same marks differently:
``strip_markup``, ``clean_for_analysis``, ``extract_text`` and
``normalize_for_comparison``. All stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"(?U)\s+"
BRACES = r"\{[^}]*\}"
TAGS = r"<[^>]*>"
HIGH_CODE = r"@[0-9]+;"


def _drop(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def squeeze(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def strip(text: Column) -> Column:
    """``text`` without white space of any kind at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def strip_markup(text: Column) -> Column:
    """Comments and tags out, the first of two alternatives in; ``?!*`` stay. Flags are computed on this."""
    text = F.regexp_replace(_drop(text, BRACES), r"\[([^:\]]*):([^\]]*)\]", "$1")
    return squeeze(_drop(text, TAGS))


def clean_for_analysis(text: Column) -> Column:
    """``strip_markup`` without ``?!*``, and capital I as i."""
    return clean_of_stripped(strip_markup(text))


def clean_of_stripped(stripped: Column) -> Column:
    """The same of a text that ``strip_markup`` has been over."""
    text = F.translate(stripped, "?!*", "")
    return squeeze(F.replace(text, F.lit("I"), F.lit("i")))


def extract_text(text: Column, clean: bool = True) -> Column:
    """Readable text: gaps as blanks, inline tags out; alternatives as their first if ``clean``."""
    text = _drop(text, BRACES)
    if clean:
        text = F.regexp_replace(text, r"\[([^:\]]+):[^\]]+\]", "$1")
    text = F.replace(text, F.lit("<->"), F.lit(" "))
    return squeeze(_drop(_drop(text, r"<[$%~]>"), r"<![^>]*>"))


def normalize_for_comparison(text: Column) -> Column:
    """Text without marks, tags, comments and bracketed readings; null as empty."""
    text = F.translate(F.coalesce(text, F.lit("")), "?!*", "")
    return squeeze(_drop(_drop(_drop(text, TAGS), BRACES), r"\[[^\]]*\]"))


def is_uncertain(raw: Column) -> Column:
    return F.contains(strip_markup(raw), F.lit("?"))


def is_illegible(raw: Column) -> Column:
    return marks_illegible(strip_markup(raw))


def marks_illegible(stripped: Column) -> Column:
    return F.contains(stripped, F.lit("!")) | F.contains(stripped, F.lit("*"))


def has_alternatives(raw: Column) -> Column:
    """Whether a bracket and a colon stand anywhere in the raw text."""
    return F.contains(raw, F.lit("[")) & F.contains(raw, F.lit(":"))


def has_high_codes(raw: Column) -> Column:
    return raw.rlike(HIGH_CODE)


def is_stripped(text: Column) -> Column:
    return ~text.rlike(r"[<>{}]")


def contains_in_both(left: Column, right: Column, pattern: str) -> Column:
    """Whether ``pattern`` stands in both texts; null is empty."""
    return F.contains(F.coalesce(left, F.lit("")), F.lit(pattern)) & F.contains(F.coalesce(right, F.lit("")), F.lit(pattern))


def words(text: Column, letters_only: bool = False) -> Column:
    """Words between dots and commas, trimmed; with ``letters_only`` those of letters alone."""
    found = F.filter(F.transform(F.split(text, "[.,]"), strip), lambda w: w != "")
    return F.filter(found, lambda w: w.rlike(r"^\p{L}+\z")) if letters_only else found


def spaced_words(text: Column) -> Column:
    """Words between dots, commas and white space."""
    return F.filter(F.split(text, r"[.,\s]+"), lambda w: w != "")


def letters(text: Column) -> Column:
    """The letters of a text, in order."""
    return _drop(text, r"[^\p{L}]+")


def fill_template(template: Column, values: dict[str, str]) -> Column:
    """``{{KEY}}`` replaced by its value; keys without one stay."""
    for key, value in values.items():
        template = F.replace(template, F.lit("{{" + key + "}}"), F.lit(value))
    return template
