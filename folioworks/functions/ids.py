"""Page, folio and quire identifiers, and what follows from their numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Illustration codes, sections by folio, foldouts and missing folios.
ILLUSTRATIONS = {"H": "herbal", "A": "astronomical", "C": "cosmological", "B": "biological", "P": "pharmaceutical", "S": "stars", "T": "text_only", "Z": "zodiac"}
LINE_TYPES = {"P": "paragraph", "L": "label", "C": "circle", "R": "radius"}
SECTIONS = [(1, 25, "herbal_a"), (26, 66, "herbal_b"), (67, 73, "astronomical"), (75, 84, "biological"), (85, 86, "cosmological"), (87, 102, "pharmaceutical"), (103, 116, "recipes")]
FALLBACK = [(66, "herbal"), (73, "astronomical"), (84, "biological"), (86, "cosmological"), (102, "pharmaceutical")]
FOLDOUTS = {"f85v": 6, "f86v": 4}
MISSING = (12, 59, 60, 61, 62, 63, 64, 74, 91, 92, 93, 94, 95, 96, 109, 110)

PAGE_ID = r"^f([0-9]+)([rv])([0-9]*)$"


def _lookup(key: Column, table: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))[key]


def folio_number(page_id: Column) -> Column:
    """Number of a well-formed page id, null for any other."""
    return F.nullif(F.regexp_extract(F.lower(page_id), PAGE_ID, 1), F.lit("")).cast("int")


def side_letter(page_id: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(page_id), PAGE_ID, 2), F.lit(""))


def panel(page_id: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(page_id), PAGE_ID, 3), F.lit("")).cast("int")


def parse_page_id(page_id: Column) -> Column:
    """Struct of folio, side and panel; raises on a malformed id."""
    found = F.struct(folio_number(page_id).alias("folio"), side_letter(page_id).alias("side"), panel(page_id).alias("panel"))
    bad = F.raise_error(F.concat(F.lit("no page id: "), page_id)).cast("struct<folio:int,side:string,panel:int>")
    return F.when(folio_number(page_id).isNotNull(), found).otherwise(bad)


def line_type(locus_type: Column) -> Column:
    return F.coalesce(_lookup(locus_type, LINE_TYPES), F.lit("unknown"))


def section_of_page(page_id: Column, illustration: Column) -> Column:
    """Section by illustration code, else by the number that the id begins with; null without either."""
    number = F.try_to_number(F.regexp_extract(page_id, r"^f([0-9]+)", 1), F.lit("9999999999"))
    by_number = F.lit(None).cast("string")
    chain = None
    for last, name in FALLBACK:
        chain = F.when(number <= last, name) if chain is None else chain.when(number <= last, name)
    by_number = F.when(number.isNotNull(), chain.otherwise("recipes"))
    return F.coalesce(_lookup(illustration, ILLUSTRATIONS), by_number)


def section_of_folio(number: Column) -> Column:
    """Section by folio range, ``unknown`` outside all."""
    chain = None
    for first, last, name in SECTIONS:
        hit = number.between(first, last)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain.otherwise("unknown")


def uncertain_section(number: Column, attribution: str = "consensus") -> Column:
    """The section with how sure it is: boundary folios are disputed and of medium confidence."""
    boundary = number.isin(*sorted({n for first, last, _ in SECTIONS for n in (first, last)}))
    return F.struct(
        section_of_folio(number).alias("value"),
        F.lit(attribution).alias("attribution"),
        F.when(boundary, "medium").otherwise("high").alias("confidence"),
        boundary.alias("disputed"),
        F.array().cast("array<string>").alias("alternatives"),
    )


def is_foldout(page_id: Column) -> Column:
    base = F.concat(F.lit("f"), folio_number(page_id).cast("string"), side_letter(page_id))
    return panel(page_id).isNotNull() | base.isin(*FOLDOUTS)


def total_panels(page_id: Column) -> Column:
    base = F.concat(F.lit("f"), folio_number(page_id).cast("string"), side_letter(page_id))
    return F.when(panel(page_id).isNotNull(), _lookup(base, FOLDOUTS))


def is_missing(number: Column) -> Column:
    return number.isin(*MISSING)


def folio_key(folio_id: Column) -> Column:
    """Sort key of a folio id: its number, 0 without one."""
    return F.coalesce(F.nullif(F.regexp_extract(folio_id, r"f([0-9]+)", 1), F.lit("")).cast("int"), F.lit(0))


def quire_id(letter: Column) -> Column:
    return F.concat(F.lit("q"), F.nullif(letter, F.lit("")))


def version_of(content: Column, length: int = 12) -> Column:
    """The first digits of a content's SHA-256."""
    return F.left(F.sha2(content, 256), F.lit(length))


def reading_order(page_id: Column, line_index: Column) -> Column:
    """Struct that sorts lines by folio, side, panel and index; odd ids come last."""
    number, side, part = (F.regexp_extract(page_id, r"^f([0-9]+)([rv])([0-9]*)", k) for k in (1, 2, 3))
    odd = number == ""
    return F.struct(
        F.when(odd, 999999).otherwise(F.nullif(number, F.lit("")).cast("int")).alias("folio"),
        F.when(side == "v", 1).otherwise(0).alias("side"),
        F.coalesce(F.nullif(part, F.lit("")).cast("int"), F.lit(0)).alias("panel"),
        F.when(odd, page_id).otherwise("").alias("page"),
        line_index.alias("line"),
    )
