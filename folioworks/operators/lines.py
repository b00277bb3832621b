"""The table of text lines: build, report, order, smoke checks."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import SmokeTestError
from ..functions import charset, ids, text
from ..sources.ivtff import formats, loci, pages_with_counts, read_lines
from ..sources.tables import file_hashes

COLUMNS = "page_id line_number line_index line_id text text_clean line_type position quire section currier_language hand illustration_type char_count word_count has_uncertain has_illegible has_alternatives has_high_ascii source source_version".split()
#: The name of the rules that made ``text_clean``, for reports.
TEXT_POLICY = "clean_for_analysis"


def line_table(lines: DataFrame, source_name: str = "primary", source_version: str = "") -> DataFrame:
    """One row a locus, with its page's attributes. ``lines`` is a frame of ``file, line_no, line``."""
    raw = F.col("text")
    rows = loci(lines, comments=False, with_page=True).withColumn("stripped", text.strip_markup(raw))
    stripped = F.col("stripped")
    rows = rows.withColumn("text_clean", text.clean_of_stripped(stripped))
    rows, checked = rows.withColumn("checked", charset.checked_text(F.col("text_clean"))), F.col("checked")
    return rows.select(
        "page_id",
        F.col("locus_number").alias("line_number"),
        "line_index",
        F.concat_ws(":", "page_id", "locus_number").alias("line_id"),
        "text",
        "text_clean",
        ids.line_type(F.col("locus_type")).alias("line_type"),
        "position",
        F.col("variables.quire").alias("quire"),
        ids.section_of_page(F.col("page_id"), F.col("variables.illustration")).alias("section"),
        F.col("variables.language").alias("currier_language"),
        F.col("variables.hand").alias("hand"),
        F.col("variables.illustration").alias("illustration_type"),
        charset.letter_count(checked).alias("char_count"),
        charset.word_count(checked).alias("word_count"),
        F.contains(stripped, F.lit("?")).alias("has_uncertain"),
        text.marks_illegible(stripped).alias("has_illegible"),
        text.has_alternatives(raw).alias("has_alternatives"),
        text.has_high_codes(raw).alias("has_high_ascii"),
        F.lit(source_name).alias("source"),
        F.lit(source_version).alias("source_version"),
    )


def in_order(table: DataFrame) -> DataFrame:
    """Lines by folio number, side, panel and index."""
    return table.orderBy(ids.reading_order(F.col("page_id"), F.col("line_index")))


def with_places(table: DataFrame, *ties: str) -> DataFrame:
    """Every line with its ``place`` in reading order, from 1; ``ties`` order lines of equal keys.

    A place is the number of lines in the folios before, on the folio's pages
    before, and the rank on the page: one task orders the folios, one row each.
    """
    key = ids.reading_order(F.col("page_id"), F.col("line_index"))
    rows = table.withColumn("_folio", key["folio"]).withColumn("_page", F.struct(*(key[c].alias(c) for c in ("side", "panel", "page"))))
    pages = rows.groupBy("_folio", "_page").agg(F.count("*").alias("_n"))
    earlier = Window.unboundedPreceding, -1
    folios = pages.groupBy("_folio").agg(F.sum("_n").alias("_n")).select("_folio", F.coalesce(F.sum("_n").over(Window.orderBy("_folio").rowsBetween(*earlier)), F.lit(0)).alias("_base"))
    inside = pages.withColumn("_inside", F.coalesce(F.sum("_n").over(Window.partitionBy("_folio").orderBy("_page").rowsBetween(*earlier)), F.lit(0)))
    # Lines without a page have no folio either; they come first.
    based = inside.alias("i").join(folios.alias("f"), F.col("i._folio").eqNullSafe(F.col("f._folio")))
    offsets = based.select(F.col("i._folio").alias("_at_folio"), F.col("i._page").alias("_at_page"), (F.col("_base") + F.col("_inside")).alias("_before"))
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("_folio", "_page").orderBy("line_index", *ties)))
    here = F.col("_folio").eqNullSafe(F.col("_at_folio")) & F.col("_page").eqNullSafe(F.col("_at_page"))
    return ranked.join(offsets, here).withColumn("place", F.col("_before") + F.col("_rank")).select(*table.columns, "place")


def _counts(frame: DataFrame, key) -> dict[str, int]:
    return {k: n for k, n in frame.groupBy(F.coalesce(key, F.lit("unknown"))).count().collect()}


def build_report(lines: DataFrame, table: DataFrame, policy: str = TEXT_POLICY, most_warnings: int = 1000) -> dict:
    """Counts over the pages and lines of a build; ``table`` should be cached, it is read several times.

    Of the warnings ``most_warnings`` are listed and the others counted.
    """
    heads = pages_with_counts(lines).cache()
    section = ids.section_of_page(F.col("page_id"), F.col("variables.illustration"))
    sums = table.agg(F.count("*").alias("total_lines"), F.coalesce(F.sum("char_count"), F.lit(0)).alias("total_characters"), F.coalesce(F.sum("word_count"), F.lit(0)).alias("total_words"), F.count_if("has_high_ascii").alias("lines_with_high_ascii")).first().asDict()
    form = formats(lines).orderBy("file").first()
    total, without = heads.agg(F.count("*"), F.count_if(F.expr("n_loci = 0"))).first()
    odd = table.where(~charset.is_clean(F.col("text_clean")))
    warnings = [f"{r[0]} holds characters that clean text must not: {' '.join(r[1])}" for r in odd.select("line_id", charset.unclean_characters(F.col("text_clean"))).orderBy("line_id").limit(most_warnings).collect()]
    more = odd.count() - len(warnings) if len(warnings) == most_warnings else 0
    return sums | {
        "build_date": datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "format_version": form and form.format_version,
        "format_options": form and form.format_options,
        "total_pages": total,
        "total_pages_in_source": total,
        "pages_with_lines": total - without,
        "pages_without_lines": without,
        "page_ids_without_lines": [r.page_id for r in heads.where("n_loci = 0").select("page_id").orderBy("page_id").toLocalIterator()],
        "pages_by_language": _counts(heads, F.col("variables.language")),
        "pages_by_section": _counts(heads, section),
        "lines_by_type": _counts(table, F.col("line_type")),
        "text_clean_policy": policy,
        "warnings": warnings + ([f"... and {more} more"] if more > 0 else []),
        "errors": [],
    }


def build_lines(spark: SparkSession, path: str, source_name: str = "primary", expected_sha256: str | None = None) -> tuple[DataFrame, dict]:
    """The ordered table of lines of a file, and the report on it."""
    source = file_hashes(spark, path).first()
    lines = read_lines(spark, path)
    table = in_order(line_table(lines, source_name, source.source_version)).cache()
    report = build_report(lines, table) | {"source_file": source.file, "source_hash": source.sha256, "source_verified": source.sha256 == expected_sha256}
    return table, report


def smoke_checks(table: DataFrame, report: dict, least_lines: int = 4000, least_pages: int = 200, languages: tuple[str, ...] = ("A", "B")) -> dict[str, bool]:
    """Ten checks of a build from one pass over the table."""
    got = table.agg(
        F.count("*").alias("n"),
        F.count_if(F.coalesce(F.col("page_id"), F.lit("")) == "").alias("no_page"),
        F.count_if(F.coalesce(F.col("line_id"), F.lit("")) == "").alias("no_line"),
        F.count_distinct("line_id").alias("ids"),
        F.count_if(F.expr("char_count > 0")).alias("some"),
        F.count_distinct("page_id").alias("pages"),
        F.collect_set("currier_language").alias("languages"),
        F.count_distinct("line_type").alias("types"),
    ).first()
    return {
        "record_count": got.n >= least_lines,
        "page_ids": got.no_page == 0,
        "line_ids": got.no_line == 0,
        "unique_line_ids": got.ids == got.n,
        "characters": bool(got.n) and 100 * got.some >= 95 * got.n,
        "pages": got.pages > least_pages,
        "languages": set(languages) <= set(got.languages),
        "line_types": got.types >= 2,
        "no_errors": not report.get("errors"),
        "fields": got.n > 0 and set("page_id line_number line_id text text_clean source".split()) <= set(table.columns),
    }


def run_smoke_test(table: DataFrame, report: dict, strict: bool = False, **limits) -> bool:
    """Whether all smoke checks hold; ``strict`` raises on those that do not."""
    failed = [k for k, ok in smoke_checks(table, report, **limits).items() if not ok]
    if failed and strict:
        raise SmokeTestError("smoke checks failed", failed=failed)
    return not failed
