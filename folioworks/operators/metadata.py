"""Pages, and their rollups to folios and quires."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..sources.ivtff import pages_with_counts, read_lines
from ..sources.tables import file_hashes


def page_records(lines: DataFrame, attribution: str = "consensus") -> DataFrame:
    """One row a page header, with ``page_ord`` as source order. Pages without loci stay."""
    rows = pages_with_counts(lines).withColumn("page_id", F.lower("page_id"))
    page, number = F.col("page_id"), ids.folio_number(F.col("page_id"))
    return rows.select(
        "file",
        "page_ord",
        "page_id",
        F.concat(F.lit("f"), number).alias("folio_id"),
        F.when(ids.side_letter(page) == "r", "recto").otherwise("verso").alias("side"),
        number.alias("folio_number"),
        ids.quire_id(F.col("variables.quire")).alias("quire_id"),
        F.col("variables.quire").alias("quire_letter"),
        F.col("variables.page_in_quire").alias("page_in_quire"),
        ids.uncertain_section(number, attribution).alias("section"),
        F.col("variables.language").alias("currier_language"),
        F.col("variables.hand").alias("hand"),
        F.col("variables.illustration").alias("illustration_type"),
        "line_count",
        "label_count",
        "has_text",
        ids.panel(page).isNotNull().alias("is_foldout_panel"),
        ids.panel(page).alias("panel_number"),
        ids.total_panels(page).alias("total_panels"),
        ids.is_missing(number).alias("is_missing"),
        F.array().cast("array<string>").alias("notes"),
    )


def _order() -> Column:
    return F.struct("file", "page_ord")


def most_frequent(value: str) -> Column:
    """The most frequent value that is not null; of equals the smallest."""
    return F.mode(F.col(value), True)


def folio_records(records: DataFrame, attribution: str = "consensus") -> DataFrame:
    """One row a folio: its first recto, its versos by panel, lines and predominant language."""
    verso = F.when(F.col("side") == "verso", F.struct(F.coalesce("panel_number", F.lit(0)).alias("panel"), "file", "page_ord", "page_id"))
    grouped = records.groupBy("folio_id").agg(
        F.first("folio_number").alias("folio_number"),
        F.min_by("quire_id", _order()).alias("quire_id"),
        F.min_by(F.when(F.col("side") == "recto", F.col("page_id")), F.when(F.col("side") == "recto", _order())).alias("recto_page_id"),
        F.array_sort(F.collect_list(verso)).alias("versos"),
        F.bool_or("is_foldout_panel").alias("panels"),
        F.sum("line_count").alias("total_lines"),
        most_frequent("currier_language").alias("currier_language"),
    )
    number, foldout = F.col("folio_number"), (F.size("versos") > 1) | F.col("panels")
    return grouped.select(
        "folio_id",
        "folio_number",
        "quire_id",
        "recto_page_id",
        F.col("versos.page_id").alias("verso_page_ids"),
        foldout.alias("is_foldout"),
        F.when(foldout, F.size("versos")).alias("panel_count"),
        ids.is_missing(number).alias("is_missing"),
        "total_lines",
        "currier_language",
        ids.uncertain_section(number, attribution).alias("section"),
        F.array().cast("array<string>").alias("notes"),
    )


def quire_records(records: DataFrame) -> DataFrame:
    """One row a quire: folios in order of number, pages, lines, sections, completeness."""
    grouped = records.where("quire_id is not null").groupBy("quire_id").agg(
        F.min_by("quire_letter", _order()).alias("quire_letter"),
        F.array_sort(F.collect_set(F.struct("folio_number", "folio_id"))).alias("folios"),
        F.count("*").alias("page_count"),
        F.bool_and(~F.col("is_missing")).alias("is_complete"),
        F.sum("line_count").alias("total_lines"),
        F.array_sort(F.collect_set("section.value")).alias("sections"),
    )
    folios = F.col("folios.folio_id")
    return grouped.select("quire_id", "quire_letter", folios.alias("folio_ids"), F.size(folios).alias("folio_count"), "page_count", "is_complete", "total_lines", "sections", F.array().cast("array<string>").alias("notes"))


def totals(records: DataFrame) -> DataFrame:
    """One row: pages, folios, quires and lines."""
    return records.agg(F.count("*").alias("total_pages"), F.count_distinct("folio_id").alias("total_folios"), F.count_distinct("quire_id").alias("total_quires"), F.coalesce(F.sum("line_count"), F.lit(0)).alias("total_lines"))


def page_counts(records: DataFrame, key: Column, missing: str | None = "unknown") -> DataFrame:
    """Pages by ``key``; rows without one are counted as ``missing`` or, if that is None, left out."""
    rows = records.select((F.coalesce(key, F.lit(missing)) if missing else key).alias("key"))
    return rows.where("key is not null").groupBy("key").agg(F.count("*").alias("n_pages"))


def build_report(records: DataFrame, folios: DataFrame, quires: DataFrame) -> dict:
    """Counts over a metadata build."""
    by = lambda c: {k: n for k, n in page_counts(records, F.col(c)).collect()}
    sums = records.agg(F.count_if("has_text").alias("pages_with_text"), F.sum("line_count").alias("total_lines"), F.sum("label_count").alias("total_labels")).first().asDict()
    leaves = folios.agg(F.count("*").alias("total_folios"), F.count_if("is_foldout").alias("foldout_folios"), F.count_if("is_missing").alias("missing_folios")).first().asDict()
    gatherings = quires.agg(F.count("*").alias("total_quires"), F.count_if("is_complete").alias("complete_quires")).first().asDict()
    return sums | leaves | gatherings | {"total_pages": records.count(), "pages_by_section": by("section.value"), "pages_by_language": by("currier_language"), "pages_by_hand": by("hand")}


def build_metadata(spark: SparkSession, path: str, attribution: str = "consensus") -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    """Pages in source order, folios by number, quires by id, and the report."""
    source = file_hashes(spark, path).first()
    records = page_records(read_lines(spark, path), attribution).cache()
    folios, quires = folio_records(records, attribution), quire_records(records)
    report = build_report(records, folios, quires) | {"source_file": source.file, "source_hash": source.source_version}
    return records.orderBy("file", "page_ord").drop("file", "page_ord"), folios.orderBy(ids.folio_key(F.col("folio_id"))), quires.orderBy("quire_id"), report
