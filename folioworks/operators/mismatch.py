"""Aligning transcriptions of the same lines and scoring their agreement."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.text import normalize_for_comparison
from ..sources.tables import SOURCES, load_sources

HIGH = 0.95
LOW = 0.5
AGREEING = ("exact_match", "normalized_match", "high_similarity")


@F.pandas_udf(DoubleType())
def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio, in the order given and with junk detection; 0 if either is empty."""
    return pd.Series([SequenceMatcher(None, a, b).ratio() if a and b else 0.0 for a, b in zip(left, right, strict=True)], dtype=float)


def ratio_bounds(left: Column, right: Column) -> Column:
    """What the similarity of two texts cannot exceed: a struct of ``by_length`` and ``by_letters``.

    Matching blocks hold at most the shorter text, and of each character at most
    the fewer there are of it. Either text empty gives 0.
    """
    n, m = F.char_length(left), F.char_length(right)
    both = n + m
    times = lambda text, c: F.char_length(text) - F.char_length(F.replace(text, c, F.lit("")))
    common = F.aggregate(F.array_distinct(F.split(left, "")), F.lit(0), lambda a, c: a + F.when(c == "", 0).otherwise(F.least(times(left, c), times(right, c))))
    some = (n > 0) & (m > 0)
    return F.struct(F.when(some, 2 * F.least(n, m) / both).otherwise(0.0).alias("by_length"), F.when(some, 2 * common / both).otherwise(0.0).alias("by_letters"))


def verdicts(aligned: DataFrame, left: str = "zl", right: str = "it") -> DataFrame:
    """``aligned`` with ``status`` and ``eva_agreement`` as ``compare`` gives them, without scores.

    Texts that cannot be similar enough by their lengths or letters are told
    by these; the cheaper bound is looked at first. Only what is left is matched.
    """
    a, b = normalize_for_comparison(F.col(f"{left}_text")), normalize_for_comparison(F.col(f"{right}_text"))
    rows = aligned.withColumn("status", cheap_status(F.col(f"{left}_text"), F.col(f"{right}_text"), left, right))
    bounds = ratio_bounds(a, b)
    near = F.when(F.col("status").isNotNull() | (bounds["by_length"] < HIGH), False).otherwise(bounds["by_letters"] >= HIGH)
    told = rows.withColumn("near", near)
    easy = told.where(~F.col("near")).withColumn("status", F.coalesce("status", F.lit("content_mismatch")))
    hard = told.where("near").withColumn("status", F.when(similarity(a, b) >= HIGH, "high_similarity").otherwise("content_mismatch"))
    agreement = F.when(F.col("status").isin(*AGREEING), True).when(F.col("status") == "content_mismatch", False)
    return easy.unionByName(hard).drop("near").withColumn("eva_agreement", agreement)


def align(lines: DataFrame, sources: tuple[str, ...] = tuple(SOURCES), key: str = "line_id", text: str = "text", source: str = "source_id", order: str | Column = "line_no") -> DataFrame:
    """One row a key with a ``<source>_text`` column for each source.

    This is the full outer join of all sources in one shuffle: each source's
    last text is picked while grouping by key.
    """
    order = F.col(order) if isinstance(order, str) else order
    last = [F.max_by(F.when(F.col(source) == s, F.col(text)), F.when(F.col(source) == s, order)).alias(f"{s}_text") for s in sources]
    return lines.groupBy(F.col(key).alias("line_id")).agg(*last)


def cheap_status(left: Column, right: Column, left_name: str = "zl", right_name: str = "it") -> Column:
    """The status that needs no similarity, or null where it does."""
    return (
        F.when(left.isNull() & right.isNull(), "both_missing")
        .when(left.isNull(), f"{left_name}_missing")
        .when(right.isNull(), f"{right_name}_missing")
        .when(left == right, "exact_match")
        .when(normalize_for_comparison(left) == normalize_for_comparison(right), "normalized_match")
    )


def compare(aligned: DataFrame, left: str = "zl", right: str = "it") -> DataFrame:
    """``aligned`` with ``status``, ``eva_agreement`` and ``similarity_score``.

    Only rows that no cheaper test decides reach the Python function: they are
    filtered first, which also keeps their number small.
    """
    a, b = F.col(f"{left}_text"), F.col(f"{right}_text")
    rows = aligned.withColumn("status", cheap_status(a, b, left, right))
    one = F.when(F.col("status").isin("exact_match", "normalized_match"), 1.0)
    easy = rows.where("status is not null").withColumn("similarity_score", one)
    hard = rows.where("status is null").withColumn("similarity_score", similarity(normalize_for_comparison(a), normalize_for_comparison(b)))
    hard = hard.withColumn("status", F.when(F.col("similarity_score") >= HIGH, "high_similarity").otherwise("content_mismatch"))
    agreement = F.when(F.col("status").isin(*AGREEING), True).when(F.col("status") == "content_mismatch", False)
    return easy.unionByName(hard).withColumn("eva_agreement", agreement)


def records(compared: DataFrame, sources: tuple[str, ...] = tuple(SOURCES)) -> DataFrame:
    """The full record of each line id: its parts, texts, verdict, sources there and not, notes."""
    there = lambda yes: F.filter(F.array(*(F.when(F.col(f"{s}_text").isNotNull() == yes, F.lit(s)) for s in sources)), lambda x: x.isNotNull())
    low = (F.col("status") == "content_mismatch") & (F.col("similarity_score") < LOW)
    # Fixed value: the note of a low score.
    note = F.array(F.format_string("Low similarity: %.2f%%", F.col("similarity_score") * 100))
    return compared.select(
        F.substring_index("line_id", ":", 1).alias("page_id"),
        F.coalesce(F.nullif(F.split_part("line_id", F.lit(":"), F.lit(2)), F.lit("")).cast("int"), F.lit(0)).alias("line_number"),
        "line_id",
        *(f"{s}_text" for s in sources),
        "status",
        "eva_agreement",
        "similarity_score",
        there(True).alias("sources_present"),
        there(False).alias("sources_missing"),
        F.when(low, note).otherwise(F.array().cast("array<string>")).alias("notes"),
    )


def statistics(compared: DataFrame, left: str = "zl", right: str = "it") -> DataFrame:
    """One row of counts. Lines with an empty text agree or not, but are not counted as both present."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    both = F.count_if((F.coalesce(F.col(f"{left}_text"), F.lit("")) != "") & (F.coalesce(F.col(f"{right}_text"), F.lit("")) != ""))
    counted = compared.agg(
        F.count("*").alias("total_lines"),
        is_("exact_match").alias("exact_matches"),
        is_("normalized_match").alias("normalized_matches"),
        is_("high_similarity").alias("high_similarity_matches"),
        is_("content_mismatch").alias("content_mismatches"),
        is_(f"{left}_missing").alias(f"{right}_only_lines"),
        is_(f"{right}_missing").alias(f"{left}_only_lines"),
        both.alias("both_eva_present"),
    )
    agreeing = F.col("exact_matches") + F.col("normalized_matches") + F.col("high_similarity_matches")
    counted = counted.withColumn("total_agreeing", agreeing)
    rate = F.when(F.col("both_eva_present") > 0, F.col("total_agreeing") / F.col("both_eva_present"))
    return counted.withColumn("agreement_rate", F.coalesce(rate, F.lit(0.0))).withColumn("agreement_shown", F.when(rate.isNotNull(), F.format_string("%.1f%%", rate * 100)).otherwise("N/A"))


def line_ids(lines: DataFrame, key: str = "line_id") -> DataFrame:
    """The keys of all sources, once each."""
    return lines.select(key).distinct()


def source_counts(lines: DataFrame, source: str = "source_id", key: str = "line_id") -> DataFrame:
    return lines.groupBy(source).agg(F.count_distinct(key).alias("n_lines"))


def build_mismatch_index(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame, dict]:
    """Records of all line ids in order of the id, and the summary. ``zl`` must be among the sources."""
    lines = load_sources(spark, paths).withColumnRenamed("locus_id", "line_id")
    compared = compare(align(lines)).cache()
    summary = statistics(compared).first().asDict() | {"per_source_counts": {s: n for s, n in source_counts(lines).collect()}}
    return records(compared).orderBy("line_id"), summary
