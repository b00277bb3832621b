"""Profiles of source files and texts: does this look like a transcription?"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.charset import SINGLE, characters
from ..sources.sinks import write_json
from ..sources.tables import Source, probe

PAGE = r"<f[0-9]+[rv][0-9]*>"
OLD_LOCUS = r"<f[0-9]+[rv][0-9]*\.\w+\.[0-9]+[;\w]*>"
OLD_LOCUS_TEXT = OLD_LOCUS + r"\s*([^<]+)"
TRANSCRIBER = r";([A-Z])>"


def _distinct(found: Column) -> Column:
    return F.array_sort(F.array_distinct(found))


def structure(content: Column) -> Column:
    """Struct of distinct pages and old-style loci, and whether there are any."""
    pages = F.size(F.array_distinct(F.regexp_extract_all(content, F.lit(PAGE), 0)))
    lines = F.regexp_count(content, F.lit(OLD_LOCUS))
    return F.struct((pages > 0).alias("can_parse_pages"), (lines > 0).alias("can_parse_lines"), pages.alias("page_count"), lines.alias("line_count"))


def eva_characters(content: Column) -> Column:
    """Struct of the alphabet's characters that old-style loci hold, and of all others."""
    texts = F.array_join(F.regexp_extract_all(content, F.lit(r"(?m)" + OLD_LOCUS_TEXT), 1), " ")
    left = F.regexp_replace(F.lower(texts), r"[.\-=,\s\[\]{}!?*@0-9<>]", "")
    found = _distinct(characters(left))
    letters = F.array(*map(F.lit, SINGLE))
    return F.struct(F.array_intersect(found, letters).alias("known"), F.array_except(found, letters).alias("unknown"))


def transcribers(content: Column) -> Column:
    return _distinct(F.regexp_extract_all(content, F.lit(TRANSCRIBER), 1))


def mentions(content: Column, *words: str) -> Column:
    """Whether any of the words stands in the text, in any case."""
    low, found = F.lower(content), F.lit(False)
    for word in words:
        found = found | F.contains(low, F.lit(word.lower()))
    return found


def profile(files: DataFrame, name: str = "file", content: str = "value") -> DataFrame:
    """One row a text: hash, size, structure, characters, transcribers, errors and warnings."""
    text = F.coalesce(F.col(content), F.lit(""))
    rows = files.select(
        F.col(name).alias("file"),
        F.sha2(text, 256).alias("sha256"),
        F.octet_length(text).alias("size"),
        (F.contains(text, F.lit("#=IVTFF")) | F.contains(F.upper(F.left(text, F.lit(1000))), F.lit("EVA"))).alias("looks_like_ivtff"),
        structure(text).alias("structure"),
        eva_characters(text).alias("characters"),
        transcribers(text).alias("transcribers"),
    )
    errors = F.filter(
        F.array(F.when(~F.col("structure.can_parse_pages"), "no page header is found"), F.when(~F.col("structure.can_parse_lines"), "no line locator is found")),
        lambda x: x.isNotNull(),
    )
    return rows.select("*", errors.alias("errors"), (F.size("characters.unknown") > 0).alias("has_unknown_characters"))


def against_hashes(found: DataFrame, expected: DataFrame) -> DataFrame:
    """Files with their expected hash beside the one found (``file, sha256`` on both sides), and whether they agree."""
    return expected.withColumnRenamed("sha256", "expected").join(found.select("file", "sha256"), "file", "left").withColumn("matches", F.coalesce(F.col("sha256") == F.col("expected"), F.lit(False)))


def verify_source(spark: SparkSession, source: Source, keywords: tuple[str, ...] = (), get: Callable = probe) -> dict:
    """What a source's address gives: status, type, size, hash, and its profile or the keywords found.

    A transcription must have pages and lines; a page with ``keywords`` must hold
    one of them. A hash other than the registered one is a warning.
    """
    result: dict = {"name": source.name, "url": source.url, "status": None, "errors": [], "warnings": []}
    try:
        content, status, kind = get(source.url)
    except OSError as error:
        return result | {"passed": False, "errors": [f"cannot be reached: {error}"]}
    frame = spark.createDataFrame([(source.name, bytearray(content))], "file string, content binary")
    text = F.make_valid_utf8(F.col("content").cast("string"))
    result |= {"status": status, "content_type": kind, "size": len(content), "sha256": frame.select(F.sha2("content", 256)).first()[0]}
    if status != 200:
        result["errors"].append(f"status {status}")
    elif keywords:
        if not frame.select(mentions(text, *keywords)).first()[0]:
            result["errors"].append(f"none of the words {', '.join(keywords)}")
    else:
        found = profile(frame.select("file", text.alias("value"))).first().asDict(True)
        result |= {k: found[k] for k in ("looks_like_ivtff", "structure", "characters", "transcribers")}
        result["errors"] += found["errors"]
        result["warnings"] += ["unknown characters: " + " ".join(found["characters"]["unknown"])] if found["has_unknown_characters"] else []
    if source.sha256 and source.sha256 != result["sha256"]:
        result["warnings"].append("not the registered hash")
    return result | {"passed": not result["errors"]}


def verify_all(spark: SparkSession, sources: dict[str, Source], keywords: dict[str, tuple[str, ...]] | None = None, save_to: str | None = None, get: Callable = probe) -> dict:
    """The results of all sources by name, and under ``_run`` when they were had and whether all passed; saved if asked."""
    results: dict = {name: verify_source(spark, s, (keywords or {}).get(name, ()), get) for name, s in sources.items()}
    results["_run"] = {"at": datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds"), "all_passed": all(r["passed"] for r in results.values())}
    if save_to:
        write_json(results, save_to)
    return results
