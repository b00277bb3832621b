"""Rules over tables: JSON schemas compiled to columns, invariants as violation rows."""

from __future__ import annotations

import json
import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import SchemaError
from ..functions import charset, ids, text
from ..sources.shared import stored

# The fields a line record must have, and the two schemas.
REQUIRED_FIELDS = "page_id line_number line_index line_id text text_clean line_type has_uncertain has_illegible has_alternatives has_high_ascii source source_version".split()
REPORT_FIELDS = "source_file source_hash build_date format_version format_options text_clean_policy total_pages total_lines lines_with_high_ascii".split()
_PAGE = {"type": "string", "pattern": r"^f\d+[rv]\d*$"}
_LINE = {"type": "string", "pattern": r"^f\d+[rv]\d*:\d+$"}
_STRING, _NULLABLE, _FLAG = {"type": "string"}, {"type": ["string", "null"]}, {"type": "boolean"}
_POSITIVE, _COUNT = {"type": "integer", "minimum": 1}, {"type": "integer", "minimum": 0}
LINES_SCHEMA = {
    "type": "object",
    "required": ["page_id", "line_number", "line_index", "line_id", "text", "source"],
    "properties": {
        "page_id": _PAGE, "line_number": _POSITIVE, "line_index": _POSITIVE, "line_id": _LINE, "text": _STRING, "text_clean": _STRING,
        "line_type": {"type": "string", "enum": ["paragraph", "label", "circle", "radius", "other"]}, "position": {"type": "string", "enum": ["@", "+", "=", "*"]},
        "quire": _NULLABLE, "section": _NULLABLE, "currier_language": {"type": ["string", "null"], "enum": ["A", "B", None]}, "hand": _NULLABLE, "illustration_type": _NULLABLE, "source": _STRING, "source_version": _STRING,
        "char_count": _COUNT, "word_count": _COUNT, "has_uncertain": _FLAG, "has_illegible": _FLAG, "has_alternatives": _FLAG, "has_high_ascii": _FLAG,
    },
}
MISMATCH_SCHEMA = {
    "type": "object",
    "required": ["page_id", "line_number", "line_id", "status"],
    "properties": {
        "page_id": _PAGE, "line_number": _POSITIVE, "line_id": _LINE, "primary_text": _NULLABLE, "secondary_text": _NULLABLE, "primary_source": _STRING, "secondary_source": _STRING,
        "status": {"type": "string", "enum": ["ok", "content_mismatch", "line_count_mismatch", "missing_in_primary", "missing_in_secondary", "reflow", "parse_error", "page_missing", "other"]},
        "mismatch_type": _NULLABLE, "similarity_score": {"type": ["number", "null"], "minimum": 0, "maximum": 1}, "notes": {"type": "array", "items": {"type": "string"}},
    },
}
SCHEMAS = {"transcription_lines": LINES_SCHEMA, "mismatch_index": MISMATCH_SCHEMA}
NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"


def load_schema(name: str, folder: str | None = None) -> dict:
    """A schema by its name, one of ``SCHEMAS`` or a file in ``folder``, or by a file's path; ``.json`` may be left off.

    A name that ends in ``.schema`` is that of the schema before it.
    """
    short = name.removesuffix(".json").removesuffix(".schema")
    if folder is None and short in SCHEMAS:
        return SCHEMAS[short]
    path = name if name.endswith(".json") else f"{name}.json"
    path = os.path.join(folder, path) if folder else path
    if not os.path.exists(path):
        raise FileNotFoundError(f"no schema {name}, neither known by name nor a file: {path}")
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def _of_type(value: Column, kind: str) -> Column:
    """Whether a value's JSON text is of a type."""
    return {
        "null": value == "null",
        "string": value.startswith('"'),
        "boolean": value.isin("true", "false"),
        "integer": value.rlike(r"^-?[0-9]+(\.0+)?$"),
        "number": value.rlike(NUMBER),
        "array": value.startswith("["),
        "object": value.startswith("{"),
    }[kind]


def schema_rules(schema: dict, json_col: str = "json") -> list[tuple[str, str, Column]]:
    """Path, rule and violating condition of a draft-07 schema of one level.

    Known keywords are type, required, pattern, enum, minimum, maximum and
    items. A missing field breaks ``required`` only; fields not named are free.
    """
    parsed = F.try_parse_json(json_col)
    rules = [("", "type", parsed.isNull() | ~F.ltrim(json_col).startswith("{"))]
    here = lambda name: F.array_contains(F.json_object_keys(json_col), name)
    rules += [("", f"required:{name}", ~here(name)) for name in schema.get("required", [])]
    for name, spec in schema.get("properties", {}).items():
        value = F.coalesce(F.variant_get(parsed, f"$.{name}", "string"), F.lit("null"))
        kind = F.schema_of_variant(F.variant_get(parsed, f"$.{name}", "variant"))
        raw = F.when(kind == "STRING", F.concat(F.lit('"'), value, F.lit('"'))).otherwise(value)
        kinds = [spec["type"]] if isinstance(spec.get("type"), str) else spec.get("type", [])
        typed = reduce(lambda a, b: a | b, (_of_type(raw, k) for k in kinds)) if kinds else F.lit(True)
        text_value = kind == "STRING"
        number = value.try_cast("double")
        if kinds:
            rules.append((name, "type", here(name) & ~typed))
        if "pattern" in spec:
            rules.append((name, "pattern", here(name) & text_value & ~value.rlike(spec["pattern"])))
        if "enum" in spec:
            allowed = [json.dumps(v) for v in spec["enum"]]
            rules.append((name, "enum", here(name) & ~raw.isin(*allowed)))
        if "minimum" in spec:
            rules.append((name, "minimum", here(name) & ~text_value & (number < spec["minimum"])))
        if "maximum" in spec:
            rules.append((name, "maximum", here(name) & ~text_value & (number > spec["maximum"])))
        if "items" in spec and "type" in spec["items"]:
            items = F.try_variant_get(parsed, f"$.{name}", "array<variant>")
            odd = F.exists(items, lambda v: F.schema_of_variant(v) != {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN"}[spec["items"]["type"]])
            rules.append((name, "items", here(name) & typed & odd))
    return rules


def schema_violations(frame: DataFrame, schema: dict, id_col: str, json_col: str = "json") -> DataFrame:
    """``record_id, path, rule`` of every broken rule, a row each; all rules in one pass."""
    broken = [F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(path).alias("path"), F.lit(rule).alias("rule"))) for path, rule, bad in schema_rules(schema, json_col)]
    found = F.filter(F.array(*broken), lambda x: x.isNotNull())
    return frame.select(F.col(id_col).alias("record_id"), F.explode(found).alias("v")).select("record_id", "v.*")


def validate_records(spark: SparkSession, records: dict | list[dict], schema: dict | str, raise_on_error: bool = False) -> tuple[bool, list[str]]:
    """Whether driver-side records keep a schema, and what they break."""
    schema = load_schema(schema) if isinstance(schema, str) else schema
    rows = records if isinstance(records, list) else [records]
    frame = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "id long, json string")
    errors = [f"Record {i}: {rule} at [{path}]" for i, path, rule in schema_violations(frame, schema, "id").orderBy("record_id", "path", "rule").collect()]
    if errors and raise_on_error:
        raise SchemaError("records break the schema", errors=errors[:20])
    return not errors, errors


def missing_fields(raw: DataFrame, required: list[str] = REQUIRED_FIELDS, json_col: str = "json") -> DataFrame:
    """Rows that lack required fields; null fields are there."""
    lacking = F.array_except(F.array(*map(F.lit, required)), F.json_object_keys(json_col))
    return raw.withColumn("missing", lacking).where(F.size("missing") > 0)


def _failures(rows: DataFrame, rule: str, record: Column, bad: Column, message: Column | str) -> DataFrame:
    said = F.lit(message) if isinstance(message, str) else message
    return rows.where(bad).select(F.lit(rule).alias("invariant"), record.alias("record_id"), said.alias("message"))


_FLAGS = ("has_illegible", "has_uncertain", "has_high_ascii")


def text_failures(lines: DataFrame) -> DataFrame:
    """Clean text that holds markup, marks or other characters, and flags that differ from the raw text."""
    raw_text = F.coalesce("text", F.lit(""))
    lines = lines.select("line_id", "page_id", "line_number", *_FLAGS, F.coalesce("text_clean", F.lit("")).alias("clean"), raw_text.alias("raw"), text.strip_markup(raw_text).alias("basis"))
    clean, raw, basis, line = F.col("clean"), F.col("raw"), F.col("basis"), F.col("line_id")
    differs = lambda name, due: F.coalesce(F.col(name), F.lit(False)) != due
    only_codes = text.strip(raw).rlike(r"^(@[0-9]+;)+$")
    rules = {
        "TEXT_CLEAN_NO_MARKUP": (charset.has_markup(clean), "clean text holds markup"),
        "TEXT_CLEAN_NO_MARKERS": (charset.has_uncertainty_marks(clean), "clean text holds marks of doubt"),
        "TEXT_CLEAN_CHARSET": (~charset.is_clean(clean), F.concat(F.lit("clean text holds "), F.array_join(charset.unclean_characters(clean), ""))),
        "FLAG_BASIS_CLEAN": (~text.is_stripped(basis), "stripping leaves tags or braces"),
        "HAS_ILLEGIBLE_CONTRACT": (differs("has_illegible", text.marks_illegible(basis)), "the flag is not what the text says"),
        "HAS_UNCERTAIN_CONTRACT": (differs("has_uncertain", F.contains(basis, F.lit("?"))), "the flag is not what the text says"),
        "LINE_ID_FORMAT": (line != F.concat_ws(":", F.coalesce("page_id", F.lit("")), F.coalesce("line_number", F.lit(0))), "the id is not made of page and number"),
        "HIGH_ASCII_FLAG": (differs("has_high_ascii", text.has_high_codes(raw)), "the flag is not what the text says"),
        "HIGH_ASCII_PRESERVED": (only_codes & (clean == ""), "clean text has lost its codes"),
    }
    # Rules are columns, and only rows that break one are taken apart.
    marked = lines.withColumns({rule: F.coalesce(bad, F.lit(False)) for rule, (bad, _) in rules.items()}).where(reduce(lambda a, b: a | b, map(F.col, rules)))
    broken = [F.when(F.col(rule), F.struct(F.lit(rule).alias("invariant"), (F.lit(said) if isinstance(said, str) else said).alias("message"))) for rule, (_, said) in rules.items()]
    rows = marked.select("line_id", F.explode(F.array(*broken)).alias("v")).where("v is not null")
    return rows.select("v.invariant", F.col("line_id").alias("record_id"), "v.message")


def duplicate_ids(lines: DataFrame, key: str = "line_id") -> DataFrame:
    found = lines.groupBy(key).agg(F.count("*").alias("n"))
    return _failures(found, "LINE_ID_UNIQUE", F.col(key), F.col("n") > 1, F.format_string("%d times", F.col("n")))


def broken_sequences(lines: DataFrame, page: str = "page_id", index: str = "line_index") -> DataFrame:
    """Pages whose line indexes are not 1 .. n."""
    at = F.coalesce(F.col(index), F.lit(0))
    found = lines.groupBy(page).agg(F.count("*").alias("n"), F.min(at).alias("low"), F.max(at).alias("high"), F.count_distinct(at).alias("kinds"))
    bad = (F.col("low") != 1) | (F.col("high") != F.col("n")) | (F.col("kinds") != F.col("n"))
    return _failures(found, "LINE_INDEX_SEQUENTIAL", F.col(page), bad, F.format_string("%d lines are numbered %d to %d", "n", "low", "high"))


#: Lines to a range of positions.
RANGE = 250_000


def order_violations(lines: DataFrame, position: str, bucket: int | None = None, group: int = 4096) -> DataFrame:
    """Lines that come before their predecessor in reading order, with their ``position``.

    ``position`` is the file's own order, a whole number. Windows cover buckets
    of positions; the step from one bucket to the next is checked on the buckets'
    ends, in groups of buckets, and on the groups' ends. Without a width of
    buckets they are ranges of some ``RANGE`` lines, however far apart positions lie.
    """
    key = ids.reading_order(F.col("page_id"), F.coalesce("line_index", F.lit(0)))
    rows = lines.select("line_id", F.col(position).alias("at"), key.alias("key"))
    if bucket is None:
        ranges = max(1, min(10_000, -(-lines.count() // RANGE)))
        # Stored, so that a line has one bucket in all that reads it.
        rows = stored(rows.repartitionByRange(ranges, "at").withColumn("bucket", F.spark_partition_id()))
    else:
        rows = rows.withColumn("bucket", F.floor(F.col("at") / bucket))

    def stepped(frame: DataFrame, by: str | None, order: str, last: str) -> DataFrame:
        return frame.withColumn("before", F.lag(last).over(Window.partitionBy(by if by else F.lit(1)).orderBy(order)))

    def ends(frame: DataFrame, by: str, order: str, last: str) -> DataFrame:
        first = [F.min_by(c, order).alias(c) for c in ("key", "line_id", "at")]
        return frame.groupBy(by).agg(*first, F.max_by(last, order).alias("last"))

    buckets = ends(rows, "bucket", "at", "key").withColumn("group", F.floor(F.col("bucket") / group))
    groups = ends(buckets, "group", "bucket", "last")
    steps = [stepped(rows, "bucket", "at", "key"), stepped(buckets, "group", "bucket", "last"), stepped(groups, None, "group", "last")]
    both = reduce(DataFrame.union, (f.select("line_id", "at", "key", "before") for f in steps)).where(F.col("key") < F.col("before"))
    return both.select(F.lit("ORDERING").alias("invariant"), F.col("line_id").alias("record_id"), F.lit("comes before the line before it").alias("message"), F.col("at").alias("position"))


def count_failures(lines: DataFrame, expected_lines: int | None = None, expected_pages: int | None = None) -> DataFrame:
    got = lines.agg(F.count("*").alias("lines"), F.count_distinct(F.coalesce("page_id", F.lit(""))).alias("pages"))
    checks = [("RECORD_COUNT", "lines", expected_lines), ("PAGE_COUNT", "pages", expected_pages)]
    parts = [_failures(got, rule, F.lit(None).cast("string"), F.col(c) != n, F.format_string(f"%d, not {n}", c)) for rule, c, n in checks if n is not None]
    return reduce(DataFrame.union, parts, _failures(got, "", F.lit(None).cast("string"), F.lit(False), ""))


#: The checks that ``verify_invariants`` runs, by the rules they report. The names of the rules.
CHECKS = (
    "RECORD_COUNT", "PAGE_COUNT", "TEXT_CLEAN_NO_MARKUP", "TEXT_CLEAN_NO_MARKERS", "TEXT_CLEAN_CHARSET", "FLAG_BASIS_CLEAN", "HAS_ILLEGIBLE_CONTRACT", "HAS_UNCERTAIN_CONTRACT",
    "LINE_ID_FORMAT", "LINE_ID_UNIQUE", "LINE_INDEX_SEQUENTIAL", "ORDERING",
)
_FOUND = ("invariant", "record_id", "message")


def invariant_failures(lines: DataFrame, position: str | None = None, expected_lines: int | None = None, expected_pages: int | None = None) -> DataFrame:
    """``invariant, record_id, message`` of all that a table of lines breaks; of order, the first place in the file only."""
    # Every check reads the lines; they are made once.
    read = ["line_id", "page_id", "line_number", "line_index", "text", "text_clean", *_FLAGS, *([position] if position else [])]
    lines = stored(lines.select(*(F.col(c) for c in dict.fromkeys(read) if c in lines.columns)))
    parts = [text_failures(lines), duplicate_ids(lines), broken_sequences(lines), count_failures(lines, expected_lines, expected_pages)]
    if position:
        parts.append(order_violations(lines, position).orderBy("position").limit(1).select(*_FOUND))
    return reduce(DataFrame.unionByName, parts)


def summarize(failures: DataFrame, shown: int = 20) -> tuple[bool, list[str]]:
    """Whether nothing failed, and the first failures with how many more there are."""
    n = failures.count()
    said = [f"[{i}] {r}: {m}" for i, r, m in failures.orderBy("invariant", "record_id").limit(shown).collect()]
    return n == 0, said + ([f"... and {n - shown} more"] if n > shown else [])


def shown_first(rows: DataFrame, text: Column, shown: int = 5) -> list[str]:
    """The first rows as text, and how many more there are."""
    said = [r[0] for r in rows.select(text.alias("text")).orderBy("text").limit(shown).collect()]
    more = rows.count() - shown if len(said) == shown else 0
    return said + ([f"... and {more} more"] if more > 0 else [])


def verify_invariants(lines: DataFrame, position: str, expected_lines: int | None = None, expected_pages: int | None = None, shown: int = 20) -> dict:
    """A report of all checks of a table: whether it passed, how many ran, the first failures and how many there are."""
    failures = invariant_failures(lines, position, expected_lines, expected_pages).cache()
    skipped = {"RECORD_COUNT": expected_lines, "PAGE_COUNT": expected_pages}
    n = failures.count()
    first = [r.asDict() for r in failures.orderBy("invariant", "record_id", "message").limit(shown).collect()]
    report = {"passed": n == 0, "total_records": lines.count(), "checks_run": sum(skipped.get(c, 0) is not None for c in CHECKS), "n_failures": n, "failures": first}
    failures.unpersist()
    return report


def report_errors(report: dict, required: list[str] = REPORT_FIELDS) -> list[str]:
    missing = [f for f in required if f not in report]
    errors = [f"the build report lacks {', '.join(missing)}"] if missing else []
    return errors + (["the build report names no text_clean_policy"] if report.get("text_clean_policy") is None else [])


def reconcile(lines: DataFrame, report: dict) -> dict[str, bool]:
    """Whether a report's totals are those of the table."""
    got = lines.agg(F.count("*").alias("total_lines"), F.sum("char_count").alias("total_characters"), F.sum("word_count").alias("total_words"), F.count_distinct("page_id").alias("pages_with_lines")).first().asDict()
    return {k: got[k] == report[k] for k in got if k in report}
