"""Queries that align several transcriptions: turns of ``conversations`` as lines, changed to make sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import mismatch as X
from .registry import query, table

# One expression for both engines: each source's condition and text.
_SOURCES = {
    "zl": ("conv_id % 11 <> 0", "text"),
    "it": ("conv_id % 13 <> 0", "case when conv_id % 5 = 0 then concat(text, '?') when (conv_id + turn) % 7 = 0 then translate(text, 'e', 'a') when (conv_id + turn) % 9 = 0 then concat('{x}', text, '[a:b]') else text end"),
    "cd": ("conv_id % 3 = 0", "upper(text)"),
    "fg": ("turn % 2 = 0", "lower(text)"),
    "gc": ("true", "concat(text, '.')"),
}
# Lines that come again later in their file: the last one counts.
_AGAIN, LATER = "conv_id % 4 = 0", 1000
SOURCES = "sources AS (" + " UNION ALL ".join(f"SELECT 'f' || conv_id || 'r:' || turn AS line_id, '{s}' AS source_id, turn AS line_no, {t} AS text FROM conversations WHERE {w}" for s, (w, t) in _SOURCES.items()) + f" UNION ALL SELECT 'f' || conv_id || 'r:' || turn, 'fg', turn + {LATER}, concat(text, ' again') FROM conversations WHERE {_AGAIN})"
ALIGNED = SOURCES + ", aligned AS (SELECT line_id, " + ", ".join(f"arg_max(text, line_no) FILTER (source_id = '{s}') AS {s}_text" for s in _SOURCES) + " FROM sources GROUP BY line_id)"
NORM = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate({0}, '?!*', ''), '<[^>]*>', '', 'g'), '\{{[^}}]*\}}', '', 'g'), '\[[^\]]*\]', '', 'g'), '\s+', ' ', 'g'))"
STATUS = f"""CASE WHEN zl_text IS NULL AND it_text IS NULL THEN 'both_missing' WHEN zl_text IS NULL THEN 'zl_missing' WHEN it_text IS NULL THEN 'it_missing' WHEN zl_text = it_text THEN 'exact_match' WHEN {NORM.format('zl_text')} = {NORM.format('it_text')} THEN 'normalized_match' ELSE 'to_compare' END"""


def source_lines(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    each = F.array(
        *(F.when(F.expr(w), F.struct(F.lit(s).alias("source_id"), F.col("turn").cast("long").alias("line_no"), F.expr(t).alias("text"))) for s, (w, t) in _SOURCES.items()),
        F.when(F.expr(_AGAIN), F.struct(F.lit("fg").alias("source_id"), (F.col("turn") + LATER).cast("long").alias("line_no"), F.expr("concat(text, ' again')").alias("text"))),
    )
    line = F.concat(F.lit("f"), "conv_id", F.lit("r:"), "turn")
    return turns.select(line.alias("line_id"), F.explode(F.filter(each, lambda x: x.isNotNull())).alias("x")).select("line_id", "x.*")


@query(f"WITH {ALIGNED} SELECT line_id, {STATUS} AS status FROM aligned")
def mismatch_status(spark, sf_dir):
    aligned = X.align(source_lines(spark, sf_dir))
    return aligned.select("line_id", F.coalesce(X.cheap_status(F.col("zl_text"), F.col("it_text")), F.lit("to_compare")).alias("status"))


@query(f"""WITH {ALIGNED}, s AS (SELECT *, {STATUS} AS status FROM aligned) SELECT count(*) AS total_lines, count(*) FILTER (status = 'exact_match') AS exact_matches, count(*) FILTER (status = 'normalized_match') AS normalized_matches,
 count(*) FILTER (status = 'zl_missing') AS it_only_lines, count(*) FILTER (status = 'it_missing') AS zl_only_lines, count(*) FILTER (coalesce(zl_text, '') <> '' AND coalesce(it_text, '') <> '') AS both_eva_present, count(*) FILTER (status = 'to_compare') AS compared FROM s""")
def mismatch_stats(spark, sf_dir):
    got = X.statistics(X.compare(X.align(source_lines(spark, sf_dir))))
    return got.select("total_lines", "exact_matches", "normalized_matches", "it_only_lines", "zl_only_lines", "both_eva_present", (F.col("high_similarity_matches") + F.col("content_mismatches")).alias("compared"))


@query(f"""WITH {ALIGNED} SELECT line_id, regexp_extract(line_id, '^([^:]*):', 1) AS page_id, CAST(regexp_extract(line_id, ':([0-9]+)$', 1) AS INT) AS line_number,
 concat_ws(',', CASE WHEN zl_text IS NOT NULL THEN 'zl' END, CASE WHEN it_text IS NOT NULL THEN 'it' END, CASE WHEN cd_text IS NOT NULL THEN 'cd' END, CASE WHEN fg_text IS NOT NULL THEN 'fg' END, CASE WHEN gc_text IS NOT NULL THEN 'gc' END) AS present,
 concat_ws(',', CASE WHEN zl_text IS NULL THEN 'zl' END, CASE WHEN it_text IS NULL THEN 'it' END, CASE WHEN cd_text IS NULL THEN 'cd' END, CASE WHEN fg_text IS NULL THEN 'fg' END, CASE WHEN gc_text IS NULL THEN 'gc' END) AS missing FROM aligned""")
def sources_present(spark, sf_dir):
    aligned = X.align(source_lines(spark, sf_dir))
    empty = aligned.withColumns({"status": F.lit("exact_match"), "eva_agreement": F.lit(True), "similarity_score": F.lit(1.0)})
    return X.records(empty).select("line_id", "page_id", "line_number", F.array_join("sources_present", ",").alias("present"), F.array_join("sources_missing", ",").alias("missing"))


@query(f"WITH {SOURCES} SELECT source_id, count(DISTINCT line_id) AS n_lines FROM sources GROUP BY 1")
def source_line_counts(spark, sf_dir):
    return X.source_counts(source_lines(spark, sf_dir))


@query(f"WITH {SOURCES} SELECT DISTINCT line_id FROM sources")
def line_id_union(spark, sf_dir):
    """The ids of all sources."""
    return X.line_ids(source_lines(spark, sf_dir))


@query(f"WITH {ALIGNED} SELECT line_id FROM aligned WHERE contains(coalesce(zl_text, ''), 'th') AND contains(coalesce(it_text, ''), 'th')")
def pattern_in_both(spark, sf_dir):
    aligned = X.align(source_lines(spark, sf_dir))
    return aligned.where(T.contains_in_both(F.col("zl_text"), F.col("it_text"), "th")).select("line_id")


@query(f"WITH {ALIGNED} SELECT d.doc_id, count(*) AS n_lines FROM aligned JOIN documents d ON d.doc_id = CAST(regexp_extract(line_id, '^f([0-9]+)r', 1) AS BIGINT) GROUP BY 1")
def mismatch_join_pages(spark, sf_dir):
    aligned = X.align(source_lines(spark, sf_dir)).select(F.regexp_extract("line_id", "^f([0-9]+)r", 1).cast("long").alias("doc_id"))
    return aligned.groupBy("doc_id").agg(F.count("*").alias("n_lines")).join(table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", "n_lines")


# One text and the same with a letter more: what they share is the shorter one, so their similarity has a formula.
# Beyond 200 characters the similarity leaves frequent characters out.
PREFIXED = f"""{ALIGNED}, p AS (SELECT *, length({NORM.format('zl_text')}) AS n FROM aligned WHERE zl_text IS NULL OR (length({NORM.format('zl_text')}) BETWEEN 1 AND 198 AND {NORM.format('gc_text')} = {NORM.format('zl_text')} || '.')),
 scored AS (SELECT *, CASE WHEN zl_text IS NULL THEN 'zl_missing' WHEN 2 * n / (2 * n + 1) >= 0.95 THEN 'high_similarity' ELSE 'content_mismatch' END AS status, CASE WHEN zl_text IS NOT NULL THEN 2 * n / (2 * n + 1) END AS score FROM p)"""


def prefixed(spark, sf_dir) -> DataFrame:
    """Lines whose texts in two sources differ by a full stop at the end, or that the first one lacks, compared."""
    zl, gc = T.normalize_for_comparison(F.col("zl_text")), T.normalize_for_comparison(F.col("gc_text"))
    rows = X.align(source_lines(spark, sf_dir))
    return X.compare(rows.where(F.col("zl_text").isNull() | (F.char_length(zl).between(1, 198) & (gc == F.concat(zl, F.lit("."))))), "zl", "gc")


@query(f"WITH {PREFIXED} SELECT line_id, status, CASE status WHEN 'high_similarity' THEN true WHEN 'content_mismatch' THEN false END AS eva_agreement, round(score, 6) AS similarity_score FROM scored ORDER BY line_id")
def similarity_scores(spark, sf_dir):
    rows = X.records(prefixed(spark, sf_dir)).orderBy("line_id")
    return rows.select("line_id", "status", "eva_agreement", F.round("similarity_score", 6).alias("similarity_score"))


@query(f"""WITH {PREFIXED} SELECT count(*) AS total_lines, count(*) FILTER (status = 'high_similarity') AS high_similarity_matches, count(*) FILTER (status = 'content_mismatch') AS content_mismatches, count(*) FILTER (zl_text <> '' AND gc_text <> '') AS both_eva_present,
 round(count(*) FILTER (status = 'high_similarity') / count(*) FILTER (zl_text <> '' AND gc_text <> ''), 6) AS agreement_rate, printf('%.1f%%', 100.0 * count(*) FILTER (status = 'high_similarity') / count(*) FILTER (zl_text <> '' AND gc_text <> '')) AS agreement_shown FROM scored""")
def agreement_rate(spark, sf_dir):
    got = X.statistics(prefixed(spark, sf_dir), "zl", "gc")
    return got.select("total_lines", "high_similarity_matches", "content_mismatches", "both_eva_present", F.round("agreement_rate", 6).alias("agreement_rate"), "agreement_shown")


@query()
def similarity_ratio(spark, sf_dir):
    """The similarity of sequences has no SQL form."""
    return X.compare(X.align(source_lines(spark, sf_dir))).where("status in ('high_similarity', 'content_mismatch')").select("line_id", "status", "eva_agreement", "similarity_score")


@query()
def mismatch_records(spark, sf_dir):
    """Whole records; their scores have no SQL form."""
    return X.records(X.compare(X.align(source_lines(spark, sf_dir))))


_BOUNDED = f"""{ALIGNED}, t AS (SELECT *, {STATUS} AS status, {NORM.format('zl_text')} AS a, {NORM.format('it_text')} AS b FROM aligned),
 h AS (SELECT line_id, a, b, length(a) AS n, length(b) AS m FROM t WHERE status = 'to_compare'),
 c AS (SELECT line_id, least(length(a) - length(replace(a, c, '')), length(b) - length(replace(b, c, ''))) AS k FROM (SELECT DISTINCT line_id, a, b, unnest(string_split(a, '')) AS c FROM h) WHERE c <> ''),
 bounds AS (SELECT line_id, CASE WHEN n > 0 AND m > 0 THEN 2 * least(n, m) / (n + m) ELSE 0.0 END AS by_length, CASE WHEN n > 0 AND m > 0 THEN 2 * coalesce(k, 0) / (n + m) ELSE 0.0 END AS by_letters FROM h LEFT JOIN (SELECT line_id, sum(k) AS k FROM c GROUP BY 1) USING (line_id))"""


@query(f"WITH {_BOUNDED} SELECT line_id, round(by_length, 6) AS by_length, round(by_letters, 6) AS by_letters FROM bounds")
def similarity_bounds(spark, sf_dir):
    """What the similarity of each line that has to be compared cannot exceed."""
    rows = X.align(source_lines(spark, sf_dir)).where(X.cheap_status(F.col("zl_text"), F.col("it_text")).isNull())
    bounds = X.ratio_bounds(T.normalize_for_comparison(F.col("zl_text")), T.normalize_for_comparison(F.col("it_text")))
    return rows.select("line_id", bounds.alias("x")).select("line_id", F.round("x.by_length", 6).alias("by_length"), F.round("x.by_letters", 6).alias("by_letters"))


@query(f"""WITH {_BOUNDED}, s AS (SELECT count(*) FILTER (status IN ('exact_match', 'normalized_match')) AS sure, count(*) FILTER (coalesce(zl_text, '') <> '' AND coalesce(it_text, '') <> '') AS both_present FROM t)
 SELECT both_present, sure / both_present AS rate_at_least, (sure + (SELECT count(*) FROM bounds WHERE by_length >= 0.95 AND by_letters >= 0.95)) / both_present AS rate_at_most FROM s""")
def agreement_range(spark, sf_dir):
    """Between what the agreement of all lines lies, by what needs no matching; ``agreement_of_all_lines`` lies in it."""
    rows = X.align(source_lines(spark, sf_dir))
    a, b = T.normalize_for_comparison(F.col("zl_text")), T.normalize_for_comparison(F.col("it_text"))
    status, bounds = X.cheap_status(F.col("zl_text"), F.col("it_text")), X.ratio_bounds(a, b)
    told = rows.select("zl_text", "it_text", status.alias("status"), F.when(status.isNull(), bounds).alias("x"))
    sure, there = F.count_if(F.col("status").isin("exact_match", "normalized_match")), F.count_if((F.coalesce("zl_text", F.lit("")) != "") & (F.coalesce("it_text", F.lit("")) != ""))
    near = F.count_if((F.col("x.by_length") >= X.HIGH) & (F.col("x.by_letters") >= X.HIGH))
    return told.agg(there.alias("both_present"), (sure / there).alias("rate_at_least"), ((sure + near) / there).alias("rate_at_most"))


@query()
def agreement_of_all_lines(spark, sf_dir):
    """Counts of statuses over all lines and their agreement; matching has no SQL form."""
    return X.statistics(X.verdicts(X.align(source_lines(spark, sf_dir))))
