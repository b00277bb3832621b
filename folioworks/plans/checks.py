"""Queries that look for broken rules, in the synthetic transcription and in JSON made of ``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import charset
from ..functions import text as T
from ..operators import lines as L
from ..operators import quality as Q
from ..operators import verification as V
from ..sources import ivtff
from ..streaming.lines import windowed_counts
from . import transcription as P
from .registry import query, table

# Rows with defects planted by key; one expression for both engines.
_BROKEN = {
    "page_id": "case when turn % 10 = 9 then 'bad' else concat('f', cast(conv_id % 116 + 1 as string), 'r') end",
    "line_number": "case when conv_id % 17 = 0 then 0 else turn + 1 end",
    "line_type": "case when conv_id % 19 = 0 then 'other type' when conv_id % 2 = 0 then 'label' else 'paragraph' end",
    "score": "case when conv_id % 23 = 0 then 2 else 1 end",
}
_JSON = """concat('{"page_id":"', page_id, '","line_number":', cast(line_number as string), ',"line_index":', cast(turn + 1 as string), ',"line_id":"', page_id, ':', cast(line_number as string), '","text":', case when conv_id % 29 = 0 then 'null' else '"x"' end, case when conv_id % 31 = 0 then '' else ',"source":"s"' end, ',"line_type":"', line_type, '","position":', case when turn % 4 = 0 then 'null' else '"@"' end, ',"char_count":', case when conv_id % 37 = 0 then '-1' when conv_id % 41 = 0 then '"7"' else '7' end, '}')"""
RECORDS = "broken AS (SELECT conv_id, turn, " + ", ".join(f"{e} AS {c}" for c, e in _BROKEN.items()) + f" FROM conversations), records AS (SELECT conv_id, turn, page_id, line_number, line_type, {_JSON} AS json, conv_id || ':' || turn AS id FROM broken)"


def records(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", *(F.expr(e).alias(c) for c, e in _BROKEN.items()))
    return rows.select("*", F.expr(_JSON).alias("json"), F.concat_ws(":", "conv_id", "turn").alias("id"))


@query(f"""WITH {RECORDS} SELECT id AS record_id, 'page_id' AS path, 'pattern' AS rule FROM records WHERE page_id = 'bad' UNION ALL SELECT id, 'line_id', 'pattern' FROM records WHERE page_id = 'bad' UNION ALL SELECT id, 'line_number', 'minimum' FROM records WHERE line_number < 1
 UNION ALL SELECT id, 'text', 'type' FROM records WHERE conv_id % 29 = 0 UNION ALL SELECT id, '', 'required:source' FROM records WHERE conv_id % 31 = 0 UNION ALL SELECT id, 'line_type', 'enum' FROM records WHERE line_type = 'other type'
 UNION ALL SELECT id, 'position', 'type' FROM records WHERE turn % 4 = 0 UNION ALL SELECT id, 'position', 'enum' FROM records WHERE turn % 4 = 0 UNION ALL SELECT id, 'char_count', 'minimum' FROM records WHERE conv_id % 37 = 0 UNION ALL SELECT id, 'char_count', 'type' FROM records WHERE conv_id % 41 = 0 AND conv_id % 37 <> 0""")
def schema_violations(spark, sf_dir):
    return Q.schema_violations(records(spark, sf_dir), Q.LINES_SCHEMA, "id")


@query(f"WITH {RECORDS} SELECT id, 'text_clean,has_uncertain,has_illegible,has_alternatives,has_high_ascii' || CASE WHEN conv_id % 31 = 0 THEN ',source' ELSE '' END || ',source_version' AS missing FROM records")
def missing_fields(spark, sf_dir):
    return Q.missing_fields(records(spark, sf_dir)).select("id", F.array_join("missing", ",").alias("missing"))


# A table of lines in which some cells are wrong.
BROKEN_LINES = f"""{P.LINES}, damaged AS (SELECT * REPLACE (CASE WHEN hash_ % 101 = 0 THEN text_clean || '<' WHEN hash_ % 103 = 0 THEN text_clean || '?' WHEN hash_ % 107 = 0 THEN text_clean || 'W' ELSE text_clean END AS text_clean, CASE WHEN hash_ % 109 = 0 THEN NOT has_uncertain ELSE has_uncertain END AS has_uncertain,
 CASE WHEN hash_ % 113 = 0 THEN NOT has_illegible ELSE has_illegible END AS has_illegible, CASE WHEN hash_ % 127 = 0 THEN 'x' || line_id ELSE line_id END AS line_id, CASE WHEN hash_ % 131 = 0 THEN line_index + 1 ELSE line_index END AS line_index, CASE WHEN hash_ % 137 = 0 THEN NOT has_high_ascii ELSE has_high_ascii END AS has_high_ascii)
 FROM (SELECT *, CAST(substr(file, 2) AS BIGINT) * 7 + line_number * 3 + length(text) AS hash_ FROM lines))"""


def damaged_lines(spark, sf_dir):
    """Lines of the synthetic transcription, with their file, in which some cells are wrong."""
    loci = ivtff.loci(P.transcript(spark, sf_dir), comments=False, with_page=True)
    raw, stripped = F.col("text"), F.col("stripped")
    checked = charset.checked_text(F.col("text_clean"))
    sound = loci.withColumn("stripped", T.strip_markup(raw)).withColumn("text_clean", T.clean_of_stripped(stripped)).select(
        "file", "page_id", F.col("locus_number").alias("line_number"), F.col("line_index").cast("long").alias("line_index"), F.concat_ws(":", "page_id", "locus_number").alias("line_id"), "text", "text_clean", charset.letter_count(checked).alias("char_count"), charset.word_count(checked).alias("word_count"),
        F.contains(stripped, F.lit("?")).alias("has_uncertain"), T.marks_illegible(stripped).alias("has_illegible"), T.has_high_codes(raw).alias("has_high_ascii"),
    )
    h = F.substring("file", 2, 20).cast("long") * 7 + F.col("line_number") * 3 + F.char_length("text")
    hit = lambda n: h % n == 0
    return sound.withColumns({
        "text_clean": F.when(hit(101), F.concat("text_clean", F.lit("<"))).when(hit(103), F.concat("text_clean", F.lit("?"))).when(hit(107), F.concat("text_clean", F.lit("W"))).otherwise(F.col("text_clean")),
        "has_uncertain": F.col("has_uncertain") != hit(109),
        "has_illegible": F.col("has_illegible") != hit(113),
        "line_id": F.when(hit(127), F.concat(F.lit("x"), "line_id")).otherwise(F.col("line_id")),
        "line_index": F.when(hit(131), F.col("line_index") + 1).otherwise(F.col("line_index")),
        "has_high_ascii": F.col("has_high_ascii") != hit(137),
    })


@query(f"""WITH {BROKEN_LINES} SELECT invariant, record_id, count(*) AS n FROM (
 SELECT 'TEXT_CLEAN_NO_MARKUP' AS invariant, line_id AS record_id FROM damaged WHERE regexp_matches(text_clean, '[<>{{}}]') UNION ALL SELECT 'TEXT_CLEAN_NO_MARKERS', line_id FROM damaged WHERE regexp_matches(text_clean, '[?!*]') UNION ALL SELECT 'TEXT_CLEAN_CHARSET', line_id FROM damaged WHERE NOT regexp_full_match(text_clean, '[a-vx-z., @;0-9'']*')
 UNION ALL SELECT 'HAS_UNCERTAIN_CONTRACT', line_id FROM damaged WHERE hash_ % 109 = 0 UNION ALL SELECT 'HAS_ILLEGIBLE_CONTRACT', line_id FROM damaged WHERE hash_ % 113 = 0 UNION ALL SELECT 'LINE_ID_FORMAT', line_id FROM damaged WHERE hash_ % 127 = 0 UNION ALL SELECT 'HIGH_ASCII_FLAG', line_id FROM damaged WHERE hash_ % 137 = 0) GROUP BY ALL""")
def invariant_violations(spark, sf_dir):
    return Q.text_failures(damaged_lines(spark, sf_dir)).groupBy("invariant", "record_id").agg(F.count("*").alias("n"))


@query(f"WITH {BROKEN_LINES} SELECT line_id AS record_id, count(*) || ' times' AS message FROM damaged GROUP BY line_id HAVING count(*) > 1")
def dup_line_ids(spark, sf_dir):
    return Q.duplicate_ids(damaged_lines(spark, sf_dir)).select("record_id", "message")


@query(f"""WITH {BROKEN_LINES} SELECT file || '/' || page_id AS record_id, count(*) || ' lines are numbered ' || min(line_index) || ' to ' || max(line_index) AS message FROM damaged GROUP BY file, page_id HAVING min(line_index) <> 1 OR max(line_index) <> count(*) OR count(DISTINCT line_index) <> count(*)""")
def broken_sequences(spark, sf_dir):
    rows = damaged_lines(spark, sf_dir).withColumn("page_id", F.concat_ws("/", "file", "page_id"))
    return Q.broken_sequences(rows).select("record_id", "message")


STEPS = """k AS (SELECT l_orderkey * 10000000000 + cast(l_linenumber as bigint) * 1000000000 + l_partkey * 1000 + l_suppkey % 1000 AS place, 'f' || (l_partkey % 120) || 'r:' || l_linenumber AS line_id, l_partkey % 120 AS num, l_linenumber AS idx FROM lineitem),
 o AS (SELECT *, lag(num) OVER w AS pn, lag(idx) OVER w AS p_idx FROM k WINDOW w AS (ORDER BY place))"""


def stepped_lines(spark, sf_dir):
    item = table(spark, sf_dir, "lineitem")
    page = F.concat(F.lit("f"), F.col("l_partkey") % 120, F.lit("r"))
    return item.select(F.expr("l_orderkey * 10000000000 + cast(l_linenumber as bigint) * 1000000000 + l_partkey * 1000 + l_suppkey % 1000").alias("at"), page.alias("page_id"), F.concat_ws(":", page, "l_linenumber").alias("line_id"), F.col("l_linenumber").alias("line_index"))


@query(f"WITH {STEPS} SELECT line_id AS record_id, place AS position FROM o WHERE num < pn OR (num = pn AND idx < p_idx)")
def order_violations(spark, sf_dir):
    return Q.order_violations(stepped_lines(spark, sf_dir), "at", bucket=10**14).select("record_id", "position")


@query(f"""WITH {BROKEN_LINES}, f AS (
 SELECT 'TEXT_CLEAN_NO_MARKUP' AS invariant FROM damaged WHERE regexp_matches(text_clean, '[<>{{}}]') UNION ALL SELECT 'TEXT_CLEAN_NO_MARKERS' FROM damaged WHERE regexp_matches(text_clean, '[?!*]') UNION ALL SELECT 'TEXT_CLEAN_CHARSET' FROM damaged WHERE NOT regexp_full_match(text_clean, '[a-vx-z., @;0-9'']*')
 UNION ALL SELECT 'HAS_UNCERTAIN_CONTRACT' FROM damaged WHERE hash_ % 109 = 0 UNION ALL SELECT 'HAS_ILLEGIBLE_CONTRACT' FROM damaged WHERE hash_ % 113 = 0 UNION ALL SELECT 'LINE_ID_FORMAT' FROM damaged WHERE hash_ % 127 = 0 UNION ALL SELECT 'HIGH_ASCII_FLAG' FROM damaged WHERE hash_ % 137 = 0
 UNION ALL SELECT 'HIGH_ASCII_PRESERVED' FROM damaged WHERE regexp_full_match(trim(text), '(@[0-9]+;)+') AND text_clean = ''
 UNION ALL SELECT 'LINE_ID_UNIQUE' FROM damaged GROUP BY line_id HAVING count(*) > 1 UNION ALL SELECT 'LINE_INDEX_SEQUENTIAL' FROM damaged GROUP BY page_id HAVING min(line_index) <> 1 OR max(line_index) <> count(*) OR count(DISTINCT line_index) <> count(*)
 UNION ALL SELECT 'RECORD_COUNT' UNION ALL SELECT 'PAGE_COUNT') SELECT invariant, count(*) AS n FROM f GROUP BY 1""")
def invariant_counts(spark, sf_dir):
    """All rules over the damaged lines; the expected counts are wrong on purpose."""
    return Q.invariant_failures(damaged_lines(spark, sf_dir), None, 5, 5).groupBy("invariant").agg(F.count("*").alias("n"))


@query("SELECT s_suppkey || '' AS record_id, 'clean text has lost its codes' AS message FROM supplier WHERE s_nationkey % 3 = 0")
def codes_lost(spark, sf_dir):
    """Lines of codes alone, of which some have lost them; the clean text of the others keeps them."""
    rows = table(spark, sf_dir, "supplier").selectExpr("cast(s_suppkey as string) AS line_id", "' @140;@152; ' AS text", "case when s_nationkey % 3 = 0 then '' else '@140;@152;' end AS text_clean", "'f1r' AS page_id", "1 AS line_number", "false AS has_illegible", "false AS has_uncertain", "true AS has_high_ascii")
    return Q.text_failures(rows).where("invariant = 'HIGH_ASCII_PRESERVED'").select("record_id", "message")


@query(f"WITH {STEPS} SELECT 'ORDERING' AS invariant, line_id AS record_id, 'comes before the line before it' AS message FROM o WHERE num < pn OR (num = pn AND idx < p_idx) ORDER BY place LIMIT 1")
def first_out_of_order(spark, sf_dir):
    """The one place that a verification reports: the first in the file."""
    lines = stepped_lines(spark, sf_dir).selectExpr("*", "'' AS text", "'' AS text_clean", "0 AS line_number", "false AS has_illegible", "false AS has_uncertain", "false AS has_high_ascii")
    return Q.invariant_failures(lines, "at").where("invariant = 'ORDERING'")


@query(f"WITH {P.LINES} SELECT 'RECORD_COUNT' AS invariant, count(*) || ', not 5' AS message FROM lines UNION ALL SELECT 'PAGE_COUNT', count(DISTINCT page_id) || ', not 5' FROM lines")
def count_failures(spark, sf_dir):
    return Q.count_failures(P.line_rows(spark, sf_dir), 5, 5).select("invariant", "message")


@query(f"""WITH {P.LINES} SELECT count(*) >= 4000 AS record_count, bool_and(page_id <> '') AS page_ids, count(DISTINCT line_id) = count(*) AS unique_line_ids, 100 * count(*) FILTER (char_count > 0) >= 95 * count(*) AS characters, count(DISTINCT page_id) > 200 AS pages, count(DISTINCT currier_language) >= 2 AS languages, count(DISTINCT line_type) >= 2 AS line_types, bool_and(line_id <> '') AS line_ids, false AS no_errors, count(*) > 0 AS fields FROM lines""")
def smoke_checks(spark, sf_dir):
    got = L.smoke_checks(P.line_rows(spark, sf_dir), {"errors": ["one"]})
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in got.items()))


@query(f"WITH {P.LINES}, s AS (SELECT count(*) AS n, CAST(sum(char_count) AS BIGINT) AS c, CAST(sum(word_count) AS BIGINT) AS w, count(DISTINCT page_id) AS p FROM lines) SELECT true AS total_lines, true AS total_characters, w = 1 AS total_words, p = 0 AS pages_with_lines FROM s")
def report_reconciled(spark, sf_dir):
    """A report with two right totals and two wrong ones against its table."""
    rows = P.line_rows(spark, sf_dir)
    sums = rows.agg(F.count("*").alias("total_lines"), F.sum("char_count").alias("total_characters")).first().asDict()
    got = Q.reconcile(rows, sums | {"total_words": 1, "pages_with_lines": 0})
    return spark.createDataFrame([got], ", ".join(f"{k} boolean" for k in got))


@query("""SELECT count(*) AS n, count(*) FILTER (trim(text) = '') AS blank, count(*) - count(DISTINCT doc_id) AS duplicate_ids, count(*) FILTER (contains(text, '?')) AS uncertain, count(*) FILTER (regexp_matches(text, '[!*]')) AS illegible, count(*) FILTER (n_chars = 0) AS no_chars FROM documents""")
def data_quality_counters(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").agg(
        F.count("*").alias("n"), F.count_if(F.trim(t) == "").alias("blank"), (F.count("*") - F.count_distinct("doc_id")).alias("duplicate_ids"), F.count_if(F.contains(t, F.lit("?"))).alias("uncertain"), F.count_if(t.rlike("[!*]")).alias("illegible"), F.count_if(F.expr("n_chars = 0")).alias("no_chars")
    )


_PROFILE = "concat('#=IVTFF Eva- 2.0', chr(10), case when s_suppkey % 7 = 0 then '' else concat('<f', cast(s_suppkey as string), 'r>') end, chr(10), case when s_suppkey % 11 = 0 then '<' else '<f' end, cast(s_suppkey as string), 'r.P.1;', case when s_nationkey % 2 = 0 then 'H' else 'T' end, '> ', lower(s_name), chr(10), case when s_nationkey % 3 = 0 then '<f1v.P.2;C> daiin' else '' end)"


@query(f"""WITH t AS (SELECT s_suppkey, {_PROFILE} AS v FROM supplier), c AS (SELECT s_suppkey, v, list_sort(list_distinct(list_filter(string_split(regexp_replace(lower(array_to_string(regexp_extract_all(v, '<f[0-9]+[rv][0-9]*\\.\\w+\\.[0-9]+[;\\w]*>\\s*([^<]+)', 1), ' ')), '[.\\-=,\\s\\[\\]{{}}!?*@0-9<>]', '', 'g'), ''), lambda x: x <> ''))) AS found FROM t)
 SELECT s_suppkey, sha256(v) AS sha256, len(list_distinct(regexp_extract_all(v, '<f[0-9]+[rv][0-9]*>'))) AS page_count, len(regexp_extract_all(v, '<f[0-9]+[rv][0-9]*\\.\\w+\\.[0-9]+[;\\w]*>')) AS line_count, array_to_string(list_sort(list_distinct(regexp_extract_all(v, ';([A-Z])>', 1))), '') AS transcribers,
 array_to_string(list_filter(found, lambda x: regexp_matches(x, '[a-vx-z]')), '') AS known, array_to_string(list_filter(found, lambda x: NOT regexp_matches(x, '[a-vx-z]')), '') AS unknown,
 concat_ws(',', CASE WHEN NOT regexp_matches(v, '<f[0-9]+[rv][0-9]*>') THEN 'no page header is found' END, CASE WHEN NOT regexp_matches(v, '<f[0-9]+[rv][0-9]*\\.\\w+\\.[0-9]+[;\\w]*>') THEN 'no line locator is found' END) AS errors, true AS looks_like_ivtff FROM c""")
def source_profile(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.expr(_PROFILE).alias("value"))
    got = V.profile(rows, "s_suppkey")
    return got.select(F.col("file").alias("s_suppkey"), "sha256", F.col("structure.page_count").cast("long").alias("page_count"), F.col("structure.line_count").cast("long").alias("line_count"), F.array_join("transcribers", "").alias("transcribers"), F.array_join("characters.known", "").alias("known"), F.array_join("characters.unknown", "").alias("unknown"), F.array_join("errors", ",").alias("errors"), "looks_like_ivtff")


@query("SELECT page_id, contains(lower(html), 'article') OR contains(lower(html), 'concordance') AS listed FROM pages")
def keyword_checks(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", V.mentions(F.col("html"), "article", "concordance").alias("listed"))


@query("SELECT time_bucket(INTERVAL 1 hour, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark, sf_dir):
    rows = windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type", value="value")
    return rows.select("start", "event_type", "n", F.round("total", 4).alias("total"))
