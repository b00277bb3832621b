"""Queries over a synthetic transcription: orders are pages, line items are loci, customers are files.

Some files hold blank lines, several format headers, loci before any page, loci
that name another page, and lines of no known kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import charset, ids
from ..functions import text as T
from ..operators import lines as L
from ..operators import metadata as M
from ..operators import stats as S
from ..sources import ivtff, sinks
from .registry import query, table

# One expression for both engines: the page's id, its header, a comment, and a locus.
_PAGE = "concat('f', cast(o_orderkey % 117 as string), case when o_orderkey % 2 = 0 then 'r' else 'v' end, case when o_orderkey % 13 = 0 then cast(o_orderkey % 6 + 1 as string) else '' end)"
_PLACE = "o_orderkey * 10000000000 + 2 + cast(l_linenumber as bigint) * 1000000000 + l_partkey * 1000 + l_suppkey % 1000"
_HEADER = f"""concat('<', {_PAGE}, '> <! ', case when o_orderkey % 7 <> 0 then concat('$Q=', chr(cast(65 + o_orderkey % 18 as int)), ' ') else '' end, '$P=', cast(o_orderkey % 9 as string), ' $B=', case when o_orderkey % 10 = 0 then 'x' else cast(o_orderkey % 8 as string) end,
 case when o_orderkey % 5 <> 0 then concat(' $I=', substring('HACBPSTZ', cast(o_orderkey % 8 + 1 as int), 1)) else '' end, case when o_orderkey % 4 <> 0 then concat(' $L=', case when o_orderkey % 3 = 0 then 'A' else 'B' end) else '' end, ' $H=1 $H=', cast(o_orderkey % 5 as string), case when o_orderkey % 3 = 1 then concat(' $F=', chr(cast(97 + o_orderkey % 4 as int)), ' $C=', cast(o_orderkey % 6 as string), ' $X=V') else '' end, '>')"""
_TEXT = """concat('qo', lower(l_returnflag), case l_partkey % 7 when 0 then '.[a:o]l' when 1 then '.d?y' when 2 then '.ch!ol' when 3 then '{note}.sh*y' when 4 then '<->cthy<$>' when 5 then '.@140;.I' else ',daiin' end, '.', case when l_suppkey % 3 = 0 then 'ckhy' else 'okaiin' end)"""
_LOCUS = f"""concat('<', case when l_partkey % 97 = 0 then 'f1r' else {_PAGE} end, '.', cast(l_linenumber as string), ',', substring('@+=*', cast(l_linenumber % 4 + 1 as int), 1), substring('PPPLCR', cast(l_suppkey % 6 + 1 as int), 1), case when l_partkey % 11 = 0 then 'c' else '0' end, ';H>   ', {_TEXT}, ' ')"""


# Lines beside headers and loci, by order: which orders, the place after the order's first, the line.
_OTHERS = [
    ("o_orderkey % 6 = 0", 0, "concat('# order ', cast(o_orderkey as string))"),
    ("o_orderkey % 8 = 0", 2_500_000_000, "concat('#  between ', cast(o_orderkey as string))"),
    ("o_orderkey % 9 = 0", 2, "'   '"),
    ("o_orderkey % 40 = 0", 3, "concat('<f1r.bad> ', cast(o_orderkey as string))"),
    ("o_orderkey % 50 = 0", -1, "concat('#=IVTFF Eva- 2.', cast(o_orderkey % 7 as string), case when o_orderkey % 3 = 0 then '' else ' M 6' end)"),
]
_FIRST = [("true", -3, "'#=IVTFF Eva- 2.0 M 5'"), ("o_custkey % 5 = 0", -2, "'<f9r.1,@P0;H> before.any.page'")]


def transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file, line_no, line`` of the synthetic files."""
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    file = F.concat(F.lit("c"), F.col("o_custkey")).alias("file")
    place = F.col("o_orderkey") * 10_000_000_000

    def lines_by(rows: list, at: Column) -> Column:
        each = F.array(*(F.when(F.expr(which), F.struct((at + after).alias("line_no"), F.expr(line).alias("line"))) for which, after, line in rows))
        # Not filtered as an array: what a lambda's function reads is interpreted, not compiled.
        return F.explode(each).alias("x")

    of_orders = orders.select(file, lines_by([*_OTHERS, ("true", 1, _HEADER)], place)).where("x is not null").select("file", "x.*")
    of_files = orders.select("o_custkey").distinct().select(file, lines_by(_FIRST, F.lit(0).cast("long"))).where("x is not null").select("file", "x.*")
    loci = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(file, F.expr(_PLACE).alias("line_no"), F.expr(_LOCUS).alias("line"))
    return of_orders.union(of_files).union(loci)


TRANSCRIPT = "transcript AS MATERIALIZED (" + " UNION ALL ".join([
    *(f"SELECT 'c' || o_custkey AS file, o_orderkey * 10000000000 + {after} AS line_no, {line} AS line FROM orders WHERE {which}" for which, after, line in [*_OTHERS, ("true", 1, _HEADER)]),
    *(f"SELECT DISTINCT 'c' || o_custkey, CAST({after} AS BIGINT), {line} FROM orders WHERE {which}" for which, after, line in _FIRST),
    f"SELECT 'c' || o_custkey, {_PLACE}, {_LOCUS} FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
]) + ")"
LOCUS = "'^<(f[0-9]+[rv][0-9]*)\\.([0-9]+),([+@=*]?)([PLCR])([0-9]*)(?:;([A-Z]))?>(.*)$'"
PAGE = "'^<(f[0-9]+[rv][0-9]*)>\\s*(.*)$'"
VAR = "nullif(list_last(regexp_extract_all(header, '\\${0}=([^\\s$>]+)', 1)), '')"
PARSED = f"""{TRANSCRIPT},
 kinds AS (SELECT *, regexp_matches(line, {PAGE}) AS is_page, regexp_matches(line, {LOCUS}) AS is_locus FROM transcript),
 placed AS MATERIALIZED (SELECT *, CAST(sum(CAST(is_page AS INT)) OVER (PARTITION BY file ORDER BY line_no) AS BIGINT) AS page_ord FROM kinds),
 heads AS (SELECT file, page_ord, line_no, regexp_extract(line, {PAGE}, 1) AS page_id, regexp_extract(line, {PAGE}, 2) AS header FROM placed WHERE is_page),
 pages_ AS (SELECT file, page_ord, line_no, page_id, {VAR.format('Q')} AS quire, {VAR.format('P')} AS page_in_quire, TRY_CAST({VAR.format('B')} AS INT) AS bifolio, {VAR.format('I')} AS illustration, {VAR.format('L')} AS language, {VAR.format('H')} AS hand, {VAR.format('F')} AS folio, TRY_CAST({VAR.format('C')} AS INT) AS cluster, {VAR.format('X')} AS extraneous FROM heads),
 loci AS (SELECT file, page_ord, line_no, regexp_extract(line, {LOCUS}, 1) AS locus_page_id, CAST(regexp_extract(line, {LOCUS}, 2) AS INT) AS locus_number, nullif(regexp_extract(line, {LOCUS}, 3), '') AS position,
  regexp_extract(line, {LOCUS}, 4) AS locus_type, TRY_CAST(nullif(regexp_extract(line, {LOCUS}, 5), '') AS INT) AS subtype, nullif(regexp_extract(line, {LOCUS}, 6), '') AS transcriber, trim(regexp_extract(line, {LOCUS}, 7)) AS text,
  row_number() OVER (PARTITION BY file, page_ord ORDER BY line_no) AS line_index FROM placed WHERE is_locus AND page_ord > 0)"""


@query(f"WITH {PARSED} SELECT file, page_ord, locus_page_id, locus_number, position, locus_type, subtype, transcriber, text, locus_page_id || ':' || locus_number AS locus_id, CAST(line_index AS BIGINT) AS line_index FROM loci")
def ivtff_parse_lines(spark, sf_dir):
    return locus_rows(transcript(spark, sf_dir))


def locus_rows(lines: DataFrame) -> DataFrame:
    rows = ivtff.loci(lines, comments=False).withColumn("line_index", F.col("line_index").cast("long"))
    return rows.select("file", "page_ord", "locus_page_id", "locus_number", "position", "locus_type", "subtype", "transcriber", "text", "locus_id", "line_index")


@query(f"WITH {PARSED} SELECT file, page_ord, page_id, quire, page_in_quire, bifolio, illustration, language, hand, folio, cluster, extraneous FROM pages_")
def page_variables(spark, sf_dir):
    return variable_rows(transcript(spark, sf_dir))


def variable_rows(lines: DataFrame) -> DataFrame:
    return ivtff.pages(lines, comments=False).select("file", "page_ord", "page_id", *(f"variables.{c}" for c in ("quire", "page_in_quire", "bifolio", "illustration", "language", "hand", "folio", "cluster", "extraneous")))


COMMENTED = f"""{PARSED}, e AS (SELECT *, sum(CAST(is_page OR (is_locus AND page_ord > 0) AS INT)) OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS island FROM placed),
 c AS (SELECT file, island, string_agg(trim(substr(line, 2)), '|' ORDER BY line_no) AS said FROM e WHERE line LIKE '#%' AND line NOT LIKE '#=IVTFF %' GROUP BY ALL)"""


@query(f"WITH {COMMENTED} SELECT file, page_ord, regexp_extract(line, {PAGE}, 1) AS page_id, coalesce(said, '') AS comments FROM e LEFT JOIN c USING (file, island) WHERE is_page")
def page_comments(spark, sf_dir):
    return comment_rows(transcript(spark, sf_dir))


def comment_rows(lines: DataFrame) -> DataFrame:
    return ivtff.pages(lines).select("file", "page_ord", "page_id", F.array_join("comments", "|").alias("comments"))


@query(rf"""WITH {TRANSCRIPT} SELECT file, arg_max(regexp_extract(line, '^#=IVTFF\s+(\S+)', 1), line_no) AS format_version, nullif(arg_max(trim(regexp_extract(line, '^#=IVTFF\s+\S+\s*(.*)$', 1)), line_no), '') AS format_options FROM transcript WHERE line LIKE '#=IVTFF %' GROUP BY file""")
def format_headers(spark, sf_dir):
    return ivtff.formats(transcript(spark, sf_dir))


@query(f"WITH {TRANSCRIPT} SELECT CASE WHEN trim(line) = '' THEN 'blank' WHEN line LIKE '#=IVTFF %' THEN 'format' WHEN line LIKE '#%' THEN 'comment' WHEN regexp_matches(line, {PAGE}) THEN 'page' WHEN regexp_matches(line, {LOCUS}) THEN 'locus' ELSE 'other' END AS kind, count(*) AS n FROM transcript GROUP BY 1")
def line_kinds(spark, sf_dir):
    return ivtff.classify(transcript(spark, sf_dir)).groupBy("kind").agg(F.count("*").alias("n"))


@query(f"WITH {PARSED} SELECT file, line_no, CASE WHEN is_locus THEN 'no page' ELSE 'unknown' END AS reason FROM placed WHERE (is_locus AND page_ord = 0) OR NOT (is_locus OR is_page OR line LIKE '#%' OR trim(line) = '')")
def strict_errors(spark, sf_dir):
    return ivtff.strict_errors(transcript(spark, sf_dir)).select("file", "line_no", "reason")


@query(f"""WITH {PARSED} SELECT file, page_ord, line_index, regexp_extract(line, '^(<[^>]*>)', 1) AS raw_locator, 'Locus(' || locus_page_id || ':' || locus_number || ': ' || CASE WHEN length(text) > 30 THEN left(text, 30) || '...' ELSE text END || ')' AS shown
 FROM loci JOIN placed USING (file, page_ord, line_no)""")
def locus_labels(spark, sf_dir):
    rows = ivtff.loci(transcript(spark, sf_dir), comments=False)
    return rows.select("file", "page_ord", F.col("line_index").cast("long").alias("line_index"), "raw_locator", ivtff.shown(F.col("locus_id"), F.col("text")).alias("shown"))


@query(f"WITH {COMMENTED} SELECT file, line_no, said AS comments FROM e JOIN c USING (file, island) WHERE is_locus AND page_ord > 0")
def locus_comments(spark, sf_dir):
    return ivtff.loci(transcript(spark, sf_dir)).where(F.size("comments") > 0).select("file", "line_no", F.array_join("comments", "|").alias("comments"))


@query(f"WITH {TRANSCRIPT} SELECT c, count(*) AS n FROM (SELECT unnest(string_split(trim(regexp_extract(line, '^[^>]*>(.*)$', 1)), '')) AS c FROM transcript WHERE line LIKE '<f%' AND contains(line, '>')) WHERE c <> '' GROUP BY c")
def locator_charset(spark, sf_dir):
    return S.character_counts(ivtff.locator_texts(transcript(spark, sf_dir)), "text").select("c", "n")


SECTION = """CASE illustration WHEN 'H' THEN 'herbal' WHEN 'A' THEN 'astronomical' WHEN 'C' THEN 'cosmological' WHEN 'B' THEN 'biological' WHEN 'P' THEN 'pharmaceutical' WHEN 'S' THEN 'stars' WHEN 'T' THEN 'text_only' WHEN 'Z' THEN 'zodiac' ELSE
  CASE WHEN num <= 66 THEN 'herbal' WHEN num <= 73 THEN 'astronomical' WHEN num <= 84 THEN 'biological' WHEN num <= 86 THEN 'cosmological' WHEN num <= 102 THEN 'pharmaceutical' ELSE 'recipes' END END"""
STRIP = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\{[^}]*\}', '', 'g'), '\[([^:\]]*):([^\]]*)\]', '\1', 'g'), '<[^>]*>', '', 'g'), '\s+', ' ', 'g'))"
CHECKED = r"regexp_replace(clean, '@[0-9]+;', '', 'g')"
LINES = f"""{PARSED},
 stripped AS (SELECT l.*, p.page_id, quire, language, hand, illustration, CAST(regexp_extract(p.page_id, '^f([0-9]+)', 1) AS INT) AS num, {STRIP} AS s FROM loci l JOIN pages_ p USING (file, page_ord)),
 cleaned AS (SELECT *, trim(replace(translate(s, '?!*', ''), 'I', 'i')) AS clean FROM stripped),
 lines AS MATERIALIZED (SELECT file, page_id, locus_number AS line_number, line_index, page_id || ':' || locus_number AS line_id, text, clean AS text_clean, CASE locus_type WHEN 'P' THEN 'paragraph' WHEN 'L' THEN 'label' WHEN 'C' THEN 'circle' WHEN 'R' THEN 'radius' ELSE 'unknown' END AS line_type,
  position, quire, {SECTION} AS section, language AS currier_language, hand, illustration AS illustration_type, CAST(length(regexp_replace(lower({CHECKED}), '[^a-vx-z]', '', 'g')) AS BIGINT) AS char_count,
  CAST(len(list_filter(regexp_split_to_array({CHECKED}, '[.,\\s]+'), lambda x: x <> '')) AS BIGINT) AS word_count, contains(s, '?') AS has_uncertain, regexp_matches(s, '[!*]') AS has_illegible, contains(text, '[') AND contains(text, ':') AS has_alternatives, regexp_matches(text, '@[0-9]+;') AS has_high_ascii FROM cleaned)"""


def line_rows(spark, sf_dir) -> DataFrame:
    return L.line_table(transcript(spark, sf_dir), "synthetic", "v1")


@query(f"WITH {LINES} SELECT * EXCLUDE (file) REPLACE (CAST(line_index AS BIGINT) AS line_index), 'synthetic' AS source, 'v1' AS source_version FROM lines")
def line_table(spark, sf_dir):
    return line_rows(spark, sf_dir).withColumn("line_index", F.col("line_index").cast("long"))


@query(f"WITH {LINES} SELECT line_id, line_index, row_number() OVER (ORDER BY CAST(regexp_extract(page_id, '^f([0-9]+)', 1) AS INT), CASE WHEN contains(page_id, 'v') THEN 1 ELSE 0 END, coalesce(TRY_CAST(nullif(regexp_extract(page_id, '[rv]([0-9]*)$', 1), '') AS INT), 0), line_index, line_id, text, file) AS place FROM lines ORDER BY place LIMIT 200")
def reading_order_first(spark, sf_dir):
    rows = L.line_table(transcript(spark, sf_dir)).select("line_id", F.col("line_index").cast("long").alias("line_index"), "text", ids.reading_order(F.col("page_id"), F.col("line_index")).alias("key"))
    first = rows.orderBy("key", "line_id", "text").limit(200)
    return first.select("line_id", "line_index", F.row_number().over(S.Window.partitionBy(F.lit(1)).orderBy("key", "line_id", "text")).cast("long").alias("place"))


@query(f"WITH {LINES} SELECT line_id, line_index, row_number() OVER (ORDER BY CAST(regexp_extract(page_id, '^f([0-9]+)', 1) AS INT), CASE WHEN contains(page_id, 'v') THEN 1 ELSE 0 END, coalesce(TRY_CAST(nullif(regexp_extract(page_id, '[rv]([0-9]*)$', 1), '') AS INT), 0), line_index, line_id, text, file) AS place FROM lines")
def reading_order(spark, sf_dir):
    rows = L.line_table(transcript(spark, sf_dir)).select("page_id", "line_id", F.col("line_index").cast("long").alias("line_index"), "text")
    return L.with_places(rows, "line_id", "text").select("line_id", "line_index", "place")


@query(f"""WITH {LINES}, u AS (SELECT DISTINCT file, page_ord FROM loci)
 SELECT count(*) AS total_lines, CAST(sum(char_count) AS BIGINT) AS total_characters, CAST(sum(word_count) AS BIGINT) AS total_words, count(*) FILTER (has_high_ascii) AS lines_with_high_ascii,
 (SELECT count(*) FROM pages_) AS total_pages, (SELECT count(*) FROM u) AS pages_with_lines, (SELECT count(*) FROM pages_) - (SELECT count(*) FROM u) AS pages_without_lines FROM lines""")
def build_lines_report(spark, sf_dir):
    sums = line_rows(spark, sf_dir).agg(F.count("*").alias("total_lines"), F.sum("char_count").alias("total_characters"), F.sum("word_count").alias("total_words"), F.count_if("has_high_ascii").alias("lines_with_high_ascii"))
    # A page has lines if any locus was counted on it.
    pages = ivtff.pages_with_counts(transcript(spark, sf_dir)).agg(F.count("*").alias("total_pages"), F.count_if(F.expr("n_loci > 0")).alias("pages_with_lines"), F.count_if(F.expr("n_loci = 0")).alias("pages_without_lines"))
    return sums.crossJoin(F.broadcast(pages))


@query(f"WITH {LINES} SELECT line_type, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM lines), 6) AS pct FROM lines GROUP BY 1")
def lines_by_type(spark, sf_dir):
    return S.shares(S.counts(line_rows(spark, sf_dir), "line_type")).withColumn("pct", F.round("pct", 6))


@query(f"""WITH {PARSED}, p AS (SELECT *, CAST(regexp_extract(page_id, '^f([0-9]+)', 1) AS INT) AS num FROM pages_)
 SELECT 'language' AS kind, coalesce(language, 'unknown') AS key, count(*) AS n_pages FROM p GROUP BY 2 UNION ALL SELECT 'section', {SECTION}, count(*) FROM p GROUP BY 2 UNION ALL SELECT 'hand', coalesce(hand, 'unknown'), count(*) FROM p GROUP BY 2""")
def pages_by_attribute(spark, sf_dir):
    heads = ivtff.pages(transcript(spark, sf_dir), comments=False)
    section = ids.section_of_page(F.col("page_id"), F.col("variables.illustration"))
    pairs = F.array(*(F.struct(F.lit(k).alias("kind"), F.coalesce(v, F.lit("unknown")).alias("key")) for k, v in (("language", F.col("variables.language")), ("section", section), ("hand", F.col("variables.hand")))))
    return heads.select(F.explode(pairs).alias("x")).groupBy("x.kind", "x.key").agg(F.count("*").alias("n_pages"))


FOLIO_SECTION = "CASE WHEN {0} BETWEEN 1 AND 25 THEN 'herbal_a' WHEN {0} BETWEEN 26 AND 66 THEN 'herbal_b' WHEN {0} BETWEEN 67 AND 73 THEN 'astronomical' WHEN {0} BETWEEN 75 AND 84 THEN 'biological' WHEN {0} BETWEEN 85 AND 86 THEN 'cosmological' WHEN {0} BETWEEN 87 AND 102 THEN 'pharmaceutical' WHEN {0} BETWEEN 103 AND 116 THEN 'recipes' ELSE 'unknown' END"
BOUNDARY = "{0} IN (1,25,26,66,67,73,75,84,85,86,87,102,103,116)"
MISSING = "{0} IN (12,59,60,61,62,63,64,74,91,92,93,94,95,96,109,110)"
RECORDS = f"""{PARSED},
 n AS (SELECT file, page_ord, count(*) FILTER (locus_type = 'P') AS line_count, count(*) FILTER (locus_type = 'L') AS label_count, bool_or(trim(text) <> '') AS has_text FROM loci GROUP BY ALL),
 parts AS (SELECT *, CAST(regexp_extract(page_id, '^f([0-9]+)', 1) AS INT) AS num, regexp_extract(page_id, '^f[0-9]+([rv])', 1) AS letter, TRY_CAST(nullif(regexp_extract(page_id, '[rv]([0-9]*)$', 1), '') AS INT) AS panel FROM pages_),
 records AS (SELECT file, page_ord, page_id, 'f' || num AS folio_id, CASE letter WHEN 'r' THEN 'recto' ELSE 'verso' END AS side, num AS folio_number, 'q' || quire AS quire_id, quire AS quire_letter, page_in_quire, {FOLIO_SECTION.format('num')} AS section,
  CASE WHEN {BOUNDARY.format('num')} THEN 'medium' ELSE 'high' END AS confidence, {BOUNDARY.format('num')} AS disputed, language AS currier_language, hand, illustration AS illustration_type, coalesce(line_count, 0) AS line_count, coalesce(label_count, 0) AS label_count,
  coalesce(has_text, false) AS has_text, panel IS NOT NULL AS is_foldout_panel, panel AS panel_number, CASE WHEN panel IS NOT NULL THEN CASE WHEN num = 85 AND letter = 'v' THEN 6 WHEN num = 86 AND letter = 'v' THEN 4 END END AS total_panels, {MISSING.format('num')} AS is_missing
  FROM parts LEFT JOIN n USING (file, page_ord))"""


def page_rows(spark, sf_dir) -> DataFrame:
    return M.page_records(transcript(spark, sf_dir))


@query(f"WITH {RECORDS} SELECT * FROM records")
def page_records(spark, sf_dir):
    rows = page_rows(spark, sf_dir)
    return rows.select(*(c for c in rows.columns if c not in ("section", "notes")), F.col("section.value").alias("section"), F.col("section.confidence").alias("confidence"), F.col("section.disputed").alias("disputed"))


@query(f"""WITH {RECORDS}, f AS (SELECT folio_id, any_value(folio_number) AS folio_number, min_by(page_id, file || lpad(CAST(page_ord AS VARCHAR), 12, '0')) FILTER (side = 'recto') AS recto_page_id,
  coalesce(string_agg(page_id, ',' ORDER BY coalesce(panel_number, 0), file, page_ord) FILTER (side = 'verso'), '') AS verso_page_ids, count(*) FILTER (side = 'verso') AS n_verso, bool_or(is_foldout_panel) AS panels, CAST(sum(line_count) AS BIGINT) AS total_lines, any_value(section) AS section_value,
  any_value(confidence) AS section_confidence FROM records GROUP BY folio_id),
 q AS (SELECT folio_id, quire_id FROM (SELECT *, row_number() OVER (PARTITION BY folio_id ORDER BY file, page_ord) AS r FROM records) WHERE r = 1),
 m AS (SELECT folio_id, currier_language FROM (SELECT folio_id, currier_language, row_number() OVER (PARTITION BY folio_id ORDER BY n DESC, currier_language) AS r FROM (SELECT folio_id, currier_language, count(*) AS n FROM records WHERE currier_language IS NOT NULL GROUP BY folio_id, currier_language)) WHERE r = 1)
 SELECT folio_id, folio_number, quire_id, recto_page_id, verso_page_ids, n_verso > 1 OR panels AS is_foldout, CASE WHEN n_verso > 1 OR panels THEN n_verso END AS panel_count, {MISSING.format('folio_number')} AS is_missing, total_lines, currier_language, section_value, section_confidence
 FROM f JOIN q USING (folio_id) LEFT JOIN m USING (folio_id)""")
def folio_rollup(spark, sf_dir):
    rows = sinks.flatten_folios(M.folio_records(page_rows(spark, sf_dir)))
    return rows.select("folio_id", "folio_number", "quire_id", "recto_page_id", "verso_page_ids", "is_foldout", F.col("panel_count").cast("long").alias("panel_count"), "is_missing", "total_lines", "currier_language", "section_value", "section_confidence")


@query(f"""WITH {RECORDS}, k AS (SELECT quire_id, quire_letter, count(*) AS page_count, bool_and(NOT is_missing) AS is_complete, CAST(sum(line_count) AS BIGINT) AS total_lines FROM records WHERE quire_id IS NOT NULL GROUP BY ALL),
 d AS (SELECT quire_id, string_agg(folio_id, ',' ORDER BY folio_number) AS folio_ids, count(*) AS folio_count FROM (SELECT DISTINCT quire_id, folio_id, folio_number FROM records) GROUP BY 1),
 s AS (SELECT quire_id, string_agg(section, ',' ORDER BY section) AS sections FROM (SELECT DISTINCT quire_id, section FROM records) GROUP BY 1)
 SELECT k.*, folio_ids, folio_count, sections FROM k JOIN d USING (quire_id) JOIN s USING (quire_id)""")
def quire_rollup(spark, sf_dir):
    rows = M.quire_records(page_rows(spark, sf_dir))
    return rows.select("quire_id", "quire_letter", "page_count", "is_complete", "total_lines", F.array_join("folio_ids", ",").alias("folio_ids"), F.col("folio_count").cast("long").alias("folio_count"), F.array_join("sections", ",").alias("sections"))


@query(f"WITH {RECORDS} SELECT count(*) AS total_pages, count(DISTINCT folio_id) AS total_folios, count(DISTINCT quire_id) AS total_quires, CAST(sum(line_count) AS BIGINT) AS total_lines FROM records")
def metadata_totals(spark, sf_dir):
    return M.totals(page_rows(spark, sf_dir))


@query(f"WITH {RECORDS} SELECT 'section' AS kind, section AS key, count(*) AS n_pages FROM records GROUP BY 2 UNION ALL SELECT 'language', coalesce(currier_language, 'unknown'), count(*) FROM records GROUP BY 2 UNION ALL SELECT 'known_language', currier_language, count(*) FROM records WHERE currier_language IS NOT NULL GROUP BY 2")
def metadata_counts(spark, sf_dir):
    rows = page_rows(spark, sf_dir).select(F.col("section.value").alias("section"), "currier_language").cache()
    parts = [M.page_counts(rows, F.col(c), m).select(F.lit(k).alias("kind"), "key", "n_pages") for k, c, m in (("section", "section", "unknown"), ("language", "currier_language", "unknown"), ("known_language", "currier_language", None))]
    return parts[0].union(parts[1]).union(parts[2])


@query(f"""WITH p AS (SELECT p_partkey, 'f' || (p_partkey % 130) || CASE WHEN p_partkey % 2 = 0 THEN 'r' ELSE 'v' END || CASE WHEN p_partkey % 9 = 0 THEN CAST(p_partkey % 6 + 1 AS VARCHAR) ELSE '' END AS page_id, p_partkey % 130 AS n FROM part)
 SELECT p_partkey, page_id, CAST(n AS INT) AS folio, {FOLIO_SECTION.format('n')} AS section, {BOUNDARY.format('n')} AS disputed, {MISSING.format('n')} AS missing, p_partkey % 9 = 0 OR (n IN (85, 86) AND p_partkey % 2 = 1) AS foldout FROM p""")
def folio_sections(spark, sf_dir):
    n = F.col("p_partkey") % 130
    page = F.concat(F.lit("f"), n, F.when(F.col("p_partkey") % 2 == 0, "r").otherwise("v"), F.when(F.col("p_partkey") % 9 == 0, (F.col("p_partkey") % 6 + 1).cast("string")).otherwise(""))
    rows = table(spark, sf_dir, "part").select("p_partkey", page.alias("page_id"))
    number = ids.folio_number(F.col("page_id"))
    section = ids.uncertain_section(number)
    return rows.select("p_partkey", "page_id", number.alias("folio"), section["value"].alias("section"), section["disputed"].alias("disputed"), ids.is_missing(number).alias("missing"), ids.is_foldout(F.col("page_id")).alias("foldout"))


@query("""SELECT p_partkey, CAST(p_partkey % 130 AS INT) AS folio, CASE WHEN p_partkey % 2 = 0 THEN 'r' ELSE 'v' END AS side, CASE WHEN p_partkey % 9 = 0 THEN CAST(p_partkey % 6 + 1 AS INT) END AS panel FROM part""")
def page_id_parts(spark, sf_dir):
    page = F.concat(F.when(F.col("p_partkey") % 7 == 0, "F").otherwise("f"), F.col("p_partkey") % 130, F.when(F.col("p_partkey") % 2 == 0, "r").otherwise("v"), F.when(F.col("p_partkey") % 9 == 0, (F.col("p_partkey") % 6 + 1).cast("string")).otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", ids.parse_page_id(page).alias("x")).select("p_partkey", "x.*")


@query(f"WITH {RECORDS}, f AS (SELECT folio_id, any_value(folio_number) AS num FROM records GROUP BY 1), q AS (SELECT DISTINCT quire_id FROM records WHERE quire_id IS NOT NULL) SELECT 'folio' AS kind, folio_id AS id, row_number() OVER (ORDER BY num) AS place FROM f UNION ALL SELECT 'quire', quire_id, row_number() OVER (ORDER BY quire_id) FROM q")
def leaf_order(spark, sf_dir):
    pages = page_rows(spark, sf_dir)
    # One row a folio and a quire.
    folios = pages.select(F.lit("folio").alias("kind"), F.col("folio_id").alias("id"), ids.folio_key(F.col("folio_id")).alias("number")).distinct()
    quires = pages.where("quire_id is not null").select(F.lit("quire").alias("kind"), F.col("quire_id").alias("id"), F.lit(0).alias("number")).distinct()
    placed = folios.union(quires).withColumn("place", F.row_number().over(S.Window.partitionBy("kind").orderBy("number", "id")))
    return placed.select("kind", "id", F.col("place").cast("long").alias("place"))


@query("""SELECT n_nationkey, sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}') AS sha, left(sha256(n_name), 12) AS version FROM nation""")
def canonical_json_sha(spark, sf_dir):
    rows = table(spark, sf_dir, "nation")
    return rows.select("n_nationkey", sinks.row_hash(rows).alias("sha"), ids.version_of(F.col("n_name")).alias("version"))


@query(f"WITH {LINES} SELECT line_id, file, length(regexp_replace(lower(text), '[^a-vx-z]', '', 'g')) AS raw_letters, char_count FROM lines WHERE has_high_ascii")
def high_code_lines(spark, sf_dir):
    rows = ivtff.loci(transcript(spark, sf_dir), comments=False, with_page=True).where(T.has_high_codes(F.col("text")))
    rows = rows.withColumn("clean", charset.checked_text(T.clean_for_analysis(F.col("text"))))
    return rows.select(F.concat_ws(":", "page_id", "locus_number").alias("line_id"), "file", charset.letter_count(F.col("text")).alias("raw_letters"), charset.letter_count(F.col("clean")).alias("char_count"))
