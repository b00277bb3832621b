"""The queries of this subpackage, ``opN_<name>``, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import spread
from .chat_format import rotate_perspectives
from .common import fold_id, table
from .conversation_repair import damage, repair_conversations
from .decontaminate import contaminated_regions
from .html_extract import extract_main_text
from .language_id import identify
from .lm_score import score_texts
from .quality_classifier import score_quality
from .quality_rules import quality_verdicts
from .simhash import simhash_classes
from .source_mix import mix_sources
from .spelling_variants import PLANTED, group_variants, vocabulary
from .suffix_dedup import repeat_digests
from .toxicity import score_toxicity

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of texts; a small one over all cores, as its few row groups would make as many tasks."""
    return spread(table(spark, sf_dir, name), 8 << 20)


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = rotate_perspectives(texts(spark, sf_dir, "conversations"))
    joined = [F.concat_ws(",", F.transform(c, lambda x: x.cast("string"))).alias(c) for c in ("segment_chars", "segment_mask")]
    return views.select("conv_id", "perspective", "part", "piece", F.col("n_turns").cast("long").alias("n_turns"), "text", *joined)


@query
def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(texts(spark, sf_dir, "pages"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(texts(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = texts(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(fold_id("doc_id"), F.lit(3)) == 1, F.lit(False))
    predicted = identify(documents, ~held_out & F.col("doc_id").isNotNull())
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(texts(spark, sf_dir, "documents"))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.pmod(fold_id("doc_id"), F.lit(5)) == 0, F.lit(False))
    scored = score_quality(texts(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(texts(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_regions(texts(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(texts(spark, sf_dir, "documents"))


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash_classes(texts(spark, sf_dir, "documents"))
    return classes.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = texts(spark, sf_dir, "conversations")
    return repair_conversations(damage(turns), turns)


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(vocabulary(texts(spark, sf_dir, "documents"), planted=PLANTED)).select("word", "form", "root", "n", "n_near", "form_n")


@query
def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.pmod(fold_id("doc_id"), F.lit(7)) == 2, F.lit(False))
    scored = score_texts(texts(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


ORACLES["op1_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         coalesce(CAST(floor(turn / 256.0) AS BIGINT), -1) AS part
  FROM conversations),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, part ORDER BY turn NULLS FIRST, role, text) AS place FROM turns),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM turns WHERE role <> 'system'),
seen AS (
  SELECT p.conv_id, s.perspective, part, (place - 1) // 256 AS piece, place,
         '<|' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN role ELSE 'user name=' || role END || '|>' || chr(10) AS header,
         text || '<|end|>' || chr(10) AS body, CASE WHEN role = perspective THEN 1 ELSE 0 END AS mine
  FROM placed p JOIN speakers s ON p.conv_id IS NOT DISTINCT FROM s.conv_id)
SELECT conv_id, perspective, part, piece, count(*) AS n_turns,
       string_agg(header || body, '' ORDER BY place) AS text,
       string_agg(length(header) || ',' || length(body), ',' ORDER BY place) AS segment_chars,
       string_agg('0,' || mine, ',' ORDER BY place) AS segment_mask
FROM seen GROUP BY conv_id, perspective, part, piece
"""

# The table of CRC-32 comes from its rule; keys are hashed byte by byte, conversations repaired turn by turn, all of them at once.
ORACLES["op11_conversation_repair"] = r"""
WITH RECURSIVE rounds(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM rounds WHERE k < 8),
crc_table AS (SELECT i, c FROM rounds WHERE k = 8),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
crc(key, pos, c) AS (
  SELECT DISTINCT key, 0, CAST(4294967295 AS BIGINT) FROM keyed
  UNION ALL
  SELECT key, pos + 1, xor(crc.c // 256, t.c) FROM crc JOIN crc_table t
    ON t.i = xor(crc.c % 256, ascii(substr(key, pos + 1, 1))) WHERE pos < length(key)),
planted AS (
  SELECT conv_id, turn, role, text, xor(c, 4294967295) % 20 AS fault FROM keyed JOIN crc USING (key) WHERE pos = length(key)),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT * FROM planted WHERE fault <> 0 UNION ALL SELECT * FROM planted WHERE fault = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS time,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending
  FROM damaged),
flagged AS (
  SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN time > 1 THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair
  FROM placed),
convs AS (SELECT DISTINCT conv_id FROM conversations),
-- Costs from 1000000000 on are states that cannot be.
fold(conv_id, n, s0, s1, s2, s3) AS (
  SELECT conv_id, CAST(0 AS BIGINT), {'c': CAST(0 AS BIGINT), 'a': '', 't': ''}, {'c': CAST(1000000000 AS BIGINT), 'a': '', 't': ''},
         {'c': CAST(1000000000 AS BIGINT), 'a': '', 't': ''}, {'c': CAST(1000000000 AS BIGINT), 'a': '', 't': ''} FROM convs
  UNION ALL
  SELECT conv_id, n,
    {'c': s0.c + 4, 'a': s0.a || 'D', 't': s0.t},
    list_min([{'c': s1.c + 4, 'a': s1.a || 'D', 't': s1.t},
      {'c': CASE WHEN free AND initial = 's' THEN s0.c + broken ELSE 2000000000 END, 'a': s0.a || 'K', 't': s0.t || chr(10) || role || ':' || text}]),
    list_min([{'c': s2.c + 4, 'a': s2.a || 'D', 't': s2.t},
      {'c': CASE WHEN free AND initial = 'u' THEN u.c + broken ELSE 2000000000 END, 'a': u.a || 'K', 't': u.t || chr(10) || role || ':' || text},
      {'c': CASE WHEN free THEN u.c + broken + 3 ELSE 2000000000 END, 'a': u.a || 'R', 't': u.t || chr(10) || 'user:' || text}]),
    list_min([{'c': s3.c + 4, 'a': s3.a || 'D', 't': s3.t},
      {'c': CASE WHEN free AND initial = 'a' THEN a.c + broken ELSE 2000000000 END, 'a': a.a || 'K', 't': a.t || chr(10) || role || ':' || text},
      {'c': CASE WHEN free THEN a.c + broken + 3 ELSE 2000000000 END, 'a': a.a || 'R', 't': a.t || chr(10) || 'assistant:' || text}])
  FROM (
    SELECT f.conv_id, f.n + 1 AS n, s0, s1, s2, s3, role, initial, text, fault NOT IN ('blank', 'duplicate') AS free,
           CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS broken,
           list_min([s0, s1, s3, {'c': s2.c + 3, 'a': s2.a || 'I', 't': s2.t || chr(10) || 'assistant:'}]) AS u,
           list_min([s2, {'c': list_min([s0, s1, s3]).c + 3, 'a': list_min([s0, s1, s3]).a || 'I', 't': list_min([s0, s1, s3]).t || chr(10) || 'user:'}]) AS a
    FROM fold f JOIN flagged g ON f.conv_id IS NOT DISTINCT FROM g.conv_id AND g.n = f.n + 1)),
ended AS (
  SELECT conv_id, list_min([s0, s3, {'c': s2.c + 3, 'a': s2.a || 'I', 't': s2.t || chr(10) || 'assistant:'},
    {'c': s1.c + 6, 'a': s1.a || 'II', 't': s1.t || chr(10) || 'user:' || chr(10) || 'assistant:'}]) AS best
  FROM fold QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM flagged GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit, sha256(substr(best.t, 2)) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
