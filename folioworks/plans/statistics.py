"""Queries over the words and characters of ``documents``, and the cleaners over ``pages``."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import charset
from ..functions import text as T
from ..operators import stats as S
from ..operators import streams as R
from ..operators.metadata import most_frequent
from .registry import query, spread, table

WORDS = r"""words AS (SELECT doc_id, lang, unnest(list_filter(regexp_split_to_array(text, '[.,\s]+'), lambda x: x <> '')) AS word FROM documents)"""
COUNTS = WORDS + ", counts AS (SELECT word, count(*) AS n FROM words GROUP BY word)"
ALPHA = r"""alpha AS (
  SELECT doc_id, lang, word FROM (SELECT doc_id, lang, unnest(list_transform(regexp_split_to_array(text, '[.,]'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g'))) AS word FROM documents)
  WHERE regexp_matches(word, '^\p{L}+$'))"""
LETTERS = r"""letters AS (
  SELECT doc_id, lang, c, pos FROM (SELECT doc_id, lang, unnest(string_split(s, '')) AS c, generate_subscripts(string_split(s, ''), 1) AS pos
  FROM (SELECT doc_id, lang, regexp_replace(text, '[^\p{L}]+', '', 'g') AS s FROM documents)) WHERE c <> '')"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def words(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return S.tokens(documents(spark, sf_dir), "text", T.spaced_words, *keep)


def alpha_words(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return S.tokens(documents(spark, sf_dir), "text", lambda c: T.words(c, letters_only=True), *keep)


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.counts(words(spark, sf_dir), "word")


@query(f"WITH {COUNTS} SELECT word, n, round(n * 100.0 / (SELECT sum(n) FROM counts), 6) AS pct FROM counts ORDER BY n DESC, word LIMIT 30")
def word_freq_topk(spark, sf_dir):
    counted = word_counts(spark, sf_dir)
    return S.shares(S.top(counted, "word", 30), of=counted).withColumn("pct", F.round("pct", 6))


@query(f"""WITH {COUNTS} SELECT CAST(sum(n) AS BIGINT) AS tokens, count(*) AS types, count(*) FILTER (n = 1) AS hapax, count(*) FILTER (n = 2) AS dis,
 round(count(*) / sum(n), 6) AS ttr, round(count(*) FILTER (n = 1) / count(*), 6) AS hapax_of_types, round(count(*) FILTER (n = 1) / sum(n), 6) AS hapax_of_tokens FROM counts""")
def vocab_stats(spark, sf_dir):
    return S.vocabulary(word_counts(spark, sf_dir)).select("tokens", "types", "hapax", "dis", *(F.round(c, 6).alias(c) for c in ("ttr", "hapax_of_types", "hapax_of_tokens")))


@query(f"WITH {COUNTS} SELECT word, length(word) AS length FROM counts WHERE n = 1 ORDER BY length DESC, word LIMIT 10")
def longest_hapax(spark, sf_dir):
    return S.longest_hapax(word_counts(spark, sf_dir)).select("word", F.col("length").cast("long").alias("length"))


@query(f"WITH {ALPHA} SELECT a.length, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series(1, 12)) AS length) a LEFT JOIN (SELECT length(word) AS length, count(*) AS n FROM alpha GROUP BY 1) b USING (length)")
def word_length_hist(spark, sf_dir):
    return S.histogram(alpha_words(spark, sf_dir).select(F.char_length("word").alias("length")), "length", 1, 12)


@query(f"""WITH {ALPHA}, l AS (SELECT CAST(length(word) AS BIGINT) AS v FROM alpha) SELECT count(*) AS n, min(v) AS least, max(v) AS greatest, round(avg(v), 6) AS mean,
 (SELECT v FROM l ORDER BY v LIMIT 1 OFFSET (SELECT count(*) // 2 FROM l)) AS upper_median, round(var_pop(v), 6) AS variance, round(stddev_pop(v), 6) AS deviation, round(stddev_pop(v) / avg(v), 6) AS variation FROM l""")
def word_length_stats(spark, sf_dir):
    lengths = alpha_words(spark, sf_dir).select(F.char_length("word").cast("long").alias("v"))
    both = S.spread(lengths, "v").crossJoin(F.broadcast(S.moments(lengths, "v").drop("mean")))
    return both.select("n", "least", "greatest", F.round("mean", 6).alias("mean"), "upper_median", *(F.round(c, 6).alias(c) for c in ("variance", "deviation", "variation")))


@query(f"""WITH {COUNTS}, ends AS (SELECT 'initial' AS place, left(word, 1) AS c, n FROM counts UNION ALL SELECT 'final', right(word, 1), n FROM counts),
 e AS (SELECT place, c, CAST(sum(n) AS BIGINT) AS n FROM ends GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY n DESC, c) AS rank, n * 100.0 / sum(n) OVER (PARTITION BY place) AS pct FROM e)
 SELECT place, c, n, rank, round(pct, 6) AS pct FROM r WHERE rank <= 10""")
def initial_final_chars(spark, sf_dir):
    ends = S.shares(S.letter_ends(word_counts(spark, sf_dir)), "place")
    return S.top_within(ends, "c", 10, "place").select("place", "c", "n", F.col("rank").cast("long").alias("rank"), F.round("pct", 6).alias("pct"))


@query(r"""WITH c AS (SELECT c, count(*) AS n FROM (SELECT unnest(string_split(translate(text, ' .,', ''), '')) AS c FROM documents) WHERE c <> '' GROUP BY c)
 SELECT c, n, round(n * 100.0 / (SELECT sum(n) FROM c), 6) AS pct FROM c ORDER BY n DESC, c LIMIT 20""")
def char_freq_pct(spark, sf_dir):
    rows = documents(spark, sf_dir).select(F.translate("text", " .,", "").alias("text"))
    counted = S.character_counts(rows, "text")
    return S.shares(S.top(counted, "c", 20), of=counted).select("c", "n", F.round("pct", 6).alias("pct"))


@query(r"""SELECT c, count(*) AS n, regexp_matches(c, '^[a-vx-z., @;0-9'']$') AS expected FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) WHERE c <> '' GROUP BY c""")
def charset_audit(spark, sf_dir):
    return S.character_counts(documents(spark, sf_dir), "text").select("c", "n", charset.is_clean(F.col("c")).alias("expected"))


@query(r"""WITH m AS (SELECT unnest(string_split('''?!*~', '')) AS c), d AS (SELECT c, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) GROUP BY c)
 SELECT m.c, n IS NOT NULL AS present, coalesce(n, 0) AS n FROM m LEFT JOIN d USING (c)""")
def charset_presence(spark, sf_dir):
    """The marks that an audit of the alphabet asks for by name."""
    return S.presence(S.character_counts(documents(spark, sf_dir), "text").select("c", "n"), "'?!*~")


@query(r"""WITH c AS (SELECT c, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) WHERE c <> '' GROUP BY c)
 SELECT c, n, CASE WHEN regexp_matches(lower(c), '^[acdehiklmnopqrsty]$') THEN 'basic' WHEN regexp_matches(lower(c), '^[fgxjvbuz]$') THEN 'rare' WHEN c IN ('.', ',', ' ') THEN 'special'
  WHEN regexp_matches(c, '^[?!*\[\]:{}''<>@;%$~]$') THEN 'editorial' ELSE 'unknown' END AS category,
 CASE WHEN lower(c) IN ('l','r','t','m','n') THEN 'medium' WHEN lower(c) IN ('p','f') THEN 'low' WHEN lower(c) IN ('g','x','j','v','b','u','z') THEN 'rare' WHEN regexp_matches(lower(c), '^[a-vx-z]$') THEN 'high'
  WHEN c IN ('.', ',', ' ') THEN 'high' WHEN regexp_matches(c, '^[?!*\[\]:{}''<>@;%$~]$') THEN 'n/a' ELSE 'unknown' END AS frequency FROM c""")
def character_info(spark, sf_dir):
    return charset.describe(S.character_counts(documents(spark, sf_dir), "text"), "c").select("c", "n", "category", "frequency")


CHECKED = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '\{{[^}}]*\}}', '', 'g'), '<[^>]*>', '', 'g'), '@[0-9]+;', '', 'g'), '\[([^:\]]+):[^\]]+\]', '\1', 'g')"""


@query(f"""WITH t AS (SELECT doc_id, {CHECKED.format('text')} AS s FROM documents)
 SELECT doc_id, length(regexp_replace(lower(s), '[^a-vx-z]', '', 'g')) AS char_count, len(list_filter(regexp_split_to_array(s, '[.,\\s]+'), lambda x: x <> '')) AS word_count,
 len(list_filter(string_split(s, ''), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^[a-vx-z0-9.,\\s\\-=?!*\\[\\]:{{}}''<>@;%$~]$'))) AS n_unknown,
 array_to_string(list_sort(list_distinct(list_filter(string_split(s, ''), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^[a-vx-z0-9.,\\s\\-=?!*\\[\\]:{{}}''<>@;%$~]$')))), '') AS unknown,
 len(regexp_extract_all(s, 'ch')) AS n_ch, len(regexp_extract_all(s, 'sh')) AS n_sh FROM t""")
def validate_documents(spark, sf_dir):
    checked = documents(spark, sf_dir).select("doc_id", charset.checked_text(F.col("text")).alias("s"))
    v = checked.select("doc_id", charset.validate_checked(F.col("s"), details=("unknown_chars", "compound_counts")).alias("v"))
    n = lambda k: F.coalesce(F.col("v.compound_counts")[k], F.lit(0)).alias(f"n_{k}")
    return v.select("doc_id", "v.char_count", "v.word_count", "v.n_unknown", F.array_join("v.unknown_chars", "").alias("unknown"), n("ch"), n("sh"))


@query(f"""WITH t AS (SELECT doc_id, string_split({CHECKED.format('text')}, '') AS s FROM documents), u AS (SELECT doc_id, s, list_filter(generate_series(1, len(s)), lambda i: s[i] <> '' AND NOT regexp_matches(lower(s[i]), '^[a-vx-z0-9.,\\s\\-=?!*\\[\\]:{{}}''<>@;%$~]$')) AS p FROM t),
 f AS (SELECT doc_id, string_agg(c || ':' || n, ',' ORDER BY c) AS frequencies FROM (SELECT doc_id, lower(c) AS c, count(*) AS n FROM (SELECT doc_id, unnest(s) AS c FROM t) WHERE regexp_matches(lower(c), '^[a-vx-z]$') GROUP BY ALL) GROUP BY doc_id)
 SELECT doc_id, len(p) = 0 AS is_valid, len(p) AS n_errors, array_to_string(list_transform(p, lambda i: (i - 1) || s[i]), ' ') AS positions, coalesce(frequencies, '') AS frequencies FROM u LEFT JOIN f USING (doc_id)""")
def validate_details(spark, sf_dir):
    """Strict validity, the places of unknown characters and the letters' frequencies."""
    checked = documents(spark, sf_dir).select("doc_id", charset.checked_text(F.col("text")).alias("s"))
    v = checked.select("doc_id", charset.validate_checked(F.col("s"), True, ("unknown_positions", "char_frequencies")).alias("v"))
    places = F.transform("v.unknown_positions", lambda x: F.concat(x.pos.cast("string"), x.char))
    counted = F.transform(F.array_sort(F.map_entries("v.char_frequencies")), lambda x: F.concat(x.key, F.lit(":"), x.value.cast("string")))
    return v.select("doc_id", "v.is_valid", "v.n_errors", F.array_join(places, " ").alias("positions"), F.array_join(counted, ",").alias("frequencies"))


@query(r"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(string_split(text, ''), lambda x: x <> '' AND NOT regexp_matches(x, '^[a-vx-z., @;0-9'']$')))), '') AS unclean,
 regexp_matches(text, '[<>{}]') AS markup, regexp_matches(text, '[?!*]') AS marks FROM documents WHERE NOT regexp_full_match(text, '[a-vx-z., @;0-9'']*')""")
def text_clean_charset(spark, sf_dir):
    t = F.col("text")
    return documents(spark, sf_dir).where(~charset.is_clean(t)).select("doc_id", F.array_join(charset.unclean_characters(t), "").alias("unclean"), charset.has_markup(t).alias("markup"), charset.has_uncertainty_marks(t).alias("marks"))


@query(r"""SELECT g AS glyph, CAST(sum(len(regexp_extract_all(lower(text), g))) AS BIGINT) AS n FROM documents, (SELECT unnest(['ch', 'sh', 'cth', 'ckh', 'cph', 'cfh']) AS g) GROUP BY g HAVING sum(len(regexp_extract_all(lower(text), g))) > 0""")
def compound_glyphs(spark, sf_dir):
    rows = documents(spark, sf_dir).select(F.explode(charset.compound_counts(F.col("text"))).alias("glyph", "k"))
    return rows.groupBy("glyph").agg(F.sum("k").alias("n"))


@query(f"WITH {COUNTS} SELECT regexp_full_match(lower(word), '[a-vx-z]*') AS valid, count(*) AS types, CAST(sum(n) AS BIGINT) AS tokens FROM counts GROUP BY 1")
def valid_words(spark, sf_dir):
    return word_counts(spark, sf_dir).groupBy(charset.is_valid_word(F.col("word")).alias("valid")).agg(F.count("*").alias("types"), F.sum("n").alias("tokens"))


@query(f"""WITH t AS (SELECT unnest(string_split({CHECKED.format('text')}, '')) AS c FROM documents) SELECT c, count(*) AS n FROM t WHERE c <> '' AND NOT regexp_matches(lower(c), '^[a-vx-z0-9.,\\s\\-=?!*\\[\\]:{{}}''<>@;%$~]$') GROUP BY c""")
def unknown_chars(spark, sf_dir):
    odd = documents(spark, sf_dir).select(charset.unknown_text(charset.checked_text(F.col("text"))).alias("odd"))
    return S.character_counts(odd, "odd").select("c", "n")


@query("SELECT source, lang FROM (SELECT source, lang, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS r FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL)) WHERE r = 1")
def dominant_language(spark, sf_dir):
    return documents(spark, sf_dir).groupBy("source").agg(most_frequent("lang").alias("lang"))


SQUEEZE = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"
STRIP = SQUEEZE.format(r"regexp_replace(regexp_replace(regexp_replace({0}, '\{{[^}}]*\}}', '', 'g'), '\[([^:\]]*):([^\]]*)\]', '\1', 'g'), '<[^>]*>', '', 'g')")


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


@query(f"SELECT page_id, {STRIP.format('html')} AS text FROM pages")
def strip_markup_html(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", T.strip_markup(F.col("html")).alias("text"))


@query(f"SELECT page_id, {SQUEEZE.format(f'''replace(translate({STRIP.format('html')}, '?!*', ''), 'I', 'i')''')} AS text FROM pages")
def clean_html(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", T.clean_for_analysis(F.col("html")).alias("text"))


@query(
    "SELECT page_id, "
    + SQUEEZE.format(r"regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(html, '\{[^}]*\}', '', 'g'), '\[([^:\]]+):[^\]]+\]', '\1', 'g'), '<->', ' '), '<[$%~]>', '', 'g'), '<![^>]*>', '', 'g')")
    + " AS text FROM pages"
)
def extract_text_html(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", T.extract_text(F.col("html")).alias("text"))


@query("SELECT page_id, " + SQUEEZE.format(r"regexp_replace(regexp_replace(regexp_replace(translate(coalesce(html, ''), '?!*', ''), '<[^>]*>', '', 'g'), '\{[^}]*\}', '', 'g'), '\[[^\]]*\]', '', 'g')") + " AS text FROM pages")
def normalize_text_html(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", T.normalize_for_comparison(F.col("html")).alias("text"))


@query(f"""WITH t AS (SELECT page_id, html, {STRIP.format('html')} AS s FROM pages)
 SELECT page_id, contains(s, '?') AS uncertain, regexp_matches(s, '[!*]') AS illegible, contains(html, '[') AND contains(html, ':') AS alternatives, regexp_matches(html, '@[0-9]+;') AS high, NOT regexp_matches(s, '[<>{{}}]') AS stripped FROM t""")
def flags_html(spark, sf_dir):
    h = F.col("html")
    return pages(spark, sf_dir).select("page_id", T.is_uncertain(h).alias("uncertain"), T.is_illegible(h).alias("illegible"), T.has_alternatives(h).alias("alternatives"), T.has_high_codes(h).alias("high"), T.is_stripped(T.strip_markup(h)).alias("stripped"))


@query("SELECT page_id, replace(replace('{{URL}} has {{N}} and {{OTHER}}', '{{URL}}', 'url'), '{{N}}', 'n') || ' ' || url AS card FROM pages")
def template_fill(spark, sf_dir):
    filled = T.fill_template(F.lit("{{URL}} has {{N}} and {{OTHER}}"), {"URL": "url", "N": "n"})
    return pages(spark, sf_dir).select("page_id", F.concat(filled, F.lit(" "), "url").alias("card"))


@query(f"""WITH {LETTERS}, c AS (SELECT lang, c, count(*) AS n FROM letters GROUP BY ALL), t AS (SELECT lang, sum(n) AS total FROM c GROUP BY lang)
 SELECT lang, CAST(total AS BIGINT) AS total, count(*) AS "distinct", round(-sum(n / total * log2(n / total)), 6) AS entropy, round(log2(count(*)), 6) AS h0 FROM c JOIN t USING (lang) GROUP BY lang, total""")
def entropy_unigram_by_lang(spark, sf_dir):
    rows = documents(spark, sf_dir).select("lang", T.letters(F.col("text")).alias("text"))
    return S.entropy(S.character_counts(rows, "text", "lang"), "lang").select("lang", "total", "distinct", F.round("entropy", 6).alias("entropy"), F.round("h0", 6).alias("h0"))


def _conditional(k: int) -> str:
    context = " || ".join(f"lag(c, {i}) OVER w" for i in range(k, 0, -1))
    return f"""WITH {LETTERS}, g AS (SELECT {context} AS ctx, c FROM letters WINDOW w AS (ORDER BY doc_id, pos)),
 n AS (SELECT ctx, c, count(*) AS n FROM g WHERE ctx IS NOT NULL GROUP BY ALL), t AS (SELECT ctx, sum(n) AS t FROM n GROUP BY ctx)
 SELECT CAST(sum(n) AS BIGINT) AS n_grams, round(-sum(n * log2(n / t)) / sum(n), 6) AS entropy FROM n JOIN t USING (ctx)"""


def _running(spark, sf_dir, k):
    return S.conditional_entropy(S.running_letter_grams(documents(spark, sf_dir), "text", k, "doc_id")).select("n_grams", F.round("entropy", 6).alias("entropy"))


@query(_conditional(1))
def entropy_cond_k1(spark, sf_dir):
    return _running(spark, sf_dir, 1)


@query(_conditional(2))
def entropy_cond_k2(spark, sf_dir):
    return _running(spark, sf_dir, 2)


@query(_conditional(3))
def entropy_cond_k3(spark, sf_dir):
    return _running(spark, sf_dir, 3)


BY_LANG = f"""{LETTERS}, g AS (SELECT lang, lag(c) OVER (PARTITION BY lang ORDER BY doc_id, pos) AS ctx, c FROM letters),
 n AS (SELECT lang, ctx, c, count(*) AS n FROM g WHERE ctx IS NOT NULL GROUP BY ALL), t AS (SELECT lang, ctx, sum(n) AS t FROM n GROUP BY ALL),
 h AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n_grams, -sum(n * log2(n / t)) / sum(n) AS entropy FROM n JOIN t USING (lang, ctx) GROUP BY lang)"""


@query(f"WITH {BY_LANG} SELECT lang, n_grams, round(entropy, 6) AS entropy FROM h")
def entropy_cond_by_lang(spark, sf_dir):
    grams = S.running_letter_grams(documents(spark, sf_dir), "text", 1, "doc_id", by=("lang",))
    return S.conditional_entropy(grams, "lang").select("lang", "n_grams", F.round("entropy", 6).alias("entropy"))


@query(f"""WITH {LETTERS}, g AS (SELECT lang, lag(c) OVER (PARTITION BY doc_id ORDER BY pos) AS ctx, c FROM letters),
 n AS (SELECT lang, ctx, c, count(*) AS n FROM g WHERE ctx IS NOT NULL GROUP BY ALL), t AS (SELECT lang, ctx, sum(n) AS t FROM n GROUP BY ALL)
 SELECT lang, CAST(sum(n) AS BIGINT) AS n_grams, round(-sum(n * log2(n / t)) / sum(n), 6) AS entropy FROM n JOIN t USING (lang, ctx) GROUP BY lang""")
def entropy_cond_within_texts(spark, sf_dir):
    return S.conditional_entropy(S.letter_grams(documents(spark, sf_dir), "text", 1, "lang"), "lang").select("lang", "n_grams", F.round("entropy", 6).alias("entropy"))


@query(f"""WITH {BY_LANG}, c AS (SELECT lang, c, count(*) AS n FROM letters GROUP BY ALL), s AS (SELECT lang, sum(n) AS total FROM c GROUP BY lang),
 u AS (SELECT lang, -sum(n / total * log2(n / total)) AS h1 FROM c JOIN s USING (lang) GROUP BY lang)
 SELECT a.lang AS lang_a, b.lang AS lang_b, round(ua.h1, 6) AS h1_a, round(ub.h1, 6) AS h1_b, round(abs(ua.h1 - ub.h1), 6) AS h1_diff, round(abs(a.entropy - b.entropy), 6) AS h2_diff
 FROM h a JOIN h b ON a.lang < b.lang JOIN u ua ON ua.lang = a.lang JOIN u ub ON ub.lang = b.lang""")
def lang_compare(spark, sf_dir):
    docs = documents(spark, sf_dir)
    letters = docs.select("lang", T.letters(F.col("text")).alias("text"))
    one = S.entropy(S.character_counts(letters, "text", "lang"), "lang").select("lang", F.col("entropy").alias("h1"))
    two = S.conditional_entropy(S.running_letter_grams(docs, "text", 1, "doc_id", by=("lang",)), "lang").select("lang", F.col("entropy").alias("h2"))
    # One row a language: pairs are made of one small array, so neither side is computed twice.
    gathered = one.join(two, "lang").agg(F.sort_array(F.collect_list(F.struct("lang", "h1", "h2"))).alias("all"))
    pairs = F.transform("all", lambda x, i: F.transform(F.slice("all", i + 2, F.size("all")), lambda y: F.struct(x.alias("a"), y.alias("b"))))
    rows = gathered.select(F.explode(F.flatten(pairs)).alias("p")).select("p.a", "p.b")
    diff = lambda c: F.round(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")), 6).alias(f"{c}_diff")
    return rows.select(F.col("a.lang").alias("lang_a"), F.col("b.lang").alias("lang_b"), F.round("a.h1", 6).alias("h1_a"), F.round("b.h1", 6).alias("h1_b"), diff("h1"), diff("h2"))


@query(f"""WITH {ALPHA}, p AS (SELECT unnest(string_split(left(word, 8), '')) AS c, generate_subscripts(string_split(left(word, 8), ''), 1) AS place FROM alpha),
 c AS (SELECT place, c, count(*) AS n FROM p WHERE c <> '' GROUP BY ALL), t AS (SELECT place, sum(n) AS total FROM c GROUP BY place),
 r AS (SELECT place, c, n, total, row_number() OVER (PARTITION BY place ORDER BY n DESC, c) AS rank FROM c JOIN t USING (place))
 SELECT CAST(place AS BIGINT) AS place, CAST(total AS BIGINT) AS total, round(-sum(n / total * log2(n / total)), 6) AS entropy, string_agg(c, '' ORDER BY rank) FILTER (rank <= 3) AS top3, round(sum(n) FILTER (rank <= 3) / total, 6) AS top3_share FROM r GROUP BY place, total""")
def position_entropy(spark, sf_dir):
    counted = S.position_counts(alpha_words(spark, sf_dir)).withColumn("place", F.col("place").cast("long"))
    best = S.top_within(counted, "c", 3, "place").groupBy("place").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "c"))), lambda x: x.c), "").alias("top3"), F.sum("n").alias("top_n"))
    return S.entropy(counted, "place").join(best, "place").select("place", "total", F.round("entropy", 6).alias("entropy"), "top3", F.round(F.col("top_n") / F.col("total"), 6).alias("top3_share"))


PAIRS = f"""{LETTERS}, g AS (SELECT lag(c) OVER (ORDER BY doc_id, pos) AS ctx, c FROM letters), n AS (SELECT ctx, c, count(*) AS n FROM g WHERE ctx IS NOT NULL GROUP BY ALL),
 s AS (SELECT c, count(*) AS n FROM letters GROUP BY c), t AS (SELECT sum(n) AS t FROM s)"""


@query(f"WITH {PAIRS} SELECT ctx || n.c AS pair, n.n, round(n.n / (a.n / t * b.n / t * (t - 1)), 6) AS ratio FROM n JOIN s a ON a.c = ctx JOIN s b ON b.c = n.c, t ORDER BY n.n DESC, pair LIMIT 15")
def bigram_obs_exp(spark, sf_dir):
    found = S.running_letter_counts(documents(spark, sf_dir), "text", (0, 1), "doc_id")
    singles = found[0].select("c", "n")
    return S.bigram_ratios(found[1], singles).select("pair", "n", F.round("ratio", 6).alias("ratio"))


@query(f"""WITH {PAIRS}, top AS (SELECT c, n FROM s ORDER BY n DESC, c LIMIT 20)
 SELECT a.c || b.c AS pair, round(a.n / t * b.n / t * t, 6) AS expected FROM top a, top b, t WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.ctx = a.c AND n.c = b.c) AND a.n / t * b.n / t * t > 10 ORDER BY expected DESC, pair LIMIT 10""")
def missing_bigrams(spark, sf_dir):
    found = S.running_letter_counts(documents(spark, sf_dir), "text", (0, 1), "doc_id")
    singles = found[0].select("c", "n")
    return S.missing_bigrams(found[1], singles, common=20).select("pair", F.round("expected", 6).alias("expected"))


EDGES = r"""l AS (SELECT list_filter(list_transform(regexp_split_to_array(line, '[.,]'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS w FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)),
 e AS (SELECT 'initial' AS place, w[1] AS word FROM l WHERE len(w) >= 1 UNION ALL SELECT 'final', w[-1] FROM l WHERE len(w) >= 2 UNION ALL SELECT 'middle', unnest(w[2:-2]) FROM l WHERE len(w) >= 3),
 c AS (SELECT place, word, count(*) AS n FROM e GROUP BY ALL)"""


def _edges(spark, sf_dir):
    lines = documents(spark, sf_dir).select(F.explode(F.split("text", "\n")).alias("line"))
    return S.edge_words(lines, "line")


@query(f"WITH {EDGES}, r AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY n DESC, word) AS rank FROM c) SELECT place, word, n, rank FROM r WHERE rank <= 10")
def line_position_words(spark, sf_dir):
    return S.top_within(_edges(spark, sf_dir), "word", 10, "place").select("place", "word", "n", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {EDGES}, t AS (SELECT place, sum(n) AS total FROM c GROUP BY place) SELECT place, CAST(total AS BIGINT) AS total, count(*) AS types, round(-sum(n / total * log2(n / total)), 6) AS entropy FROM c JOIN t USING (place) GROUP BY place, total")
def line_position_entropy(spark, sf_dir):
    return S.entropy(_edges(spark, sf_dir), "place").select("place", "total", F.col("distinct").alias("types"), F.round("entropy", 6).alias("entropy"))


@query(f"WITH {WORDS}, c AS (SELECT lang, word, count(*) AS n FROM words GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank FROM c) SELECT lang, word, n, rank FROM r WHERE rank <= 5")
def top_words_by_lang(spark, sf_dir):
    return S.top_within(S.counts(words(spark, sf_dir, "lang"), "word", "lang"), "word", 5, "lang").select("lang", "word", "n", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {WORDS} SELECT DISTINCT word FROM words WHERE lang = 'en' AND word NOT IN (SELECT word FROM words WHERE lang = 'fr')")
def vocab_only_a(spark, sf_dir):
    return S.vocabulary_only_in(words(spark, sf_dir, "lang"), "lang", "en", "fr")


@query(f"WITH {WORDS} SELECT DISTINCT word FROM words WHERE lang = 'fr' AND word NOT IN (SELECT word FROM words WHERE lang = 'en')")
def vocab_only_b(spark, sf_dir):
    return S.vocabulary_only_in(words(spark, sf_dir, "lang"), "lang", "fr", "en")


@query("SELECT coalesce(source, 'unknown') AS source, count(DISTINCT doc_id) AS n_pages, count(*) AS n_lines, CAST(sum(n_chars) AS BIGINT) AS n_chars, CAST(sum(w) AS BIGINT) AS n_words FROM (SELECT *, len(list_filter(regexp_split_to_array(text, '[.,\\s]+'), lambda x: x <> '')) AS w FROM documents) GROUP BY 1")
def section_stats(spark, sf_dir):
    return S.group_summary(documents(spark, sf_dir).withColumn("w", F.size(T.spaced_words(F.col("text")))), "source", "doc_id", "n_chars", "w")


@query("SELECT coalesce(lang, 'unknown') AS lang, count(DISTINCT doc_id) AS n_pages, count(*) AS n_lines, CAST(sum(n_chars) AS BIGINT) AS n_chars, CAST(sum(w) AS BIGINT) AS n_words FROM (SELECT *, len(list_filter(regexp_split_to_array(text, '[.,\\s]+'), lambda x: x <> '')) AS w FROM documents) GROUP BY 1")
def language_stats(spark, sf_dir):
    return S.group_summary(documents(spark, sf_dir).withColumn("w", F.size(T.spaced_words(F.col("text")))), "lang", "doc_id", "n_chars", "w")


@query("SELECT lang, count(*) AS n, round(avg(len(list_filter(regexp_split_to_array(text, '[.,\\s]+'), lambda x: x <> ''))), 6) AS mean_words FROM documents GROUP BY lang")
def value_counts_by_lang(spark, sf_dir):
    return documents(spark, sf_dir).groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg(F.size(T.spaced_words(F.col("text")))), 6).alias("mean_words"))


@query("""WITH p AS (SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS v FROM documents) SELECT count(*) AS n, min(v) AS least, max(v) AS greatest, round(avg(v), 6) AS mean, (SELECT v FROM p ORDER BY v LIMIT 1 OFFSET (SELECT count(*) // 2 FROM p)) AS upper_median FROM p""")
def lines_per_page_median(spark, sf_dir):
    per_page = documents(spark, sf_dir).select(F.size(F.split("text", "\n")).cast("long").alias("v"))
    return S.spread(per_page, "v").select("n", "least", "greatest", F.round("mean", 6).alias("mean"), "upper_median")


@query("""WITH p AS (SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n FROM documents) (SELECT 'most' AS kind, doc_id, n FROM p ORDER BY n DESC, doc_id LIMIT 5) UNION ALL (SELECT 'fewest', doc_id, n FROM p ORDER BY n, doc_id LIMIT 5)""")
def pages_with_most_lines(spark, sf_dir):
    per_page = documents(spark, sf_dir).select("doc_id", F.size(F.split("text", "\n")).cast("long").alias("n"))
    ends = [per_page.orderBy(o, "doc_id").limit(5).select(F.lit(k).alias("kind"), "doc_id", "n") for k, o in (("most", F.desc("n")), ("fewest", F.asc("n")))]
    return ends[0].union(ends[1])


@query("""WITH d AS (SELECT doc_id, CAST(length(text) AS BIGINT) AS c, CAST(len(list_filter(regexp_split_to_array(text, '[.,\\s]+'), lambda x: x <> '')) AS BIGINT) AS w FROM documents)
 SELECT count(*) AS lines, count(DISTINCT doc_id) AS pages, CAST(sum(c) AS BIGINT) AS characters, CAST(sum(w) AS BIGINT) AS words, round(count(*) / count(DISTINCT doc_id), 6) AS lines_per_page, round(sum(c) / count(*), 6) AS chars_per_line, round(sum(w) / count(*), 6) AS words_per_line FROM d""")
def corpus_overview(spark, sf_dir):
    sized = documents(spark, sf_dir).select("doc_id", F.char_length("text").cast("long").alias("c"), F.size(T.spaced_words(F.col("text"))).cast("long").alias("w"))
    got = S.overview(sized, "doc_id", "c", "w")
    return got.select("lines", "pages", "characters", "words", *(F.round(c, 6).alias(c) for c in ("lines_per_page", "chars_per_line", "words_per_line")))


def _order(k: int) -> str:
    context = " || ".join(f"lag(c, {i}) OVER w" for i in range(k, 0, -1))
    return f"""g{k} AS (SELECT {context} AS ctx, c FROM letters WINDOW w AS (ORDER BY doc_id, pos)), n{k} AS (SELECT ctx, c, count(*) AS n FROM g{k} WHERE ctx IS NOT NULL GROUP BY ALL),
 e{k} AS (SELECT -sum(n * log2(n / t)) / sum(n) AS h FROM n{k} JOIN (SELECT ctx, sum(n) AS t FROM n{k} GROUP BY ctx) USING (ctx))"""


@query(f"""WITH {LETTERS.replace('letters AS (', 'letters AS MATERIALIZED (')}, s AS (SELECT c, count(*) AS n FROM letters GROUP BY c), t AS (SELECT sum(n) AS t, count(*) AS k FROM s), {_order(1)}, {_order(2)}, {_order(3)}
 SELECT CAST(t AS BIGINT) AS letters, round(log2(k), 6) AS h0, round((SELECT -sum(n / t * log2(n / t)) FROM s), 6) AS h1, round(e1.h, 6) AS h2, round(e2.h, 6) AS h3, round(e3.h, 6) AS h4 FROM t, e1, e2, e3""")
def letter_entropies(spark, sf_dir):
    return S.letter_entropies(documents(spark, sf_dir), "text", "doc_id").select("letters", *(F.round(f"h{i}", 6).alias(f"h{i}") for i in range(5)))


@query()
def compression_ratio(spark, sf_dir):
    """Real compressors have no SQL form."""
    return S.corpus_compression(documents(spark, sf_dir), "text", "doc_id")


@query()
def shuffled_baseline(spark, sf_dir):
    """A seeded shuffle has no SQL form."""
    return S.corpus_compression(documents(spark, sf_dir), "text", "doc_id", shuffled=True)


_JOINED = "j AS (SELECT string_agg(coalesce(text, ''), ' ' ORDER BY doc_id, text) AS data FROM documents)"


@query(f"WITH {_JOINED}, n AS (SELECT strlen(data) AS n FROM j) SELECT k AS block, CAST(least({R.BLOCK}, n - k * {R.BLOCK}) AS BIGINT) AS n_bytes FROM n, range(0, (n + {R.BLOCK} - 1) // {R.BLOCK}) r(k)")
def stream_blocks(spark, sf_dir):
    """How the corpus is cut for the compressors."""
    return S.corpus_compression(documents(spark, sf_dir), "text", "doc_id").where("block >= 0").select("block", "n_bytes")


@query(f"WITH {_JOINED} SELECT c, count(*) AS n FROM (SELECT unnest(string_split(data, '')) AS c FROM j) WHERE c <> '' GROUP BY c")
def shuffled_letters(spark, sf_dir):
    """The characters of all blocks of the shuffled corpus, which are those of the corpus."""
    corpus, letters = R.shuffled_blocks(documents(spark, sf_dir), "text")

    def counted(batches):
        for batch in batches:
            for block in batch.column("id").to_pylist():
                counts = corpus.counts(block)
                yield pa.RecordBatch.from_pydict({"c": [chr(x) for x in letters], "n": counts}, pa.schema([("c", pa.string()), ("n", pa.int64())]))

    blocks = spark.range(corpus.blocks).mapInArrow(counted, "c string, n long")
    return blocks.groupBy("c").agg(F.sum("n").alias("n"))
