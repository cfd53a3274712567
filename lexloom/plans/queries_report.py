"""Queries over reports: merges of tenants, totals, histograms, dashboard pages, differences, each with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assembly, language, reports, wordforms
from ..operators.materialise import cut
from . import sql as S
from .common import add, load, spread
from .queries_text import GLOSSARY, TERM_TOKENS, conversation_tokens, doc_tokens, glossary

QUERIES: dict = {}
ORACLES: dict = {}
query = add(QUERIES, ORACLES)

#: a report made of the documents' tokens: tenants are sources, facts follow from letters
_REPORT = """report AS MATERIALIZED (SELECT game, language, token, lower(token) AS token_lower,
  CASE length(token) % 3 WHEN 0 THEN 'tb_only' WHEN 1 THEN 'corpus_only' ELSE 'tb_and_corpus' END AS origin_class,
  CASE WHEN length(token) % 2 = 0 THEN ['tb_filtered_base', 'corpus_aff_form'] ELSE ['corpus_aff_form'] END AS lineage_tags,
  length(token) % 2 = 0 AS in_tb_tokens, length(token) % 5 = 0 AS in_filtered_dic_base, true AS is_corpus_form, ends_with(token, 'e') AS is_ghost_form, token <> lower(token) AS is_casing_inferred,
  CASE WHEN ends_with(token, 'n') THEN ['N', 'U'] WHEN ends_with(token, 'e') THEN ['S'] ELSE []::VARCHAR[] END AS assigned_flags, [lower(token)] AS source_base_words,
  CASE WHEN length(token) % 4 = 0 THEN 'kept_neologism' WHEN length(token) % 4 = 1 THEN 'removed_known_word' ELSE '' END AS filter_status,
  CASE WHEN length(token) % 4 = 1 THEN 'exact_or_affix' ELSE '' END AS filter_match_type
  FROM (SELECT DISTINCT source AS game, lang AS language, token FROM tok))"""
_WITH = (S.TOK, _REPORT)


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tokens of the documents."""
    rows = doc_tokens(spark, sf_dir).select(F.col("source").alias("game"), F.col("lang").alias("language"), "token").distinct()
    n, t = F.char_length("token"), F.col("token")
    texts = lambda *xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    none = texts()
    rows = rows.withColumns(
        {
            "token_lower": F.lower(t),
            "origin_class": F.when(n % 3 == 0, "tb_only").when(n % 3 == 1, "corpus_only").otherwise("tb_and_corpus"),
            "lineage_tags": F.when(n % 2 == 0, texts("tb_filtered_base", "corpus_aff_form")).otherwise(texts("corpus_aff_form")),
            "in_tb_tokens": n % 2 == 0,
            "in_filtered_dic_base": n % 5 == 0,
            "is_corpus_form": F.lit(True),
            "is_ghost_form": F.endswith(t, F.lit("e")),
            "is_casing_inferred": t != F.lower(t),
            "assigned_flags": F.when(F.endswith(t, F.lit("n")), texts("N", "U")).when(F.endswith(t, F.lit("e")), texts("S")).otherwise(none),
            "source_base_words": F.array(F.lower(t)),
            "filter_status": F.when(n % 4 == 0, "kept_neologism").when(n % 4 == 1, "removed_known_word").otherwise(""),
            "filter_match_type": F.when(n % 4 == 1, "exact_or_affix").otherwise(""),
        }
    )
    return rows.withColumns({c: none for c in reports.LISTS if c not in rows.columns})


def _united(column: str) -> str:
    return f"array_to_string(list_sort(list_distinct(flatten(list({column})))), ' | ') AS {column}"


@query(S.statement(*_WITH, select=f"""SELECT language, token_lower, first(token ORDER BY length(token), lower(token), encode(token)) AS token,
  CASE WHEN count(DISTINCT origin_class) > 1 THEN 'mixed' ELSE min(origin_class) END AS origin_class, {_united('lineage_tags')}, {_united('assigned_flags')}, {_united('source_base_words')},
  bool_or(in_tb_tokens) AS in_tb_tokens, bool_or(in_filtered_dic_base) AS in_filtered_dic_base, bool_or(is_corpus_form) AS is_corpus_form, bool_or(is_ghost_form) AS is_ghost_form, bool_or(is_casing_inferred) AS is_casing_inferred,
  array_to_string(list_sort(list(DISTINCT game)), ' | ') AS game, count(DISTINCT game) AS source_reports_count, count(*) AS source_rows_merged,
  coalesce(array_to_string(list_sort(list(DISTINCT filter_status) FILTER (WHERE filter_status <> '')), ' | '), '') AS filter_status,
  coalesce(array_to_string(list_sort(list(DISTINCT filter_match_type) FILTER (WHERE filter_match_type <> '')), ' | '), '') AS filter_match_type FROM report GROUP BY 1, 2"""))
def cross_tenant_merge(spark, sf_dir):
    merged = reports.merge_reports(report(spark, sf_dir))
    flat = lambda c: F.array_join(c, " | ").alias(c)
    return merged.select("language", "token_lower", "token", "origin_class", flat("lineage_tags"), flat("assigned_flags"), flat("source_base_words"), *reports.BOOLEANS, "game", "source_reports_count", "source_rows_merged", "filter_status", "filter_match_type")


@query(S.statement(*_WITH, select="SELECT (SELECT count(*) FROM report) AS rows_before, count(*) AS rows_after, (SELECT count(*) FROM report) - count(*) AS rows_removed FROM (SELECT DISTINCT language, token_lower FROM report)"))
def merge_metrics(spark, sf_dir):
    rows = report(spark, sf_dir)
    return reports.merge_metrics(rows, reports.merge_reports(rows))


@query(S.statement(*_WITH, select="""SELECT count(*) AS rows, count(DISTINCT token_lower) AS distinct_token_lower, count(DISTINCT token) AS distinct_tokens_surface, count(*) FILTER (WHERE in_tb_tokens) AS in_tb_tokens,
  count(*) FILTER (WHERE in_filtered_dic_base) AS in_filtered_dic_base, count(*) FILTER (WHERE is_corpus_form) AS is_corpus_form, count(*) FILTER (WHERE is_ghost_form) AS is_ghost_form, count(*) FILTER (WHERE is_casing_inferred) AS is_casing_inferred FROM report"""))
def report_totals(spark, sf_dir):
    return reports.report_totals(report(spark, sf_dir))


@query(S.statement(*_WITH, select="""SELECT metric, value, count(*) AS rows FROM (
  SELECT 'origin_class' AS metric, origin_class AS value FROM report UNION ALL SELECT 'filter_status', CASE WHEN filter_status = '' THEN '(empty)' ELSE filter_status END FROM report
  UNION ALL SELECT 'filter_match_type', CASE WHEN filter_match_type = '' THEN '(empty)' ELSE filter_match_type END FROM report
  UNION ALL SELECT 'token_length', CASE WHEN length(token) <= 4 THEN '1-4' WHEN length(token) <= 8 THEN '5-8' WHEN length(token) <= 12 THEN '9-12' ELSE '13+' END FROM report
  UNION ALL SELECT 'lineage_tag', unnest(lineage_tags) FROM report UNION ALL SELECT 'assigned_flag', unnest(assigned_flags) FROM report) GROUP BY 1, 2"""))
def report_histograms(spark, sf_dir):
    return reports.report_histograms(report(spark, sf_dir))


@query(S.statement(*_WITH, select="""SELECT game, language, token, filter_status FROM report WHERE filter_status = '' AND is_ghost_form AND origin_class = 'tb_only'
  AND contains(lower(concat_ws(' ', token, game, language, token_lower, origin_class, filter_status, filter_match_type, array_to_string(lineage_tags, ' '), array_to_string(source_base_words, ' '), array_to_string(assigned_flags, ' '))), 'sch')"""))
def dashboard_filter(spark, sf_dir):
    chosen = reports.ReportFilter(text="SCH", origin="tb_only", status=reports.EMPTY, ghost=True)
    return reports.report_query(report(spark, sf_dir), chosen, page_size=0).select("game", "language", "token", "filter_status")


@query(S.statement(*_WITH, select="SELECT game, token, language FROM (SELECT DISTINCT game, token, language FROM report WHERE game IN ('src1', 'src2') AND language = 'de' AND NOT regexp_matches(token, '[^A-Za-z]')) ORDER BY lower(token), game, token LIMIT 120 OFFSET 120"))
def dashboard_page(spark, sf_dir):
    rows = report(spark, sf_dir).where("game IN ('src1', 'src2') AND language = 'de' AND NOT token RLIKE '[^A-Za-z]'").select("game", "token", "language")
    keyed = rows.withColumn("order_key", F.concat_ws(" ", "token", "game"))
    return reports.report_query(keyed, sort="order_key", page=2, page_size=120).drop("order_key")


@query(S.statement(*_WITH, select="SELECT value, count(*) AS rows FROM (SELECT unnest(source_base_words) AS value FROM report) GROUP BY 1 ORDER BY rows DESC, value LIMIT 12"))
def dashboard_bars(spark, sf_dir):
    return reports.bar_counts(report(spark, sf_dir), "source_base_words", 12)


@query(S.statement(*_WITH, select="""SELECT game, token, array_to_string(lineage_tags, ' | ') AS lineage_tags, array_to_string(assigned_flags, ' | ') AS assigned_flags, in_tb_tokens, '' AS flag_evidence_summary FROM report"""))
def csv_report(spark, sf_dir):
    return reports.csv_report(report(spark, sf_dir)).select("game", "token", "lineage_tags", "assigned_flags", "in_tb_tokens", "flag_evidence_summary")


_RUNS = f"""said AS MATERIALIZED (SELECT unnest({S.tokens('text')}) AS token FROM conversations),
runs AS (SELECT base_word, a, b FROM (SELECT substr(token, 1, 3) AS base_word, list(DISTINCT token) AS a FROM tok GROUP BY 1) FULL JOIN (SELECT substr(token, 1, 3) AS base_word, list(DISTINCT token) AS b FROM said GROUP BY 1) USING (base_word)),
diff AS (SELECT base_word, list_sort(list_filter(coalesce(a, []), lambda x: NOT list_contains(coalesce(b, []), x))) AS lost, list_sort(list_filter(coalesce(b, []), lambda x: NOT list_contains(coalesce(a, []), x))) AS gained, list_sort(list_filter(coalesce(a, []), lambda x: list_contains(coalesce(b, []), x))) AS kept FROM runs)"""


def _diff(spark, sf_dir) -> DataFrame:
    # all documents are the old run, all conversations the new one
    of = lambda tokens: tokens.groupBy(F.substring("token", 1, 3).alias("base_word")).agg(F.collect_set("token").alias("found_forms"))
    return wordforms.diff_wordforms(of(doc_tokens(spark, sf_dir)), of(conversation_tokens(spark, sf_dir)))


@query(S.statement(S.TOK, _RUNS, select="SELECT base_word, array_to_string(lost, ' | ') AS lost, array_to_string(gained, ' | ') AS gained, array_to_string(kept, ' | ') AS kept FROM diff"))
def wordform_diff(spark, sf_dir):
    flat = lambda c: F.array_join(c, " | ").alias(c)
    return _diff(spark, sf_dir).select("base_word", flat("lost"), flat("gained"), flat("kept"))


@query(S.statement(S.TOK, _RUNS, select="SELECT sum(len(lost))::BIGINT AS lost, sum(len(kept))::BIGINT AS kept, sum(len(gained))::BIGINT AS gained, round(sum(len(lost)) * 100.0::DOUBLE / greatest(sum(len(lost)) + sum(len(kept)), 1), 6) AS lost_percent FROM diff"))
def wordform_diff_totals(spark, sf_dir):
    return wordforms.diff_totals(_diff(spark, sf_dir))


@query("""SELECT p_partkey, CASE WHEN b AND c THEN 'tb_and_corpus' WHEN b THEN 'tb_only' WHEN c OR g THEN 'corpus_only' WHEN k THEN 'generated_casing_inference' ELSE 'generated_unknown' END AS origin_class
FROM (SELECT p_partkey, p_partkey % 2 = 0 AS b, p_partkey % 3 = 0 AS c, p_partkey % 5 = 0 AS g, p_partkey % 7 = 0 AS k FROM part)""")
def lineage_class(spark, sf_dir):
    k = F.col("p_partkey")
    return load(spark, sf_dir, "part").select("p_partkey", assembly.origin_class(k % 2 == 0, k % 3 == 0, k % 5 == 0, k % 7 == 0).alias("origin_class"))


@query("""SELECT coalesce(a.c_nationkey, b.s_nationkey) AS nationkey, a.n AS "left", b.n AS "right", a.n IS NOT DISTINCT FROM b.n AS equal FROM (SELECT c_nationkey, count(*) // 10 AS n FROM customer GROUP BY 1) a
FULL JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) b ON a.c_nationkey = b.s_nationkey""")
def run_parity(spark, sf_dir):
    a = load(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.expr("count(*) div 10").alias("signature"))
    b = load(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count("*").alias("signature"))
    return reports.parity(a, b, ["nationkey"])


@query("""SELECT count(*) AS words, count(*) FILTER (WHERE v) AS correct, count(*) FILTER (WHERE NOT v) AS misspelled, count(*) FILTER (WHERE v IS NULL) AS unknown,
round(count(*) FILTER (WHERE v) * 100.0::DOUBLE / count(*), 6) AS correct_percent, round(count(*) FILTER (WHERE NOT v) * 100.0::DOUBLE / count(*), 6) AS misspelled_percent
FROM (SELECT CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END AS v FROM part)""")
def verdict_summary(spark, sf_dir):
    verdict = F.when(F.col("p_size") % 3 == 0, True).when(F.col("p_size") % 3 == 1, False)
    return reports.verdict_summary(load(spark, sf_dir, "part").select(F.col("p_name").alias("word"), verdict.alias("is_correct")))


def _trigrams(expression: str) -> str:
    return f"list_transform(range(1, length({expression}) - 1), lambda i: substr({expression}, i, 3))"


_DETECTED = S.squeezed(S.replaced(S.replaced(S.stripped_tags("text"), r"\[[^\]]*\]", " "), r"\{[^}]*\}", " "))
_LANGUAGES = f"""counted AS (SELECT lang, gram, count(*) AS n FROM (SELECT lang, unnest({_trigrams('p')}) AS gram FROM (SELECT lang, ' ' || lower(text) || ' ' AS p FROM documents WHERE lang IS NOT NULL)) GROUP BY 1, 2),
profile AS MATERIALIZED (SELECT lang, gram, round(ln((n + 1.0::DOUBLE) / (total + 1.0::DOUBLE)), 6) AS weight FROM (
  SELECT *, sum(n) OVER (PARTITION BY lang) AS total, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS nth FROM counted) WHERE nth <= 2000),
clean AS (SELECT conv_id || '.' || turn AS key, {_DETECTED} AS t FROM conversations),
stats AS MATERIALIZED (SELECT key, t, len(list_filter(string_split_regex(t, '\\s+'), lambda w: w <> '')) AS words, length(regexp_replace(t, '\\P{{L}}', '', 'g')) AS letters FROM clean),
tried AS MATERIALIZED (SELECT *, words > 0 AND letters >= 3 AND letters::DOUBLE / greatest(length(t), 1) >= 0.35::DOUBLE AND NOT (t = upper(t) AND t <> lower(t) AND letters <= 4) AS try FROM stats),
asked AS (SELECT key, gram, count(*) AS k FROM (SELECT key, unnest({_trigrams('p')}) AS gram FROM (SELECT key, ' ' || lower(t) || ' ' AS p FROM tried WHERE try)) GROUP BY 1, 2),
scored AS (SELECT a.key, l.lang, sum(a.k * coalesce(p.weight, -14.0::DOUBLE)) / sum(a.k) AS score FROM asked a CROSS JOIN (SELECT DISTINCT lang FROM profile) l LEFT JOIN profile p ON p.lang = l.lang AND p.gram = a.gram GROUP BY 1, 2),
odds AS (SELECT key, lang, exp((score - max(score) OVER (PARTITION BY key)) * 4) AS o FROM scored),
shares AS (SELECT key, lang, round(o / sum(o) OVER (PARTITION BY key), 6) AS c FROM odds),
found AS (SELECT key, max(c) FILTER (WHERE lang = 'de') AS target, max(c) FILTER (WHERE lang = 'en') AS en, max(c) FILTER (WHERE lang = 'fr') AS fr FROM shares GROUP BY 1)"""


@query(S.statement(_LANGUAGES, select="""SELECT key, words AS word_count, coalesce(target, 1.0::DOUBLE) AS confidence, CASE WHEN try AND words >= 7 THEN 0.12::DOUBLE ELSE 0.0::DOUBLE END AS threshold,
  coalesce(CASE WHEN words >= 7 THEN target < 0.12::DOUBLE ELSE target < en AND target < fr END, false) AS is_wrong FROM tried LEFT JOIN found USING (key)"""))
def language_filter(spark, sf_dir):
    """Strings tagged with a language that their letters do not bear out; the scores are our own."""
    docs = spread(load(spark, sf_dir, "documents"))
    table = language.profiles(docs)
    rows = load(spark, sf_dir, "conversations").select(F.concat_ws(".", "conv_id", "turn").alias("key"), "text")
    return language.language_filter(rows, table, lang="de").select("key", "word_count", "confidence", "threshold", "is_wrong")


def _pair(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Corpus tokens, glossary rows, the words of both and the dictionary of the German pair, all of each."""
    from ..operators import tokens as O
    from .queries_affix import dictionary

    tokens = cut(doc_tokens(spark, sf_dir).where("lang = 'de'"), "tokens")
    rows = cut(O.glossary_tokens(glossary(spark, sf_dir)), "glossary-tokens")
    words = cut(rows.select("token").unionByName(tokens.select("token")).distinct(), "words")
    return tokens, rows, words, dictionary(tokens).drop("lang")


_DERIVED = """SELECT w.{key}, r.flag, r.kind, CASE r.kind WHEN 'SFX' THEN left(w.{word}, length(w.{word}) - length(strip)) || addn ELSE addn || substr(w.{word}, length(strip) + 1) END AS form
  FROM {source} w JOIN rules r ON r.lang = 'de'{on} WHERE (r.kind = 'SFX' AND ends_with(w.{word}, strip) AND (cond = '.' OR regexp_matches(w.{word}, '(?:' || cond || ')$')))
     OR (r.kind = 'PFX' AND starts_with(w.{word}, strip) AND (cond = '.' OR regexp_matches(w.{word}, '^(?:' || cond || ')')))"""
#: the German pair from its tokens to its report: audit, word forms and quorum, assembly
_PAIR = (
    "vocabulary AS MATERIALIZED (SELECT token FROM tok WHERE lang = 'de' UNION SELECT token FROM terms)",
    "keyed AS (SELECT lower(token) AS low, list_sort(list(DISTINCT trim(key))) AS keys FROM terms WHERE tracked AND trim(key) <> '' GROUP BY 1)",
    """checked AS MATERIALIZED (SELECT v.token, lower(v.token) AS low, f.form IS NULL AS is_new, coalesce(k.keys, []) AS keys FROM vocabulary v
      LEFT JOIN (SELECT DISTINCT form FROM forms WHERE lang = 'de') f ON f.form = lower(v.token) LEFT JOIN keyed k ON k.low = lower(v.token))""",
    "kept AS MATERIALIZED (SELECT token, low FROM checked WHERE is_new)",
    "lowers AS MATERIALIZED (SELECT DISTINCT low AS base FROM kept)",
    f"derived AS MATERIALIZED ({_DERIVED.format(key='base', word='base', source='lowers', on='')})",
    "prefixed AS (SELECT d.base, p.addn || d.form AS form FROM derived d JOIN rules p ON p.lang = 'de' AND p.kind = 'PFX' AND d.kind = 'SFX' WHERE p.cond = '.' OR regexp_matches(d.form, '^(?:' || p.cond || ')'))",
    "spelled AS MATERIALIZED (SELECT lower(token) AS low, list_sort(list(DISTINCT token)) AS spellings FROM tok WHERE lang = 'de' GROUP BY 1)",
    "hits AS (SELECT base, list_sort(list(DISTINCT spelling)) AS found FROM (SELECT m.base, unnest(c.spellings) AS spelling FROM (SELECT base, form FROM derived UNION SELECT base, form FROM prefixed) m JOIN spelled c ON c.low = m.form WHERE m.form <> m.base) GROUP BY 1)",
    """tested AS (SELECT d.base, d.flag, count(*) AS n, count(c.low) AS hits FROM (SELECT DISTINCT base, flag, form FROM derived WHERE flag IN ('N', 'U') AND form <> base) d LEFT JOIN spelled c ON c.low = d.form GROUP BY 1, 2)""",
    """proof AS (SELECT base, coalesce(list(flag ORDER BY flag) FILTER (WHERE hits > 0 AND hits / n >= 0.5), []) AS valid, list(flag || ':' || hits || '/' || n ORDER BY flag) AS evidence FROM tested GROUP BY 1)""",
    """found AS MATERIALIZED (SELECT k.token AS base_word, coalesce(h.found, []) AS found, coalesce(p.valid, []) AS valid, coalesce(p.evidence, []) AS evidence
      FROM kept k LEFT JOIN hits h ON h.base = k.low LEFT JOIN proof p ON p.base = k.low WHERE len(coalesce(h.found, [])) + len(coalesce(p.valid, [])) > 0)""",
    "sprung AS MATERIALIZED (SELECT base_word, unnest(found) AS form FROM found)",
    "removed AS (SELECT DISTINCT low FROM checked WHERE NOT is_new)",
    """confirmed AS MATERIALIZED (SELECT form, tag, parent FROM (SELECT token AS form, 'tb_filtered_base' AS tag, token AS parent FROM kept UNION SELECT form, 'corpus_aff_form', base_word FROM sprung) WHERE lower(form) NOT IN (SELECT low FROM removed))""",
    """casing AS (SELECT token AS original, low AS inferred FROM kept WHERE token[1] = upper(token[1]) AND token[1] <> lower(token[1]) AND token <> low AND low NOT IN (SELECT token FROM kept) AND low IN (SELECT form FROM sprung))""",
    "everything AS MATERIALIZED (SELECT * FROM confirmed UNION SELECT inferred, 'casing_inference', original FROM casing)",
    "entries2 AS (SELECT token FROM kept UNION SELECT inferred FROM casing)",
    """assigned AS MATERIALIZED (SELECT e.token, list_sort(list_distinct(list_concat(['U'], coalesce(flatten(list(f.valid)), [])))) AS flags FROM entries2 e LEFT JOIN found f
      ON f.base_word IN (e.token, lower(e.token), upper(e.token[1]) || substr(e.token, 2)) GROUP BY 1)""",
    "flagged AS (SELECT token, unnest(flags) AS own FROM assigned)",
    f"generated AS (SELECT token AS source, form FROM ({_DERIVED.format(key='token', word='token', source='flagged', on=' AND r.flag = w.own')}))",
    "dropped AS (SELECT DISTINCT form FROM generated WHERE form NOT IN (SELECT token FROM assigned))",
    "built AS (SELECT form AS token, list_sort(list(DISTINCT tag)) AS tags, list_sort(list(DISTINCT parent)) AS parents FROM everything WHERE form NOT IN (SELECT form FROM dropped) GROUP BY 1)",
    """by_base AS (SELECT token, list(nth ORDER BY nth) AS nths, flatten(list(ks ORDER BY nth)) AS keys, flatten(list(es ORDER BY nth)) AS evidence FROM (
      SELECT b.token, b.nth, coalesce(c.keys, []) AS ks, coalesce(list_transform(f.evidence, lambda x: b.parent || ':' || x), []) AS es
      FROM (SELECT token, unnest(parents) AS parent, unnest(range(len(parents))) AS nth FROM built) b
      LEFT JOIN (SELECT low, any_value(keys) AS keys FROM checked WHERE is_new GROUP BY 1) c ON c.low = lower(b.parent) LEFT JOIN found f ON f.base_word = b.parent) GROUP BY 1)""",
    "related AS (SELECT lower(form) AS low, list_sort(list(DISTINCT base_word)) AS bases FROM sprung GROUP BY 1)",
    "own AS (SELECT low, bool_or(is_new) AS is_new, any_value(keys) AS keys FROM checked GROUP BY 1)",
    """joined AS (SELECT b.*, a.flags, f.valid, o.low IS NOT NULL AS known, o.is_new, r.bases,
        list_filter(list_concat(CASE WHEN o.is_new THEN o.keys ELSE [] END, y.keys), lambda x: x <> '') AS all_keys, y.evidence
      FROM built b LEFT JOIN assigned a USING (token) LEFT JOIN found f ON f.base_word = b.token LEFT JOIN own o ON o.low = lower(b.token) LEFT JOIN related r ON r.low = lower(b.token) LEFT JOIN by_base y USING (token))""",
    """reported AS (SELECT *, list_reduce(list_prepend([]::VARCHAR[], list_transform(all_keys, lambda x: [x])), lambda x, y: CASE WHEN list_contains(x, y[1]) THEN x ELSE list_concat(x, y) END) AS one_each FROM joined)""",
    "described AS (SELECT *, array_to_string(one_each, ' | ') AS tb_key, coalesce(one_each[1], '') AS k FROM reported)",
)


def _flat(expression: str, name: str) -> str:
    return f"coalesce(array_to_string({expression}, ' | '), '') AS {name}"


@query(S.statement(*S.AFFIX, GLOSSARY, TERM_TOKENS, *_PAIR, select=f"""SELECT 'g' AS game, 'de' AS language, token, lower(token) AS token_lower,
  CASE WHEN list_contains(tags, 'tb_filtered_base') AND list_contains(tags, 'corpus_aff_form') THEN 'tb_and_corpus' WHEN list_contains(tags, 'tb_filtered_base') THEN 'tb_only' WHEN list_contains(tags, 'corpus_aff_form') THEN 'corpus_only' ELSE 'generated_casing_inference' END AS origin_class,
  {_flat('tags', 'lineage_tags')}, known AS in_tb_tokens, tb_key,
  CASE WHEN len(list_filter(string_split(k, '.'), lambda x: trim(x) <> '')) >= 2 THEN trim(list_filter(string_split(k, '.'), lambda x: trim(x) <> '')[1]) || ':' || trim(list_filter(string_split(k, '.'), lambda x: trim(x) <> '')[2]) ELSE k END AS tb_source_entity,
  coalesce(is_new, false) AS in_filtered_dic_base, list_contains(tags, 'corpus_aff_form') AS is_corpus_form, false AS is_ghost_form, list_contains(tags, 'casing_inference') AS is_casing_inferred,
  {_flat('parents', 'source_base_words')}, {_flat('flags', 'assigned_flags')}, CASE WHEN list_contains(flags, 'U') THEN 'U' ELSE '' END AS mandatory_flags_assigned,
  {_flat("list_filter(flags, lambda x: list_contains(valid, x))", 'validated_flags_assigned')}, {_flat('valid', 'validated_flags_candidates')},
  CASE WHEN NOT known THEN '' WHEN is_new THEN 'kept_neologism' ELSE 'removed_known_word' END AS filter_status, CASE WHEN known AND NOT is_new THEN 'exact_or_affix' ELSE '' END AS filter_match_type,
  coalesce(array_to_string(evidence, ' ; '), '') AS flag_evidence_summary, {_flat('bases', 'step4_related_bases')} FROM described"""))
def consolidated_report(spark, sf_dir):
    """Glossary, audit, word forms and assembly of one pair joined into its report."""
    from ..operators import affix, filtering
    from ..operators import tokens as O
    from .queries_affix import rule_table

    tokens, rows, words, entries = _pair(spark, sf_dir)
    rules = rule_table(spark, "de")
    forms = affix.expand(entries, rules, word="base_lower").select("form").distinct()
    audits = cut(filtering.audit(words, forms, token_keys=O.token_keys(rows).drop("game", "lang")), "audits")
    kept = audits.where("status = 'kept_neologism'").select("token")
    cases = cut(O.case_map(tokens.select("token"), keys=[]), "cases")
    found = cut(wordforms.corpus_wordforms(kept.select(F.col("token").alias("base_word")), rules, cases, lang="de", flags=["N", "U"]), "found")
    assembled = cut(assembly.assemble(kept, found, rules, lang="de", mandatory=["U"], audits=audits), "assembly")
    return reports.csv_report(reports.consolidated_report(assembled, audits, words, kept, found, game="g", lang="de"))
