"""Queries over affix expansion, dictionary filtering, word forms and assembly, each with DuckDB SQL.

The dictionaries are made of the documents' own short words; rules are a small fixed table. Compounds, flags,
pruning and exports run over words of every length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..operators import affix, assembly, compound, filtering, wordforms
from ..operators import tokens as O
from ..operators.materialise import cut
from . import sql as S
from .common import add
from .queries_text import conversation_tokens, doc_tokens

QUERIES: dict = {}
ORACLES: dict = {}
query = add(QUERIES, ORACLES)


def rule_table(spark: SparkSession, lang: str | None = None, chained: bool = False) -> DataFrame:
    rows = [(la, kind, flag, True, n, strip, new, (["D"] if chained and flag == "G" else []), cond) for n, (la, kind, flag, strip, new, cond) in enumerate(S.RULES) if lang in (None, la)]
    df = spark.createDataFrame(rows, "lang string, " + affix.RULES)
    return df.drop("lang") if lang else df


def dictionary(tokens: DataFrame) -> DataFrame:
    """(lang, base_lower, flags): words of three or four letters of at least five documents, all flags."""
    short = tokens.where(F.char_length("token").between(3, 4)).groupBy("lang", F.lower("token").alias("base_lower")).agg(F.count_distinct("doc_id").alias("n")).where("n >= 5")
    flags = F.create_map(*[x for la in sorted({r[0] for r in S.RULES}) for x in (F.lit(la), F.array(*[F.lit(f) for f in dict.fromkeys(r[2] for r in S.RULES if r[0] == la)]))])
    return short.select("lang", "base_lower", F.coalesce(F.try_element_at(flags, F.col("lang")), F.array().cast("array<string>")).alias("flags"))


def all_forms(spark, tokens: DataFrame) -> DataFrame:
    return affix.expand(dictionary(tokens), rule_table(spark), keys=["lang"], word="base_lower")


@query(S.statement(*S.AFFIX, select="SELECT DISTINCT t.lang, t.token FROM tok t WHERE NOT EXISTS (SELECT 1 FROM forms f WHERE f.lang = t.lang AND f.form = lower(t.token))"))
def neologisms_by_lang(spark, sf_dir):
    tokens = cut(doc_tokens(spark, sf_dir), "tokens")
    forms = filtering.dictionary_forms(dictionary(tokens), rule_table(spark), keys=["lang"])
    return filtering.remove_known(tokens.select("lang", "token").distinct(), forms, keys=["lang"]).select("lang", "token")


@query(S.statement(S.TOK, S.RULES_CTE, S.ENTRIES_CTE, S.ONE_CTE, select="SELECT DISTINCT lang, base, flag, form FROM one WHERE form <> base"))
def affix_forms_by_flag(spark, sf_dir):
    alone = dictionary(doc_tokens(spark, sf_dir)).select("lang", "base_lower", F.explode("flags").alias("flag"))
    made = affix.expand(alone.withColumn("flags", F.array("flag")), rule_table(spark), keys=["lang"], word="base_lower", by_flag=True)
    return made.where(~F.contains("flag", F.lit("+"))).select("lang", "base", "flag", "form").distinct()


@query(S.statement(*S.AFFIX, select="SELECT lang, base, form FROM forms"))
def affix_expansion_crossed(spark, sf_dir):
    return all_forms(spark, doc_tokens(spark, sf_dir))


@query(S.statement(S.TOK, S.RULES_CTE, S.ENTRIES_CTE, S.ONE_CTE, select="""SELECT DISTINCT base, form FROM (
  SELECT base, base AS form FROM entries WHERE lang = 'en' UNION ALL SELECT base, form FROM one WHERE lang = 'en' AND flag IN ('G', 'D')
  UNION ALL SELECT base, form || 'ed' FROM one WHERE lang = 'en' AND flag = 'G')"""))
def affix_expansion_chained(spark, sf_dir):
    entries = dictionary(doc_tokens(spark, sf_dir)).where("lang = 'en'").withColumn("flags", F.array(F.lit("G"), F.lit("D")))
    return affix.expand(entries, rule_table(spark, "en", chained=True), word="base_lower")


@query(S.statement(S.TOK, S.RULES_CTE, S.ENTRIES_CTE, select=f"""SELECT DISTINCT lower(t.token) AS token_lower FROM (SELECT DISTINCT token FROM tok WHERE lang = 'de') t
  WHERE EXISTS (SELECT 1 FROM entries e WHERE e.lang = 'de' AND e.base = lower(t.token))
     OR EXISTS (SELECT 1 FROM entries e, rules r WHERE e.lang = 'de' AND r.lang = 'de' AND r.kind = 'SFX' AND ends_with(e.base, strip) AND (cond = '.' OR regexp_matches(e.base, '(?:' || cond || ')$')) AND {S.SUFFIXED.format(w='e.base')} = lower(t.token))
     OR EXISTS (SELECT 1 FROM entries e, rules r WHERE e.lang = 'de' AND r.lang = 'de' AND r.kind = 'PFX' AND (cond = '.' OR regexp_matches(e.base, '^(?:' || cond || ')')) AND addn || substr(e.base, length(strip) + 1) = lower(t.token))
     OR EXISTS (SELECT 1 FROM entries e, rules r, rules p WHERE e.lang = 'de' AND r.lang = 'de' AND r.kind = 'SFX' AND p.lang = 'de' AND p.kind = 'PFX' AND ends_with(e.base, r.strip) AND (r.cond = '.' OR regexp_matches(e.base, '(?:' || r.cond || ')$'))
        AND p.addn || left(e.base, length(e.base) - length(r.strip)) || r.addn = lower(t.token))"""))
def reverse_lookup(spark, sf_dir):
    tokens = cut(doc_tokens(spark, sf_dir), "tokens")
    words = tokens.where("lang = 'de'").select(F.lower("token").alias("token_lower"))
    return affix.known_by_reverse_lookup(words, dictionary(tokens).where("lang = 'de'"), rule_table(spark, "de"), base="base_lower")


_AUDIT = """audit AS MATERIALIZED (SELECT DISTINCT t.lang, t.token, lower(t.token) AS token_lower,
  CASE WHEN f.form IS NULL THEN 'kept_neologism' ELSE 'removed_known_word' END AS status, CASE WHEN f.form IS NULL THEN '' ELSE 'exact_or_affix' END AS match_type
  FROM tok t LEFT JOIN (SELECT DISTINCT lang, form FROM forms) f ON f.lang = t.lang AND f.form = lower(t.token))"""


def audits(spark, tokens: DataFrame) -> DataFrame:
    forms = filtering.dictionary_forms(dictionary(tokens), rule_table(spark), keys=["lang"])
    return filtering.audit(tokens, forms, keys=["lang"])


@query(S.statement(*S.AFFIX, _AUDIT, select="SELECT lang, token, token_lower, '' AS tb_key, status, match_type FROM audit"))
def filter_audit(spark, sf_dir):
    return audits(spark, cut(doc_tokens(spark, sf_dir), "tokens"))


@query(S.statement(*S.AFFIX, _AUDIT, select="SELECT lang, count(*) AS tokens, count(*) FILTER (WHERE status = 'kept_neologism') AS kept, count(*) FILTER (WHERE status <> 'kept_neologism') AS removed, round(count(*) FILTER (WHERE status <> 'kept_neologism') * 100.0::DOUBLE / count(*), 6) AS removal_rate FROM audit GROUP BY 1"))
def filter_summary(spark, sf_dir):
    return filtering.filter_summary(audits(spark, cut(doc_tokens(spark, sf_dir), "tokens")), keys=["lang"])


@query(S.statement(*S.AFFIX, _AUDIT, select="""SELECT token, CASE WHEN bool_or(status = 'kept_neologism') THEN 'kept_neologism' ELSE 'removed_known_word' END AS status,
  CASE WHEN bool_or(match_type <> '') THEN 'exact_or_affix' ELSE '' END AS match_type, array_to_string(list_sort(list(DISTINCT lang)), ' | ') AS tb_key FROM audit GROUP BY 1"""))
def merged_audits(spark, sf_dir):
    rows = audits(spark, cut(doc_tokens(spark, sf_dir), "tokens")).withColumn("tb_key", F.col("lang"))
    return filtering.merge_audits(rows, F.col("lang"))


_ROLES = """begins AS (SELECT DISTINCT base AS form FROM entries WHERE lang = 'de'), ends AS (SELECT DISTINCT form FROM forms WHERE lang = 'de'),
words AS MATERIALIZED (SELECT DISTINCT lower(token) AS w FROM tok WHERE lang = 'de')"""


@query(S.statement(*S.AFFIX, _ROLES, select="""SELECT DISTINCT w AS token_lower, l AS head, r AS tail FROM (SELECT w, left(w, i) AS l, substr(w, i + 1) AS r FROM (SELECT w, unnest(range(3, length(w) - 2)) AS i FROM words WHERE length(w) >= 6))
  WHERE l IN (SELECT form FROM begins) AND r IN (SELECT form FROM ends)"""))
def two_part_compounds(spark, sf_dir):
    tokens = cut(doc_tokens(spark, sf_dir), "tokens")
    entries = dictionary(tokens).where("lang = 'de'")
    forms = affix.expand(entries, rule_table(spark, "de"), word="base_lower")
    words = tokens.where("lang = 'de'").select(F.lower("token").alias("token_lower")).distinct()
    pairs = words.select("token_lower", F.explode(compound.two_part_split(F.col("token_lower"), 3)).alias("p")).select("token_lower", F.col("p.left").alias("head"), F.col("p.right").alias("tail"))
    ends = forms.select(F.col("form").alias("tail")).distinct()
    return pairs.join(ends, "tail", "left_semi").join(entries.select(F.col("base_lower").alias("head")).distinct(), "head", "left_semi").select("token_lower", "head", "tail")


_SPLIT2 = "SELECT w, left(w, i) AS l, substr(w, i + 1) AS r FROM (SELECT w, unnest(range(3, length(w) - 2)) AS i FROM {t} WHERE length(w) >= 6)"


@query(S.statement(*S.AFFIX, _ROLES, f"""two AS MATERIALIZED ({_SPLIT2.format(t='words')}), open_ AS MATERIALIZED (SELECT DISTINCT w, l FROM two WHERE r IN (SELECT form FROM ends)),
  rest1 AS (SELECT DISTINCT l AS w FROM open_ WHERE l NOT IN (SELECT form FROM begins) AND length(l) >= 6),
  two1 AS ({_SPLIT2.format(t='rest1')}), open1 AS MATERIALIZED (SELECT DISTINCT w, l FROM two1 WHERE r IN (SELECT form FROM ends)),
  rest2 AS (SELECT DISTINCT l AS w FROM open1 WHERE l NOT IN (SELECT form FROM begins) AND length(l) >= 6),
  two2 AS ({_SPLIT2.format(t='rest2')}), open2 AS MATERIALIZED (SELECT DISTINCT w, l FROM two2 WHERE r IN (SELECT form FROM ends)),
  rest3 AS (SELECT DISTINCT l AS w FROM open2 WHERE l NOT IN (SELECT form FROM begins) AND length(l) >= 6),
  two3 AS ({_SPLIT2.format(t='rest3')}), done3 AS (SELECT DISTINCT w FROM two3 WHERE r IN (SELECT form FROM ends) AND l IN (SELECT form FROM begins)),
  done2 AS (SELECT DISTINCT w FROM open2 WHERE l IN (SELECT form FROM begins) OR l IN (SELECT w FROM done3)),
  done1 AS (SELECT DISTINCT w FROM open1 WHERE l IN (SELECT form FROM begins) OR l IN (SELECT w FROM done2))""",
  select="SELECT DISTINCT w AS token_lower FROM open_ WHERE l IN (SELECT form FROM begins) OR l IN (SELECT w FROM done1)"))
def recursive_compounds(spark, sf_dir):
    tokens = cut(doc_tokens(spark, sf_dir).where("lang = 'de'"), "tokens")
    entries = dictionary(tokens).where("lang = 'de'")
    forms = affix.expand(entries, rule_table(spark, "de"), word="base_lower").select("form").distinct()
    roles = entries.select(F.col("base_lower").alias("form"), F.lit("begin").alias("role")).unionByName(forms.select("form", F.lit("end").alias("role"))).distinct()
    words = tokens.select(F.lower("token").alias("token_lower"))
    return compound.compounds(words, roles, forms)


def _ghost_sql(lang: str) -> str:
    suffixes, endings = C.GHOST_SUFFIXES[lang]
    cases = " ".join(f"WHEN ends_with(b, {S.quoted(e)}) THEN left(b, length(b) - {len(e)}) || {S.quoted(n)}" for e, n in endings)
    neutral = f"CASE {cases} END" if cases else "NULL"
    guard = "b NOT IN ('tar', 'star', 'sir', 'over') AND length(b) > 3 AND NOT (length(b) <= 4 AND ends_with(b, 'r'))" if lang == "es" else "true"
    values = ", ".join(f"({S.quoted(x)})" for x in suffixes)
    return f"""SELECT '{lang}' AS lang, base_lower, form FROM (
      SELECT b AS base_lower, b || s AS form FROM bases, (VALUES {values}) v(s) WHERE lang = '{lang}' AND {guard}
      UNION SELECT b, {neutral} || s FROM bases, (VALUES {values}) v(s) WHERE lang = '{lang}' AND {guard}
      UNION SELECT b, {neutral} FROM bases WHERE lang = '{lang}' AND {guard}) WHERE form IS NOT NULL AND form <> base_lower"""


@query(S.statement(S.TOK, "bases AS MATERIALIZED (SELECT DISTINCT lang, lower(token) AS b FROM tok)", select=f"{_ghost_sql('es')} UNION ALL {_ghost_sql('de')}"))
def gender_ghosts(spark, sf_dir):
    bases = doc_tokens(spark, sf_dir).select("lang", F.lower("token").alias("base_lower")).distinct()
    parts = [wordforms.gender_ghosts(bases.where(F.col("lang") == la), la).select(F.lit(la).alias("lang"), "base_lower", "form") for la in ("es", "de")]
    return parts[0].unionByName(parts[1])


_HITS = """hits AS MATERIALIZED (SELECT f.base, f.form, unnest(c.spellings) AS spelling FROM forms f JOIN cases c ON c.lang = f.lang AND c.low = f.form WHERE f.lang = 'de' AND f.form <> f.base)"""


def _german(spark, sf_dir, tokens: DataFrame | None = None):
    tokens = cut(doc_tokens(spark, sf_dir), "tokens") if tokens is None else tokens
    cases = O.case_map(tokens.where("lang = 'de'").select("token"), keys=[])
    words = dictionary(tokens).where("lang = 'de'").select(F.col("base_lower").alias("base_word"))
    return words, rule_table(spark, "de"), cases


@query(S.statement(*S.AFFIX, S.CASES_CTE, _HITS, select="SELECT base AS base_word, array_to_string(list_sort(list(DISTINCT spelling)), ' | ') AS found_forms, count(DISTINCT spelling)::INT AS count FROM hits GROUP BY 1"))
def corpus_wordforms(spark, sf_dir):
    words, rules, cases = _german(spark, sf_dir)
    out = wordforms.corpus_wordforms(words, rules, cases, lang="de", flags=["N", "U"], quorum=0.5)
    return out.where("count > 0").select("base_word", F.array_join("found_forms", " | ").alias("found_forms"), "count")


@query(S.statement(*S.AFFIX, S.CASES_CTE, _HITS, select="SELECT base AS base_word, count(DISTINCT spelling)::INT AS new_count FROM hits WHERE form NOT IN (SELECT base FROM entries WHERE lang = 'de') GROUP BY 1 ORDER BY new_count DESC, base_word LIMIT 20"))
def new_forms_top(spark, sf_dir):
    words, rules, cases = _german(spark, sf_dir)
    known = words.select(F.col("base_word").alias("form"))
    out = wordforms.corpus_wordforms(words, rules, cases, lang="de", flags=["N", "U"], custom_known=known, retain_known=False)
    return wordforms.top_bases(out, "new_count", 20).select("base_word", "new_count")


_QUORUM = """quorum AS MATERIALIZED (SELECT o.base AS base_lower, o.flag, count(*) AS derived_count, count(c.low) AS hit_count, round(count(c.low)::DOUBLE / count(*), 6) AS hit_ratio,
  count(c.low) > 0 AND count(c.low)::DOUBLE / count(*) >= 0.5 AS passed FROM (SELECT DISTINCT lang, base, flag, form FROM one WHERE form <> base AND lang = 'de') o LEFT JOIN cases c ON c.lang = o.lang AND c.low = o.form GROUP BY 1, 2)"""
_ONE = (S.TOK, S.RULES_CTE, S.ENTRIES_CTE, S.ONE_CTE, S.CASES_CTE)


@query(S.statement(*_ONE, _QUORUM, select="SELECT base_lower, flag, derived_count, hit_count, hit_ratio, passed FROM quorum WHERE flag IN ('N', 'U')"))
def flag_quorum(spark, sf_dir):
    words, rules, cases = _german(spark, sf_dir)
    rows = wordforms.quorum_rows(words.select(F.col("base_word").alias("base_lower")), rules, cases, lang="de", flags=["N", "U"], quorum=0.5)
    return rows.select("base_lower", "flag", "derived_count", "hit_count", "hit_ratio", "passed")


_LEFT = "kept AS MATERIALIZED (SELECT DISTINCT token FROM tok WHERE lang = 'de')"
_ASSIGN = """validated AS (SELECT base_lower, list(flag) AS fl FROM quorum WHERE passed AND flag IN ('N', 'U') GROUP BY 1),
assigned AS MATERIALIZED (SELECT k.token, list_sort(list_distinct(list_concat(['U'], coalesce(flatten(list(v.fl)), [])))) AS flags FROM kept k LEFT JOIN validated v
  ON v.base_lower IN (k.token, lower(k.token), upper(k.token[1]) || substr(k.token, 2)) GROUP BY 1)"""


def _flags(spark, sf_dir):
    tokens = cut(doc_tokens(spark, sf_dir), "tokens")
    kept = tokens.where("lang = 'de'").select("token").distinct()
    words, rules, cases = _german(spark, sf_dir, tokens)
    out = wordforms.corpus_wordforms(words, rules, cases, lang="de", flags=["N", "U"], quorum=0.5)
    return kept, assembly.assign_flags(kept, out, ["U"]), rules


@query(S.statement(*_ONE, _QUORUM, _LEFT, _ASSIGN, select="SELECT token, array_to_string(flags, '') AS flags FROM assigned"))
def flag_assignment(spark, sf_dir):
    _, assigned, _ = _flags(spark, sf_dir)
    return assigned.select("token", F.array_join("assigned", "").alias("flags"))


@query(S.statement(*_ONE, _QUORUM, _LEFT, _ASSIGN, select="SELECT flag, count(*) AS words FROM (SELECT unnest(flags) AS flag FROM assigned) GROUP BY 1"))
def flag_usage(spark, sf_dir):
    return assembly.flag_usage(_flags(spark, sf_dir)[1])


_GENERATED = """flagged AS (SELECT token, unnest(flags) AS flag FROM assigned),
made AS MATERIALIZED (SELECT f.token AS source, r.kind, CASE r.kind WHEN 'SFX' THEN left(f.token, length(f.token) - length(strip)) || addn ELSE addn || substr(f.token, length(strip) + 1) END AS form
  FROM flagged f JOIN rules r ON r.lang = 'de' AND r.flag = f.flag
  WHERE (r.kind = 'SFX' AND ends_with(f.token, strip) AND (cond = '.' OR regexp_matches(f.token, '(?:' || cond || ')$'))) OR (r.kind = 'PFX' AND starts_with(f.token, strip)))"""


@query(S.statement(*_ONE, _QUORUM, "kept AS MATERIALIZED (SELECT DISTINCT token FROM tok WHERE lang = 'de')", _ASSIGN.replace("['U']", "[]::VARCHAR[]"), _GENERATED,
  select="SELECT m.form, array_to_string(list_sort(list(DISTINCT m.source)), ' | ') AS sources FROM made m JOIN assigned a ON a.token = m.form AND len(a.flags) = 0 WHERE m.form <> m.source GROUP BY 1"))
def redundancy_prune(spark, sf_dir):
    tokens = cut(doc_tokens(spark, sf_dir), "tokens")
    kept = tokens.where("lang = 'de'").select("token").distinct()
    words, rules, cases = _german(spark, sf_dir, tokens)
    out = wordforms.corpus_wordforms(words, rules, cases, lang="de", flags=["N", "U"], quorum=0.5)
    assigned = cut(assembly.assign_flags(kept, out, []), "assigned")
    generated = assembly.generated_by_flags(assigned, rules)
    pruned = assembly.redundant_forms(kept.withColumnRenamed("token", "form"), assigned, generated)
    return pruned.select("form", F.array_join("sources", " | ").alias("sources"))


_CASING = f"""base AS MATERIALIZED (SELECT DISTINCT token FROM tok WHERE lang = 'de'), seen AS MATERIALIZED (SELECT DISTINCT token FROM (SELECT unnest({S.tokens('text')}) AS token FROM conversations) WHERE token = lower(token))"""


@query(S.statement(S.TOK, _CASING, select="""SELECT token AS original, lower(token) AS inferred_lower, 'corpus_exact_lower' AS source FROM base
  WHERE token[1] = upper(token[1]) AND token[1] <> lower(token[1]) AND token <> lower(token) AND lower(token) NOT IN (SELECT token FROM base) AND lower(token) IN (SELECT token FROM seen)"""))
def casing_inference(spark, sf_dir):
    # all German documents stand for the dictionary, all conversations for the corpus
    base = doc_tokens(spark, sf_dir).where("lang = 'de'").select("token").distinct()
    seen = conversation_tokens(spark, sf_dir).where("token = lower(token)").select(F.col("token").alias("form"))
    return assembly.infer_casing(base, seen)


@query(S.statement(*S.AFFIX, _AUDIT, select="SELECT DISTINCT token AS form FROM tok WHERE lang = 'fr' AND lower(token) NOT IN (SELECT token_lower FROM audit WHERE lang = 'fr' AND status = 'removed_known_word')"))
def rebound_guard(spark, sf_dir):
    tokens = cut(doc_tokens(spark, sf_dir), "tokens")
    checked = audits(spark, tokens).where("lang = 'fr'")
    return assembly.guard_known_words(tokens.where("lang = 'fr'").select(F.col("token").alias("form")).distinct(), checked)


@query(S.statement(S.TOK, "spelled AS (SELECT lang, lower(token) AS low, token, CASE WHEN token[1] = upper(token[1]) AND token[1] <> lower(token[1]) THEN 0 ELSE 1 END AS c FROM tok)",
  select="SELECT lang, low AS word_lower, first(token ORDER BY c, length(token), lower(token), encode(token)) AS surface FROM spelled GROUP BY 1, 2"))
def representative_surface(spark, sf_dir):
    return assembly.representative_surface(doc_tokens(spark, sf_dir).select("lang", F.col("token").alias("word")), keys=["lang"])


_EXPORTS = "exports AS MATERIALIZED (SELECT DISTINCT lang, source AS game, token AS word, substr(source, 4) AS flag FROM tok)"


@query(S.statement(S.TOK, _EXPORTS, select="SELECT lang, word, array_to_string(list_sort(list(DISTINCT flag)), ',') AS flags, array_to_string(list_sort(list(DISTINCT game)), ' | ') AS sources FROM exports GROUP BY 1, 2"))
def merged_exports(spark, sf_dir):
    tokens = doc_tokens(spark, sf_dir)
    rows = tokens.select("lang", F.col("source").alias("game"), F.col("token").alias("word"), F.array(F.substring(F.col("source"), F.lit(4), F.char_length("source"))).alias("flags")).distinct()
    merged = assembly.merge_exports(rows)
    return merged.select("lang", "word", F.array_join("flags", ",").alias("flags"), F.array_join("sources", " | ").alias("sources"))
