"""Queries over text functions, tokens and row predicates, each with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import predicates as P
from ..functions import text as T
from ..operators import tokens as O
from . import sql as S
from .common import add, load, spread

QUERIES: dict = {}
ORACLES: dict = {}
query = add(QUERIES, ORACLES)


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, token) of all documents, in default mode."""
    return O.exploded_tokens(spread(load(spark, sf_dir, "documents")), F.col("text"), keep=["doc_id", "lang", "source"])


def conversation_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(token) of all turns of the conversations, which carry no language, in default mode."""
    return O.exploded_tokens(load(spark, sf_dir, "conversations"), F.col("text"), keep=[])


@query(S.statement(S.TOK, select="SELECT DISTINCT lang, token FROM tok"))
def token_extraction(spark, sf_dir):
    return O.distinct_tokens(spread(load(spark, sf_dir, "documents")), F.col("text"), keys=["lang"])


_REASON = (
    "CASE WHEN t = '' THEN 'empty' WHEN length(t) < 3 THEN 'short' WHEN replace(lower(t), lower(t)[1], '') = '' THEN 'one_character'"
    f" WHEN regexp_matches(t, '^\\p{{Nd}}+$') THEN 'digits' WHEN regexp_matches(t, {S.quoted('(?i)' + C.TIME_TOKEN)}) THEN 'time'"
    " WHEN regexp_matches(t, '^\\d+-[\\p{L}\\p{N}_]+$') THEN 'digit_word' ELSE 'kept' END"
)


@query(f"SELECT lang, {_REASON} AS reason, count(*) AS tokens FROM (SELECT lang, unnest({S.raw_tokens('text')}) AS t FROM documents) GROUP BY 1, 2")
def token_quality_reasons(spark, sf_dir):
    clean = T.strip_emails(T.strip_urls(T.strip_control_escapes(T.strip_escaped_tags(F.col("text")))))
    raw = F.transform(T.raw_tokens(clean), lambda t: F.regexp_replace(t, r"^['-]+|['-]+$", ""))
    rows = spread(load(spark, sf_dir, "documents")).select("lang", F.explode(raw).alias("t"))
    t = F.col("t")
    reason = (
        F.when(t == "", "empty")
        .when(F.char_length(t) < 3, "short")
        .when(F.size(F.array_distinct(F.split(F.lower(t), ""))) == 1, "one_character")
        .when(t.rlike(r"(?U)^\d+$"), "digits")
        .when(t.rlike("(?iU)" + C.TIME_TOKEN), "time")
        .when(~T.is_good_token(t), "digit_word")
        .otherwise("kept")
    )
    return rows.groupBy("lang", reason.alias("reason")).agg(F.count("*").alias("tokens"))


_ESCAPED = "replace(replace(html, '<', '&lt;'), '>', '&gt;')"


@query(f"SELECT page_id, length(t) AS chars, md5(t) AS digest FROM (SELECT page_id, {S.stripped_tags(_ESCAPED)} AS t FROM pages)")
def escaped_tags(spark, sf_dir):
    escaped = F.replace(F.replace(F.col("html"), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    rows = load(spark, sf_dir, "pages").select("page_id", T.strip_escaped_tags(escaped).alias("t"))
    return rows.select("page_id", F.char_length("t").alias("chars"), F.md5("t").alias("digest"))


def _raw_tags_sql(html: str) -> str:
    for tag in ("script", "style"):
        html = S.replaced(html, rf"(?is)<{tag}\b.*?</{tag}\s*>", " ")
    return S.squeezed(S.decoded(S.replaced(S.replaced(html, r"(?s)<!--.*?-->", " "), r"<[^>]*>", " ")))


@query(f"SELECT page_id, length(t) AS chars, md5(t) AS digest FROM (SELECT page_id, {_raw_tags_sql('html')} AS t FROM pages)")
def raw_tags(spark, sf_dir):
    rows = load(spark, sf_dir, "pages").select("page_id", T.strip_raw_tags(F.col("html")).alias("t"))
    return rows.select("page_id", F.char_length("t").alias("chars"), F.md5("t").alias("digest"))


_MESSY = r"replace(text, ' ', '\n') || ' see http://example.com/a?b=1 or a.b@example.org'"


@query(f"SELECT conv_id, turn, {S.replaced(S.replaced(S.replaced(_MESSY, chr(92) * 2 + '+[nrt]', ' '), C.URL, ''), C.EMAIL, '')} AS cleaned FROM conversations")
def escapes_urls_emails(spark, sf_dir):
    messy = F.concat(F.replace("text", F.lit(" "), F.lit("\\n")), F.lit(" see http://example.com/a?b=1 or a.b@example.org"))
    clean = T.strip_emails(T.strip_urls(T.strip_control_escapes(messy)))
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", clean.alias("cleaned"))


def _contractions_sql(expression: str) -> str:
    for short, long in C.ENGLISH_CONTRACTIONS.items():
        first, rest = short[0], short[1:].replace(".", r"\.")
        for letter, new in ((first.upper(), long.capitalize()), (first, long)):
            expression = S.replaced(expression, rf"\b{letter}(?i:{rest})\b", new)
    return expression


_SPOKEN = "text || ' Don''t say she''d WON''T; can''t y''all see I''m late? He''s there, WE''RE not.'"


@query(f"SELECT conv_id, turn, {_contractions_sql(_SPOKEN)} AS expanded FROM conversations")
def english_contractions(spark, sf_dir):
    spoken = F.concat("text", F.lit(" Don't say she'd WON'T; can't y'all see I'm late? He's there, WE'RE not."))
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", T.expand_contractions(spoken).alias("expanded"))


_ELIDED = "replace(replace(text, ' e', ' l''e'), ' o', ' qu’o')"


@query(f"SELECT doc_id, md5({S.replaced(_ELIDED, '(?i)' + chr(92) + 'b' + C.FRENCH_CLITICS + '([' + C.FRENCH_VOWELS + '])', chr(92) + '1')}) AS digest FROM documents WHERE lang = 'fr'")
def french_elisions(spark, sf_dir):
    elided = F.replace(F.replace("text", F.lit(" e"), F.lit(" l'e")), F.lit(" o"), F.lit(" qu’o"))
    return spread(load(spark, sf_dir, "documents")).where("lang = 'fr'").select("doc_id", F.md5(T.strip_french_elisions(elided)).alias("digest"))


def _portuguese_sql(e: str) -> str:
    e = S.replaced(e, rf"\bd'([{C.PORTUGUESE_CAPITALS}])", r"de \1")
    e = S.replaced(e, rf"\bl'([{C.PORTUGUESE_CAPITALS}])", r"le \1")
    return S.replaced(e, rf"([{C.PORTUGUESE_VOWELS}])-([lm][eoasá]s?)\b", r"\1r \2")


@query(f"""SELECT p_partkey, {_portuguese_sql("'d''Água l''Isto ' || p_name || 'á-lo e-mas'")} AS split_text FROM part""")
def portuguese_contractions(spark, sf_dir):
    text = F.concat(F.lit("d'Água l'Isto "), F.col("p_name"), F.lit("á-lo e-mas"))
    return load(spark, sf_dir, "part").select("p_partkey", T.split_portuguese(text).alias("split_text"))


@query("""SELECT p_partkey, w || 'as ' || w || 'os' || ' ' || w || 'a ' || w || 'o' || ' ' || w || ' ' || w || 's' AS expanded
FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS w FROM part)""")
def morphology_marks(spark, sf_dir):
    w = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))
    marked = F.concat(w, F.lit("{[>1]?a:o}s "), w, F.lit("{[=2]?a:o} "), w, F.lit("{~ps}"))
    return load(spark, sf_dir, "part").select("p_partkey", T.expand_morphology(marked).alias("expanded"))


@query("SELECT doc_id, substr(replace(replace(lower(upper(lang) || '-XX'), '-', ''), '_', ''), 1, 2) AS code FROM documents")
def language_codes(spark, sf_dir):
    return spread(load(spark, sf_dir, "documents")).select("doc_id", T.language_code(F.concat(F.upper("lang"), F.lit("-XX"))).alias("code"))


_PAIRS = """pairs AS (SELECT conv_id, turn, role, text AS source,
 CASE conv_id % 7 WHEN 0 THEN text WHEN 1 THEN upper(text) WHEN 2 THEN '[WIP] ' || text WHEN 3 THEN '  ' WHEN 4 THEN NULL WHEN 5 THEN '[!]' || text ELSE text || ' .' END AS target FROM conversations)"""
_SKIP = f"""CASE WHEN target IS NULL OR regexp_matches(target, '^\\s*$') THEN 'empty_target' WHEN source = target THEN 'identical'
 WHEN regexp_matches(source, '\\[.+\\]') THEN 'square_brackets' WHEN target = upper(target) AND target <> lower(target) AND length(target) > 2 THEN 'all_caps'
 WHEN contains(target, '[!]') OR regexp_matches(target, {S.quoted('(?i)' + C.WIP_MARKER)}) THEN 'wip_markers' END"""


def translation_pairs(spark, sf_dir):
    t, k = F.col("text"), F.col("conv_id") % 7
    target = F.when(k == 0, t).when(k == 1, F.upper(t)).when(k == 2, F.concat(F.lit("[WIP] "), t)).when(k == 3, F.lit("  ")).when(k == 4, F.lit(None)).when(k == 5, F.concat(F.lit("[!]"), t)).otherwise(F.concat(t, F.lit(" .")))
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", t.alias("source"), target.alias("target"))


@query(S.statement(_PAIRS, select=f"SELECT role, reason, count(*) AS rows FROM (SELECT role, {_SKIP} AS reason FROM pairs) WHERE reason IS NOT NULL GROUP BY 1, 2"))
def skip_reasons(spark, sf_dir):
    return O.skip_histogram(translation_pairs(spark, sf_dir), P.skip_reason(F.col("source"), F.col("target")), keys=["role"])


@query(S.statement(_PAIRS, select=f"SELECT conv_id, turn, coalesce(contains(target, '[!]') OR regexp_matches(target, {S.quoted('(?i)' + C.WIP_MARKER)}), false) AS is_wip FROM pairs"))
def wip_markers(spark, sf_dir):
    return translation_pairs(spark, sf_dir).select("conv_id", "turn", P.has_wip_marker(F.col("target")).alias("is_wip"))


#: glossary rows made of parts: keys of all categories, markup in some terms
_KEY = """CASE p_partkey % 9 WHEN 0 THEN 'monster.' || p_partkey || '.name, NPC.' || p_size || '.name' WHEN 1 THEN 'Item.name.' || p_partkey WHEN 2 THEN 'subarea.' || p_partkey || '.name'
 WHEN 3 THEN 'emoticon.' || p_partkey || '.shortcut' WHEN 4 THEN 'hint about morse ' || p_partkey WHEN 5 THEN 'title.' || p_partkey || '.male' WHEN 6 THEN 'object.' || p_partkey || '.name'
 WHEN 7 THEN 'document.' || p_partkey || '.author' ELSE 'spell.' || p_partkey || '.name' END"""
GLOSSARY = f"""glossary AS (SELECT p_partkey AS row_id, {_KEY} AS key, p_name AS term, 'One: "' || p_name || '", Other: "' || p_type || '"' AS info FROM part
  WHERE NOT regexp_matches({_KEY}, '^emoticon\\.\\d+\\.shortcut') AND NOT regexp_matches({_KEY}, '(?i)\\bmorse\\b'))"""


def glossary(spark, sf_dir):
    p, k = load(spark, sf_dir, "part"), F.col("p_partkey") % 9
    name = lambda a, c, b="": F.concat(F.lit(a), F.col(c).cast("string"), F.lit(b))
    key = (
        F.when(k == 0, F.concat(name("monster.", "p_partkey", ".name, NPC."), name("", "p_size", ".name")))
        .when(k == 1, name("Item.name.", "p_partkey"))
        .when(k == 2, name("subarea.", "p_partkey", ".name"))
        .when(k == 3, name("emoticon.", "p_partkey", ".shortcut"))
        .when(k == 4, name("hint about morse ", "p_partkey"))
        .when(k == 5, name("title.", "p_partkey", ".male"))
        .when(k == 6, name("object.", "p_partkey", ".name"))
        .when(k == 7, name("document.", "p_partkey", ".author"))
        .otherwise(name("spell.", "p_partkey", ".name"))
    )
    info = F.concat(F.lit('One: "'), F.col("p_name"), F.lit('", Other: "'), F.col("p_type"), F.lit('"'))
    return p.select(F.lit("g").alias("game"), F.lit("de").alias("lang"), F.col("p_partkey").alias("row_id"), key.alias("key"), F.col("p_name").alias("term"), info.alias("info"))


_CATEGORY = "CASE " + " ".join(f"WHEN {' OR '.join(f'regexp_matches(k, {S.quoted(p)})' for p in ps)} THEN {S.quoted(c)}" for c, ps in C.KEY_CATEGORIES.items()) + " END"


@query(S.statement(GLOSSARY, select=f"SELECT row_id, category FROM (SELECT DISTINCT row_id, {_CATEGORY} AS category FROM (SELECT row_id, unnest(list_transform(string_split(key, ','), lambda x: trim(x))) AS k FROM glossary)) WHERE category IS NOT NULL"))
def key_classification(spark, sf_dir):
    rows = O.glossary_rows(glossary(spark, sf_dir))
    return rows.select("row_id", F.explode(O.key_categories(F.col("key"))).alias("category"))


TERM_TOKENS = f"""terms AS MATERIALIZED (SELECT row_id, key, true AS tracked, unnest({S.tokens('term')}) AS token FROM glossary
  UNION ALL SELECT row_id, key, false, unnest({S.tokens('form')}) FROM (SELECT row_id, key, unnest(regexp_extract_all(info, {S.quoted(C.PLURAL_INFO)}, 1)) AS form FROM glossary))"""


@query(S.statement(GLOSSARY, TERM_TOKENS, select="SELECT token, count(DISTINCT row_id) AS rows, count(*) FILTER (WHERE tracked) AS in_terms FROM terms GROUP BY 1"))
def glossary_tokens(spark, sf_dir):
    rows = O.glossary_tokens(glossary(spark, sf_dir))
    return rows.groupBy("token").agg(F.count_distinct("row_id").alias("rows"), F.count_if(F.col("tracked")).alias("in_terms"))


@query(S.statement(GLOSSARY, TERM_TOKENS, select="SELECT lower(token) AS token_lower, array_to_string(list_sort(list(DISTINCT trim(key))), ' | ') AS tb_keys FROM terms WHERE tracked GROUP BY 1"))
def token_key_lineage(spark, sf_dir):
    return O.token_keys(O.glossary_tokens(glossary(spark, sf_dir))).select("token_lower", F.array_join("keys", " | ").alias("tb_keys"))


@query(S.statement(GLOSSARY, select=r"""SELECT row_id, CASE WHEN len(p) >= 2 THEN p[1] || ':' || p[2] ELSE f END AS entity
FROM (SELECT row_id, f, list_filter(list_transform(string_split(f, '.'), lambda x: trim(x)), lambda x: x <> '') AS p FROM (SELECT row_id, trim(string_split(key || ' | x.1', '|')[1]) AS f FROM glossary))"""))
def source_entities(spark, sf_dir):
    rows = O.glossary_rows(glossary(spark, sf_dir))
    return rows.select("row_id", T.source_entity(F.concat("key", F.lit(" | x.1"))).alias("entity"))


_LETTERS = f"[{C.LETTER}]"


@query(f"""SELECT doc_id, lower({S.replaced(f"regexp_extract(text, {S.quoted(_LETTERS + '[' + C.LETTER + chr(39) + '’-]*')})", "^['’-]+|['’-]+$", "")}) AS first_word FROM documents""")
def first_words(spark, sf_dir):
    return spread(load(spark, sf_dir, "documents")).select("doc_id", T.first_word_lower(F.col("text")).alias("first_word"))


@query(S.statement(S.TOK, select="SELECT lang, lower(token) AS token_lower, array_to_string(list_sort(list(DISTINCT token)), ' | ') AS forms, min(token) AS first_form FROM tok GROUP BY 1, 2"))
def case_map(spark, sf_dir):
    cases = O.case_map(doc_tokens(spark, sf_dir), keys=["lang"])
    return cases.select("lang", "token_lower", F.array_join("forms", " | ").alias("forms"), F.get("forms", F.lit(0)).alias("first_form"))


_WORD = f"[{C.LETTER}][{C.LETTER}'’-]*"


@query(f"""WITH pieces AS (SELECT lang, regexp_extract_all(t, {S.quoted(_WORD)}) AS w, string_split_regex(t, {S.quoted(_WORD)}) AS b FROM (SELECT lang, {S.stripped_tags('text')} AS t FROM documents WHERE lang = 'es')),
spread AS (SELECT lang, unnest(w) AS w, unnest(b[1:len(w)]) AS b, unnest(range(len(w))) AS i FROM pieces),
named AS (SELECT lang, {S.replaced('w', "^['’-]+|['’-]+$", '')} AS token, CASE WHEN i = 0 THEN regexp_matches(b, '^\\s*$|[.!?:;]\\s*$') ELSE regexp_matches(b, '[.!?:;]\\s*$') END AS starts FROM spread)
SELECT lang, lower(token) AS token_lower, count(*) FILTER (WHERE token = lower(token)) AS lowercase_count,
 count(*) FILTER (WHERE token[1] = upper(token[1]) AND token[1] <> lower(token[1]) AND NOT starts) AS uppercase_mid_sentence_count FROM named WHERE token <> '' GROUP BY 1, 2""")
def case_evidence(spark, sf_dir):
    return O.case_evidence(spread(load(spark, sf_dir, "documents")).where("lang = 'es'"), F.col("text"), keys=["lang"])


@query("""SELECT doc_id, len(list_filter(string_split_regex(t, '\\s+'), lambda w: w <> '')) AS words, length(regexp_replace(t, '\\P{L}', '', 'g')) AS letters
FROM (SELECT doc_id, %s AS t FROM documents)""" % S.squeezed(S.replaced(S.replaced("text", r"\[[^\]]*\]", " "), r"\{[^}]*\}", " ")))
def detection_stats(spark, sf_dir):
    s = T.word_stats(T.strip_placeholders(F.col("text")))
    return spread(load(spark, sf_dir, "documents")).select("doc_id", s["words"].alias("words"), s["letters"].alias("letters"))


@query("SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(p_name || ' | ' || ' |' || p_brand, '|'), lambda x: trim(x)), lambda x: x <> ''), '/') AS parts FROM part")
def pipe_lists(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", F.array_join(T.pipe_list(F.concat("p_name", F.lit(" | "), F.lit(" |"), "p_brand")), "/").alias("parts"))


@query(f"""SELECT p_partkey, CASE WHEN n <= 4 THEN '1-4' WHEN n <= 8 THEN '5-8' WHEN n <= 12 THEN '9-12' ELSE '13+' END AS bucket FROM (SELECT p_partkey, length(trim(p_name)) AS n FROM part)""")
def length_buckets(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", T.length_bucket(F.col("p_name")).alias("bucket"))


@query("SELECT p_partkey, upper(p_name[1]) || substr(p_name, 2) IS NOT NULL AS ok, regexp_replace(p_name || '...', '\\.+$', '') AS undotted, replace('straße ' || p_name, 'ß', 'ss') AS sharp FROM part")
def dictionary_spellings(spark, sf_dir):
    name = F.col("p_name")
    sharp = F.element_at(T.sharp_s_variants(F.concat(F.lit("straße "), name)), 2)
    return load(spark, sf_dir, "part").select("p_partkey", name.isNotNull().alias("ok"), T.strip_dots(F.concat(name, F.lit("..."))).alias("undotted"), sharp.alias("sharp"))
