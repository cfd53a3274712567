"""Queries that write a table with a writer and read it with the reader of that format, and queries over roles of
compounds, names, overrides and merged dictionaries, each with DuckDB SQL over the tables they come from."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import text as T
from ..operators import affix, assembly, compound, filtering, wordforms
from ..operators import tokens as O
from ..operators.materialise import cut, shared_path
from ..sources import files, hunspell, readers, writers
from . import queries_affix as A
from . import sql as S
from .common import add, load
from .queries_report import _WITH, report
from .queries_text import doc_tokens

QUERIES: dict = {}
ORACLES: dict = {}
query = add(QUERIES, ORACLES)


@query(S.statement(S.TOK, select="SELECT DISTINCT token FROM tok"))
def token_list_file(spark, sf_dir):
    path = shared_path(spark, "tokens-txt")
    writers.write_tokens(doc_tokens(spark, sf_dir), path)
    return readers.read_token_list(spark, path)


@query(S.statement(*S.AFFIX, A._AUDIT, select="SELECT DISTINCT token FROM audit WHERE lang = 'fr' AND status = 'kept_neologism'"))
def filtered_dictionary_file(spark, sf_dir):
    path = shared_path(spark, "filtered") + ".dic"
    kept = A.audits(spark, cut(doc_tokens(spark, sf_dir), "tokens")).where("lang = 'fr' AND status = 'kept_neologism'")
    writers.write_filtered_dictionary(kept, path)
    return readers.read_filtered_dictionary(spark, path)


@query(S.statement(*S.AFFIX, A._AUDIT, select="SELECT token, token_lower, 'k.1 | k.2' AS tb_key, status, match_type FROM audit WHERE lang = 'de'"))
def audit_file(spark, sf_dir):
    path = shared_path(spark, "audit-csv")
    rows = A.audits(spark, cut(doc_tokens(spark, sf_dir), "tokens")).where("lang = 'de'").drop("lang")
    writers.write_csv(rows.withColumn("tb_key", F.array(F.lit("k.1"), F.lit("k.2"))), path)
    return readers.read_audit(spark, path).select("token", "token_lower", "tb_key", "status", "match_type")


@query("SELECT conv_id || '.' || turn AS key, text FROM conversations")
def i18n_json_file(spark, sf_dir):
    path = shared_path(spark, "corpus") + ".json"
    rows = load(spark, sf_dir, "conversations").select(F.concat_ws(".", "conv_id", "turn").alias("key"), "text")
    writers.write_i18n(rows, path)
    return readers.read_i18n(spark, path, "GAME", "en").select("key", "text")


@query("SELECT 'part.' || p_partkey AS key, p_name || ' = ' || p_brand AS text FROM part")
def i18n_properties_file(spark, sf_dir):
    path = shared_path(spark, "corpus") + ".properties"
    rows = load(spark, sf_dir, "part").select(F.concat(F.lit("part."), "p_partkey").alias("key"), F.concat("p_name", F.lit(" = "), "p_brand").alias("text"))
    writers.write_i18n(rows, path)
    return readers.read_i18n(spark, path, "GAME", "en").select("key", "text")


_TERM = "p_name || '; \"' || p_brand || '\"'"


@query(f"""SELECT kind, key, token FROM (SELECT 'monster.' || p_partkey || '.name' AS key, unnest({S.tokens(_TERM)}) AS token FROM part
  UNION SELECT 'monster.' || p_partkey || '.name', unnest({S.tokens("lower(p_type) || 's'")}) FROM part), (VALUES ('csv'), ('tsv')) v(kind)""")
def glossary_files(spark, sf_dir):
    rows = load(spark, sf_dir, "part").select(
        F.concat(F.lit("monster."), "p_partkey", F.lit(".name")).alias("key"),
        F.concat("p_name", F.lit('; "'), "p_brand", F.lit('"')).alias("es"),
        F.concat(F.lit('One: "'), F.lower("p_type"), F.lit('s"')).alias("es (info)"),
    )
    parts = []
    for kind, sep in (("csv", ";"), ("tsv", "\t")):
        path = f"{shared_path(spark, 'glossary')}.{kind}"
        rows.write.option("header", True).option("sep", sep).option("escape", '"').csv(path)
        long = readers.glossary(readers.read_table(spark, path), "es", "GAME")
        parts.append(O.glossary_tokens(long).select(F.lit(kind).alias("kind"), "key", "token").distinct())
    return parts[0].unionByName(parts[1])


_UNITS = """units AS (SELECT p_partkey AS id, CASE WHEN p_size % 5 = 0 THEN '[DEBUG] ' ELSE '' END || p_name AS source,
  CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN p_name || ' [!]' ELSE '' END AS target FROM part)"""


@query(S.statement(_UNITS, select="""SELECT id::VARCHAR AS unit_id, target AS text, CASE WHEN target = '' THEN 'empty' WHEN source = target THEN 'identical' WHEN starts_with(source, '[') THEN 'square_brackets'
  WHEN target = upper(target) AND length(target) > 2 THEN 'all_caps' WHEN contains(target, '[!]') THEN 'wip_markers' ELSE '' END AS reason FROM units"""))
def xliff_file(spark, sf_dir):
    path = shared_path(spark, "units") + ".xliff"
    debug = F.when(F.col("p_size") % 5 == 0, "[DEBUG] ").otherwise("")
    kind = F.col("p_size") % 4
    target = F.when(kind == 0, F.col("p_name")).when(kind == 1, F.upper("p_name")).when(kind == 2, F.concat("p_name", F.lit(" [!]"))).otherwise("")
    unit = F.concat(F.lit('<trans-unit id="'), "p_partkey", F.lit('"><source>'), debug, "p_name", F.lit("</source><target>"), target, F.lit("</target></trans-unit>"))
    body = F.concat(F.lit('<file source-language="en" target-language="es"><body>'), F.array_join(F.collect_list(unit), ""), F.lit("</body></file>"))
    groups = load(spark, sf_dir, "part").groupBy("p_brand", "p_size").agg(body.alias("value")).orderBy("p_brand", "p_size")
    lines = chain(['<?xml version="1.0"?><xliff version="1.2">'], (r["value"] for r in groups.toLocalIterator()), ["</xliff>"])
    writers.write_lines(spark, path, lines)
    units = readers.xliff_texts(readers.read_xliff(spark, path), "es")
    return units.select("unit_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("reason", F.lit("")).alias("reason"))


_KEYED = """keyed AS MATERIALIZED (SELECT DISTINCT lower(token) AS token_lower, source || '.1' AS key, CASE WHEN lang = 'de' THEN 'npc' ELSE 'item' END AS category FROM tok)"""


@query(S.statement(S.TOK, _KEYED, select="""SELECT token_lower, array_to_string(list_sort(list(DISTINCT key)), ' | ') AS keys, array_to_string(list_sort(list(DISTINCT category)), ' | ') AS categories FROM keyed GROUP BY 1"""))
def sidecar_file(spark, sf_dir):
    path = shared_path(spark, "sidecar") + ".json"
    rows = doc_tokens(spark, sf_dir).select(F.lower("token").alias("token_lower"), F.concat("source", F.lit(".1")).alias("key"), F.when(F.col("lang") == "de", "npc").otherwise("item").alias("category"))
    rows = cut(rows.distinct(), "keyed")
    writers.write_sidecar(rows.select("category", "token_lower"), rows.groupBy("token_lower").agg(F.array_sort(F.collect_set("key")).alias("keys")), path)
    categories, keys = writers.read_sidecar(spark, path)
    named = categories.groupBy("token_lower").agg(F.array_join(F.array_sort(F.collect_set("category")), " | ").alias("categories"))
    return keys.select("token_lower", F.array_join("keys", " | ").alias("keys")).join(named, "token_lower", "left")


@query(S.statement(*S.AFFIX, S.CASES_CTE, A._HITS, select="SELECT kind, base AS base_word, array_to_string(list_sort(list(DISTINCT spelling)), ' | ') AS found_forms, count(DISTINCT spelling)::INT AS count FROM hits, (VALUES ('csv'), ('jsonl')) v(kind) GROUP BY 1, 2"))
def wordform_files(spark, sf_dir):
    words, rules, cases = A._german(spark, sf_dir)
    out = cut(wordforms.corpus_wordforms(words, rules, cases, lang="de", flags=["N", "U"], quorum=0.5).where("count > 0"), "wordforms")
    path = shared_path(spark, "wordforms")
    writers.write_wordforms(out, f"{path}.csv", f"{path}.jsonl")
    flat = spark.read.csv(f"{path}.csv", header=True, escape='"').select(F.lit("csv").alias("kind"), "base_word", "found_forms", F.col("count").cast("int").alias("count"))
    lines = readers.read_jsonl(spark, f"{path}.jsonl", "base_word string, found_forms array<string>, count int")
    return flat.unionByName(lines.select(F.lit("jsonl").alias("kind"), "base_word", F.array_join("found_forms", " | ").alias("found_forms"), "count"))


@query(S.statement(*A._ONE, A._QUORUM, A._LEFT, A._ASSIGN, select="SELECT token AS word, array_to_string(flags, ',') AS flags FROM assigned"))
def dictionary_export_file(spark, sf_dir):
    path = shared_path(spark, "export") + ".dic"
    writers.write_dictionary(A._flags(spark, sf_dir)[1].withColumnRenamed("assigned", "assigned_flags"), path)
    return hunspell.read_export(spark, path).select("word", F.array_join("flags", ",").alias("flags"))


@query(S.statement(*A._ONE, A._QUORUM, A._LEFT, A._ASSIGN, select="SELECT lower(token) AS base_lower, array_to_string(flags, ',') AS flags, token AS word FROM assigned WHERE NOT list_contains(flags, 'N')"))
def dictionary_entries_file(spark, sf_dir):
    """The dictionary of German tokens read as a base dictionary whose affix file forbids what carries N."""
    path = shared_path(spark, "entries") + ".dic"
    writers.write_dictionary(A._flags(spark, sf_dir)[1].withColumnRenamed("assigned", "assigned_flags"), path)
    affixes = hunspell.parse_affixes(b"SET UTF-8\nFORBIDDENWORD N\n")
    return hunspell.read_entries(spark, path, affixes).select("word", "base_lower", F.array_join("flags", ",").alias("flags"))


@query(S.statement(S.TOK, select="SELECT DISTINCT lower(token) AS form FROM tok WHERE lang = 'es'"))
def head_words_file(spark, sf_dir):
    path = shared_path(spark, "heads") + ".dic"
    words = doc_tokens(spark, sf_dir).where("lang = 'es'").select("token").distinct()
    writers.write_dictionary(words.withColumn("assigned_flags", F.array(F.lit("S"))), path)
    return hunspell.read_head_words(spark, path)


@query(S.statement(S.TOK, select="SELECT DISTINCT token AS word, true AS utf16_mark, true AS crlf FROM tok WHERE lang = 'fr'"))
def flat_list_file(spark, sf_dir):
    path = shared_path(spark, "flat") + ".DIC"
    writers.write_flat_list(doc_tokens(spark, sf_dir).where("lang = 'fr'"), path)
    probe = writers.flat_list_probe(files.read_bytes(spark, path))
    return hunspell.read_export(spark, path).select("word", F.lit(probe["utf16_mark"]).alias("utf16_mark"), F.lit(probe["crlf"]).alias("crlf"))


@query(S.statement(*_WITH, select="""SELECT kind, game, token, array_to_string(lineage_tags, ' | ') AS lineage_tags, array_to_string(assigned_flags, ' | ') AS assigned_flags, in_tb_tokens, filter_status FROM report, (VALUES ('csv'), ('jsonl')) v(kind)"""))
def report_files(spark, sf_dir):
    path = shared_path(spark, "report")
    paths = writers.write_report(cut(report(spark, sf_dir), "report"), path)
    parts = [readers.read_report(spark, p).select(F.lit(kind).alias("kind"), "game", "token", F.array_join("lineage_tags", " | ").alias("lineage_tags"), F.array_join("assigned_flags", " | ").alias("assigned_flags"), "in_tb_tokens", "filter_status") for kind, p in paths.items()]
    return parts[0].unionByName(parts[1])


def affix_text(lang: str) -> str:
    """The shared rules of a language as an affix file."""
    out, rules = ["SET UTF-8", "TRY abc"], [r for r in S.RULES if r[0] == lang]
    for kind, flag in dict.fromkeys((r[1], r[2]) for r in rules):
        block = [r for r in rules if (r[1], r[2]) == (kind, flag)]
        out += [f"{kind} {flag} Y {len(block)}"] + [f"{kind} {flag} {r[3] or '0'} {r[4]} {r[5]}" for r in block]
    return "\n".join(out) + "\n"


@query(S.statement(S.RULES_CTE, select="SELECT v.file, lang, kind, flag, strip, addn AS add, cond AS condition FROM rules, (VALUES ('whole'), ('custom')) v(file) WHERE v.file = 'whole' OR flag IN ('S', 'N', 'E')"))
def affix_files(spark, sf_dir):
    """Affix files written, read and parsed; custom ones keep only the blocks of flags in use."""
    parts = []
    for lang in dict.fromkeys(r[0] for r in S.RULES):
        path = files.write_bytes(spark, shared_path(spark, "affix") + ".aff", affix_text(lang).encode())
        raw = files.read_bytes(spark, path)
        custom = hunspell.custom_affixes(hunspell.raw_blocks(raw), {"S", "N", "E"})
        for name, parsed in (("whole", hunspell.read_affixes(spark, path)), ("custom", hunspell.parse_affixes(custom.encode()))):
            parts.append(parsed.table(spark, lang).select(F.lit(name).alias("file"), "lang", "kind", "flag", "strip", "add", "condition"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _role_entries(tokens: DataFrame) -> DataFrame:
    """German entries with N (whose rule adds the flag of beginnings), Z for three letters, Y up to m."""
    b = F.col("base_lower")
    marks = F.array(F.lit("N"), F.when(F.char_length(b) == 3, "Z"), F.when(F.substring(b, 1, 1) < "n", "Y"))
    return A.dictionary(tokens).where("lang = 'de'").select("base_lower", F.filter(marks, lambda f: f.isNotNull()).alias("flags"))


def _role_rules(spark) -> DataFrame:
    rules = A.rule_table(spark, "de")
    return rules.withColumn("add_flags", F.when(F.col("flag") == "N", F.array(F.lit("X"))).otherwise(F.col("add_flags")))


_ROLE_FORMS = """base AS (SELECT base FROM entries WHERE lang = 'de'), made AS MATERIALIZED (SELECT base, base AS form FROM base UNION SELECT base, base || 'en' FROM base),
roles AS MATERIALIZED (SELECT DISTINCT form, role FROM (SELECT form, 'begin' AS role FROM made UNION ALL SELECT form, 'middle' FROM made WHERE length(base) = 3 UNION ALL SELECT form, 'end' FROM made WHERE base[1] < 'n'))"""


@query(S.statement(*S.AFFIX, _ROLE_FORMS, select="SELECT form, role FROM roles"))
def compound_roles(spark, sf_dir):
    tokens = cut(doc_tokens(spark, sf_dir), "tokens")
    return compound.role_forms(_role_entries(tokens), _role_rules(spark), {"begin": "X", "middle": "Z", "end": "Y"}, word="base_lower")


_ANY = """words AS MATERIALIZED (SELECT DISTINCT low AS w FROM (SELECT lower(token) AS low FROM tok WHERE lang = 'de') UNION SELECT DISTINCT low || '-' || left(low, 4) FROM (SELECT lower(token) AS low FROM tok WHERE lang = 'de')),
marked AS MATERIALIZED (SELECT base AS form FROM entries WHERE lang = 'de'), known AS MATERIALIZED (SELECT DISTINCT form FROM forms WHERE lang = 'de'),
pieces AS MATERIALIZED (SELECT w, unnest(list_distinct(list_filter(string_split(w, '-'), lambda p: p <> ''))) AS p FROM words WHERE length(w) >= 6 AND contains(w, '-') AND len(list_filter(string_split(w, '-'), lambda p: p <> '')) >= 2),
asked AS MATERIALIZED (SELECT w FROM words UNION SELECT p FROM pieces),
two AS MATERIALIZED (SELECT DISTINCT w FROM (SELECT w, unnest(range(3, length(w) - 2)) AS i FROM asked WHERE length(w) >= 6) WHERE left(w, i) IN (SELECT form FROM marked) AND substr(w, i + 1) IN (SELECT form FROM marked))"""


@query(S.statement(*S.AFFIX, _ANY, select="""SELECT w AS token_lower FROM words WHERE w IN (SELECT w FROM two)
  UNION SELECT w FROM pieces GROUP BY w HAVING bool_and(p IN (SELECT form FROM known) OR p IN (SELECT w FROM two))"""))
def free_and_hyphenated_compounds(spark, sf_dir):
    """German tokens, and each of them joined to its first four letters by a hyphen, against parts that may
    stand anywhere."""
    tokens = cut(doc_tokens(spark, sf_dir), "tokens")
    entries = A.dictionary(tokens).where("lang = 'de'")
    forms = affix.expand(entries, A.rule_table(spark, "de"), word="base_lower").select("form").distinct()
    low = tokens.where("lang = 'de'").select(F.lower("token").alias("token_lower")).distinct()
    words = low.unionByName(low.select(F.concat("token_lower", F.lit("-"), F.substring("token_lower", 1, 4)).alias("token_lower")))
    return compound.compounds(words, entries.select(F.col("base_lower").alias("form"), F.lit("flag").alias("role")), forms)


_NAMED = """bases AS (SELECT lang, base AS b FROM entries WHERE lang = 'es' AND base < 'p'), listed AS (SELECT base FROM entries WHERE lang = 'es')"""


@query(S.statement(*S.AFFIX, S.CASES_CTE, _NAMED, f"ghosts AS ({A._ghost_sql('es')})", """seen AS (SELECT g.base_lower, g.form, unnest(c.spellings) AS spelling FROM ghosts g JOIN cases c ON c.lang = 'es' AND c.low = g.form
  WHERE g.base_lower IN (SELECT base FROM listed) AND NOT EXISTS (SELECT 1 FROM forms f WHERE f.lang = 'es' AND f.base = g.base_lower AND f.form = g.form))""",
  select="SELECT base_lower AS base_word, array_to_string(list_sort(list(DISTINCT spelling)), ' | ') AS ghost_forms, count(DISTINCT spelling)::INT AS ghost_count, count(DISTINCT CASE WHEN form NOT IN (SELECT base FROM listed) THEN spelling END)::INT AS new_ghost_count FROM seen GROUP BY 1"))
def attested_ghosts(spark, sf_dir):
    """Supposed forms of names that no rule derives and the corpus shows."""
    tokens = cut(doc_tokens(spark, sf_dir), "tokens")
    words = A.dictionary(tokens).where("lang = 'es'").select(F.col("base_lower").alias("base_word"))
    cases = O.case_map(tokens.where("lang = 'es'").select("token"), keys=[])
    names = words.where("base_word < 'p'").select(F.col("base_word").alias("token_lower"))
    out = wordforms.corpus_wordforms(words, A.rule_table(spark, "es"), cases, lang="es", flags=["S", "A"], names=names, custom_known=words.select(F.col("base_word").alias("form")))
    return out.where("ghost_count > 0").select("base_word", F.array_join("ghost_forms", " | ").alias("ghost_forms"), "ghost_count", "new_ghost_count")


@query(S.statement(*A._ONE, S.CROSSED_CTE, S.FORMS_CTE, A._HITS, A._QUORUM, """counted AS (SELECT base, count(DISTINCT spelling) AS n, count(DISTINCT CASE WHEN form NOT IN (SELECT base FROM entries WHERE lang = 'de') THEN spelling END) AS fresh FROM hits GROUP BY 1)""",
  select="SELECT count(*) AS bases, count(*) FILTER (WHERE fresh > 0) AS bases_with_new, sum(n)::BIGINT AS total_count, sum(fresh)::BIGINT AS total_new_count, (SELECT count(DISTINCT base_lower) FROM quorum WHERE passed AND flag IN ('N', 'U')) AS bases_with_flags FROM counted"))
def wordform_totals(spark, sf_dir):
    words, rules, cases = A._german(spark, sf_dir)
    out = wordforms.corpus_wordforms(words, rules, cases, lang="de", flags=["N", "U"], custom_known=words.select(F.col("base_word").alias("form")))
    return wordforms.wordform_totals(out).select("bases", "bases_with_new", "total_count", "total_new_count", "bases_with_flags")


_KNOWN = "known AS MATERIALIZED (SELECT DISTINCT form FROM forms WHERE lang = 'de' UNION SELECT base FROM entries WHERE lang = 'de')"


@query(S.statement(*S.AFFIX, _KNOWN, select="SELECT form FROM known UNION SELECT replace(form, 'ß', 'ss') FROM known UNION SELECT replace(form, 'ss', 'ß') FROM known"))
def known_dictionary_forms(spark, sf_dir):
    entries = A.dictionary(doc_tokens(spark, sf_dir)).where("lang = 'de'")
    return filtering.known_forms(entries, A.rule_table(spark, "de"), checksharps=True)


_MERGED = """merged AS MATERIALIZED (SELECT token AS word, bool_or(length(token) < 5) AS flagged, array_to_string(list_sort(list(DISTINCT source)), ' | ') AS sources FROM tok WHERE lang = 'de' GROUP BY 1),
made AS MATERIALIZED (SELECT DISTINCT lower(word || 'en') AS low FROM merged WHERE flagged)"""


@query(S.statement(S.TOK, _MERGED, select="SELECT word, CASE WHEN flagged THEN 'N' ELSE '' END AS flags, sources FROM merged WHERE flagged OR lower(word) NOT IN (SELECT low FROM made)"))
def pruned_merged_exports(spark, sf_dir):
    rows = doc_tokens(spark, sf_dir).where("lang = 'de'").select("lang", F.col("source").alias("game"), F.col("token").alias("word")).distinct()
    rows = rows.withColumn("flags", F.when(F.char_length("word") < 5, F.array(F.lit("N"))).otherwise(F.array().cast("array<string>")))
    merged = assembly.prune_merged(cut(assembly.merge_exports(rows), "merged"), A.rule_table(spark, "de"))
    return merged.select("word", F.array_join("flags", ",").alias("flags"), F.array_join("sources", " | ").alias("sources"))


_OVERRIDE = """listed AS MATERIALIZED (SELECT DISTINCT token FROM tok WHERE lang = 'en')"""


@query(S.statement(S.TOK, _OVERRIDE, select="""SELECT token FROM listed WHERE lower(token) NOT IN ('the', 'and') UNION SELECT unnest(['the', 'With', 'with'])
  UNION SELECT unnest(['Und', 'und']) WHERE EXISTS (SELECT 1 FROM listed WHERE lower(token) = 'and') UNION SELECT 'x' WHERE EXISTS (SELECT 1 FROM listed WHERE token = 'qqqq')"""))
def token_overrides(spark, sf_dir):
    tokens = doc_tokens(spark, sf_dir).where("lang = 'en'").select("token").distinct()
    return O.override_tokens(tokens, lower_only=["The"], keep_both=["With"], replace={"And": ["Und", "und"], "qqqq": ["x"]})


@query("""SELECT p_partkey, p_partkey % 2 = 0 OR p_size % 3 = 0 AS truth, list_aggregate(list_sort(string_split(p_type, '')), 'string_agg', '') AS single, CASE WHEN length(p_type) < 2 THEN '' ELSE '/' || array_to_string(list_sort(regexp_extract_all(p_type, '..')), '') END AS long,
  '/' || array_to_string(list_sort([p_partkey::VARCHAR, p_size::VARCHAR]), ',') AS num FROM part""")
def flag_strings(spark, sf_dir):
    word = F.when(F.col("p_partkey") % 2 == 0, " Yes").when(F.col("p_size") % 3 == 0, "1").otherwise("no")
    numbers = F.concat(F.col("p_partkey").cast("string"), F.lit(", ,"), F.col("p_size").cast("string"))
    return load(spark, sf_dir, "part").select(
        "p_partkey",
        T.as_flag(word).alias("truth"),
        F.array_join(F.array_sort(T.split_flags(F.col("p_type"), "single")), "").alias("single"),
        T.join_flags(T.split_flags(F.col("p_type"), "long"), "long").alias("long"),
        T.join_flags(T.split_flags(numbers, "num"), "num").alias("num"),
    )


@query("""SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(substr(w, 2))), ' ') AS term,
  string_split(p_name, ' ')[1] AS note FROM part""")
def annotated_terms(spark, sf_dir):
    noted = F.concat(F.upper("p_name"), F.lit(" (x y) [z]  ; "))
    led = F.concat(F.lit(" ["), "p_name", F.lit("] REST"))
    return load(spark, sf_dir, "part").select("p_partkey", T.clean_annotated_term(noted).alias("term"), T.clean_annotated_term(led).alias("note"))


@query(S.statement(S.TOK, "owned AS (SELECT DISTINCT token || v.s AS token FROM tok, (VALUES (''), ('''s'), ('’S'), ('s')) v(s) WHERE lang = 'en')", select="SELECT token FROM owned WHERE regexp_matches(token, '(?i)(''|’)s$')"))
def possessives(spark, sf_dir):
    tokens = doc_tokens(spark, sf_dir).where("lang = 'en'").select("token").distinct()
    ends = F.explode(F.array(*[F.lit(x) for x in ("", "'s", "’S", "s")]))
    return tokens.withColumn("s", ends).select(F.concat("token", "s").alias("token")).where(P.is_possessive(F.col("token"))).distinct()
