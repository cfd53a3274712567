"""The whole way from glossaries and corpora to dictionaries and reports, for many (game, lang) pairs.

Steps: tokens of the glossary (1), removal of what the base dictionary knows (2-3), corpus word forms and
quorum (4), assembly (5) and the consolidated report (5b). What several steps or sinks share is written
to the checkpoint folder, so plans stay short and executors keep no tables of pairs that are done. A pair that fails is reported and does not stop the others, unless ``strict``.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C

from ..operators import assembly, filtering, language, reports, tokens, wordforms
from ..operators.materialise import cut
from ..sources import files, hunspell, readers, writers


@dataclass(frozen=True)
class Inputs:
    """Where a project's files lie: glossary and corpus by (game, lang), dictionary by lang."""

    glossaries: dict[tuple[str, str], str]
    corpora: dict[tuple[str, str], str] = field(default_factory=dict)
    dictionaries: dict[str, str] = field(default_factory=dict)
    profile_texts: DataFrame | None = None


@dataclass(frozen=True)
class Options:
    quorum: float = 0.5
    verbs: bool = False
    skip_corpus: bool = False
    std_forms: str = "expanded"  # expanded, headwords or off
    retain_known: bool = True
    detect_language: bool = True
    min_words: int = 7
    min_confidence: float = 0.12
    strict: bool = False
    pair_workers: int = 1
    provenance: bool = True
    sample: int = 0
    cleanup: bool = True
    output: str = ""


@dataclass
class PairResult:
    """What a pair gives, as DataFrames; written only if an output folder is named."""

    game: str
    lang: str
    status: str = "ok"
    error: str = ""
    seconds: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)
    artifacts: dict = field(default_factory=dict)
    tables: dict = field(default_factory=dict)


def selected(chosen: str | Iterable[str], available: Iterable[str]) -> list[str]:
    """'all', one name or several, as a list."""
    if chosen == "all":
        return sorted(available)
    return [chosen] if isinstance(chosen, str) else list(chosen)


def glossary_step(spark: SparkSession, inputs: Inputs, game: str, lang: str, corpus: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tokens, keys of tokens, categories of tokens) of a pair's glossary."""
    tb = cut(readers.glossary(readers.read_table(spark, inputs.glossaries[game, lang]), lang, game), "glossary")
    rows = cut(tokens.glossary_tokens(tb, full_entities=True), "glossary-tokens")
    words = rows.select("token").distinct()
    if lang == "es" and corpus is not None:
        first, named = tokens.first_word_rules(tb, rows)
        evidence = tokens.case_evidence(corpus, F.col("text"), keys=["game", "lang"])
        words = words.unionByName(tokens.default_lowercase(first, named, evidence).select(F.col("token_lower").alias("token"))).distinct()
    return words, tokens.token_keys(rows), tokens.token_categories(rows)


def corpus_step(spark: SparkSession, inputs: Inputs, game: str, lang: str, options: Options) -> DataFrame | None:
    """A pair's corpus strings in its language; None without a corpus."""
    path = inputs.corpora.get((game, lang))
    if not path:
        return None
    rows = readers.read_i18n(spark, path, game, lang)
    if not options.detect_language or inputs.profile_texts is None:
        return rows
    table = cut(language.profiles(inputs.profile_texts), "profiles")
    checked = language.language_filter(rows, table, lang=lang, min_words=options.min_words, min_confidence=options.min_confidence)
    return checked.where(~F.col("is_wrong")).select(*rows.columns)


def run_pair(spark: SparkSession, inputs: Inputs, game: str, lang: str, options: Options = Options()) -> PairResult:
    lang = files.language_prefix(lang)
    out, began = PairResult(game, lang), time.time()

    def done(step: str) -> None:
        nonlocal began
        out.seconds[step], began = round(time.time() - began, 3), time.time()

    found = files.find_dictionary(spark, lang, inputs.dictionaries)
    if not found["ok"]:
        raise FileNotFoundError(f"no dictionary for {lang}: {[c['dic'] for c in found['checks']]}")
    affixes = hunspell.read_affixes(spark, found["aff"])
    rules, entries = affixes.table(spark), cut(hunspell.read_entries(spark, found["dic"], affixes), "entries")

    corpus = corpus_step(spark, inputs, game, lang, options)
    words, keys, categories = glossary_step(spark, inputs, game, lang, corpus)
    words, keys, categories = cut(words, "words"), cut(keys, "keys"), cut(categories, "categories")
    corpus = cut(corpus, "corpus") if corpus is not None else None
    done("tokens")

    audits = cut(filtering.filter_tokens(words, entries, rules, affixes.meta, token_keys=keys.drop("game", "lang")), "audits")
    kept = audits.where("status = 'kept_neologism'").select("token")
    out.metrics |= {"tokens": words.count(), "kept": kept.count()}
    done("filter")

    flags = wordforms.candidate_flags(lang, rules, options.verbs)
    if options.skip_corpus or corpus is None:
        empty = wordforms.corpus_wordforms(kept.select(F.col("token").alias("base_word")).limit(0), rules, _no_cases(spark), lang=lang, flags=flags, skip_flags=affixes.skip_flags())
        forms = cut(empty, "forms")
    else:
        spelled = readers.corpus_tokens(corpus).select("token")
        case_map = cut(tokens.case_map(spelled, keys=[]), "case-map")
        bases = kept.select(F.col("token").alias("base_word"))
        if options.sample:
            bases = bases.orderBy("base_word").limit(options.sample)
        std = None if options.std_forms == "off" else filtering.known_forms(entries, rules, skip_flags=affixes.skip_flags(), heads_only=options.std_forms == "headwords", checksharps=bool(affixes.meta["CHECKSHARPS"]))
        names = categories.where(F.col("category").isin("monster", "npc", "title", "area")).select("token_lower")
        found_forms = wordforms.corpus_wordforms(
            bases, rules, case_map, lang=lang, flags=flags, quorum=options.quorum, names=names, custom_known=kept.select(F.lower("token").alias("form")), std_known=std, retain_known=options.retain_known, skip_flags=affixes.skip_flags()
        )
        forms = cut(found_forms, "forms")
    out.metrics["wordform_rows"] = forms.count()
    done("wordforms")

    mandatory = [f for f in C.FLAG_POLICY.get(lang, {}).get("mandatory", []) if f in affixes.flags]
    assembled = assembly.assemble(kept, forms, rules, lang=lang, mandatory=mandatory, audits=audits, skip_flags=affixes.skip_flags())
    assembled = cut(assembled, "assembly")
    out.metrics |= assembly.assembly_totals(assembled).first().asDict()
    report = reports.consolidated_report(assembled, audits, words, kept, forms, game=game, lang=lang) if options.provenance else None
    report = cut(report, "report") if report is not None else None
    out.tables = {"tokens": words, "keys": keys, "categories": categories, "audit": audits, "kept": kept, "wordforms": forms, "assembly": assembled, "report": report}
    done("assembly")
    if options.output:
        out.artifacts = write_pair(spark, out, affixes, found, options)
        done("write")
    return out


def _no_cases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "token_lower string, forms array<string>")


def write_pair(spark: SparkSession, result: PairResult, affixes: hunspell.Affixes, dictionary: dict, options: Options) -> dict:
    """All files of a pair under the output folder."""
    game, lang, t = result.game, result.lang, result.tables
    work, name = f"{options.output}/work/{game}_{lang}", f"{lang}_{game}"
    if options.cleanup:
        result.metrics["stale_removed"] = len(writers.remove_stale(spark, f"{options.output}/work", rf"^{game}_{lang}(_|$)"))
    out = {"tokens": f"{work}/tokens.txt", "filtered": f"{work}/filtered_tokens.dic", "audit": f"{work}/filter_audit", "wordforms": f"{work}/corpus_wordforms", "sidecar": f"{work}/propernoun_tokens.json"}
    writers.write_token_file(t["tokens"], out["tokens"])
    writers.write_filtered_dictionary(t["kept"], out["filtered"])
    writers.write_csv(t["audit"], out["audit"])
    writers.write_sidecar(t["categories"], t["keys"], out["sidecar"])
    writers.write_wordforms(t["wordforms"], csv_path=out["wordforms"], jsonl_path=f"{work}/wordforms_provenance")
    packed = t["assembly"].where("in_compressed_output")
    out |= {"flat": f"{options.output}/Flatlists/{name}.DIC", "dic": f"{options.output}/Compressed_dics/{name}/{name}.dic", "aff": f"{options.output}/Compressed_dics/{name}/{name}.aff"}
    writers.write_flat_list(t["assembly"], out["flat"])
    writers.write_dictionary(packed, out["dic"], affixes.meta["flag_mode"])
    used = {r[0] for r in assembly.flag_usage(t["assembly"].select(F.col("assigned_flags").alias("assigned"))).collect()}
    blocks = hunspell.raw_blocks(files.read_bytes(spark, dictionary["aff"]))
    files.write_bytes(spark, out["aff"], hunspell.custom_affixes(blocks, used).encode(blocks["encoding"], "replace"))
    out["full"] = f"{options.output}/Full_dics/{name}"
    writers.write_bundle(spark, out["full"], name, out["dic"], out["aff"], dictionary["dic"].rsplit("/", 1)[0])
    casing = t["assembly"].where("is_casing_inferred").select(F.get("source_base_words", F.lit(0)).alias("original"), F.col("token").alias("inferred_lower"), F.lit("corpus_exact_lower").alias("source"))
    writers.write_csv(casing.orderBy("original"), f"{work}/casing_inference")
    writers.write_jsonl(t["assembly"], f"{work}/munch_provenance")
    if t["report"] is not None:
        out |= {f"report_{k}": v for k, v in writers.write_report(t["report"], f"{options.output}/reports/{game}_{lang}_token_provenance_report").items()}
    return out


def run_batch(spark: SparkSession, inputs: Inputs, languages="all", games="all", options: Options = Options()) -> dict:
    """Run pairs games x languages that have a glossary; a report of statuses, timings, metrics and paths."""
    pairs = [(g, la) for g in selected(games, {g for g, _ in inputs.glossaries}) for la in selected(languages, {la for _, la in inputs.glossaries}) if (g, la) in inputs.glossaries]
    began = time.time()

    def one(pair: tuple[str, str]) -> PairResult:
        try:
            return run_pair(spark, inputs, *pair, options)
        except Exception as e:
            if options.strict:
                raise
            return PairResult(*pair, status="failed", error=f"{type(e).__name__}: {e}")

    workers = 1 if options.strict or len(pairs) < 2 else max(1, options.pair_workers)
    with ThreadPoolExecutor(workers) as pool:
        runs = list(pool.map(one, pairs))
    ok = sum(r.status == "ok" for r in runs)
    return {"runs": runs, "summary": {"pairs": len(runs), "ok": ok, "failed": len(runs) - ok, "seconds": round(time.time() - began, 3)}}


def run_single(spark: SparkSession, inputs: Inputs, language: str, game: str, **options) -> PairResult:
    return run_batch(spark, inputs, [language], [game], replace(Options(), **options))["runs"][0]


def consolidate_exports(spark: SparkSession, root: str, languages="all", games="all", *, flag_mode: str = "single", known_langs: set[str] = frozenset(C.TOKENIZER_MODES), known_games: set[str] = frozenset()) -> DataFrame:
    """(lang, word, flags, sources): the dictionaries of all tenants under root, merged by language."""
    found = files.discover_exports(spark, root, set(known_langs), set(known_games))
    langs, names = selected(languages, found["languages"]), {g.upper() for g in selected(games, found["games"])}
    parts = []
    for lang, game in found["pairs"]:
        if lang in langs and game in names:
            paths = files.resolve_export(spark, root, lang, game)
            df = hunspell.read_export(spark, paths["dic"] or paths["flat"], flag_mode)
            parts.append(df.withColumn("lang", F.lit(lang)).withColumn("game", F.lit(game)))
    if not parts:
        return spark.createDataFrame([], "lang string, word string, flags array<string>, sources array<string>")
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    return assembly.merge_exports(rows)


def consolidate_reports(spark: SparkSession, folder: str, languages="all", games="all") -> DataFrame:
    """All tenants' reports in a folder, merged by (language, token)."""
    found = files.discover_reports(spark, folder)
    langs, names = selected(languages, {la for _, la in found}), selected(games, {g for g, _ in found})
    parts = [readers.read_report(spark, path).select("game", "language", "token", "token_lower", "origin_class", "filter_status", "filter_match_type", *reports.BOOLEANS, *reports.LISTS) for (g, la), path in sorted(found.items()) if la in langs and g in names]
    if not parts:
        raise FileNotFoundError(f"no reports in {folder}")
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    return reports.merge_reports(rows).orderBy("token_lower")


def signature(spark: SparkSession, result: PairResult) -> dict:
    """What two runs of a pair must agree in."""
    import hashlib

    digest = {k: hashlib.sha256(files.read_bytes(spark, result.artifacts[k])).hexdigest() for k in ("dic", "aff") if k in result.artifacts}
    return {"status": result.status, "tokens": result.metrics.get("tokens"), "wordform_rows": result.metrics.get("wordform_rows")} | digest


def parse_verdicts(words: list[str], output: str) -> list[tuple[str, bool | None, str]]:
    """(word, is correct, suggestions) from the output of a spell checker in pipe mode: a block of lines a
    word; *, + and - are right, & is wrong with suggestions, # is wrong without."""
    lines = output.splitlines()
    blocks = [b.split("\n") for b in "\n".join(x for x in lines if not x.startswith("@")).split("\n\n") if b.strip()]
    out = []
    for word, block in zip(words, blocks):
        wrong = [x for x in block if x.startswith(("&", "#"))]
        right = any(x.startswith(("*", "+", "-")) for x in block)
        hints = "; ".join(x.split(": ", 1)[1] for x in wrong if ": " in x)
        out.append((word, False if wrong else True if right else None, hints))
    return out + [(w, None, "no_block") for w in words[len(blocks) :]]


def tokenizer_mode(lang: str) -> str:
    return C.TOKENIZER_MODES.get(files.language_prefix(lang), "default")


