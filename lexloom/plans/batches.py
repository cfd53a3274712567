"""Work over whole folders: filtering token lists, warming corpora, exporting merged dictionaries, and cleaning up."""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assembly, filtering, language
from ..operators.materialise import cut
from ..sources import files, hunspell, readers, writers
from .pipeline import Inputs, Options, consolidate_exports

#: corpora whose names end so went through the language filter already
FILTERED_CORPUS = ("_i18n_filtered.json", "_i18n_filtered.properties")


def filter_token_files(spark: SparkSession, folder: str, languages: list[str], dictionaries: dict[str, str], output: str, *, sidecar: str | None = None, rewrite: bool = False) -> list[dict]:
    """Filter every token list of each language against its dictionary: kept words as a dictionary, and the audit.

    A list whose result is there is left alone unless ``rewrite``. A row for each file: language, input, output,
    status (ok, skipped, no_dictionary), tokens, kept, removed, removal_rate in percent, and seconds."""
    keys = writers.read_sidecar(spark, sidecar)[1] if sidecar else None
    done = []
    for lang in languages:
        found = files.find_dictionary(spark, lang, dictionaries)
        lists = files.token_files(spark, folder, lang)
        if not found["ok"]:
            done += [{"language": lang, "input": path, "status": "no_dictionary"} for path in lists]
            continue
        affixes = hunspell.read_affixes(spark, found["aff"])
        rules, entries = affixes.table(spark), cut(hunspell.read_entries(spark, found["dic"], affixes), "entries")
        for path in lists:
            name = path.rsplit("/", 1)[-1].rsplit(".", 1)[0].replace("tokens", "filtered_tokens")
            target, row = f"{output}/{name}.dic", {"language": lang, "input": path}
            if files.exists(spark, target) and not rewrite:
                done.append(row | {"output": target, "status": "skipped"})
                continue
            began = time.time()
            audits = cut(filtering.filter_tokens(readers.read_token_list(spark, path), entries, rules, affixes.meta, token_keys=keys), "audits")
            writers.write_csv(audits, f"{output}/{name}_filter_audit")
            # the dictionary comes last: where it is there, all of the list's results are
            writers.write_filtered_dictionary(audits.where("status = 'kept_neologism'"), target)
            counts = filtering.filter_summary(audits.withColumn("language", F.lit(lang)), keys=["language"]).first()
            counts = counts.asDict() if counts else {"tokens": 0, "kept": 0, "removed": 0, "removal_rate": 0.0}
            done.append(row | counts | {"output": target, "status": "ok", "seconds": round(time.time() - began, 3)})
    return done


def batch_totals(spark: SparkSession, done: list[dict]) -> DataFrame:
    """Sums, removal rate and mean seconds of filter_token_files(), by language and ('all') together."""
    rows = [(r["language"], r["tokens"], r["kept"], r["removed"], r["seconds"]) for r in done if r["status"] == "ok"]
    rows = spark.createDataFrame(rows, "language string, tokens long, kept long, removed long, seconds double")
    rate = F.round(F.sum("removed") * 100.0 / F.greatest(F.sum("tokens"), F.lit(1)), 6)
    out = rows.rollup("language").agg(F.count("*").alias("files"), F.sum("tokens").alias("tokens"), F.sum("kept").alias("kept"), F.sum("removed").alias("removed"), rate.alias("removal_rate"), F.round(F.avg("seconds"), 3).alias("mean_seconds"))
    return out.withColumn("language", F.coalesce("language", F.lit("all")))


def warm_corpora(spark: SparkSession, inputs: Inputs, folder: str, options: Options = Options()) -> tuple[Inputs, dict]:
    """Filter the corpora of all pairs by language, one pass for each language, and write what stays to ``folder``.

    Gives the inputs with the new paths, and a report: runs (game, language, path, status ok, skipped or failed,
    error) and their summary. Corpora that were filtered before are taken as they are; missing ones are skipped."""
    began, runs, wanted, paths = time.time(), {}, {}, {}
    for (game, lang), path in inputs.corpora.items():
        pair = (game, files.language_prefix(lang))
        if pair in runs or not path:
            continue
        run = runs[pair] = {"game": pair[0], "language": pair[1], "path": path, "status": "ok", "error": ""}
        paths[pair] = path
        if not files.exists(spark, path):
            run |= {"status": "skipped", "error": f"no corpus at {path}"}
        elif not path.endswith(FILTERED_CORPUS) and inputs.profile_texts is not None and options.detect_language:
            wanted.setdefault(pair[1], []).append(pair)
    table = cut(language.profiles(inputs.profile_texts), "profiles") if wanted else None
    for lang, pairs in wanted.items():
        try:
            rows = None
            for game, _ in pairs:
                more = readers.read_i18n(spark, paths[game, lang], game, lang)
                rows = more if rows is None else rows.unionByName(more)
            # keys are unique within a game only
            keyed = rows.withColumn("ll_id", F.concat_ws("\x1f", "game", "key"))
            checked = language.language_filter(keyed, table, lang=lang, id_col="ll_id", min_words=options.min_words, min_confidence=options.min_confidence)
            kept = cut(checked.where(~F.col("is_wrong")).select(*rows.columns), "warm")
            for game, _ in pairs:
                end = ".properties" if paths[game, lang].lower().endswith(".properties") else ".json"
                target = f"{folder}/{game}_{lang}_i18n_filtered{end}"
                writers.write_i18n(kept.where(F.col("game") == game), target)
                paths[game, lang] = runs[game, lang]["path"] = target
        except Exception as e:
            if options.strict:
                raise
            for pair in pairs:
                runs[pair] |= {"status": "failed", "error": f"{type(e).__name__}: {e}"}
    states = [r["status"] for r in runs.values()]
    summary = {"total": len(states), "seconds": round(time.time() - began, 3)} | {s: states.count(s) for s in ("ok", "skipped", "failed")}
    return replace(inputs, corpora=paths), {"runs": list(runs.values()), "summary": summary}


def export_merged(spark: SparkSession, root: str, dictionaries: dict[str, str], output: str, *, tenant: str, languages="all", games="all", known_games: set[str] = frozenset()) -> dict[str, dict]:
    """The dictionaries of all tenants, merged by language, as exports of one ``tenant``.

    The flat list has every word; the compressed dictionary has no words that its flagged words generate, and its
    affix file only the flags it uses; the full bundle adds the reference's files. Paths and counts by language."""
    merged = cut(consolidate_exports(spark, root, languages, games, known_games=known_games), "merged")
    out = {}
    for lang in sorted(r[0] for r in merged.select("lang").distinct().collect()):
        found = files.find_dictionary(spark, lang, dictionaries)
        if not found["ok"]:
            raise FileNotFoundError(f"no dictionary for {lang}: {[c['dic'] for c in found['checks']]}")
        raw = files.read_bytes(spark, found["aff"])
        affixes, blocks, name = hunspell.parse_affixes(raw), hunspell.raw_blocks(raw), f"{lang}_{tenant}"
        words = merged.where(F.col("lang") == lang).drop("lang")
        pruned = cut(assembly.prune_merged(words, affixes.table(spark), skip_flags=affixes.skip_flags()), "pruned")
        used = sorted(r[0] for r in assembly.flag_usage(pruned.select(F.col("flags").alias("assigned"))).collect())
        paths = {"flat": f"{output}/Flatlists/{name}.DIC", "dic": f"{output}/Compressed_dics/{name}/{name}.dic", "aff": f"{output}/Compressed_dics/{name}/{name}.aff", "full": f"{output}/Full_dics/{name}"}
        flat = writers.write_flat_list(words.select(F.col("word").alias("token")), paths["flat"])
        writers.write_dictionary(pruned.select(F.col("word").alias("token"), F.col("flags").alias("assigned_flags")), paths["dic"], affixes.meta["flag_mode"])
        files.write_bytes(spark, paths["aff"], hunspell.custom_affixes(blocks, set(used)).encode(blocks["encoding"], "replace"))
        writers.write_bundle(spark, paths["full"], name, paths["dic"], paths["aff"], found["dic"].rsplit("/", 1)[0])
        entries = pruned.count()
        out[lang] = paths | {"flat_words": flat, "entries": entries, "pruned": flat - entries, "flags_used": used}
    return out


def erase_outputs(spark: SparkSession, work: str, output: str, *, keep_filtered: bool = True) -> dict:
    """Empty both folders; with ``keep_filtered`` the filtered corpora directly in ``work`` stay."""
    removed, kept = [], []
    for folder, spare in ((work, keep_filtered), (output, False)):
        for name, is_folder in files.names_in(spark, folder):
            stays = spare and not is_folder and name.endswith(FILTERED_CORPUS)
            (kept if stays else removed).append(f"{folder}/{name}")
            if not stays:
                files.delete(spark, f"{folder}/{name}")
    return {"removed": removed, "kept": kept}
