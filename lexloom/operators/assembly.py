"""Assembly of dictionaries: guards, casing, flags, pruning, provenance of every token."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from .affix import expand
from .materialise import cut


def _none():
    return F.array().cast("array<string>")


def confirmed_forms(bases: DataFrame, wordforms: DataFrame) -> DataFrame:
    """(form, tag, parent): every base and attested form, with where it comes from. ``bases`` has token,
    ``wordforms`` is the result of corpus_wordforms()."""
    own = bases.select(F.col("token").alias("form"), F.lit("tb_filtered_base").alias("tag"), F.col("token").alias("parent"))
    aff = wordforms.select(F.explode(F.array_union("found_forms", "new_found_forms")).alias("form"), F.lit("corpus_aff_form").alias("tag"), F.col("base_word").alias("parent"))
    ghost = wordforms.select(F.explode(F.array_union("ghost_forms", "new_ghost_forms")).alias("form"), F.lit("corpus_ghost_form").alias("tag"), F.col("base_word").alias("parent"))
    rows = own.unionByName(aff).unionByName(ghost).withColumn("form", F.trim("form"))
    return rows.where("form <> ''").distinct()


def guard_possessives(confirmed: DataFrame) -> DataFrame:
    return confirmed.where(~P.is_possessive(F.col("form")))


def guard_known_words(confirmed: DataFrame, audits: DataFrame) -> DataFrame:
    """Without forms whose lower-case the audit removed as known words."""
    known = audits.where(F.col("status") == "removed_known_word").select(F.coalesce(F.nullif(F.lower(F.trim("token_lower")), F.lit("")), F.lower(F.trim("token"))).alias("ll_low")).distinct()
    return confirmed.join(known, F.lower(confirmed["form"]) == known["ll_low"], "left_anti")


def infer_casing(bases: DataFrame, exact_lowers: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """(original, inferred_lower, source): capitalised bases whose lower-case spelling the corpus uses, or
    names hold if given, and is no base itself."""
    first = F.substring("token", 1, 1)
    upper = bases.select("token").distinct().where((first == F.upper(first)) & (first != F.lower(first))).select(F.col("token").alias("original"), F.lower("token").alias("inferred_lower"))
    upper = upper.where("original <> inferred_lower").join(bases.select(F.col("token").alias("inferred_lower")).distinct(), "inferred_lower", "left_anti")
    seen = exact_lowers.select(F.col("form").alias("inferred_lower")).distinct().withColumn("s1", F.lit("corpus_exact_lower"))
    rows = upper.join(seen, "inferred_lower", "left")
    if names is not None:
        listed = names.select(F.lower("token_lower").alias("inferred_lower")).distinct().withColumn("s2", F.lit("propernoun_sidecar"))
        rows = rows.join(listed, "inferred_lower", "left")
    else:
        rows = rows.withColumn("s2", F.lit(None).cast("string"))
    return rows.where("s1 IS NOT NULL OR s2 IS NOT NULL").select("original", "inferred_lower", F.concat_ws(" + ", "s1", "s2").alias("source"))


def assign_flags(bases: DataFrame, validated: DataFrame, mandatory: list[str]) -> DataFrame:
    """(token, assigned, mandatory): flags of each base: mandatory ones, and those validated for it, for its
    lower-case and for its capitalised spelling. ``validated`` has base_word and validated_flags."""
    low, cap = F.lower("token"), F.concat(F.upper(F.substring("token", 1, 1)), F.substring(F.col("token"), F.lit(2), F.char_length("token")))
    keys = bases.select("token").distinct().withColumn("base_word", F.explode(F.array_distinct(F.array("token", low, cap))))
    flags = validated.select("base_word", F.explode("validated_flags").alias("flag"))
    found = keys.join(flags, "base_word", "left").groupBy("token").agg(F.collect_set("flag").alias("found"))
    always = F.array(*[F.lit(f) for f in mandatory]).cast("array<string>")
    return found.select("token", F.array_sort(F.array_union("found", always)).alias("assigned"), F.array_sort(always).alias("mandatory"))


def flag_usage(assigned: DataFrame) -> DataFrame:
    return assigned.select(F.explode("assigned").alias("flag")).groupBy("flag").agg(F.count("*").alias("words"))


def generated_by_flags(assigned: DataFrame, rules: DataFrame, *, skip_flags: list[str] = ()) -> DataFrame:
    """(source, form): forms that flagged words generate in their own spelling, themselves among them."""
    flagged = assigned.where(F.size("assigned") > 0)
    return expand(flagged, rules, skip_flags=skip_flags, word="token", flags="assigned").withColumnRenamed("base", "source")


def redundant_forms(confirmed: DataFrame, assigned: DataFrame, generated: DataFrame) -> DataFrame:
    """(form, sources): confirmed forms without flags of their own that flagged words generate."""
    made = generated.where("form <> source AND trim(form) <> ''").join(confirmed.select("form").distinct(), "form", "left_semi")
    flagged = assigned.where(F.size("assigned") > 0).select(F.col("token").alias("form"))
    return made.join(flagged, "form", "left_anti").groupBy("form").agg(F.array_sort(F.collect_set("source")).alias("sources"))


def origin_class(is_base, is_corpus, is_ghost, is_casing):
    """The class of a token by where it comes from, the first that holds."""
    return (
        F.when(is_base & is_corpus, "tb_and_corpus")
        .when(is_base, "tb_only")
        .when(is_corpus | is_ghost, "corpus_only")
        .when(is_casing, "generated_casing_inference")
        .otherwise("generated_unknown")
    )


def assemble(bases: DataFrame, wordforms: DataFrame, rules: DataFrame, *, lang: str, mandatory: list[str] = (), audits: DataFrame | None = None, skip_flags: list[str] = ()) -> DataFrame:
    """The provenance of every token of a dictionary, one row each.

    Guards run before casing: a lower-case form that casing infers is not checked again.
    """
    # tables that several joins read are written once, as plans would double with every use
    confirmed = cut(confirmed_forms(bases, wordforms), "confirmed")
    exact = confirmed.where("tag <> 'tb_filtered_base' AND form = lower(form)").select("form")
    if lang == "en":
        confirmed = guard_possessives(confirmed)
    if audits is not None:
        confirmed = cut(guard_known_words(confirmed, audits), "guarded")
    left = confirmed.where("tag = 'tb_filtered_base'").select(F.col("form").alias("token")).distinct()
    casing = cut(infer_casing(left, exact), "casing")
    inferred = casing.select(F.col("inferred_lower").alias("form"), F.lit("casing_inference").alias("tag"), F.col("original").alias("parent"))
    everything = confirmed.unionByName(inferred)
    words = left.unionByName(casing.select(F.col("inferred_lower").alias("token"))).distinct()
    assigned = cut(assign_flags(words, wordforms, list(mandatory)), "assigned")
    generated = cut(generated_by_flags(assigned, rules, skip_flags=skip_flags), "generated")
    dropped = redundant_forms(everything, assigned, generated)
    rows = everything.groupBy(F.col("form").alias("token")).agg(F.array_sort(F.collect_set("tag")).alias("lineage_tags"), F.array_sort(F.collect_set("parent")).alias("source_base_words"))
    own = generated.groupBy(F.col("source").alias("token")).agg(F.array_sort(F.collect_set("form")).alias("flag_generated_forms"))
    candidates = wordforms.groupBy(F.col("base_word").alias("token")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("validated_flags")))).alias("validated_flags_candidates"))
    rows = rows.join(assigned.drop("mandatory"), "token", "left").join(dropped.withColumnRenamed("form", "token"), "token", "left").join(own, "token", "left").join(candidates, "token", "left")
    rows = rows.withColumns({c: F.coalesce(c, _none()) for c in ("assigned", "sources", "flag_generated_forms", "validated_flags_candidates")})
    tag = lambda t: F.array_contains("lineage_tags", t)
    always = F.array(*[F.lit(f) for f in mandatory]).cast("array<string>")
    is_base, is_corpus, is_ghost, is_casing = tag("tb_filtered_base"), tag("corpus_aff_form"), tag("corpus_ghost_form"), tag("casing_inference")
    gone = F.size("sources") > 0
    return rows.select(
        "token",
        F.lower("token").alias("token_lower"),
        origin_class(is_base, is_corpus, is_ghost, is_casing).alias("origin_class"),
        "lineage_tags",
        "source_base_words",
        is_base.alias("is_tb_base"),
        is_corpus.alias("is_corpus_form"),
        is_ghost.alias("is_ghost_form"),
        is_casing.alias("is_casing_inferred"),
        F.lit(True).alias("in_flat_output"),
        (~gone).alias("in_compressed_output"),
        gone.alias("dropped_from_compressed"),
        F.col("sources").alias("dropped_generated_by"),
        F.col("assigned").alias("assigned_flags"),
        F.array_intersect("assigned", always).alias("mandatory_flags_assigned"),
        F.array_intersect("assigned", "validated_flags_candidates").alias("validated_flags_assigned"),
        "validated_flags_candidates",
        "flag_generated_forms",
    )


def assembly_totals(rows: DataFrame) -> DataFrame:
    """One row of counts over assemble()'s result."""
    return rows.agg(
        F.count_if(F.col("is_tb_base")).alias("base_words"),
        F.count("*").alias("flat_words"),
        F.count_if(F.col("in_compressed_output")).alias("compressed_entries"),
        F.count_if(F.size("assigned_flags") > 0).alias("flagged_words"),
        F.count_if(F.col("is_casing_inferred")).alias("casing_inferences"),
        F.count_if(F.col("dropped_from_compressed")).alias("pruned"),
    )


def merge_exports(entries: DataFrame, *, keys: list[str] = ("lang",)) -> DataFrame:
    """Dictionaries of several tenants in one: columns keys, game, word, flags; flags and tenants united by
    exact word."""
    return entries.groupBy(*keys, "word").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("flags")))).alias("flags"), F.array_sort(F.collect_set("game")).alias("sources"))


def prune_merged(merged: DataFrame, rules: DataFrame, *, skip_flags: list[str] = ()) -> DataFrame:
    """``merged`` without words that have no flags and that flagged words generate, whatever their case."""
    made = expand(merged.where(F.size("flags") > 0), rules, keys=[], skip_flags=skip_flags).where("form <> base")
    low = made.select(F.lower("form").alias("ll_low")).distinct()
    plain = merged.where(F.size("flags") == 0)
    return merged.where(F.size("flags") > 0).unionByName(plain.join(low, F.lower(plain["word"]) == low["ll_low"], "left_anti"))


def better_surface(word: str | Column = "word"):
    """Order by which the best of several spellings comes first: capitalised, then shorter, then by letter."""
    word = F.col(word) if isinstance(word, str) else word
    first = F.substring(word, 1, 1)
    capital = (first == F.upper(first)) & (first != F.lower(first))
    return F.struct((~capital).alias("c"), F.char_length(word).alias("n"), F.lower(word).alias("l"), word.alias("w"))


def representative_surface(words: DataFrame, *, keys: list[str], word: str = "word") -> DataFrame:
    """The best spelling of each word. Repeated words go first, by hashing: a minimum of texts sorts what it is given,
    and Spark leaves out a distinct() below one. The few spellings of a word are compared as a list."""
    best = F.array_min(F.transform(F.collect_list(word), better_surface))["w"]
    return words.select(*keys, word).distinct().groupBy(*keys, F.lower(word).alias("word_lower")).agg(best.alias("surface"))
