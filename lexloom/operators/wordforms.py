"""Word forms of dictionary candidates that the corpus attests, and which flags hold by quorum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import predicates as P
from .affix import expand
from .materialise import cut


def gender_ghosts(bases: DataFrame, lang: str, *, base: str = "base_lower") -> DataFrame:
    """(base_lower, form): supposed gender and plural forms of names, by suffix and after dropping an accent."""
    suffixes, endings = C.GHOST_SUFFIXES.get(lang, ((), ()))
    b = F.col(base)
    rows = bases.select(b.alias("base_lower")).distinct()
    if not suffixes:
        return rows.select("base_lower", F.col("base_lower").alias("form")).limit(0)
    b = F.col("base_lower")
    if lang == "es":
        rows = rows.where(~b.isin(*C.SPANISH_NOISE) & (F.char_length(b) > 3) & ~((F.char_length(b) <= 4) & F.endswith(b, F.lit("r"))))
    neutral = F.lit(None).cast("string")
    for end, plain in reversed(endings):
        neutral = F.when(F.endswith(b, F.lit(end)), F.concat(F.substring(b, F.lit(1), (F.char_length(b) - len(end)).cast("int")), F.lit(plain))).otherwise(neutral)
    stems = F.filter(F.array(b, neutral), lambda s: s.isNotNull())
    made = F.flatten(F.transform(stems, lambda s: F.array(*[F.concat(s, F.lit(x)) for x in suffixes])))
    forms = F.array_distinct(F.concat(made, F.filter(F.array(neutral), lambda s: s.isNotNull())))
    return rows.select("base_lower", F.explode(forms).alias("form")).where("form <> base_lower")


def candidate_flags(lang: str, rules: DataFrame, add_verbs: bool = False) -> list[str]:
    """The flags to test for a language: those of its policy that the rules know."""
    policy = C.FLAG_POLICY.get(lang, {})
    wanted = policy.get("validation", []) + (policy.get("verb", []) if add_verbs else [])
    there = {r[0] for r in rules.select("flag").distinct().collect()}
    return [f for f in wanted if f in there]


def attested(forms: DataFrame, case_map: DataFrame, lang: str) -> DataFrame:
    """(.., form, spelling): generated forms that occur in the corpus, in each of their spellings. In English
    possessives are none."""
    spelled = case_map.select(F.col("token_lower").alias("form"), F.explode("forms").alias("spelling"))
    hits = forms.join(spelled, "form")
    return hits.where(~P.is_possessive(F.col("form")) & ~P.is_possessive(F.col("spelling"))) if lang == "en" else hits


def corpus_wordforms(
    words: DataFrame,
    rules: DataFrame,
    case_map: DataFrame,
    *,
    lang: str,
    flags: list[str],
    quorum: float = 0.5,
    names: DataFrame | None = None,
    custom_known: DataFrame | None = None,
    std_known: DataFrame | None = None,
    retain_known: bool = True,
    skip_flags: list[str] = (),
) -> DataFrame:
    """A row for each base word with any evidence: base_word, found_forms, count, ghost_forms, ghost_count,
    new_found_forms, new_count, new_ghost_forms, new_ghost_count, validated_flags and flag_evidence.

    ``words`` has base_word; every flag of the rules is tried for forms, ``flags`` for quorum. Ghost
    forms are tried for bases among ``names`` (token_lower). New forms are known neither to the custom
    nor to the standard dictionary (columns form). Without ``retain_known`` only new forms are listed.
    """
    all_flags = [r[0] for r in rules.select("flag").distinct().collect() if r[0] not in set(skip_flags)]
    bases = words.select("base_word", F.lower("base_word").alias("base_lower")).distinct()
    if lang == "es":
        bases = bases.where(~F.col("base_lower").isin(*C.SPANISH_NOISE))
    lowers = bases.select("base_lower").distinct().withColumn("flags", F.array(*[F.lit(f) for f in all_flags]).cast("array<string>"))
    # one expansion serves both forms and quorum
    made = cut(expand(lowers, rules, skip_flags=skip_flags, word="base_lower", by_flag=True).withColumnRenamed("base", "base_lower"), "wordforms")
    forms = made.select("base_lower", "form").distinct()
    found = attested(forms, case_map, lang).select("base_lower", "form", "spelling", F.lit("aff").alias("kind"))
    if names is not None:
        named = lowers.select("base_lower").join(names.select(F.col("token_lower").alias("base_lower")).distinct(), "base_lower", "left_semi")
        ghosts = gender_ghosts(named, lang).join(forms, ["base_lower", "form"], "left_anti")
        found = found.unionByName(attested(ghosts, case_map, lang).select("base_lower", "form", "spelling", F.lit("ghost").alias("kind")))
    known = [k.select(F.col("form").alias("form")) for k in (custom_known, std_known) if k is not None]
    if known:
        both = known[0] if len(known) == 1 else known[0].unionByName(known[1])
        found = found.join(both.distinct().withColumn("known", F.lit(True)), "form", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    else:
        found = found.withColumn("known", F.lit(False))
    listed = found if retain_known else found.where("NOT known")
    collect = lambda kind, new: F.array_sort(F.collect_set(F.when((F.col("kind") == kind) & (~F.col("known") if new else F.lit(retain_known)), F.col("spelling"))))
    per_base = listed.groupBy("base_lower").agg(collect("aff", False).alias("found_forms"), collect("ghost", False).alias("ghost_forms"), collect("aff", True).alias("new_found_forms"), collect("ghost", True).alias("new_ghost_forms"))
    per_base = per_base.withColumn("ghost_forms", F.array_except("ghost_forms", "found_forms")).withColumn("new_ghost_forms", F.array_except("new_ghost_forms", "new_found_forms"))
    evidence = evidence_of(hits_by_flag(made, case_map, lang=lang, flags=flags, quorum=quorum))
    rows = bases.join(per_base, "base_lower", "left").join(evidence, "base_lower", "left")
    for c in ("found_forms", "ghost_forms", "new_found_forms", "new_ghost_forms", "validated_flags"):
        rows = rows.withColumn(c, F.coalesce(c, F.array().cast("array<string>")))
    some = F.size("found_forms") + F.size("ghost_forms") + F.size("new_found_forms") + F.size("new_ghost_forms") + F.size("validated_flags")
    return rows.where(some > 0).select(
        "base_word",
        "new_found_forms",
        F.size("new_found_forms").alias("new_count"),
        "found_forms",
        F.size("found_forms").alias("count"),
        "ghost_forms",
        F.size("ghost_forms").alias("ghost_count"),
        "new_ghost_forms",
        F.size("new_ghost_forms").alias("new_ghost_count"),
        "validated_flags",
        "flag_evidence",
    )


def quorum_rows(bases: DataFrame, rules: DataFrame, case_map: DataFrame, *, lang: str, flags: list[str], quorum: float, skip_flags: list[str] = ()) -> DataFrame:
    """(base_lower, flag, derived_count, hit_count, hit_ratio, passed, hit_forms_lower, hit_forms_truecase):
    each flag alone against the corpus."""
    alone = bases.select("base_lower").distinct().withColumn("flags", F.array(*[F.lit(f) for f in flags]).cast("array<string>"))
    made = expand(alone, rules, skip_flags=skip_flags, word="base_lower", by_flag=True).withColumnRenamed("base", "base_lower")
    return hits_by_flag(made, case_map, lang=lang, flags=flags, quorum=quorum)


def hits_by_flag(made: DataFrame, case_map: DataFrame, *, lang: str, flags: list[str], quorum: float) -> DataFrame:
    """quorum_rows() of forms that are already there: (base_lower, form, flag), forms that cross flags left out."""
    forms = made.where(F.col("flag").isin(flags)).select("base_lower", "form", "flag").distinct()
    truth = case_map.select(F.col("token_lower").alias("form"), "forms")
    rows = forms.join(truth, "form", "left")
    hit = F.col("forms").isNotNull()
    if lang == "en":
        hit = hit & ~P.is_possessive(F.col("form"))
        rows = rows.withColumn("forms", F.filter("forms", lambda s: ~P.is_possessive(s)))
    n, hits = F.count("*"), F.count_if(hit)
    ratio = hits / n
    return rows.groupBy("base_lower", "flag").agg(
        n.alias("derived_count"),
        hits.alias("hit_count"),
        F.round(ratio, 6).alias("hit_ratio"),
        ((hits > 0) & (ratio >= quorum)).alias("passed"),
        F.array_sort(F.collect_set(F.when(hit, F.col("form")))).alias("hit_forms_lower"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(hit, F.col("forms")))))).alias("hit_forms_truecase"),
    )


def evidence_of(rows: DataFrame) -> DataFrame:
    """(base_lower, validated_flags, flag_evidence) of quorum_rows(), flags in the order of their names."""
    one = F.struct("flag", "derived_count", "hit_count", "hit_ratio", "passed", "hit_forms_lower", "hit_forms_truecase")
    return rows.groupBy("base_lower").agg(F.array_sort(F.collect_set(F.when(F.col("passed"), F.col("flag")))).alias("validated_flags"), F.array_sort(F.collect_list(one)).alias("flag_evidence"))


def wordform_totals(results: DataFrame) -> DataFrame:
    """One row: bases, bases with new forms, sums of all counts, and bases with validated flags."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}")
    return results.agg(
        F.count("*").alias("bases"),
        F.count_if(F.col("new_count") > 0).alias("bases_with_new"),
        F.count_if(F.col("ghost_count") > 0).alias("bases_with_ghosts"),
        F.count_if(F.size("validated_flags") > 0).alias("bases_with_flags"),
        *[total(c) for c in ("count", "new_count", "ghost_count", "new_ghost_count")],
    )


def top_bases(results: DataFrame, column: str = "new_count", n: int = 20) -> DataFrame:
    """The bases with most of ``column``, none without any."""
    return results.where(F.col(column) > 0).orderBy(F.desc(column), "base_word").limit(n)


def diff_wordforms(old: DataFrame, new: DataFrame) -> DataFrame:
    """(base_word, lost, gained, kept) of the found forms of two runs."""
    a = old.select("base_word", F.col("found_forms").alias("a"))
    b = new.select("base_word", F.col("found_forms").alias("b"))
    none = F.array().cast("array<string>")
    rows = a.join(b, "base_word", "full").select("base_word", F.coalesce("a", none).alias("a"), F.coalesce("b", none).alias("b"))
    return rows.select("base_word", F.array_sort(F.array_except("a", "b")).alias("lost"), F.array_sort(F.array_except("b", "a")).alias("gained"), F.array_sort(F.array_intersect("a", "b")).alias("kept"))


def diff_totals(diff: DataFrame) -> DataFrame:
    lost, kept = F.sum(F.size("lost")), F.sum(F.size("kept"))
    return diff.agg(lost.alias("lost"), kept.alias("kept"), F.sum(F.size("gained")).alias("gained"), F.round(lost * 100.0 / F.greatest(lost + kept, F.lit(1)), 6).alias("lost_percent"))


def top_lost(diff: DataFrame, n: int = 30) -> DataFrame:
    """(base_word, lost): the bases that lost most forms, ties by name."""
    return diff.where(F.size("lost") > 0).orderBy(F.desc(F.size("lost")), "base_word").limit(n).select("base_word", "lost")


def order_by_lower(column: str | Column) -> list[Column]:
    """Case-insensitive order, ties by the word itself."""
    c = F.col(column) if isinstance(column, str) else column
    return [F.lower(c), c]
