"""Reports on where every token comes from: joins with audits and evidence, merges over tenants, and the
queries of the dashboard."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

BOOLEANS = ("in_tb_tokens", "in_filtered_dic_base", "is_corpus_form", "is_ghost_form", "is_casing_inferred")
LISTS = (
    "lineage_tags",
    "source_base_words",
    "assigned_flags",
    "mandatory_flags_assigned",
    "validated_flags_assigned",
    "validated_flags_candidates",
    "flag_generated_forms",
    "dropped_generated_by",
    "step4_related_bases",
)
MERGED_LISTS = ("source_games", "origin_classes", "filter_statuses", "filter_match_types")
CSV_COLUMNS = (
    "game", "language", "token", "token_lower", "origin_class", "lineage_tags", "in_tb_tokens", "tb_key", "tb_source_entity",
    "in_filtered_dic_base", "is_corpus_form", "is_ghost_form", "is_casing_inferred", "source_base_words", "assigned_flags",
    "mandatory_flags_assigned", "validated_flags_assigned", "validated_flags_candidates", "filter_status", "filter_match_type",
    "flag_evidence_summary", "step4_related_bases",
)
MERGED_COLUMNS = ("source_games", "source_reports_count", "source_rows_merged", "origin_classes", "filter_statuses", "filter_match_types")


def _none():
    return F.array().cast("array<string>")


def consolidated_report(assembly: DataFrame, audits: DataFrame, tokens: DataFrame, filtered: DataFrame, wordforms: DataFrame, *, game: str, lang: str) -> DataFrame:
    """One row for each token of the compressed dictionary: what assemble() knows, its audit, its glossary
    keys (its own first, then those of its bases), evidence for its flags, and bases that lead to it.

    The audit of the exact spelling comes before those of its lower-case form; the first gives status and
    match type, all kept ones give keys.
    """
    rows = assembly.where("in_compressed_output AND trim(token) <> ''").withColumn("token", F.trim("token")).withColumn("token_lower", F.lower("token"))
    exact = audits.select(F.trim("token").alias("spelling"), "status", "match_type", "tb_key").distinct()
    info = F.struct("spelling", "status", "match_type", "tb_key")
    by_low = exact.groupBy(F.lower("spelling").alias("low")).agg(F.array_sort(F.collect_list(info)).alias("infos"))

    def infos_for(df: DataFrame, word: str, out: str) -> DataFrame:
        got = df.join(by_low.withColumnsRenamed({"low": "ll_low", "infos": out}), F.lower(F.col(word)) == F.col("ll_low"), "left").drop("ll_low")
        own = F.filter(out, lambda x: x["spelling"] == F.col(word))
        return got.withColumn(out, F.coalesce(F.concat(own, F.col(out)), F.array().cast(by_low.schema["infos"].dataType)))

    keys_of = lambda infos: F.flatten(F.transform(F.filter(infos, lambda x: x["status"] == "kept_neologism"), lambda x: T.pipe_list(x["tb_key"])))
    rows = infos_for(rows, "token", "own_infos")

    # bases in their order, each with its keys and its evidence
    evidence_type = "array<struct<base_word: string, flag: string, derived_count: bigint, hit_count: bigint, hit_ratio: double, passed: boolean>>"
    tagged = F.transform(F.coalesce("flag_evidence", F.array().cast(wordforms.schema["flag_evidence"].dataType)), lambda e: F.struct(F.col("base_word").alias("base_word"), e["flag"].alias("flag"), e["derived_count"].alias("derived_count"), e["hit_count"].alias("hit_count"), e["hit_ratio"].alias("hit_ratio"), e["passed"].alias("passed")))
    per_base = wordforms.select("base_word", tagged.cast(evidence_type).alias("evidence"))
    spread = rows.select("token", F.posexplode("source_base_words").alias("nth", "base")).withColumn("base", F.trim("base"))
    spread = infos_for(spread, "base", "base_infos").join(per_base, spread["base"] == per_base["base_word"], "left")
    spread = spread.groupBy("token").agg(F.array_sort(F.collect_list(F.struct("nth", keys_of(F.col("base_infos")).alias("keys"), F.coalesce("evidence", F.array().cast(evidence_type)).alias("evidence")))).alias("per_base"))
    rows = rows.join(spread, "token", "left")
    tb_keys = F.array_distinct(F.concat(keys_of(F.col("own_infos")), F.flatten(F.transform(F.coalesce("per_base", F.array().cast(spread.schema["per_base"].dataType)), lambda x: x["keys"]))))

    related = wordforms.select(F.col("base_word"), F.explode(F.array_union("found_forms", "ghost_forms")).alias("form")).groupBy(F.lower(F.trim("form")).alias("token_lower")).agg(F.array_sort(F.collect_set("base_word")).alias("step4_related_bases"))
    rows = rows.join(related, "token_lower", "left")
    for name, words in (("in_tb_tokens", tokens), ("in_filtered_dic_base", filtered)):
        known = words.select(F.lower("token").alias("token_lower")).distinct().withColumn(name, F.lit(True))
        rows = rows.join(known, "token_lower", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    first = lambda f: F.coalesce(F.get("own_infos", F.lit(0))[f], F.lit(""))
    rows = rows.withColumn("tb_key", F.array_join(tb_keys, " | "))
    return rows.select(
        F.lit(game).alias("game"),
        F.lit(lang).alias("language"),
        "token",
        "token_lower",
        "origin_class",
        "lineage_tags",
        "in_tb_tokens",
        "tb_key",
        T.source_entity(F.col("tb_key")).alias("tb_source_entity"),
        "in_filtered_dic_base",
        "is_corpus_form",
        "is_ghost_form",
        "is_casing_inferred",
        F.filter(F.transform("source_base_words", lambda b: F.trim(b)), lambda b: b != "").alias("source_base_words"),
        "assigned_flags",
        "mandatory_flags_assigned",
        "validated_flags_assigned",
        "validated_flags_candidates",
        "flag_generated_forms",
        first("status").alias("filter_status"),
        first("match_type").alias("filter_match_type"),
        F.coalesce(F.flatten(F.transform("per_base", lambda x: x["evidence"])), F.array().cast(evidence_type)).alias("flag_evidence"),
        "dropped_generated_by",
        F.coalesce("step4_related_bases", _none()).alias("step4_related_bases"),
    )


def normalise_report(df: DataFrame) -> DataFrame:
    """Rows read from a report file in the types of consolidated_report(): texts trimmed, booleans from words,
    lists from pipes."""
    have = set(df.columns)
    out = df
    for c in ("token", "game", "language", "filter_status", "filter_match_type", "tb_key", "tb_source_entity"):
        out = out.withColumn(c, F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in have else F.lit(""))
    low = F.lower(F.trim(F.coalesce(F.col("token_lower").cast("string"), F.lit("")))) if "token_lower" in have else F.lit("")
    out = out.withColumn("token_lower", F.when(low == "", F.lower("token")).otherwise(low))
    origin = F.trim(F.coalesce(F.col("origin_class").cast("string"), F.lit(""))) if "origin_class" in have else F.lit("")
    out = out.withColumn("origin_class", F.when(origin == "", "generated_unknown").otherwise(origin))
    for c in BOOLEANS:
        out = out.withColumn(c, T.as_flag(F.col(c)) if c in have else F.lit(False))
    for c in LISTS + tuple(x for x in MERGED_LISTS if x in have):
        if c not in have:
            out = out.withColumn(c, _none())
        elif df.schema[c].dataType.simpleString().startswith("array"):
            out = out.withColumn(c, F.filter(F.transform(F.coalesce(c, _none()), lambda v: F.trim(v)), lambda v: v != ""))
        else:
            out = out.withColumn(c, T.pipe_list(F.col(c).cast("string")))
    return out


def csv_report(df: DataFrame) -> DataFrame:
    """A report flattened for CSV: lists joined by ' | ', evidence as a summary."""
    summary = T.evidence_summary(F.col("flag_evidence")) if "flag_evidence" in df.columns else F.lit("")
    flat = df.withColumn("flag_evidence_summary", summary)
    names = CSV_COLUMNS + tuple(c for c in MERGED_COLUMNS if c in df.columns)
    kinds = dict(flat.dtypes)
    return flat.select(*[F.array_join(c, " | ").alias(c) if kinds.get(c, "").startswith("array") else F.col(c) if c in kinds else F.lit("").alias(c) for c in names])


def merge_reports(rows: DataFrame) -> DataFrame:
    """Reports of several tenants in one row for each (language, token_lower): booleans or-ed, lists united
    and sorted, the shortest spelling, several classes as 'mixed', statuses joined."""
    texts = {c: F.array_sort(F.collect_set(F.when(F.trim(c) != "", F.trim(c)))) for c in ("filter_status", "filter_match_type")}
    surface = F.struct((F.col("token") == "").alias("empty"), F.char_length("token").alias("n"), F.lower("token").alias("l"), F.col("token").alias("t"))
    lists = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in LISTS if c in rows.columns]
    evidence = [F.array_sort(F.array_distinct(F.flatten(F.collect_list("flag_evidence")))).alias("flag_evidence")] if "flag_evidence" in rows.columns else []
    merged = rows.where("token_lower <> ''").groupBy("language", "token_lower").agg(
        F.min_by("token", surface).alias("token"),
        *[F.bool_or(c).alias(c) for c in BOOLEANS],
        *lists,
        *evidence,
        F.array_sort(F.collect_set("game")).alias("source_games"),
        F.count_distinct("game").alias("source_reports_count"),
        F.count("*").alias("source_rows_merged"),
        F.array_sort(F.collect_set("origin_class")).alias("origin_classes"),
        texts["filter_status"].alias("filter_statuses"),
        texts["filter_match_type"].alias("filter_match_types"),
    )
    return merged.withColumns(
        {
            "game": F.array_join("source_games", " | "),
            "origin_class": F.when(F.size("origin_classes") > 1, "mixed").otherwise(F.get("origin_classes", F.lit(0))),
            "filter_status": F.array_join("filter_statuses", " | "),
            "filter_match_type": F.array_join("filter_match_types", " | "),
        }
    )


def merge_metrics(before: DataFrame, merged: DataFrame) -> DataFrame:
    """One row: rows before the merge, rows after it, rows it removed."""
    b, a = before.agg(F.count("*").alias("rows_before")), merged.agg(F.count("*").alias("rows_after"))
    return b.join(a).withColumn("rows_removed", F.greatest(F.col("rows_before") - F.col("rows_after"), F.lit(0)))


def report_totals(rows: DataFrame) -> DataFrame:
    """One row: rows, distinct lower-case and exact tokens, and how often each boolean holds."""
    low = F.nullif(F.lower(F.trim("token_lower")), F.lit(""))
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_distinct(low).alias("distinct_token_lower"),
        F.count_distinct(F.nullif(F.trim("token"), F.lit(""))).alias("distinct_tokens_surface"),
        *[F.count_if(F.col(c)).alias(c) for c in BOOLEANS],
    )


def report_histograms(rows: DataFrame, top: int = 20) -> DataFrame:
    """(metric, value, rows): counts of classes, statuses, match types, tags, flags, tenants and lengths; of
    tags and flags only the ``top`` most frequent, ties by name."""
    shown = lambda c: F.when(F.trim(F.coalesce(c, F.lit(""))) == "", "(empty)").otherwise(F.trim(c))
    one = lambda metric, value: F.struct(F.lit(metric).alias("metric"), value.cast("string").alias("value"))
    many = lambda metric, c: F.transform(F.col(c), lambda v: one(metric, v))
    cells = F.array(
        one("origin_class", F.coalesce(F.nullif(F.col("origin_class"), F.lit("")), F.lit("generated_unknown"))),
        one("filter_status", shown("filter_status")),
        one("filter_match_type", shown("filter_match_type")),
        one("token_length", T.length_bucket(F.col("token"))),
    )
    lists = [many(m, c) for m, c in (("lineage_tag", "lineage_tags"), ("assigned_flag", "assigned_flags"), ("source_game", "source_games")) if c in rows.columns]
    counts = rows.select(F.explode(F.concat(cells, *lists)).alias("x")).groupBy("x.metric", "x.value").agg(F.count("*").alias("rows"))
    nth = F.row_number().over(Window.partitionBy("metric").orderBy(F.desc("rows"), "value"))
    return counts.withColumn("nth", nth).where(~F.col("metric").isin("lineage_tag", "assigned_flag") | (F.col("nth") <= top)).drop("nth")


EMPTY = "__EMPTY__"


@dataclass(frozen=True)
class ReportFilter:
    """What the dashboard's controls choose; empty texts and False choose everything."""

    text: str = ""
    origin: str = ""
    status: str = ""
    match_type: str = ""
    source_game: str = ""
    corpus: bool = False
    ghost: bool = False
    casing: bool = False
    tb: bool = False
    searched: tuple[str, ...] = field(
        default=("token", "game", "language", "token_lower", "origin_class", "filter_status", "filter_match_type", "tb_key", "tb_source_entity", "lineage_tags", "source_base_words", "assigned_flags", "source_games")
    )

    def condition(self, df: DataFrame) -> Column:
        kinds, out = dict(df.dtypes), F.lit(True)
        if self.origin:
            out = out & (F.col("origin_class") == self.origin)
        for value, c in ((self.status, "filter_status"), (self.match_type, "filter_match_type")):
            if value:
                out = out & (F.trim(F.coalesce(c, F.lit(""))) == ("" if value == EMPTY else value))
        if self.source_game:
            out = out & F.array_contains("source_games", self.source_game)
        for on, c in ((self.corpus, "is_corpus_form"), (self.ghost, "is_ghost_form"), (self.casing, "is_casing_inferred"), (self.tb, "in_tb_tokens")):
            if on:
                out = out & F.coalesce(F.col(c), F.lit(False))
        if wanted := self.text.strip().lower():
            parts = [F.array_join(c, " ") if kinds[c].startswith("array") else F.coalesce(F.col(c), F.lit("")) for c in self.searched if c in kinds]
            out = out & F.contains(F.lower(F.concat_ws(" ", *parts)), F.lit(wanted))
        return out


def report_query(df: DataFrame, chosen: ReportFilter = ReportFilter(), *, sort: str | None = None, descending: bool = False, page: int = 1, page_size: int = 120) -> DataFrame:
    """A page of the report's rows that match, sorted naturally (numbers by value, case and accents ignored,
    empty values last); ``page_size`` 0 is all."""
    rows = df.where(chosen.condition(df))
    if sort:
        kind = dict(df.dtypes)[sort]
        if kind in ("boolean", "int", "bigint", "double"):
            key, empty = F.col(sort).cast("double"), F.lit(False)
        else:
            value = F.array_join(sort, " | ") if kind.startswith("array") else F.coalesce(F.col(sort), F.lit(""))
            key, empty = T.natural_key(value), F.trim(value) == ""
        rows = rows.orderBy(empty, key.desc() if descending else key.asc(), "token")
    if page_size:
        rows = rows.offset((page - 1) * page_size).limit(page_size)
    return rows


def page_sizes(default: int = 120) -> list[int]:
    """Half, default, half more, double, and all."""
    return [max(1, default // 2), default, max(1, -(-default * 3 // 2)), max(1, default * 2), 0]


def bar_counts(df: DataFrame, column: str, limit: int = 12) -> DataFrame:
    """The most frequent values of a column or list column."""
    value = F.explode(column) if dict(df.dtypes)[column].startswith("array") else F.col(column)
    rows = df.select(value.alias("value")).where("value IS NOT NULL AND value <> ''")
    return rows.groupBy("value").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "value").limit(limit)


def verdict_summary(verdicts: DataFrame) -> DataFrame:
    """Correct, misspelled and unknown words with their percentages; ``verdicts`` has word and is_correct."""
    n = F.count("*")
    share = lambda c: F.round(c * 100.0 / n, 6)
    good, bad, open_ = F.count_if(F.col("is_correct")), F.count_if(~F.col("is_correct")), F.count_if(F.col("is_correct").isNull())
    return verdicts.agg(n.alias("words"), good.alias("correct"), bad.alias("misspelled"), open_.alias("unknown"), share(good).alias("correct_percent"), share(bad).alias("misspelled_percent"))


def parity(a: DataFrame, b: DataFrame, on: list[str], column: str = "signature") -> DataFrame:
    """Full outer comparison of two runs' signatures: keys, left, right, equal."""
    rows = a.select(*on, F.col(column).alias("left")).join(b.select(*on, F.col(column).alias("right")), on, "full")
    return rows.select(*on, "left", "right", F.col("left").eqNullSafe(F.col("right")).alias("equal"))


def median_seconds(timings: DataFrame, on: list[str]) -> DataFrame:
    """(on, runs, seconds): the median of each step's timings, column ``seconds``."""
    return timings.groupBy(*on).agg(F.count("seconds").alias("runs"), F.median("seconds").alias("seconds"))
