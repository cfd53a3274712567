"""Which tokens a dictionary knows: filter, audit, and merges of audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .affix import expand
from .compound import compounds, role_forms


def dictionary_forms(entries: DataFrame, rules: DataFrame, *, skip_flags: list[str] = (), checksharps: bool = False, keys: list[str] = ()) -> DataFrame:
    """(keys, form) of all forms of lower-case entries; with ``checksharps`` also with ss for ß."""
    forms = expand(entries, rules, keys=list(keys), skip_flags=skip_flags, word="base_lower").select(*keys, "form")
    if checksharps:
        forms = forms.select(*keys, F.explode(T.sharp_s_variants(F.col("form"))).alias("form"))
    return forms.distinct()


def known_forms(entries: DataFrame, rules: DataFrame, *, skip_flags: list[str] = (), forbidden: str | None = None, heads_only: bool = False, checksharps: bool = False) -> DataFrame:
    """(form): what a base dictionary knows, for telling new forms: forms of entries that are not forbidden
    and all head words, with ß and ss taken for each other; or head words alone."""
    heads = entries.select(F.col("base_lower").alias("form"))
    if heads_only:
        return heads.distinct()
    allowed = entries.where(~F.array_contains("flags", forbidden)) if forbidden else entries
    out = expand(allowed, rules, skip_flags=skip_flags, word="base_lower").select("form").unionByName(heads)
    return (out.select(F.explode(T.sharp_s_variants(F.col("form"), both_ways=True)).alias("form")) if checksharps else out).distinct()


def remove_known(tokens: DataFrame, forms: DataFrame, *, keys: list[str] = ()) -> DataFrame:
    """Tokens whose lower-case form the dictionary does not know."""
    known = forms.select(*keys, F.col("form").alias("ll_form")).distinct()
    on = [F.lower(tokens["token"]) == known["ll_form"]] + [tokens[k] == known[k] for k in keys]
    return tokens.join(known, on, "left_anti")


def audit(tokens: DataFrame, forms: DataFrame, *, compound_tokens: DataFrame | None = None, token_keys: DataFrame | None = None, keys: list[str] = ()) -> DataFrame:
    """(keys, token, token_lower, tb_key, status, match_type) of each distinct token: kept_neologism or
    removed_known_word, by exact_or_affix or compound."""
    keys = list(keys)
    known = forms.select(*keys, F.col("form").alias("token_lower")).distinct().withColumn("ll_exact", F.lit(True))
    rows = tokens.select(*keys, "token", F.lower("token").alias("token_lower")).distinct().join(known, [*keys, "token_lower"], "left")
    if compound_tokens is not None:
        made = compound_tokens.select(*[k for k in keys if k in compound_tokens.columns], "token_lower").distinct().withColumn("ll_compound", F.lit(True))
        rows = rows.join(made, [c for c in made.columns if c != "ll_compound"], "left")
    else:
        rows = rows.withColumn("ll_compound", F.lit(None).cast("boolean"))
    if token_keys is not None:
        rows = rows.join(token_keys.withColumn("tb_key", F.array_join("keys", " | ")).drop("keys"), [*keys, "token_lower"], "left")
    else:
        rows = rows.withColumn("tb_key", F.lit(""))
    match_type = F.when(F.col("ll_exact"), "exact_or_affix").when(F.col("ll_compound"), "compound").otherwise("")
    status = F.when(match_type == "", "kept_neologism").otherwise("removed_known_word")
    return rows.select(*keys, "token", "token_lower", F.coalesce("tb_key", F.lit("")).alias("tb_key"), status.alias("status"), match_type.alias("match_type"))


def filter_tokens(tokens: DataFrame, entries: DataFrame, rules: DataFrame, meta: dict, *, token_keys: DataFrame | None = None) -> DataFrame:
    """The audit of one language's tokens against its dictionary, compounds included where the affix file
    declares them; kept tokens are those with status kept_neologism."""
    skip = [f for f in (meta.get(k) for k in ("NEEDAFFIX", "CIRCUMFIX", "ONLYINCOMPOUND", "FORBIDDENWORD")) if f]
    forms = dictionary_forms(entries, rules, skip_flags=skip, checksharps=bool(meta.get("CHECKSHARPS")))
    roles = {"begin": meta.get("COMPOUNDBEGIN"), "middle": meta.get("COMPOUNDMIDDLE"), "end": meta.get("COMPOUNDEND"), "flag": meta.get("COMPOUNDFLAG")}
    found = None
    if any(roles.values()):
        free = [f for f in skip if f != meta.get("ONLYINCOMPOUND")]
        parts = role_forms(entries, rules, roles, skip_flags=free, word="base_lower")
        # unknown tokens only, as splitting multiplies rows
        unknown = remove_known(tokens, forms).select(F.lower("token").alias("token_lower")).distinct()
        found = compounds(unknown, parts, forms, least=meta.get("COMPOUNDMIN", 3))
    return audit(tokens, forms, compound_tokens=found, token_keys=token_keys)


def merge_audits(rows: DataFrame, order: Column, *, keys: list[str] = ()) -> DataFrame:
    """One row a token from several audits in ``order``: kept_neologism wins, else the first status; the first
    match type that is not empty; keys in order, each once."""
    ordered = F.array_sort(F.collect_list(F.struct(order.alias("o"), "status", "match_type", "tb_key")))
    rows = rows.groupBy(*keys, "token").agg(ordered.alias("r"))
    first = lambda field: F.coalesce(F.get(F.filter(F.transform("r", lambda x: F.trim(x[field])), lambda v: v != ""), F.lit(0)), F.lit(""))
    kept = F.exists("r", lambda x: F.trim(x["status"]) == "kept_neologism")
    every = F.array_distinct(F.flatten(F.transform("r", lambda x: T.pipe_list(x["tb_key"]))))
    return rows.select(*keys, "token", F.when(kept, "kept_neologism").otherwise(first("status")).alias("status"), first("match_type").alias("match_type"), F.array_join(every, " | ").alias("tb_key"))


def filter_summary(audits: DataFrame, *, keys: list[str]) -> DataFrame:
    """Tokens, kept, removed and the removal rate in percent for each of ``keys``."""
    kept = F.count_if(F.col("status") == "kept_neologism")
    n = F.count("*")
    return audits.groupBy(*keys).agg(n.alias("tokens"), kept.alias("kept"), (n - kept).alias("removed"), F.round((n - kept) * 100.0 / n, 6).alias("removal_rate"))
