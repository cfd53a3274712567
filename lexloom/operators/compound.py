"""Compound words: role sets of forms, and a test of tokens by splitting them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .affix import expand, flags_reaching
from .materialise import cut

#: how deep the first part may itself be a compound, and hyphenated parts be taken apart
BEGIN_DEPTH, HYPHEN_DEPTH = 3, 4
ROLES = ("begin", "middle", "end", "flag")


def role_forms(entries: DataFrame, rules: DataFrame, roles: dict[str, str], *, skip_flags: list[str] = (), word: str = "word", flags: str = "flags") -> DataFrame:
    """(form, role): all forms of entries that carry a role's flag, or a flag whose rules lead to it.

    ``roles`` names the flag of begin, middle, end and flag (any position). Flags that skip derivation
    still skip it, but a flag that only marks words for compounds does not.
    """
    known = {r: f for r, f in roles.items() if f}
    if not known:
        return entries.sparkSession.createDataFrame([], "form string, role string")
    by_flag = {f: r for r, f in known.items()}
    reach = F.broadcast(flags_reaching(rules, list(known.values())).replace(by_flag, subset=["role"]))
    marked = entries.select(F.col(word).alias("base"), F.explode(flags).alias("flag")).join(reach, "flag").select("base", "role").distinct()
    able = entries.join(marked.select(F.col("base").alias(word)).distinct(), word, "left_semi")
    forms = expand(able, rules, skip_flags=skip_flags, word=word, flags=flags)
    return forms.join(marked, "base").select("form", "role").distinct()


def _split(df: DataFrame, column: str, least: int) -> DataFrame:
    """Each way to cut ``column`` into left and right, both of at least ``least`` characters."""
    n = F.char_length(column)
    at = F.explode(F.when(n >= 2 * least, F.sequence(F.lit(least), n - least)))
    cut = df.withColumn("at", at)
    return cut.withColumn("left", F.substring(F.col(column), F.lit(1), F.col("at"))).withColumn("right", F.substring(F.col(column), F.col("at") + 1, n - F.col("at"))).drop("at")


def compounds(tokens: DataFrame, roles: DataFrame, forms: DataFrame, *, least: int = 3, token: str = "token_lower") -> DataFrame:
    """The distinct tokens that are compounds: begin + end, begin + middle + end, where the beginning may
    itself be a compound; two parts for any position; or parts between hyphens that are forms or compounds.

    Ends are looked up before beginnings, as they are fewer. What has still to be decided goes one level
    deeper, always as distinct words, and only while there is any.
    """
    words = cut(tokens.select(F.col(token).alias("w")).distinct(), "compound-words")
    known = cut(roles.select("form", "role").distinct(), "compound-roles")
    whole = cut(forms.select(F.col("form").alias("p")).distinct(), "compound-forms")
    present = {r[0] for r in known.select("role").distinct().collect()}  # at most four
    of = lambda role, name: known.where(F.col("role") == role).select(F.col("form").alias(name))
    return _compounds(words, of, present, whole, least, 0).withColumnRenamed("w", token)


def _compounds(words: DataFrame, of, present: set[str], whole: DataFrame, least: int, depth: int) -> DataFrame:
    words = words.where(F.char_length("w") >= 2 * least)
    found, deeper = [], []
    if {"begin", "end"} <= present:
        open_ = _split(words, "w", least).join(of("end", "right"), "right", "left_semi").select("w", "left")
        if "middle" in present:
            three = _split(words, "w", least).withColumnRenamed("right", "rest")
            three = _split(three.where(F.char_length("rest") >= 2 * least).withColumnRenamed("left", "begin"), "rest", least)
            three = three.join(of("end", "right"), "right", "left_semi").join(of("middle", "left"), "left", "left_semi").select("w", F.col("begin").alias("left"))
            open_ = open_.unionByName(three)
        open_ = cut(open_.distinct(), "compound-open")  # two steps read it
        found.append(open_.join(of("begin", "left"), "left", "left_semi").select("w"))
        rest = open_.join(of("begin", "left"), "left", "left_anti").where(F.char_length("left") >= 2 * least)
        if depth < BEGIN_DEPTH:
            deeper.append(rest.select(F.col("left").alias("w")))
    if "flag" in present:
        found.append(_split(words, "w", least).join(of("flag", "left"), "left", "left_semi").join(of("flag", "right"), "right", "left_semi").select("w"))
    # parts between hyphens; those that are no forms must be compounds
    parts = words.where(F.contains("w", F.lit("-"))).withColumn("parts", F.filter(F.split("w", "-"), lambda p: p != "")).where(F.size("parts") >= 2)
    pieces = parts.select("w", F.explode(F.array_distinct("parts")).alias("p"))
    unknown = cut(pieces.join(whole, "p", "left_anti"), "compound-pieces")
    deeper.append(unknown.select(F.col("p").alias("w")))
    inner = None
    if depth < HYPHEN_DEPTH:
        asked = deeper[0]
        for more in deeper[1:]:
            asked = asked.unionByName(more)
        asked = cut(asked.where(F.char_length("w") >= 2 * least).distinct(), "compound-asked")
        if not asked.isEmpty():
            inner = cut(_compounds(asked, of, present, whole, least, depth + 1), "compound-inner")
    if inner is not None and len(deeper) == 2:
        found.append(rest.join(inner.select(F.col("w").alias("left")), "left", "left_semi").select("w"))
    bad = unknown if inner is None else unknown.join(inner.select(F.col("w").alias("p")), "p", "left_anti")
    out = pieces.select("w").distinct().join(bad.select("w").distinct(), "w", "left_anti")
    for more in found:
        out = out.unionByName(more)
    return out.distinct()


def two_part_split(word: Column, least: int) -> Column:
    """All ways to cut a word in two, as an array of (left, right)."""
    n = F.char_length(word)
    pair = lambda i: F.struct(F.substring(word, F.lit(1), i).alias("left"), F.substring(word, i + 1, n - i).alias("right"))
    return F.when(n >= 2 * least, F.transform(F.sequence(F.lit(least), n - least), pair)).otherwise(F.array().cast("array<struct<left: string, right: string>>"))
