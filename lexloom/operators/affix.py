"""Expansion of dictionary entries by affix rules, set at a time.

Rules are a small table: kind (SFX or PFX), flag, cross_product, rule_no, strip, add, add_flags and
condition. A round of expansion is one join of (word, flag) with the rules of that flag; only rules
that add flags feed the next round, and at most four affixes are chained. A suffixed and a prefixed form
of one word are crossed if both rules allow it.

Entries of other languages never meet: ``keys`` such as lang are part of every join.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .materialise import cut

MOST_AFFIXES = 4
RULES = "kind string, flag string, cross_product boolean, rule_no int, strip string, add string, add_flags array<string>, condition string"
#: rule tables are a few thousand rows; larger ones are joined by shuffle
BROADCAST_RULES = 50_000


def usable_condition(condition: Column, kind: Column) -> Column:
    """The anchored pattern of a rule; '' for conditions that match everything."""
    return F.when(condition == ".", "").when(kind == "PFX", F.concat(F.lit("^(?:"), condition, F.lit(")"))).otherwise(F.concat(F.lit("(?:"), condition, F.lit(")$")))


def condition_holds(word: Column, pattern: Column) -> Column:
    return (pattern == "") | F.rlike(word, pattern)


def attach(word: Column, kind: Column, strip: Column, add: Column) -> Column:
    """The derived form; null if the part to strip is not there."""
    n, k = F.char_length(word), F.char_length(strip)
    suffixed = F.when(F.endswith(word, strip), F.concat(F.substring(word, F.lit(1), (n - k).cast("int")), add))
    prefixed = F.when(F.startswith(word, strip), F.concat(add, F.substring(word, (k + 1).cast("int"), F.greatest(n - k, F.lit(0)).cast("int"))))
    return F.when(kind == "SFX", suffixed).otherwise(prefixed)


def _hinted(rules: DataFrame, n_rules: int) -> DataFrame:
    return F.broadcast(rules) if n_rules <= BROADCAST_RULES else rules


@lru_cache(maxsize=100_000)
def _compiles(condition: str) -> bool:
    from py4j.protocol import Py4JJavaError
    from pyspark import SparkContext

    try:
        SparkContext._active_spark_context._jvm.java.util.regex.Pattern.compile(f"(?:{condition})$")
    except Py4JJavaError:
        return False
    return True


class _Facts:
    """What planning needs to know of a rule table, by one job: an affix file has a few thousand rules at most."""

    def __init__(self, rules: DataFrame):
        rows = rules.groupBy("kind", "flag", "cross_product", "add_flags", "condition").agg(F.count("*").alias("n")).collect()
        self.n = sum(r["n"] for r in rows)
        self.crossing = any(r["kind"] == "PFX" and r["cross_product"] for r in rows)
        self.leads = {}
        for r in rows:
            self.leads.setdefault(r["flag"], set()).update(r["add_flags"] or ())
        self.broken = sorted({r["condition"] for r in rows if r["condition"] not in (None, ".") and not _compiles(r["condition"])})

    def levels(self, skipped: set[str]) -> int:
        """How many affixes can follow each other."""
        active, depth = set(self.leads) - skipped, 1
        while depth < MOST_AFFIXES:
            active = {f for a in active for f in self.leads.get(a, ())} - skipped
            if not active & set(self.leads):
                break
            depth += 1
        return depth

    def table(self, rules: DataFrame) -> DataFrame:
        """``rules`` with anchored patterns; a condition that is no pattern matches everything."""
        condition = F.coalesce("condition", F.lit("."))
        if self.broken:
            condition = F.when(condition.isin(self.broken), ".").otherwise(condition)
        return rules.withColumn("pattern", usable_condition(condition, F.col("kind"))).drop("condition", "rule_no").withColumnRenamed("flag", "rule_flag")


def expand(entries: DataFrame, rules: DataFrame, *, keys: list[str] = (), skip_flags: list[str] = (), word: str = "word", flags: str = "flags", by_flag: bool = False) -> DataFrame:
    """(keys, base, form) of all forms of ``entries``, each base among its own forms; with ``by_flag`` also
    the entry's flag that the form comes from (for crossed forms both), without the bases.

    ``skip_flags`` are those that are no affixes (they need, forbid or mark something). Definition: all forms
    reachable by at most four affixes; at every word its suffixed forms cross with the prefixes of the same
    flags. Flags of repeated entries are united. A level is a chain of joins with the broadcast rules, without
    a shuffle; where rules add flags, levels are written so that the next one reads them.
    """
    keys, skipped = list(keys), set(skip_flags)
    facts = _Facts(rules)
    table = _hinted(facts.table(rules), facts.n)
    active = lambda c: F.filter(c, lambda f: ~f.isin(sorted(skipped))) if skipped else F.col(c)
    shared = [k for k in keys if k in table.columns]
    union = F.array_distinct(F.flatten(F.collect_list(F.coalesce(flags, F.array().cast("array<string>")))))
    start = entries.groupBy(*keys, F.col(word).alias("base")).agg(union.alias("stem_flags")).where("base IS NOT NULL")
    bases = start.select(*keys, "base")
    level = start.select(*keys, "base", F.col("base").alias("stem"), active("stem_flags").alias("stem_flags"), F.lit(None).cast("string").alias("root_flag"))
    found, levels = [], facts.levels(skipped)
    for depth in range(levels):
        rows = level.withColumn("flag", F.explode("stem_flags"))
        joined = rows.alias("e").join(table.alias("r"), [F.col("r.rule_flag") == F.col("e.flag")] + [F.col(f"r.{k}") == F.col(f"e.{k}") for k in shared])
        own = [F.col(f"e.{k}").alias(k) for k in keys]
        form = attach(F.col("stem"), F.col("kind"), F.col("strip"), F.col("add"))
        crosses = F.when((F.col("kind") == "SFX") & F.col("cross_product"), F.col("stem_flags"))
        made = joined.where(condition_holds(F.col("stem"), F.col("pattern"))).select(
            *own, "base", form.alias("form"), F.coalesce("root_flag", "flag").alias("root_flag"), F.col("root_flag").alias("led"), crosses.alias("crosses"), "add_flags"
        ).where("form IS NOT NULL AND form <> ''")
        if depth + 1 < levels:
            made = cut(made, "affix-level")
        found.append(_crossed(made, table, keys, shared) if facts.crossing else made.select(*keys, "base", "form", "root_flag"))
        level = made.where(F.size("add_flags") > 0).select(*keys, "base", F.col("form").alias("stem"), active("add_flags").alias("stem_flags"), "root_flag").distinct()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    if by_flag:
        return out.where("form <> base").distinct().withColumnRenamed("root_flag", "flag")
    return out.select(*keys, "base", "form").unionByName(bases.withColumn("form", F.col("base"))).distinct()


def _crossed(made: DataFrame, table: DataFrame, keys: list[str], shared: list[str]) -> DataFrame:
    """(keys, base, form, root_flag): the derived forms, and prefixes before those that may cross."""
    none = F.array(F.lit(None).cast("string"))
    rows = made.withColumn("p_flag", F.explode(F.concat(none, F.coalesce("crosses", F.array().cast("array<string>")))))
    prefixes = table.where("kind = 'PFX' AND cross_product").select(*[F.col(k).alias(f"p_{k}") for k in shared], "rule_flag", F.col("strip").alias("p_strip"), F.col("add").alias("p_add"), F.col("pattern").alias("p_pattern"))
    on = [F.col("p_flag") == F.col("rule_flag")] + [F.col(k) == F.col(f"p_{k}") for k in shared]
    alone = F.col("p_flag").isNull()
    rows = rows.join(F.broadcast(prefixes), on, "left").where(alone | (F.col("p_pattern").isNotNull() & condition_holds(F.col("form"), F.col("p_pattern"))))
    root = F.coalesce("led", "p_flag")
    flag = F.when(alone | (F.col("root_flag") == root), F.col("root_flag")).otherwise(F.concat_ws("+", "root_flag", root))
    form = F.when(alone, F.col("form")).otherwise(attach(F.col("form"), F.lit("PFX"), F.col("p_strip"), F.col("p_add")))
    return rows.select(*keys, "base", form.alias("form"), flag.alias("root_flag")).where("form IS NOT NULL AND form <> ''")


class DepthFirst:
    """The depth-first variant: derivations that lead on are remembered across the whole recursion, so a
    form reached twice is followed once, in rule order. Never more forms than expand()."""

    def __init__(self, rules: list[dict], skip_flags: set[str]):
        import re

        self.skip, self.rules = skip_flags, {}
        for r in sorted(rules, key=lambda r: r["rule_no"]):
            try:
                test = None if r["condition"] == "." else re.compile(f"^(?:{r['condition']})" if r["kind"] == "PFX" else f"(?:{r['condition']})$")
            except re.error:
                test = None
            self.rules.setdefault((r["kind"], r["flag"]), []).append((r, test))

    def _one(self, kind: str, flag: str, word: str) -> Iterator[tuple[str, dict]]:
        for r, test in self.rules.get((kind, flag), ()):
            if test is not None and not test.search(word):
                continue
            strip, add = r["strip"], r["add"]
            if kind == "SFX" and word.endswith(strip):
                yield word[: len(word) - len(strip)] + add, r
            elif kind == "PFX" and word.startswith(strip):
                yield add + word[len(strip) :], r

    def forms(self, word: str, flags: list[str], seen: set[str] | None = None, depth: int = 0) -> set[str]:
        seen = set() if seen is None else seen
        out = {word}
        if depth >= MOST_AFFIXES:
            return out
        active = [f for f in flags if f not in self.skip]
        crossing = {"SFX": [], "PFX": []}
        for kind in ("SFX", "PFX"):
            for flag in active:
                for form, r in self._one(kind, flag, word):
                    if not form or form in seen:
                        continue
                    out.add(form)
                    if kind == "SFX" and r["cross_product"]:
                        crossing["SFX"].append(form)
                    if r["add_flags"]:
                        seen.add(form)
                        out |= self.forms(form, r["add_flags"], seen, depth + 1)
        for form in crossing["SFX"]:
            for flag in active:
                out |= {made for made, r in self._one("PFX", flag, form) if r["cross_product"] and made and made not in seen}
        return out


def expand_depth_first(entries: DataFrame, rules: list[dict], *, skip_flags: set[str] = frozenset(), word: str = "word", flags: str = "flags") -> DataFrame:
    """(base, form) by the depth-first variant, an entry at a time in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = DepthFirst(rules, set(skip_flags))
        for batch in batches:
            rows = [(w, f) for w, fs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for f in sorted(engine.forms(w, fs or []))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], ["base", "form"])

    return entries.select(F.col(word), F.col(flags)).mapInArrow(run, "base string, form string").distinct()


def known_by_reverse_lookup(tokens: DataFrame, bases: DataFrame, rules: DataFrame, *, token: str = "token_lower", base: str = "base") -> DataFrame:
    """Distinct tokens that some rule, or a prefix and a suffix that may cross, derives from a base word,
    whatever flags the base has. Right when there are far fewer tokens than entries.

    A token's ends (or beginnings), of the few lengths that rules add, are joined with what rules add."""
    words = tokens.select(F.col(token).alias("t")).distinct()
    facts = _Facts(rules)
    table = facts.table(rules).select("kind", "strip", "add", "pattern", F.col("cross_product").alias("cross")).distinct()
    lengths = {}
    for kind, n in table.select("kind", F.char_length("add").alias("n")).distinct().collect():
        lengths.setdefault(kind, []).append(n)

    def undone(df: DataFrame, column: str, kind: str) -> DataFrame:
        r = _hinted(table.where(F.col("kind") == kind).drop("kind"), facts.n)
        n, k = F.char_length(column), F.col("ll_k")
        rows = df.withColumn("ll_k", F.explode(F.array(*[F.lit(x) for x in sorted(lengths.get(kind, []))]).cast("array<int>"))).where(k <= n)
        left, right = F.substring(F.col(column), F.lit(1), n - k), F.substring(F.col(column), n - k + 1, k)
        if kind == "PFX":
            left, right = F.substring(F.col(column), F.lit(1), k), F.substring(F.col(column), k + 1, n - k)
        rows = rows.withColumn("add", right if kind == "SFX" else left).withColumn("rest", left if kind == "SFX" else right).join(r, "add")
        stem = F.concat("rest", "strip") if kind == "SFX" else F.concat("strip", "rest")
        return rows.withColumn("stem", stem).where((F.col("stem") != "") & condition_holds(F.col("stem"), F.col("pattern")))

    suffix = undone(words, "t", "SFX")
    prefix = undone(words, "t", "PFX")
    mixed = undone(prefix.where("cross").select("t", F.col("stem").alias("inner")).distinct(), "inner", "SFX").where("cross")
    stems = words.select("t", F.col("t").alias("stem"))
    for more in (suffix, prefix, mixed):
        stems = stems.unionByName(more.select("t", "stem"))
    return stems.join(bases.select(F.col(base).alias("stem")).distinct(), "stem", "left_semi").select(F.col("t").alias(token)).distinct()


def flags_reaching(rules: DataFrame, roles: list[str]) -> DataFrame:
    """(flag, role): flags from which a role flag can be reached through the flags that rules add. The closure
    is over the flags of an affix file, not over words."""
    leads = {}
    for r in rules.select("flag", F.explode("add_flags").alias("next")).distinct().collect():
        leads.setdefault(r["next"], set()).add(r["flag"])
    rows = []
    for role in roles:
        seen, ask = {role}, [role]
        while ask:
            for flag in leads.get(ask.pop(), ()):
                if flag not in seen:
                    seen.add(flag)
                    ask.append(flag)
        rows += [(flag, role) for flag in sorted(seen)]
    return rules.sparkSession.createDataFrame(rows, "flag string, role string")
