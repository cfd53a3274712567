"""Tokens of glossary rows and corpus strings, with what is known about each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import predicates as P
from ..functions import text as T


def exploded_tokens(df: DataFrame, text: Column, mode: str | Column = "default", *, keep: list[str], full_entities: bool = False) -> DataFrame:
    """A row for each distinct good token of each row's text, beside the ``keep`` columns."""
    return df.select(*keep, F.explode(T.tokens(text, mode, full_entities=full_entities)).alias("token"))


def distinct_tokens(df: DataFrame, text: Column, mode: str | Column = "default", *, keys: list[str]) -> DataFrame:
    """The distinct tokens of each partition ``keys`` such as (game, lang)."""
    return exploded_tokens(df, text, mode, keep=keys).distinct()


def glossary_rows(tb: DataFrame, key: str = "key") -> DataFrame:
    """Glossary rows without emote shortcuts and morse."""
    return tb.where(~P.is_shortcut_key(F.col(key)) & ~P.is_morse_key(F.col(key)))


def glossary_tokens(tb: DataFrame, *, full_entities: bool = False) -> DataFrame:
    """(game, lang, row_id, key, token) of a glossary in long form with columns game, lang, row_id, key,
    term and info: tokens of the term and, if info describes plurals, of each plural form."""
    mode = T.tokenizer_mode(F.col("lang"))
    rows = glossary_rows(tb)
    terms = rows.where(~P.is_blank(F.col("term"))).select("game", "lang", "row_id", "key", F.col("term").alias("text"), F.lit(True).alias("tracked"))
    plurals = rows.select("game", "lang", "row_id", "key", F.explode(T.plural_forms(F.col("info"))).alias("text"), F.lit(False).alias("tracked"))
    return exploded_tokens(terms.unionByName(plurals), F.col("text"), mode, keep=["game", "lang", "row_id", "key", "tracked"], full_entities=full_entities)


def key_categories(key: Column) -> Column:
    """The categories of the comma-separated glossary keys in one cell."""
    found = F.transform(F.split(key, ","), lambda part: T.key_category(F.trim(part)))
    return F.array_distinct(F.filter(found, lambda c: c.isNotNull()))


def token_keys(tokens: DataFrame) -> DataFrame:
    """(game, lang, token_lower, keys): the sorted glossary keys of each token."""
    rows = tokens.where(F.col("tracked") & (F.trim("key") != ""))
    return rows.groupBy("game", "lang", F.lower("token").alias("token_lower")).agg(F.array_sort(F.collect_set(F.trim("key"))).alias("keys"))


def token_categories(tokens: DataFrame) -> DataFrame:
    """(game, lang, category, token_lower): tokens of keys in a known category."""
    rows = tokens.where("tracked").withColumn("category", F.explode(key_categories(F.col("key"))))
    return rows.select("game", "lang", "category", F.lower("token").alias("token_lower")).distinct()


def skip_histogram(df: DataFrame, reason: Column, *, keys: list[str]) -> DataFrame:
    """How many rows each reason leaves out."""
    return df.select(*keys, reason.alias("reason")).where("reason IS NOT NULL").groupBy(*keys, "reason").agg(F.count("*").alias("rows"))


def case_map(tokens: DataFrame, *, keys: list[str], compact: bool = False) -> DataFrame:
    """Lower-case token to its sorted spellings, or with ``compact`` to the smallest of them.

    Repeated tokens go first, by hashing: a set or minimum of texts would sort every occurrence (and Spark leaves out
    a distinct() below either)."""
    found = F.collect_list("token")
    made = F.array_min(found).alias("form") if compact else F.array_sort(found).alias("forms")
    return tokens.select(*keys, "token").distinct().groupBy(*keys, F.lower("token").alias("token_lower")).agg(made)


def case_evidence(df: DataFrame, text: Column, *, keys: list[str]) -> DataFrame:
    """For each word how often it is written in lower case, and capitalised inside a sentence."""
    word = rf"[{C.LETTER}][{C.LETTER}'’-]*"
    cleaned = T.expand_morphology(T.strip_escaped_tags(text))
    spans = df.select(*keys, cleaned.alias("t"))
    # text before each word: the pieces between words say where a sentence starts
    pieces = F.zip_with(F.regexp_extract_all("t", F.lit(f"({word})"), F.lit(1)), F.split("t", word, -1), lambda w, b: F.struct(w.alias("w"), b.alias("b")))
    rows = spans.select(*keys, F.posexplode(pieces).alias("nth", "x")).where("x.w IS NOT NULL")
    token = F.regexp_replace("x.w", "^['’-]+|['’-]+$", "")
    # directly after another word (no piece between them) the previous character is a letter
    starts = F.when(F.col("nth") == 0, P.starts_sentence(F.col("x.b"))).otherwise(F.coalesce(F.col("x.b").rlike(r"(?U)[.!?:;]\s*$"), F.lit(False)))
    rows = rows.select(*keys, token.alias("token"), starts.alias("starts")).where("token <> ''")
    first = F.substring("token", 1, 1)
    capital = (first == F.upper(first)) & (first != F.lower(first))
    return rows.groupBy(*keys, F.lower("token").alias("token_lower")).agg(
        F.count_if(F.col("token") == F.lower("token")).alias("lowercase_count"),
        F.count_if(capital & ~F.col("starts")).alias("uppercase_mid_sentence_count"),
    )


def default_lowercase(first_words: DataFrame, protected: DataFrame, evidence: DataFrame | None) -> DataFrame:
    """Lower-case first words of items and monsters that may join the tokens: those that are no token of
    people or places, and that the corpus does not only show capitalised. Without evidence, none.

    All three have columns game, lang, token_lower; evidence also the counts of case_evidence()."""
    on = ["game", "lang", "token_lower"]
    if evidence is None:
        return first_words.select(*on).distinct().limit(0)
    blocked = evidence.where("uppercase_mid_sentence_count > 0 AND lowercase_count = 0")
    return first_words.select(*on).distinct().join(protected.select(*on).distinct(), on, "left_anti").join(blocked.select(*on), on, "left_anti")


def first_word_rules(tb: DataFrame, tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(first words of item and monster terms, protected words of people and places), for default_lowercase()."""
    rows = glossary_rows(tb).where(~P.is_blank(F.col("term"))).withColumn("cats", key_categories(F.col("key")))
    first = rows.withColumn("token_lower", T.first_word_lower(F.trim("term"))).where("token_lower <> ''")
    of = lambda *names: F.arrays_overlap("cats", F.array(*[F.lit(n) for n in names]))
    has_tokens = first.join(tokens.where("tracked").select("game", "lang", "row_id").distinct(), ["game", "lang", "row_id"], "left_semi")
    candidates = has_tokens.where(of("item", "monster")).select("game", "lang", "token_lower").distinct()
    named = tokens.where("tracked").withColumn("cats", key_categories(F.col("key"))).where(of("npc", "area")).select("game", "lang", F.lower("token").alias("token_lower"))
    return candidates, named.unionByName(has_tokens.where(of("npc", "area")).select("game", "lang", "token_lower")).distinct()


def override_tokens(tokens: DataFrame, *, lower_only: list[str] = (), keep_both: list[str] = (), replace: dict[str, list[str]] | None = None) -> DataFrame:
    """One-column ``token`` tables with listed corrections: words kept in lower case only, words kept in
    both cases, and words replaced by others where they occur."""
    spark = tokens.sparkSession
    dropped = [w.lower() for w in lower_only]
    out = tokens.where(~F.lower("token").isin(dropped)) if dropped else tokens
    added = dropped + [x for w in keep_both for x in (w, w.lower())]
    if added:
        out = out.unionByName(spark.createDataFrame([(w,) for w in added], "token string"))
    for old, new in (replace or {}).items():
        present = out.where(F.lower("token") == old.lower()).limit(1)
        extra = present.select(F.explode(F.array(*[F.lit(x) for x in new])).alias("token"))
        out = out.where(F.lower("token") != old.lower()).unionByName(extra)
    return out.distinct()


def sentence_positions(tokens: DataFrame, *, keys: list[str]) -> DataFrame:
    """Tokens numbered within ``keys`` in code point order."""
    return tokens.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy("token")))
