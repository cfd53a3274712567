"""Which corpus strings are in another language than they should be.

The detector is a function of (text column, language) that gives a confidence column. The default one
counts character trigrams of each language in a table of known texts; it is our own, so its numbers
differ from those of any other detector, while the decision rule is fixed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import text as T

Scorer = Callable[[DataFrame, str], DataFrame]


def trigrams(text: Column) -> Column:
    """Character trigrams of a lower-cased text with a space at both ends."""
    padded = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    return F.coalesce(F.regexp_extract_all(padded, F.lit("(?s)(?=(...))"), F.lit(1)), F.array().cast("array<string>"))


def profiles(texts: DataFrame, *, lang: str = "lang", text: str = "text", per_language: int = 2000) -> DataFrame:
    """(lang, gram, weight): log of the smoothed share of each language's most frequent trigrams; at most
    ``per_language`` rows a language, so the table can be broadcast."""
    grams = texts.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.explode(trigrams(F.col(text))).alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("lang"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return grams.withColumn("nth", nth).withColumn("weight", F.round(F.log((F.col("n") + 1.0) / (total + 1.0)), 6)).where(F.col("nth") <= per_language).select("lang", "gram", "weight")


def confidences(rows: DataFrame, table: DataFrame, *, id_col: str, text: str, missing: float = -14.0) -> DataFrame:
    """(id, lang, confidence): the share of each language in a text, over all languages of the profiles."""
    langs = F.broadcast(table.select("lang").distinct())
    grams = rows.select(id_col, F.explode(trigrams(F.col(text))).alias("gram")).groupBy(id_col, "gram").agg(F.count("*").alias("k"))
    spread = grams.join(langs)  # a handful of languages to a trigram
    scored = spread.join(F.broadcast(table), ["lang", "gram"], "left")
    mean = scored.groupBy(id_col, "lang").agg((F.sum(F.col("k") * F.coalesce("weight", F.lit(missing))) / F.sum("k")).alias("score"))
    w = Window.partitionBy(id_col)
    odds = F.exp((F.col("score") - F.max("score").over(w)) * 4)
    return mean.select(id_col, "lang", odds.alias("odds")).withColumn("confidence", F.round(F.col("odds") / F.sum("odds").over(w), 6)).drop("odds")


def language_filter(rows: DataFrame, table: DataFrame, *, lang: str, id_col: str = "key", text: str = "text", min_words: int = 7, min_confidence: float = 0.12) -> DataFrame:
    """``rows`` with detection_text, word_count, confidence, threshold and is_wrong. Texts with too few letters
    are never wrong and are not scored."""
    clean = rows.withColumn("detection_text", T.strip_placeholders(T.expand_morphology(T.strip_escaped_tags(F.col(text)))))
    clean = clean.withColumn("word_count", T.word_stats(F.col("detection_text"))["words"]).withColumn("ll_try", P.needs_detection(F.col("detection_text")))
    asked = clean.where("ll_try").select(id_col, "detection_text")
    found = confidences(asked, table, id_col=id_col, text="detection_text").where(F.col("lang").isin(lang, "en", "fr"))
    of = lambda x: F.max(F.when(F.col("lang") == x, F.col("confidence")))
    found = found.groupBy(id_col).agg(of(lang).alias("target"), of("en").alias("en"), of("fr").alias("fr"))
    out = clean.join(found, id_col, "left")
    wrong = P.is_wrong_language(F.col("target"), F.col("en"), F.col("fr"), F.col("word_count"), lang, min_words=min_words, min_confidence=min_confidence)
    return out.select(
        *rows.columns,
        "detection_text",
        "word_count",
        F.coalesce("target", F.lit(1.0)).alias("confidence"),
        F.when(F.col("ll_try") & (F.col("word_count") >= min_words), F.lit(min_confidence)).otherwise(0.0).alias("threshold"),
        F.coalesce(wrong, F.lit(False)).alias("is_wrong"),
    )


def lowest_confidence(removed: DataFrame, n: int = 10) -> DataFrame:
    return removed.where("is_wrong").orderBy("confidence", *[c for c in removed.columns[:1]]).limit(n)
