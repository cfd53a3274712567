"""Structured Streaming over corpus strings: new vocabulary and token counts as rows arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def stream_tokens(rows: DataFrame, text: str = "text", *, keys: list[str] = ("lang",), mode: str = "default") -> DataFrame:
    """The good tokens of each arriving string; stateless."""
    return rows.select(*keys, *[c for c in ("ts",) if c in rows.columns], F.explode(T.tokens(F.col(text), mode)).alias("token"))


def stream_new_vocabulary(rows: DataFrame, known: DataFrame, text: str = "text", *, keys: list[str] = ("lang",), delay: str = "1 hour") -> DataFrame:
    """Tokens that a static table of known forms (columns keys and form) lacks, each once while its event time
    is within ``delay`` of the latest."""
    tokens = stream_tokens(rows, text, keys=keys).withColumn("form", F.lower("token"))
    fresh = tokens.join(known, [*keys, "form"], "left_anti")
    return fresh.withWatermark("ts", delay).dropDuplicatesWithinWatermark([*keys, "token"])


def stream_token_counts(rows: DataFrame, text: str = "text", *, keys: list[str] = ("lang",), window: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """How often each token occurs in each window of event time."""
    tokens = stream_tokens(rows, text, keys=keys).withWatermark("ts", delay)
    return tokens.groupBy(F.window("ts", window), *keys, "token").agg(F.count("*").alias("uses"))
