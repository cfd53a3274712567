"""Encoding with a public tokenizer, and exact token counts.

The tokenizer file is a parameter: a ``tokenizers`` JSON file. Where the same vocabulary lies beside
it as tiktoken ranks, texts go through those, several times as fast and with the same ids; texts that
hold one of the vocabulary's special strings go through the JSON file, which gives those their own id.
"""

from __future__ import annotations

import base64
import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut


@lru_cache(maxsize=4)
def encoder(path: str):
    """A function from a text to its ids as a numpy array."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    exact = lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
    ranks = os.path.splitext(path)[0] + ".tiktoken"
    if not os.path.exists(ranks):
        return exact
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
    with open(path, encoding="utf-8") as f:
        special = [x["content"] for x in json.load(f).get("added_tokens", ())]

    def encode(text: str) -> np.ndarray:
        return exact(text) if any(s in text for s in special) else np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def n_tokens(text: Column, path: str) -> Column:
    """Number of ids of a text; 0 for null."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        encode = encoder(path)
        return pa.array([len(encode(t.as_py() or "")) for t in texts], pa.int64())

    return run(text)


def length_histogram(docs: DataFrame, text_col: str = "text", *, path: str) -> DataFrame:
    """(length, n_docs): how many documents have each encoded length. A row per distinct length, which
    the longest text bounds; a length that a third of the documents share is summed before the shuffle."""
    return docs.select(n_tokens(F.col(text_col), path).alias("length")).groupBy("length").agg(F.count("*").alias("n_docs"))


def context_table(histogram: DataFrame, *, block: int = 64) -> DataFrame:
    """What a context limit of each occurring length keeps, from suffix sums of the histogram.

    Columns: context_limit, n_docs (of exactly that length), docs_at_least, tokens_at_least,
    truncated_total (tokens left if every document is cut at the limit), total_tokens, and quantile
    (share of the documents that fit whole). Between two rows docs_at_least is that of the upper row,
    so ``at_limit`` answers any other limit. Sums run within blocks of lengths and over a table of
    blocks. An empty histogram gives an empty table.
    """
    h = cut(histogram, "lengths").withColumn("ll_block", F.floor(F.col("length") / block)).withColumn("ll_tokens", F.col("length") * F.col("n_docs"))
    blocks = h.groupBy("ll_block").agg(F.sum("n_docs").alias("d"), F.sum("ll_tokens").alias("t"))
    after = Window.orderBy(F.desc("ll_block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    blocks = blocks.select(
        "ll_block",
        F.coalesce(F.sum("d").over(after), F.lit(0)).alias("ll_d"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("ll_t"),
        F.sum("d").over(whole).alias("ll_docs"),
        F.sum("t").over(whole).alias("total_tokens"),
    )
    inside = Window.partitionBy("ll_block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    out = h.withColumn("ll_in_d", F.sum("n_docs").over(inside)).withColumn("ll_in_t", F.sum("ll_tokens").over(inside)).join(blocks, "ll_block")
    docs, tokens = F.col("ll_d") + F.col("ll_in_d"), F.col("ll_t") + F.col("ll_in_t")
    return out.select(
        F.col("length").alias("context_limit"),
        "n_docs",
        docs.alias("docs_at_least"),
        tokens.alias("tokens_at_least"),
        (F.col("total_tokens") - tokens + F.col("length") * docs).alias("truncated_total"),
        "total_tokens",
        ((F.col("ll_docs") - docs + F.col("n_docs")) / F.col("ll_docs")).alias("quantile"),
    )


def at_limit(table: DataFrame, limit: int) -> DataFrame:
    """One row: tokens left and documents cut if every document is cut at ``limit``."""
    above = table.where(F.col("context_limit") > limit)
    below = table.where(F.col("context_limit") <= limit)
    cut = above.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs_cut"))
    kept = below.agg(F.coalesce(F.sum(F.col("n_docs") * F.col("context_limit")), F.lit(0)).alias("kept"))
    return cut.join(kept).select(F.lit(limit).alias("context_limit"), "docs_cut", (F.col("kept") + F.col("docs_cut") * limit).alias("truncated_total"))
