"""One query per operator over its whole table: name -> function of (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), threshold=0.7).drop("text")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack
    from .tokens import public_path

    return pack(table(spark, sf_dir, "documents"), path=public_path("byte_bpe_50k.json"), window=2048, end_id=1)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality

    out = quality(table(spark, sf_dir, "documents").select("doc_id", "text"), materialise=True)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")
    return out.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in names])


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=20, min_docs=3)
    d = F.col("line_dedup")
    return out.select("doc_id", d["n_lines"].alias("n_lines"), d["n_dropped"].alias("n_dropped"), F.sha2(F.encode(d["text"], "UTF-8"), 256).alias("kept_sha256"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), n_gram=3, percent=90)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokens import context_table, length_histogram, public_path

    return context_table(length_histogram(table(spark, sf_dir, "documents"), path=public_path("byte_bpe_50k.json")))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import replace_pii

    out = replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), key=b"surrogates")
    return out.select("doc_id", "text", F.col("pii.n_entities").alias("n_entities"), F.col("pii.entities").alias("entities"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import edited_fingerprints, op_columns

    return op_columns(cut(edited_fingerprints(table(spark, sf_dir, "documents")), "fingerprints"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive, page_name, read_warc

    back = read_warc(spark, archive(table(spark, sf_dir, "pages"), min_revisit_bytes=0), payloads=False).where("kind = 'record'")
    return back.select(page_name("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), page_name("refers_to").alias("refers_to"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "position")


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_packing, op3_quality_rules, op4_line_dedup, op5_ngram_jaccard, op6_token_counts, op7_pii, op8_fingerprints, op9_warc, op10_mixing)}
