"""From raw documents to packed training sequences: quality rules, line dedup, near-duplicate removal,
mixing of sources, packing. Each stage works on all that the one before it kept, is written as Parquet
and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.llm.common import BATCH_SETTING, Carried, Scratch, cut, small_batches, table
from lexloom.llm.jaccard import jaccard_components
from lexloom.llm.line_dedup import dedup_lines
from lexloom.llm.mixing import training_stream
from lexloom.llm.packing import pack
from lexloom.llm.quality import quality
from lexloom.llm.tokens import public_path


def _recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs``, n_chars following the text."""
    return docs.select(*docs.columns[: len(columns)]).toDF(*columns).select(*[F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    small_batches(spark)
    return quality(docs).where("quality.kept").drop("quality").toDF(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three or more documents stay in the one with the largest id; a document that loses all
    its lines goes."""
    small_batches(spark)
    out = dedup_lines(docs).where(~(F.col("line_dedup.n_dropped") == F.col("line_dedup.n_lines")))
    return _recounted(out, docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity 0.8) the document with the smallest id stays, a
    null id coming last.

    Rows are told apart by id and text, so rows that share an id go only with copies of their own text; of
    rows equal in both one stays. Which go is decided on keys; texts meet the table of those that go only.
    """
    small_batches(spark)
    scratch = Scratch(spark)
    carried = Carried(docs)
    doc, text = F.col(carried.name("doc_id")).alias("doc_id"), carried.name("text")
    keyed = carried.df.withColumn("ll_key", F.xxhash64(carried.name("doc_id"), text))
    groups = jaccard_components(keyed.select("ll_key", text), "ll_key", text, n_gram=5, percent=80)
    groups = scratch.cut(groups.groupBy("ll_key", "component_id").count(), "groups")
    several = groups.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    members = groups.join(several, "component_id", "left_semi").select("ll_key", "component_id")
    members = scratch.cut(keyed.select("ll_key", doc).join(members, "ll_key").distinct(), "members")
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "ll_key")
    heads = members.groupBy("component_id").agg(F.min(first).alias("head"))
    gone = scratch.cut(members.join(heads, "component_id").where("ll_key <> head.ll_key").select("ll_key"), "gone")
    repeated = scratch.cut(groups.where("count > 1").select("ll_key"), "repeated")
    scratch.free("groups", "members")
    kept = keyed.join(gone, "ll_key", "left_anti")
    if not repeated.isEmpty():
        nth = F.row_number().over(Window.partitionBy("ll_key").orderBy(F.xxhash64(*carried.df.columns), *carried.df.columns))
        one = kept.join(repeated, "ll_key", "left_semi").withColumn("ll_nth", nth).where("ll_nth = 1").drop("ll_nth")
        kept = kept.join(repeated, "ll_key", "left_anti").unionByName(one)
    return kept.select(*carried.back())


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix reads them, in training order: left out, once or twice, and cut where a
    source's target is reached."""
    return _recounted(training_stream(docs), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2,048 tokens."""
    small_batches(spark)
    return pack(docs, path=public_path("byte_bpe_50k.json"), window=2048, end_id=1)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, limit = table(spark, sf_dir, "documents"), spark.conf.get(BATCH_SETTING, None)
    try:
        for name, stage in STAGES:
            docs = cut(stage(spark, docs, sf_dir), name)
    finally:  # all is written: the session has its own limit again
        spark.conf.unset(BATCH_SETTING) if limit is None else spark.conf.set(BATCH_SETTING, limit)
    return docs


#: expectation-maximisation and tokens are beyond SQL; tests hold each stage against brute force
ORACLE_SQL = None
