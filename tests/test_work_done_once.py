"""Texts are taken apart once, and repeated tokens go before spellings are collected or compared."""

from pyspark.sql import functions as F

from lexloom.operators import assembly
from lexloom.operators import tokens as O
from lexloom.plans import queries_affix, queries_files, queries_text
from lexloom.sources import readers, writers


def _plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def _documents(spark, folder) -> str:
    rows = [(1, "Tofu tofu and TOFU", "en", "s1"), (2, "tofu Gobbos", "en", "s2"), (3, "tofu", "de", "s1")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_case_map_takes_texts_apart_once(spark, tmp_path):
    df = queries_text.case_map(spark, _documents(spark, tmp_path))
    assert _plan(df).count("Generate explode") == 1
    assert ("en", "tofu", "TOFU | Tofu | tofu", "TOFU") in {tuple(r) for r in df.collect()}
    words = spark.createDataFrame([("en", w) for w in ("Bo", "bo", "bo", None)], "lang string, token string")
    for compact in (False, True):
        assert "HashAggregate(keys=[lang#" in _plan(O.case_map(words, keys=["lang"], compact=compact)).split("collect_list(token")[-1]
    assert {(r["token_lower"], tuple(r["forms"])) for r in O.case_map(words, keys=["lang"]).collect()} == {("bo", ("Bo", "bo")), (None, ())}


def test_surfaces_are_compared_once_for_each_spelling(spark, tmp_path):
    df = queries_affix.representative_surface(spark, _documents(spark, tmp_path))
    below = _plan(df).split("collect_list(")[-1]  # what the first aggregate of spellings is given
    assert "HashAggregate(keys=[lang#" in below
    assert ("en", "tofu", "TOFU") in {tuple(r) for r in df.collect()}
    many = spark.range(1000).select(F.lit("bo").alias("word")).unionByName(spark.createDataFrame([("Bo",)], "word string"))
    assert [tuple(r) for r in assembly.representative_surface(many, keys=[]).collect()] == [("bo", "Bo")]


def test_reports_are_computed_once_and_compressed(spark, tmp_path, monkeypatch):
    given, write = [], writers.write_report
    monkeypatch.setattr(writers, "write_report", lambda df, path: write(given.append(df) or df, f"{tmp_path}/r"))
    df = queries_files.report_files(spark, _documents(spark, tmp_path))
    assert "Generate explode" not in _plan(given[0])
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == 2 * given[0].count() and {r[0] for r in rows} == {"csv", "jsonl"}
    for end in ("csv", "jsonl"):
        parts = list((tmp_path / f"r.{end}").glob("part-*"))
        assert parts and all(p.name.endswith(".gz") for p in parts)
        assert {r["token"] for r in readers.read_report(spark, f"{tmp_path}/r.{end}").collect()} == {r["token"] for r in given[0].collect()}
