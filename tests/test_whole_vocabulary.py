"""Registered queries read all words of the documents, however long, against brute force on a small fixture."""

import pytest

from lexloom.plans import queries_affix as A
from lexloom.plans import queries_report as R

LONG = "Wasserkraftwerksgesellschaften"
#: "aber" and "zug" are of five documents, so they are dictionary entries; the last document has one long compound of them
TEXTS = ["aber zug Haus", "aber zug Nachbarschaft", "aber zug laufen", "aber zug neulich", "aber zug wieder"]
DOCS = [(2 * i + 1, t, "de", f"src{i % 3}") for i, t in enumerate(TEXTS)] + [(20, LONG + " aberaberaberaberzug " + "abc" * 7 + "zug", "de", "src1"), (21, "Straße", "fr", "src2")]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("words"))
    spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, "user", "haus Aberglaube wieder straße Vecino")], "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    spark.createDataFrame([(7, "tofu", "STEEL", 3)], "p_partkey long, p_name string, p_type string, p_size int").write.parquet(f"{folder}/part.parquet")
    return folder


def pairs():
    return {(source, lang, w) for _, t, lang, source in DOCS for w in t.split()}


def test_reports_hold_all_words(spark, tables):
    rows = pairs()
    assert {(r["game"], r["language"], r["token"]) for r in R.report(spark, tables).collect()} == rows
    got = {(r["metric"], r["value"]): r["rows"] for r in R.report_histograms(spark, tables).collect()}
    bucket = lambda n: "1-4" if n <= 4 else "5-8" if n <= 8 else "9-12" if n <= 12 else "13+"
    for b in ("1-4", "5-8", "13+"):
        assert got["token_length", b] == sum(bucket(len(w)) == b for _, _, w in rows)
    assert R.report_totals(spark, tables).first()["rows"] == len(rows) == R.csv_report(spark, tables).count()
    metrics = R.merge_metrics(spark, tables).first()
    assert (metrics["rows_before"], metrics["rows_after"]) == (len(rows), len({(la, w.lower()) for _, la, w in rows}))
    assert LONG.lower() in {r["token_lower"] for r in R.cross_tenant_merge(spark, tables).collect()}


def test_consolidated_report_reads_long_words_and_the_whole_dictionary(spark, tables):
    _, _, words, entries = R._pair(spark, tables)
    assert {r["token"] for r in words.collect()} >= {w for _, la, w in pairs() if la == "de"} | {"tofu"}
    assert {r["base_lower"] for r in entries.collect()} == {"aber", "zug"}


def test_compounds_flags_and_exports_of_any_length(spark, tables):
    assert {r["token_lower"] for r in A.recursive_compounds(spark, tables).collect()} == {"aberaberaberaberzug"}
    assert A.two_part_compounds(spark, tables).count() == 0
    german = {w for _, la, w in pairs() if la == "de"}
    assert {r["token"] for r in A.flag_assignment(spark, tables).collect()} == german
    assert {r["flag"]: r["words"] for r in A.flag_usage(spark, tables).collect()}["U"] == len(german)
    want = {(la, w): " | ".join(sorted({g for g, lb, x in pairs() if (lb, x) == (la, w)})) for _, la, w in pairs()}
    assert {(r["lang"], r["word"]): r["sources"] for r in A.merged_exports(spark, tables).collect()} == want


def test_both_sides_are_whole_tables(spark, tables):
    """Half of the documents' ids are odd, and both tables' words count in any row."""
    docs, turns = {w for _, _, w in pairs()}, {"haus", "Aberglaube", "wieder", "straße", "Vecino"}
    assert {(r["original"], r["inferred_lower"]) for r in A.casing_inference(spark, tables).collect()} == {("Haus", "haus")}
    got = {r["base_word"]: r for r in R.wordform_diff(spark, tables).collect()}
    assert set(got) == {w[:3] for w in docs | turns}
    for side, want in (("lost", docs - turns), ("gained", turns - docs), ("kept", docs & turns)):
        assert {w for r in got.values() for w in r[side].split(" | ") if w} == want
    totals = R.wordform_diff_totals(spark, tables).first()
    assert (totals["lost"], totals["kept"], totals["gained"]) == (len(docs - turns), len(docs & turns), len(turns - docs))
