"""All eleven queries over a small set of tables, and the pipeline stage by stage."""

import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables are not here")
REQUIRED = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op3_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op4_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op5_ngram_jaccard": ["doc_id", "n_shingles", "component_id"],
    "op6_token_counts": ["context_limit", "n_docs", "truncated_total"],
    "op7_pii": ["doc_id", "text", "n_entities"],
    "op8_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op9_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op10_mixing": ["doc_id", "size", "source_size", "target", "taken"],
}


@pytest.mark.parametrize("name", REQUIRED)
def test_query_runs(spark, name):
    import __spark_entry__ as entry

    out = entry.queries()[name](spark, SF)
    assert set(REQUIRED[name]) <= set(out.columns)
    assert out.count() > 0


@pytest.mark.parametrize("name", ["op4_line_dedup", "op5_ngram_jaccard", "op9_warc", "op10_mixing"])
def test_query_agrees_with_sql(spark, name):
    import duckdb

    import __spark_entry__ as entry

    db = duckdb.connect()
    for name_ in ("documents", "pages"):
        db.sql(f"CREATE VIEW {name_} AS SELECT * FROM '{SF}/{name_}.parquet'")
    out = entry.queries()[name](spark, SF)
    columns = sorted(out.columns)
    want = db.sql(entry.oracle_sql()[name])
    assert sorted(want.columns) == columns
    assert sorted(map(str, (tuple(r) for r in out.select(*columns).collect()))) == sorted(map(str, want.select(*columns).fetchall()))


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as C
    from lexloom.llm.quality import signals_of

    assert [n for n, _ in C.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    inputs = [docs]
    for k, (_, stage) in enumerate(C.STAGES):
        stage(spark, inputs[-1], SF).write.parquet(str(tmp_path / str(k)))
        inputs.append(spark.read.parquet(str(tmp_path / str(k))))
    assert all(x.columns == columns for x in inputs[:-1])
    counts = [x.count() for x in inputs]
    assert 0.5 * n < counts[1] < n
    assert all(signals_of(r["text"])["n_words"] >= 50 for r in inputs[1].collect())
    # lines of three documents stay in one
    holders = defaultdict(set)
    for r in inputs[2].collect():
        assert r["n_chars"] == len(r["text"])
        for line in r["text"].split("\n"):
            if len(line.strip()) >= 20:
                holders[line.strip().lower()].add(r["doc_id"])
    assert max(map(len, holders.values())) <= 2
    ids = [r["doc_id"] for r in inputs[3].collect()]
    assert len(ids) == len(set(ids)) <= counts[2]
    mixed = defaultdict(int)
    for r in inputs[4].collect():
        mixed[r["doc_id"]] += 1
    assert set(mixed) <= set(ids) and max(mixed.values()) <= 2
    packed = inputs[5].collect()
    assert {r["doc_id"] for r in packed} == set(mixed)
    assert C.run(spark, SF).count() == len(packed)


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(C.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.count() == 0


def test_near_duplicates_keep_unlike_rows_of_one_id(spark):
    import corpus_pipeline as C

    text = lambda stem: " ".join(f"{stem}{i}" for i in range(80))
    a, b, c, d = map(text, "abcd")
    rows = [(3, a), (5, b), (5, a + " tail"), (7, c), (7, d), (7, c), (-2, d + " end"), (None, a), (8, ""), (8, None), (9, b + " x"), (None, d), (None, d), (None, None)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    got = sorted(((r["doc_id"], r["text"]) for r in C.near_duplicates(spark, docs, SF).collect()), key=str)
    # a null id comes last, so a goes from it; d of 7 goes as -2 holds it; rows of 7 with c are one
    assert got == sorted([(3, a), (5, b), (7, c), (-2, d + " end"), (8, ""), (8, None), (None, None)], key=str)


def test_stages_on_nulls_repeats_and_clashing_columns(spark, tmp_path):
    """Every stage keeps the columns of its input, whatever they are called, and takes nulls and repeated rows."""
    import corpus_pipeline as C

    line = "a line of words that many of these documents hold"
    text = lambda stem: "\n".join([" ".join(f"{stem}word{i}x" for i in range(90)), line])
    rows = [(i, text("abcdefgh"[i % 8] + str(i)), "en", f"s{i % 3}", 9, "k") for i in range(30)]
    rows += [(4, rows[4][1], "en", "s1", 9, "k")] * 3 + [(None, text("zz"), None, None, None, None), (50, None, "en", "s1", 0, "k"), (51, "", "en", None, 0, "k")]
    names = "doc_id long, text string, lang string, source string, n_chars long, quality string"
    docs = spark.createDataFrame(rows, names).withColumns({c: F.lit("own") for c in ("line_dedup", "mix", "ll_key", "pii", "ll_signals", "component_id")})
    for k, (name, stage) in enumerate(C.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        assert out.count() > 0
        if name != "packing":
            assert out.columns == docs.columns
            assert out.where("mix <> 'own' OR line_dedup <> 'own' OR ll_key <> 'own' OR ll_signals <> 'own'").count() == 0
            assert {r[0] for r in out.select("quality").distinct().collect()} <= {"k", None}
            docs = out


@pytest.mark.parametrize("name", ["quality_rules", "line_dedup", "near_duplicates", "packing"])
def test_stages_hand_texts_to_python_in_small_batches(spark, monkeypatch, name):
    """An executor's memory outside its heap follows the size of a batch; the stages bound its bytes, not only its rows."""
    import pyarrow as pa

    import corpus_pipeline as C
    from lexloom.llm.common import BATCH_BYTES, BATCH_SETTING

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(len(x.as_py()) for x in batch.column(0))])], ["n"])

    stage, wide = dict(C.STAGES)[name], spark.range(0, 300, 1, 1).select(F.expr("repeat('long text ', 3000)").alias("text"))
    docs = spark.createDataFrame([(i, f"text {i}\nof the stage") for i in range(5)], "doc_id long, text string")
    spark.conf.unset(BATCH_SETTING)
    try:
        stage(spark, docs, SF)  # what it returns runs later, in this session
        got = [r[0] for r in wide.mapInArrow(sizes, "n long").collect()]
        assert sum(got) == 300 * 30_000 and max(got) <= BATCH_BYTES + 30_000
        spark.conf.set(BATCH_SETTING, "64k")
        stage(spark, docs, SF)
        assert spark.conf.get(BATCH_SETTING) == "64k"
        spark.conf.set(BATCH_SETTING, "32m")
        monkeypatch.setattr(C, "STAGES", [(name, stage)])
        assert C.run(spark, SF).count() > 0 and spark.conf.get(BATCH_SETTING) == "32m"
    finally:
        spark.conf.unset(BATCH_SETTING)
