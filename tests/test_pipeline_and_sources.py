import gzip
import json

import pytest
from pyspark.sql import functions as F

from lexloom.plans import dashboard, pipeline
from lexloom.sources import files, hunspell, readers, writers

AFF = "SET UTF-8\nTRY abc\nSFX S Y 1\nSFX S 0 s [^s]\nSFX G Y 2\nSFX G o a o\nSFX G o as o\nSFX Z Y 1\nSFX Z 0 z .\n"
DIC = "3\ncasa/S\nperro/SG\nel\n"
TB = 'key,es-ES,"es-ES (info)"\nmonster.1.name,Gobbo rojo,\nItem.name.2,"casa de Gobbo",\nemoticon.1.shortcut,:hola,\nobject.3.name,Perros,"One: ""Tofu"", Other: ""Tofus"""\n'
CORPUS = {"entries": {"a": "los gobbos y gobba con tofus rojos", "b": "Rojos Gobbas [!] wip", "c": "una gobbas roja", "n": 5, "d": "tofu gobbo"}}


@pytest.fixture
def project(tmp_path):
    (tmp_path / "dics" / "es").mkdir(parents=True)
    (tmp_path / "dics" / "es" / "es.aff").write_text(AFF)
    (tmp_path / "dics" / "es" / "es.dic").write_text(DIC)
    (tmp_path / "dics" / "es" / "README").write_text("about")
    (tmp_path / "tb.csv").write_text(TB, encoding="utf-8-sig")
    (tmp_path / "i18n.json").write_text(json.dumps(CORPUS))
    return tmp_path


def inputs(p, **more):
    games = {("GAME", "es"): f"{p}/tb.csv", ("OTHER_GAME", "es"): f"{p}/tb.csv"}
    return pipeline.Inputs(games, {("GAME", "es"): f"{p}/i18n.json"}, {"es": f"{p}/dics/es/es.dic"}, **more)


def test_whole_run(spark, project):
    out = f"{project}/out"
    report = pipeline.run_batch(spark, inputs(project), "all", "all", pipeline.Options(output=out))
    assert report["summary"]["ok"] == 2, [r.error for r in report["runs"]]
    with_corpus, without = report["runs"]
    dic = files.decode(files.read_bytes(spark, with_corpus.artifacts["dic"])).splitlines()
    # the count line, and word/flags in case-insensitive order
    assert int(dic[0]) == len(dic) - 1 and [x.split("/")[0].lower() for x in dic[1:]] == sorted(x.split("/")[0].lower() for x in dic[1:])
    assert "Gobbo/GS" in dic and "perros" not in [x.lower() for x in dic]
    aff = files.read_bytes(spark, with_corpus.artifacts["aff"]).decode()
    assert "SFX S Y 1" in aff and "SFX Z" not in aff and "WORDCHARS '-0123456789" in aff and "TRY abc-'" in aff
    flat = files.read_bytes(spark, with_corpus.artifacts["flat"])
    probe = writers.flat_list_probe(flat)
    assert probe["utf16_mark"] and probe["crlf"] and probe["words"] == with_corpus.metrics["flat_words"]
    # without a corpus the dictionary is the filtered tokens, and the affix file has no blocks
    kept = {r["token"] for r in without.tables["kept"].collect()}
    plain = files.decode(files.read_bytes(spark, without.artifacts["dic"])).splitlines()
    assert set(plain[1:]) == kept and "SFX" not in files.read_bytes(spark, without.artifacts["aff"]).decode()
    filtered = files.decode(files.read_bytes(spark, without.artifacts["filtered"])).splitlines()
    assert filtered[1:] == sorted(kept) and int(filtered[0]) == len(kept)
    assert files.exists(spark, f"{without.artifacts['full']}/README") and files.exists(spark, f"{without.artifacts['full']}/es_OTHER_GAME.aff")
    # the two runs of a pair agree
    again = pipeline.run_single(spark, inputs(project), "es", "GAME", output=f"{project}/again")
    assert pipeline.signature(spark, again) == pipeline.signature(spark, with_corpus)
    merged = pipeline.consolidate_exports(spark, out, known_games={"GAME", "OTHER_GAME"})
    rows = {r["word"]: r for r in merged.collect()}
    assert rows["Gobbo"]["flags"] == ["G", "S"] and rows["Gobbo"]["sources"] == ["GAME", "OTHER_GAME"]
    reports = pipeline.consolidate_reports(spark, f"{out}/reports")
    got = {r["token_lower"]: r for r in reports.collect()}
    assert got["gobbo"]["source_games"] == ["GAME", "OTHER_GAME"] and got["gobbo"]["source_reports_count"] == 2
    page = dashboard.write_dashboard(reports, f"{project}/page.html", "T <1>")
    text = files.read_bytes(spark, page["path"]).decode()
    assert "T &lt;1&gt;" in text and '"token_lower": "gobbo"' in text and page["rows"] == len(got)


def test_failures_are_reported(spark, project):
    broken = pipeline.Inputs({("A", "es"): f"{project}/tb.csv", ("B", "fr"): f"{project}/tb.csv"}, {}, {"es": f"{project}/dics/es/es.dic"})
    report = pipeline.run_batch(spark, broken, options=pipeline.Options(pair_workers=2))
    assert [(r.game, r.status) for r in report["runs"]] == [("A", "ok"), ("B", "failed")] and "fr" in report["runs"][1].error
    with pytest.raises(FileNotFoundError):
        pipeline.run_batch(spark, broken, options=pipeline.Options(strict=True))


def test_tables(spark, tmp_path):
    (tmp_path / "a.CSV").write_bytes("id;es;fr\n1;ñandú;autruche\n".encode("latin-1"))
    (tmp_path / "b.tsv").write_text("note\tpt-BR\nx\tolá\n", encoding="utf-8-sig")
    df = readers.read_table(spark, f"{tmp_path}/a.CSV")
    assert df.columns == ["id", "es", "fr"] and df.first()["es"] == "ñandú"
    long = readers.glossary(readers.read_table(spark, f"{tmp_path}/b.tsv"), "pt", "G").first()
    assert (long["lang"], long["key"], long["term"], long["info"]) == ("pt", "x", "olá", None)
    assert files.term_column(["x", "de", "fr (info)"], "es") == "de" and files.key_column(["es", "remark"]) == "remark"
    with pytest.raises(ValueError):
        files.term_column(["x"], "es")
    assert [files.file_type(x) for x in ("A.XLSX", "b.xls", "c.csv", "d.txt", "e.xlf")] == ["excel", "excel", "csv", "tsv", "xliff"]
    with pytest.raises(ValueError):
        files.file_type("x.pdf")
    (tmp_path / "c.xlsx").write_bytes(b"PK")
    with pytest.raises(Exception):
        readers.read_table(spark, f"{tmp_path}/c.xlsx")


@pytest.mark.parametrize("ns", ["", ' xmlns="urn:oasis:names:tc:xliff:document:1.2"'])
def test_xliff(spark, tmp_path, ns):
    (tmp_path / "x.xlf").write_text(
        f'<?xml version="1.0"?><xliff{ns} version="1.2"><file source-language="en" target-language="es"><body>'
        '<trans-unit id="1"><source>Hello world</source><target>Hola mundo</target></trans-unit>'
        '<trans-unit id="2"><source>[DEBUG] x</source><target>Prueba</target></trans-unit>'
        '<trans-unit id="3"><source>Same</source><target>Same</target></trans-unit>'
        '<trans-unit id="4"><source>Only</source></trans-unit><trans-unit id="5"><source>Up</source><target>ARRIBA</target></trans-unit></body></file></xliff>'
    )
    units = readers.read_xliff(spark, f"{tmp_path}/x.xlf")
    got = {r["unit_id"]: (r["text"], r["reason"]) for r in readers.xliff_texts(units, "es").collect()}
    assert got == {"1": ("Hola mundo", None), "2": ("Prueba", "square_brackets"), "3": ("Same", "identical"), "4": (None, "empty"), "5": ("ARRIBA", "all_caps")}
    source = {r["unit_id"]: r["reason"] for r in readers.xliff_texts(units, "en").collect()}
    assert source["3"] is None and source["4"] is None
    assert readers.xliff_texts(units, "fr").count() == 0


def test_corpora(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"k1": "one", "k2": 2, "k3": {"x": "y"}, "k4": ""}))
    (tmp_path / "p.properties").write_text("# c\n\na.b = text=more\nempty=\nnope\n c=d\n")
    assert {(r["key"], r["text"]) for r in readers.read_i18n_json(spark, f"{tmp_path}/m.json").collect()} == {("k1", "one"), ("k4", "")}
    assert {(r["key"], r["text"]) for r in readers.read_i18n_properties(spark, f"{tmp_path}/p.properties").collect()} == {("a.b", " text=more"), ("c", "d")}
    n = writers.write_filtered_properties(spark, f"{tmp_path}/p.properties", f"{tmp_path}/q.properties", {"a.b"})
    assert n == 1 and (tmp_path / "q.properties").read_text() == "# c\n\nempty=\nnope\n c=d\n"
    rows = spark.createDataFrame([("b", "x"), ("a", "y")], "key string, text string")
    writers.write_i18n(rows, f"{tmp_path}/o.json")
    assert json.loads((tmp_path / "o.json").read_text()) == {"entries": {"a": "y", "b": "x"}}
    writers.write_i18n(rows, f"{tmp_path}/o.properties")
    assert (tmp_path / "o.properties").read_text() == "a=y\nb=x\n"


def test_hunspell_files(spark, tmp_path):
    aff = hunspell.parse_affixes(b"SET ISO8859-1\nSFX S Y 1\nSFX S 0 s .\n")
    (tmp_path / "x.dic").write_bytes("2\nñu/S\nBomb./S\n".encode("latin-1"))
    assert {(r["word"], r["base_lower"], tuple(r["flags"])) for r in hunspell.read_entries(spark, f"{tmp_path}/x.dic", aff).collect()} == {("ñu", "ñu", ("S",)), ("Bomb", "bomb", ("S",))}
    (tmp_path / "y.dic").write_text("2\nWord/SG\tpo:n\nother\n", encoding="utf-8-sig")
    assert {r[0] for r in hunspell.read_head_words(spark, f"{tmp_path}/y.dic").collect()} == {"word", "other"}
    assert [r[0] for r in readers.read_filtered_dictionary(spark, f"{tmp_path}/y.dic").collect()] == ["Word", "other"]
    assert hunspell.parse_export("2\na/GS\nb\nc/12,3\n".encode("utf-16")) == [("a", ["G", "S"]), ("b", []), ("c", ["12", "3"])]
    assert hunspell.parse_export(b"x/AaBb\n", "long") == [("x", ["Aa", "Bb"])]
    blocks = hunspell.raw_blocks(b"TRY a\nSFX S Y 1\nSFX S 0 s .\nPFX R Y 1\nPFX R 0 re .\n")
    assert hunspell.custom_affixes(blocks, {"R"}) == "TRY a-'\nWORDCHARS '-0123456789\nPFX R Y 1\nPFX R 0 re .\n"
    lines, changes = hunspell.patch_header(["SET UTF-8", "X", "TRY ab", "TRY bc"])
    assert lines == ["SET UTF-8", "WORDCHARS '-0123456789", "TRY abc-'", "X"] and all(c["changed"] for c in changes)
    assert hunspell.patch_header(lines)[0] == lines and not any(c["changed"] for c in hunspell.patch_header(lines)[1])


def test_reports_and_lists(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"token": "A", "lineage_tags": ["x"], "in_tb_tokens": true}\n\nbroken\n{"token": "B"}\n')
    assert {r["token"]: (r["lineage_tags"], r["in_tb_tokens"]) for r in readers.read_report(spark, f"{tmp_path}/r.jsonl").collect()} == {"A": (["x"], True), "B": ([], False)}
    (tmp_path / "r.csv").write_text("﻿token,lineage_tags,in_tb_tokens\nA,x | y,True\n")
    r = readers.read_report(spark, f"{tmp_path}/r.csv").first()
    assert (r["token"], r["lineage_tags"], r["in_tb_tokens"], r["origin_class"]) == ("A", ["x", "y"], True, "generated_unknown")
    (tmp_path / "t.txt").write_text(" one \n\ntwo\n")
    assert [x[0] for x in readers.read_token_list(spark, f"{tmp_path}/t.txt").collect()] == ["one", "two"]
    (tmp_path / "audit.csv").write_text("﻿token,token_lower,tb_key,status,match_type\nA,a,k,kept_neologism,\n,x,,,\n")
    assert readers.read_audit(spark, f"{tmp_path}/audit.csv").count() == 1
    for name in ("G_es_token_provenance_report.csv", "G_es_token_provenance_report.jsonl", "A_B_fr_token_provenance_report.csv", "x.csv"):
        (tmp_path / name).write_text("")
    assert files.discover_reports(spark, str(tmp_path)) == {("G", "es"): f"{tmp_path}/G_es_token_provenance_report.jsonl", ("A_B", "fr"): f"{tmp_path}/A_B_fr_token_provenance_report.csv"}
    assert writers.remove_stale(spark, str(tmp_path), r"_report\.csv$", keep="^A_") == ["G_es_token_provenance_report.csv"]
    cats = spark.createDataFrame([("npc", "a"), ("npc", "b")], "category string, token_lower string")
    keys = spark.createDataFrame([("a", ["k1"])], "token_lower string, keys array<string>")
    writers.write_sidecar(cats, keys, f"{tmp_path}/s.json")
    back = writers.read_sidecar(spark, f"{tmp_path}/s.json")
    assert back[0].count() == 2 and back[1].first()["keys"] == ["k1"]
    (tmp_path / "old.json").write_text('{"npc": ["A "]}')
    assert [tuple(r) for r in writers.read_sidecar(spark, f"{tmp_path}/old.json")[0].collect()] == [("npc", "a")]
    (tmp_path / "G_es_tokens.txt").write_text("")
    assert files.token_files(spark, str(tmp_path), "es") == [f"{tmp_path}/G_es_tokens.txt"]


def test_names(spark):
    langs, games = {"es", "fr"}, {"GAME", "BIG_GAME"}
    assert files.parse_pair("es_GAME", langs, games) == ("es", "GAME") and files.parse_pair("BIG_GAME_fr.dic", langs, games) == ("fr", "BIG_GAME")
    assert files.parse_pair("es-ES_big_game", langs, games) == ("es", "BIG_GAME") and files.parse_pair("nope", langs, games) is None and files.parse_pair("de_GAME", langs, games) is None
    found = files.find_dictionary(spark, "es-ES", {"es": "/nowhere/es.dic"}, folder="/also/nowhere")
    assert not found["ok"] and len(found["checks"]) == 4
    assert pipeline.tokenizer_mode("pt-BR") == "portuguese" and pipeline.tokenizer_mode("xx") == "default"


def test_spell_checker_verdicts():
    out = "@(#) International\n*\n\n& wrod 2 0: word, rod\n\n# xx 0\n\n+ root\n\n- \n\n"
    assert pipeline.parse_verdicts(["a", "wrod", "xx", "b", "c", "d"], out) == [("a", True, ""), ("wrod", False, "word, rod"), ("xx", False, ""), ("b", True, ""), ("c", True, ""), ("d", None, "no_block")]


def test_streaming(spark, tmp_path):
    from lexloom.streaming import stream_new_vocabulary, stream_token_counts

    rows = spark.createDataFrame([("en", "fresh words and known words", "2024-01-01 00:00:00"), ("en", "fresh again", "2024-01-01 00:05:00")], "lang string, text string, t string").select("lang", "text", F.to_timestamp("t").alias("ts"))
    rows.write.parquet(f"{tmp_path}/in")
    known = spark.createDataFrame([("en", "known"), ("en", "and")], "lang string, form string")
    source = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    for name, frame in (("vocabulary", stream_new_vocabulary(source, known)), ("counts", stream_token_counts(source))):
        q = frame.writeStream.format("memory").queryName(name).outputMode("append" if name == "vocabulary" else "complete").option("checkpointLocation", f"{tmp_path}/{name}").start()
        q.processAllAvailable()
        q.stop()
    assert sorted(r["token"] for r in spark.table("vocabulary").collect()) == ["again", "fresh", "words"]
    assert {r["token"]: r["uses"] for r in spark.table("counts").groupBy("token").agg(F.sum("uses").alias("uses")).collect()} == {"fresh": 2, "words": 1, "and": 1, "known": 1, "again": 1}


def test_registry_agrees_on_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and "neologisms_by_lang" in entry.queries()
    assert gzip


@pytest.mark.parametrize("sep", [";", "|"])
def test_separator_and_encoding_are_found_at_any_size(spark, tmp_path, sep):
    line = f"monster.1.name{sep}jabal\u00ed de la monta\u00f1a{sep}{'x' * 2000}\n".encode("latin-1")
    n = (64 << 20) // len(line) + 10
    with open(tmp_path / "big.csv", "wb") as f:
        f.write(f"key{sep}es{sep}other\n".encode())
        f.write(line.replace("\u00ed".encode("latin-1"), b"i").replace("\u00f1".encode("latin-1"), b"n") * (n - 1) + line)  # only the last line tells
    df = readers.read_table(spark, f"{tmp_path}/big.csv")
    assert df.columns == ["key", "es", "other"]
    terms = {r["es"]: r["count"] for r in df.groupBy("es").count().collect()}
    assert terms == {"jabali de la montana": n - 1, "jabal\u00ed de la monta\u00f1a": 1}
