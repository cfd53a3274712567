import json

import pytest

from lexloom.plans import batches, pipeline
from lexloom.sources import files, hunspell, readers, writers

AFF = "SET UTF-8\nSFX S Y 1\nSFX S 0 s .\nSFX Z Y 1\nSFX Z 0 z .\n"


@pytest.fixture
def folder(tmp_path):
    for lang in ("es", "fr"):
        (tmp_path / "dics" / lang).mkdir(parents=True)
        (tmp_path / "dics" / lang / f"{lang}.aff").write_text(AFF)
        (tmp_path / "dics" / lang / f"{lang}.dic").write_text("1\ncasa/S\n")
    return tmp_path


def dictionaries(folder):
    return {la: f"{folder}/dics/{la}/{la}.dic" for la in ("es", "fr")}


def test_token_lists_are_filtered_once(spark, folder):
    (folder / "G_es_tokens.txt").write_text("Casas\ngobbo\ntofu\n")
    (folder / "H_es_tokens.txt").write_text("")
    (folder / "G_de_tokens.txt").write_text("Haus\n")
    out = f"{folder}/out"
    first = batches.filter_token_files(spark, str(folder), ["es", "de"], dictionaries(folder), out)
    assert [(r["language"], r["status"], r.get("tokens"), r.get("removed")) for r in first] == [("es", "ok", 3, 1), ("es", "ok", 0, 0), ("de", "no_dictionary", None, None)]
    assert files.decode(files.read_bytes(spark, f"{out}/G_es_filtered_tokens.dic")) == "2\ngobbo\ntofu\n"
    assert readers.read_audit(spark, f"{out}/G_es_filtered_tokens_filter_audit").where("status = 'removed_known_word'").first()["token"] == "Casas"
    files.write_bytes(spark, f"{out}/G_es_filtered_tokens.dic", b"0\n")
    again = batches.filter_token_files(spark, str(folder), ["es"], dictionaries(folder), out)
    assert {r["status"] for r in again} == {"skipped"} and files.read_bytes(spark, f"{out}/G_es_filtered_tokens.dic") == b"0\n"
    assert batches.filter_token_files(spark, str(folder), ["es"], dictionaries(folder), out, rewrite=True)[0]["kept"] == 2
    totals = {r["language"]: r for r in batches.batch_totals(spark, first).collect()}
    assert set(totals) == {"es", "all"} and totals["all"]["files"] == 2 and totals["es"]["removal_rate"] == pytest.approx(100 / 3, abs=1e-6)


def test_corpora_are_warmed_by_language(spark, folder):
    texts = [("es", "la casa grande de los perros y las gatas del pueblo pequeño"), ("en", "the big house of the dogs and the cats of the small town"), ("fr", "la grande maison des chiens et des chattes du petit village")]
    known = spark.createDataFrame(texts * 20, "lang string, text string")
    spanish, english = texts[0][1], texts[1][1]
    (folder / "a.json").write_text(json.dumps({"k": spanish, "w": english}))
    (folder / "b.properties").write_text(f"k={english}\nw={spanish}\n")
    done = folder / "D_es_i18n_filtered.json"
    done.write_text(json.dumps({"k": english}))
    corpora = {("A", "es"): f"{folder}/a.json", ("B", "es-ES"): f"{folder}/b.properties", ("C", "es"): f"{folder}/none.json", ("D", "es"): str(done)}
    inputs, report = batches.warm_corpora(spark, pipeline.Inputs({}, corpora, {}, known), f"{folder}/work")
    assert {r["game"]: r["status"] for r in report["runs"]} == {"A": "ok", "B": "ok", "C": "skipped", "D": "ok"}
    assert {k: report["summary"][k] for k in ("total", "ok", "skipped", "failed")} == {"total": 4, "ok": 3, "skipped": 1, "failed": 0}
    got = {g: [(r["key"], r["text"]) for r in readers.read_i18n(spark, inputs.corpora[g, "es"], g, "es").collect()] for g in "ABD"}
    # the same key of two games is decided for each
    assert got == {"A": [("k", spanish)], "B": [("w", spanish)], "D": [("k", english)]}
    files.write_bytes(spark, f"{folder}/work/x.txt", b"x")
    files.write_bytes(spark, f"{folder}/gone/sub/y.txt", b"x")
    erased = batches.erase_outputs(spark, f"{folder}/work", f"{folder}/gone")
    assert len(erased["kept"]) == 2 and len(erased["removed"]) == 2 and files.names_in(spark, f"{folder}/gone") == []
    assert batches.erase_outputs(spark, f"{folder}/work", f"{folder}/none", keep_filtered=False)["kept"] == []


def test_merged_exports_are_pruned(spark, folder):
    for game, text in (("G", "2\ngobbo/S\ntofu\n"), ("H", "3\nGobbos\ngobbo\nzaap\n")):
        files.write_bytes(spark, f"{folder}/in/Compressed_dics/es_{game}/es_{game}.dic", text.encode())
    out = batches.export_merged(spark, f"{folder}/in", dictionaries(folder), f"{folder}/out", tenant="ALL", known_games={"G", "H"})["es"]
    assert hunspell.parse_export(files.read_bytes(spark, out["dic"])) == [("gobbo", ["S"]), ("tofu", []), ("zaap", [])]
    assert {w for w, _ in hunspell.parse_export(files.read_bytes(spark, out["flat"]))} == {"gobbo", "Gobbos", "tofu", "zaap"}
    assert (out["flat_words"], out["entries"], out["pruned"], out["flags_used"]) == (4, 3, 1, ["S"])
    aff = files.read_bytes(spark, out["aff"]).decode()
    assert "SFX S" in aff and "SFX Z" not in aff and files.exists(spark, f"{out['full']}/es.dic")


def test_json_writers_escape_and_keep_names_unique(spark, tmp_path):
    rows = spark.createDataFrame([('a"b', "x\ny"), ("é", "1"), ("é", "2"), ("n", None)], "key string, text string")
    writers.write_i18n(rows, f"{tmp_path}/o.json")
    assert json.loads((tmp_path / "o.json").read_text()) == {"entries": {'a"b': "x\ny", "é": "2", "n": None}}
    writers.write_i18n(rows.limit(0), f"{tmp_path}/none.json")
    assert json.loads((tmp_path / "none.json").read_text()) == {"entries": {}}
    (tmp_path / "broken.json").write_text('{"a": ')
    with pytest.raises(Exception, match="JSONDecodeError"):
        readers.read_i18n_json(spark, f"{tmp_path}/broken.json").collect()
    cats = spark.createDataFrame([("npc", "b"), ("area", "a"), ("npc", "a"), ("npc", "a"), (None, "x")], "category string, token_lower string")
    keys = spark.createDataFrame([("a", ["k2", 'k"1']), ("b", ["k3"]), ("c", [])], "token_lower string, keys array<string>")
    writers.write_sidecar(cats, keys, f"{tmp_path}/s.json")
    assert json.loads((tmp_path / "s.json").read_text()) == {"by_category": {"area": ["a"], "npc": ["a", "b"]}, "by_token": {"a": ["k2", 'k"1'], "b": ["k3"]}}
    writers.write_sidecar(cats.limit(0), keys.limit(0), f"{tmp_path}/e.json")
    assert json.loads((tmp_path / "e.json").read_text()) == {"by_category": {}, "by_token": {}}
    back = writers.read_sidecar(spark, f"{tmp_path}/e.json")
    assert back[0].isEmpty() and back[1].isEmpty()
