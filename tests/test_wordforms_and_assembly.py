from pyspark.sql import functions as F

from lexloom.operators import affix, assembly, language, reports, wordforms
from lexloom.operators import tokens as O

RULES = [
    ("SFX", "S", True, "", "s", [], "[^s]"),
    ("SFX", "G", True, "o", "a", [], "o"),
    ("SFX", "G", True, "o", "as", [], "o"),
    ("PFX", "R", True, "", "re", [], "."),
]


def rules(spark):
    return spark.createDataFrame([(k, f, x, n, s, a, af, c) for n, (k, f, x, s, a, af, c) in enumerate(RULES)], affix.RULES)


def cases(spark, words):
    return O.case_map(spark.createDataFrame([(w,) for w in words], "token string"), keys=[])


def test_gender_ghosts(spark):
    df = spark.createDataFrame([(w,) for w in ("jalatín", "tar", "abc", "amor", "mar", "francés", "bwork")], "base_lower string")
    got = {}
    for r in wordforms.gender_ghosts(df, "es").collect():
        got.setdefault(r["base_lower"], set()).add(r["form"])
    assert got["jalatín"] == {"jalatín" + s for s in ("a", "as", "os", "es")} | {"jalatin" + s for s in ("", "a", "as", "os", "es")}
    assert got["bwork"] == {"bworka", "bworkas", "bworkos", "bworkes"}
    assert "frances" in got["francés"] and set(got) == {"jalatín", "francés", "bwork"}
    assert wordforms.gender_ghosts(df, "en").count() == 0
    assert {r["form"] for r in wordforms.gender_ghosts(df.where("base_lower = 'amor'"), "de").collect()} == {"amorin", "amorinnen"}


def test_corpus_wordforms(spark):
    words = spark.createDataFrame([("Gobbo",), ("tofu",), ("tar",), ("nada",)], "base_word string")
    corpus = cases(spark, ["gobba", "Gobbas", "gobbos", "tofus", "Tofus", "regobbos", "tars", "gobboes"])
    names = spark.createDataFrame([("gobbo",)], "token_lower string")
    std = spark.createDataFrame([("tofus",)], "form string")
    out = {r["base_word"]: r for r in wordforms.corpus_wordforms(words, rules(spark), corpus, lang="es", flags=["S", "G"], quorum=0.5, names=names, std_known=std).collect()}
    assert set(out) == {"Gobbo", "tofu"}
    g = out["Gobbo"]
    assert g["found_forms"] == ["Gobbas", "gobba", "gobbos", "regobbos"] and g["count"] == 4 and g["ghost_forms"] == ["gobboes"]
    assert g["validated_flags"] == ["G", "S"]
    assert [(e["flag"], e["derived_count"], e["hit_count"], e["hit_ratio"], e["passed"], e["hit_forms_truecase"]) for e in g["flag_evidence"]] == [("G", 2, 2, 1.0, True, ["Gobbas", "gobba"]), ("S", 1, 1, 1.0, True, ["gobbos"])]
    assert out["tofu"]["found_forms"] == ["Tofus", "tofus"] and out["tofu"]["new_count"] == 0
    only_new = {r["base_word"]: r for r in wordforms.corpus_wordforms(words, rules(spark), corpus, lang="es", flags=[], names=names, std_known=std, retain_known=False).collect()}
    assert set(only_new) == {"Gobbo"} and only_new["Gobbo"]["found_forms"] == [] and only_new["Gobbo"]["new_found_forms"] == ["Gobbas", "gobba", "gobbos", "regobbos"]


def test_quorum(spark):
    many = spark.createDataFrame([("SFX", "Q", True, n, "", str(n), [], ".") for n in range(10)], affix.RULES)
    base = spark.createDataFrame([("w",)], "base_lower string")
    for hits, quorum, passed in ((5, 0.5, True), (3, 0.5, False), (3, 0.3, True), (0, 0.0, False)):
        r = wordforms.quorum_rows(base, many, cases(spark, [f"w{k}" for k in range(hits)]), lang="es", flags=["Q"], quorum=quorum).first()
        assert (r["derived_count"], r["hit_count"], r["passed"]) == (10, hits, passed)


def test_english_possessives_are_no_forms(spark):
    m = spark.createDataFrame([("SFX", "M", True, 0, "", "'s", [], "."), ("SFX", "S", True, 1, "", "s", [], ".")], affix.RULES)
    words = spark.createDataFrame([("orc",)], "base_word string")
    out = wordforms.corpus_wordforms(words, m, cases(spark, ["orc's", "orcs"]), lang="en", flags=["M", "S"]).first()
    assert out["found_forms"] == ["orcs"] and out["validated_flags"] == ["S"]


def built(spark):
    bases = spark.createDataFrame([(w,) for w in ("Gobbo", "Gobbos", "Bwork", "known", "tofu")], "token string")
    corpus = cases(spark, ["gobbos", "gobba", "gobbas", "bwork", "bworks", "knowns", "gobbo"])
    audits = spark.createDataFrame([("knowns", "knowns", "", "removed_known_word", "exact_or_affix"), ("Gobbo", "gobbo", "monster.1.name", "kept_neologism", ""), ("tofu", "tofu", "Item.name.2", "kept_neologism", "")], "token string, token_lower string, tb_key string, status string, match_type string")
    found = wordforms.corpus_wordforms(bases.withColumnRenamed("token", "base_word"), rules(spark), corpus, lang="es", flags=["S", "G"])
    rows = assembly.assemble(bases, found, rules(spark), lang="es", mandatory=[], audits=audits)
    return bases, audits, found, rows


def test_assembly(spark):
    bases, audits, found, rows = built(spark)
    got = {r["token"]: r for r in rows.collect()}
    assert "knowns" not in got and "known" in got
    assert got["Gobbo"]["assigned_flags"] == ["G", "S"] and got["Gobbo"]["origin_class"] == "tb_only"
    assert got["gobba"]["origin_class"] == "corpus_only" and got["gobba"]["source_base_words"] == ["Gobbo"]
    assert got["Gobbos"]["dropped_from_compressed"] and got["Gobbos"]["dropped_generated_by"] == ["Gobbo"]
    assert not got["Gobbos"]["in_compressed_output"] and got["Gobbos"]["in_flat_output"]
    # bworks, not bwork itself, is a hit of Bwork; gobbos is a lower-case form, so Gobbos gets a lower-case spelling
    assert got["gobbos"]["lineage_tags"] == ["casing_inference", "corpus_aff_form"] and got["gobbos"]["source_base_words"] == ["Gobbo", "Gobbos"]
    assert "bwork" not in got
    total = assembly.assembly_totals(rows).first()
    assert total["flat_words"] == len(got) and total["pruned"] == sum(r["dropped_from_compressed"] for r in got.values())


def test_consolidated_report(spark):
    bases, audits, found, rows = built(spark)
    tokens = spark.createDataFrame([("Gobbo",), ("known",)], "token string")
    out = {r["token"]: r for r in reports.consolidated_report(rows, audits, tokens, bases, found, game="g", lang="es").collect()}
    assert "Gobbos" not in out
    g = out["Gobbo"]
    assert (g["tb_key"], g["tb_source_entity"], g["filter_status"], g["in_tb_tokens"], g["in_filtered_dic_base"]) == ("monster.1.name", "monster:1", "kept_neologism", True, True)
    assert out["gobba"]["tb_key"] == "monster.1.name" and out["gobba"]["filter_status"] == ""  # by its base
    assert out["gobba"]["step4_related_bases"] == ["Gobbo"]
    assert [(e["base_word"], e["flag"]) for e in g["flag_evidence"]] == [("Gobbo", "G"), ("Gobbo", "S")]
    flat = {r["token"]: r for r in reports.csv_report(reports.consolidated_report(rows, audits, tokens, bases, found, game="g", lang="es")).collect()}
    assert flat["Gobbo"]["flag_evidence_summary"] == "Gobbo:G:2/2 ; Gobbo:S:1/1" and flat["Gobbo"]["assigned_flags"] == "G | S"


def test_exports_and_surfaces(spark):
    rows = spark.createDataFrame([("es", "A", "Bo", ["S"]), ("es", "B", "Bo", ["G", "S"]), ("es", "B", "bo", []), ("es", "C", "Bos", [])], "lang string, game string, word string, flags array<string>")
    merged = assembly.merge_exports(rows)
    got = {r["word"]: (r["flags"], r["sources"]) for r in merged.collect()}
    assert got == {"Bo": (["G", "S"], ["A", "B"]), "bo": ([], ["B"]), "Bos": ([], ["C"])}
    assert {r["word"] for r in assembly.prune_merged(merged, rules(spark)).collect()} == {"Bo", "bo"}
    words = spark.createDataFrame([("bo",), ("BO",), ("Bo",), ("xx",)], "word string")
    assert {r["word_lower"]: r["surface"] for r in assembly.representative_surface(words, keys=[]).collect()} == {"bo": "BO", "xx": "xx"}


def test_casing_and_guards(spark):
    bases = spark.createDataFrame([(w,) for w in ("Bwork", "Tofu", "tofu", "low", "Ümlaut", "A")], "token string")
    exact = spark.createDataFrame([(w,) for w in ("bwork", "tofu", "ümlaut")], "form string")
    names = spark.createDataFrame([("a",), ("bwork",)], "token_lower string")
    got = {(r["original"], r["inferred_lower"], r["source"]) for r in assembly.infer_casing(bases, exact, names).collect()}
    assert got == {("Bwork", "bwork", "corpus_exact_lower + propernoun_sidecar"), ("Ümlaut", "ümlaut", "corpus_exact_lower"), ("A", "a", "propernoun_sidecar")}
    forms = spark.createDataFrame([("Orc's",), ("Orcs",)], "form string")
    assert [r[0] for r in assembly.guard_possessives(forms).collect()] == ["Orcs"]


def test_report_merge_and_dashboard(spark):
    raw = spark.createDataFrame(
        [("A", "es", "Bo", "", "tb_only", "x | y", "true", "kept_neologism"), ("B", "es", "bo", "bo", "corpus_only", "y", "no", ""), ("B", "es", " Zed10 ", "", "", "", "", ""), ("A", "es", "zed9", "", "tb_only", "", "1", "")],
        "game string, language string, token string, token_lower string, origin_class string, lineage_tags string, in_tb_tokens string, filter_status string",
    )
    rows = reports.normalise_report(raw)
    merged = {r["token_lower"]: r for r in reports.merge_reports(rows).collect()}
    bo = merged["bo"]
    assert (bo["token"], bo["origin_class"], bo["lineage_tags"], bo["in_tb_tokens"], bo["game"], bo["source_reports_count"], bo["filter_status"]) == ("Bo", "mixed", ["x", "y"], True, "A | B", 2, "kept_neologism")
    assert merged["zed10"]["origin_class"] == "generated_unknown"
    totals = reports.report_totals(rows).first()
    assert (totals["rows"], totals["distinct_token_lower"], totals["distinct_tokens_surface"], totals["in_tb_tokens"]) == (4, 3, 4, 2)
    page = [r["token"] for r in reports.report_query(rows, reports.ReportFilter(text="zed"), sort="token").collect()]
    assert page == ["zed9", "Zed10"]
    assert [r["token"] for r in reports.report_query(rows, reports.ReportFilter(status=reports.EMPTY), sort="token", descending=True).collect()] == ["Zed10", "zed9", "bo"]
    assert reports.report_query(rows, page=2, page_size=3, sort="token").count() == 1
    assert reports.page_sizes() == [60, 120, 180, 240, 0]
    hist = {(r["metric"], r["value"]): r["rows"] for r in reports.report_histograms(rows).collect()}
    assert hist["filter_status", "(empty)"] == 3 and hist["lineage_tag", "y"] == 2
    assert [tuple(r) for r in reports.bar_counts(rows, "lineage_tags").collect()] == [("y", 2), ("x", 1)]


def test_language_filter(spark):
    known = spark.createDataFrame([("es", "el perro grande come la comida del gato en la casa " * 5), ("en", "the big dog eats the food of the cat in the house " * 5), ("fr", "le grand chien mange la nourriture du chat dans la maison " * 5)], "lang string, text string")
    table = language.profiles(known)
    rows = spark.createDataFrame([("1", "the dog of the house eats the food in the house"), ("2", "el gato come la comida en la casa del perro"), ("3", "12 34"), ("4", "the cat"), ("5", "el gato"), ("6", "[#1] {x}")], "key string, text string")
    got = {r["key"]: r for r in language.language_filter(rows, table, lang="es").collect()}
    assert [k for k, r in got.items() if r["is_wrong"]] and {k for k, r in got.items() if r["is_wrong"]} == {"1", "4"} or {k for k, r in got.items() if r["is_wrong"]} == {"1"}
    assert got["3"]["confidence"] == 1.0 and got["1"]["threshold"] == 0.12 and got["5"]["threshold"] == 0.0
    assert not any(r["is_wrong"] for r in language.language_filter(rows, table, lang="fr").where("word_count < 7").collect())


def test_differences(spark):
    old = spark.createDataFrame([("a", ["x", "y"]), ("b", ["z"])], "base_word string, found_forms array<string>")
    new = spark.createDataFrame([("a", ["y", "w"]), ("c", ["v"])], "base_word string, found_forms array<string>")
    diff = wordforms.diff_wordforms(old, new)
    assert {r["base_word"]: (r["lost"], r["gained"], r["kept"]) for r in diff.collect()} == {"a": (["x"], ["w"], ["y"]), "b": (["z"], [], []), "c": ([], ["v"], [])}
    assert tuple(wordforms.diff_totals(diff).first()) == (2, 1, 2, round(200 / 3, 6))
    assert [tuple(r) for r in wordforms.top_lost(diff).collect()] == [("a", ["x"]), ("b", ["z"])]
    assert [r["base_word"] for r in wordforms.top_lost(diff, 1).collect()] == ["a"]
    times = spark.createDataFrame([("filter", 3.0), ("filter", 1.0), ("filter", 9.0), ("tokens", 2.0), ("tokens", None)], "step string, seconds double")
    assert {r["step"]: (r["runs"], r["seconds"]) for r in reports.median_seconds(times, ["step"]).collect()} == {"filter": (3, 3.0), "tokens": (1, 2.0)}


def test_glossary_rules(spark):
    tb = spark.createDataFrame(
        [("g", "es", 1, "monster.1.name, NPC.2.name", "Dragón Rojo", None), ("g", "es", 2, "emoticon.1.shortcut", ":)hola", None), ("g", "es", 3, "a morse thing", "raya", None), ("g", "es", 4, "Item.name.3", "Espada Roja", 'One: "Espadita", Other: "Espaditas"'), ("g", "es", 5, "Item.name.4", " ", None), ("g", "es", 6, "subarea.1.name", "Bosque Dragón", None)],
        "game string, lang string, row_id long, key string, term string, info string",
    )
    rows = O.glossary_tokens(tb)
    assert {r["token"] for r in rows.collect()} == {"Dragón", "Rojo", "Espada", "Roja", "Espadita", "Espaditas", "Bosque"}
    keys = {r["token_lower"]: r["keys"] for r in O.token_keys(rows).collect()}
    assert keys["dragón"] == ["monster.1.name, NPC.2.name", "subarea.1.name"] and "espadita" not in keys
    cats = {(r["category"], r["token_lower"]) for r in O.token_categories(rows).collect()}
    assert {("monster", "dragón"), ("npc", "dragón"), ("area", "bosque"), ("item", "roja")} <= cats
    first, named = O.first_word_rules(tb, rows)
    assert {r["token_lower"] for r in first.collect()} == {"dragón", "espada"}
    corpus = spark.createDataFrame([("g", "es", "La espada roja. Espada y Dragón"), ("g", "es", "un Bosque")], "game string, lang string, text string")
    evidence = O.case_evidence(corpus, F.col("text"), keys=["game", "lang"])
    got = {r["token_lower"]: (r["lowercase_count"], r["uppercase_mid_sentence_count"]) for r in evidence.collect()}
    assert got["espada"] == (1, 0) and got["dragón"] == (0, 1) and got["bosque"] == (0, 1) and got["la"] == (0, 0)
    assert {r["token_lower"] for r in O.default_lowercase(first, named, evidence).collect()} == {"espada"}
    assert O.default_lowercase(first, named, None).count() == 0
    over = O.override_tokens(spark.createDataFrame([("Dragopavo",), ("Mechasme",), ("x",)], "token string"), lower_only=["Dragopavo"], keep_both=["Sela"], replace={"mechasme": ["Mecasma", "mecasma"]})
    assert {r[0] for r in over.collect()} == {"dragopavo", "Sela", "sela", "Mecasma", "mecasma", "x"}
