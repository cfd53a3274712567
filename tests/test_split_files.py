"""JSON files that are written by executors and read by lines, wherever they are split."""

import json

import pytest

from lexloom.sources import files, readers, writers


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _no_rows_to_the_driver(spark, monkeypatch):
    monkeypatch.setattr(type(spark.range(0)), "toLocalIterator", lambda *a, **k: pytest.fail("rows went to the driver"))
    monkeypatch.setattr(files, "read_bytes", lambda *a: pytest.fail("the driver read the file"))


def test_sidecar_is_written_and_read_without_the_driver(spark, tmp_path, monkeypatch, small_splits):
    pairs = [(c, f"{c[0]}{i:03}") for c in ("area", "npc", 'a"b') for i in range(60)]
    listed = [(f"t{i:03}", [f"k{j}" for j in range(1 + i % 30)]) for i in range(90)] + [("é\\\n", ['q"', "\t", "ü"])]
    _no_rows_to_the_driver(spark, monkeypatch)
    path = f"{tmp_path}/s.json"
    writers.write_sidecar(spark.createDataFrame(pairs, "category string, token_lower string"), spark.createDataFrame(listed, "token_lower string, keys array<string>"), path)
    by_category = {c: sorted(t for x, t in pairs if x == c) for c in sorted({c for c, _ in pairs})}
    expected = {"by_category": by_category, "by_token": dict(sorted(listed))}
    assert (tmp_path / "s.json").read_text() == json.dumps(expected, indent=2, ensure_ascii=False) + "\n"
    assert spark.read.text(path).rdd.getNumPartitions() > 10
    categories, keys = writers.read_sidecar(spark, path)
    assert sorted(tuple(r) for r in categories.collect()) == sorted(pairs)
    assert {r["token_lower"]: r["keys"] for r in keys.collect()} == dict(listed)


@pytest.mark.parametrize("text", ['{"by_category": {"npc": ["A ", 5]}, "by_token": {"a": []}}', '{\n  "by_category": {\n    "npc": [\n      "A ",\n      5\n    ]\n  },\n  "by_token": {\n    "a": []\n  }\n}\n'])
def test_sidecar_in_any_layout(spark, tmp_path, text):
    (tmp_path / "s.json").write_text(text)
    categories, keys = writers.read_sidecar(spark, f"{tmp_path}/s.json")
    assert sorted(tuple(r) for r in categories.collect()) == [("npc", "5"), ("npc", "a")] and [tuple(r) for r in keys.collect()] == [("a", [])]


def test_broken_sidecar_is_an_error(spark, tmp_path):
    (tmp_path / "s.json").write_text('{\n  "by_category": {\n    "npc": [\n      "a"\n      "b"\n    ]\n  },\n  "by_token": {\n  }\n}\n')
    with pytest.raises(Exception, match="JSONDecodeError"):
        writers.read_sidecar(spark, f"{tmp_path}/s.json")[0].collect()


def test_i18n_is_written_and_read_without_the_driver(spark, tmp_path, monkeypatch, small_splits):
    rows = [(f"k{i:03}", f'text "{i}"\n\\ é') for i in range(200)] + [("none", None)]
    _no_rows_to_the_driver(spark, monkeypatch)
    for end in ("json", "properties"):
        writers.write_i18n(spark.createDataFrame(rows, "key string, text string"), f"{tmp_path}/c.{end}")
    assert (tmp_path / "c.json").read_text() == json.dumps({"entries": dict(sorted(rows))}, indent=2, ensure_ascii=False) + "\n"
    assert (tmp_path / "c.properties").read_text() == "".join(f"{k}={t}\n" for k, t in sorted(rows))
    back = readers.read_i18n_json(spark, f"{tmp_path}/c.json")
    assert back.rdd.getNumPartitions() > 10
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows[:-1])


@pytest.mark.parametrize(
    "text, rows",
    [
        ('{\n  "entries": {\n    "a": "1",\n    "b": {\n      "x": "y"\n    },\n    "c": "3"\n  }\n}\n', [("a", "1"), ("c", "3")]),
        ('{\n  "entries": {\n    "a": "1",\n    "a": "2"\n  }\n}\n', [("a", "2")]),
        ('{\n  "entries": {\n    "a": "1",\n    "b": 2\n  }\n}\n', [("a", "1")]),
        ('{\n  "entries": {\n    "a": "1"\n  },\n  "more": {\n    "b": "2"\n  }\n}\n', [("a", "1")]),
    ],
)
def test_i18n_in_any_layout(spark, tmp_path, text, rows):
    (tmp_path / "c.json").write_text(text)
    assert sorted(tuple(r) for r in readers.read_i18n_json(spark, f"{tmp_path}/c.json").collect()) == rows


def test_i18n_without_a_comma_is_an_error(spark, tmp_path):
    (tmp_path / "c.json").write_text('{\n  "entries": {\n    "a": "1"\n    "b": "2"\n  }\n}\n')
    with pytest.raises(Exception, match="JSONDecodeError"):
        readers.read_i18n_json(spark, f"{tmp_path}/c.json").collect()
