"""Readers that give DataFrames."""

from __future__ import annotations

import csv
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import text as T
from . import files

TB = "game string, lang string, row_id long, key string, term string, info string"


def sniff_separator(first_line: str) -> str:
    """The separator of a CSV file from its first line."""
    try:
        return csv.Sniffer().sniff(first_line, delimiters=",;\t|").delimiter
    except csv.Error:
        return ","


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A glossary file as it is, all columns strings: CSV with its separator found, TSV, or the first sheet of
    an Excel file where a reader for those is installed. UTF-8 with or without a mark, else Latin-1."""
    kind = files.file_type(path)
    if kind == "excel":
        return read_excel(spark, path)
    if kind == "xliff":
        raise ValueError(f"{path} is XLIFF; use read_xliff()")
    # the text source keeps bytes as they are, so both are found at any size without taking the file to the driver
    lines = spark.read.text(path)
    encoding = "UTF-8" if lines.where(~F.is_valid_utf8("value")).isEmpty() else "ISO-8859-1"
    sep = "\t"
    if kind != "tsv":
        head = lines.select(F.col("value").cast("binary")).first()
        sep = sniff_separator(bytes(head[0]).decode("utf-8-sig" if encoding == "UTF-8" else "latin-1") if head else "")
    df = spark.read.csv(path, header=True, sep=sep, encoding=encoding, multiLine=True, escape='"')
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def read_excel(spark: SparkSession, path: str, *, lang: str | None = None) -> DataFrame:
    """The first sheet, or with ``lang`` the first that has values in that column."""
    import pandas as pd

    try:
        book = pd.ExcelFile(path)
    except ImportError as e:
        raise RuntimeError(f"{path}: reading Excel files needs the openpyxl or xlrd package") from e
    chosen = None
    for sheet in book.sheet_names:
        df = book.parse(sheet, dtype=str)
        if chosen is None or (lang and lang in df.columns and df[lang].notna().any()):
            chosen = df
            if not lang or (lang in df.columns and df[lang].notna().any()):
                break
    return spark.createDataFrame(chosen.where(chosen.notna(), None))


def glossary(df: DataFrame, lang: str, game: str, *, term: str | None = None, fallback: bool = True) -> DataFrame:
    """A wide glossary table in long form: game, lang, row_id, key, term, info."""
    key = files.key_column(df.columns)
    column = term or files.term_column(df.columns, lang, fallback)
    info = f"{column} (info)"
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`").cast("string")
    return df.select(
        F.lit(game).alias("game"),
        F.lit(files.language_prefix(lang)).alias("lang"),
        F.monotonically_increasing_id().alias("row_id"),
        (quoted(key) if key else F.lit("")).alias("key"),
        quoted(column).alias("term"),
        (quoted(info) if info in df.columns else F.lit(None).cast("string")).alias("info"),
    )


def read_xliff(spark: SparkSession, path: str) -> DataFrame:
    """(source_lang, target_lang, unit_id, source, target), by Spark's XML reader. Namespaces are ignored."""
    unit = "struct<_id: string, source: string, target: string>"
    body = f"struct<`trans-unit`: array<{unit}>, group: array<struct<`trans-unit`: array<{unit}>>>>"
    schema = f"`_source-language` string, `_target-language` string, body {body}"
    raw = spark.read.format("xml").option("rowTag", "file").option("ignoreNamespace", True).schema(schema).load(path)
    inner = F.flatten(F.transform(F.coalesce("body.group", F.array().cast(f"array<struct<`trans-unit`: array<{unit}>>>")), lambda g: F.coalesce(g["trans-unit"], F.array().cast(f"array<{unit}>"))))
    units = F.concat(F.coalesce(F.col("body.`trans-unit`"), F.array().cast(f"array<{unit}>")), inner)
    rows = raw.select(F.col("`_source-language`").alias("source_lang"), F.col("`_target-language`").alias("target_lang"), F.explode(units).alias("u"))
    return rows.select("source_lang", "target_lang", F.col("u._id").alias("unit_id"), F.col("u.source").alias("source"), F.col("u.target").alias("target"))


def xliff_texts(units: DataFrame, lang: str, **switches) -> DataFrame:
    """Units with the text of a language, from source or target as the file says, and why a unit is left out
    (reason: empty, identical, square_brackets, all_caps, wip_markers; null if it stays)."""
    is_source = F.col("source_lang") == lang
    text = F.when(is_source, F.col("source")).when(F.col("target_lang") == lang, F.col("target"))
    s, t = F.coalesce("source", F.lit("")), F.coalesce("target", F.lit(""))
    rows = units.where((F.col("source_lang") == lang) | (F.col("target_lang") == lang)).withColumn("text", text)
    on = {"identical": True, "brackets": True, "all_caps": True, "wip": True} | switches
    reason = F.when(F.coalesce("text", F.lit("")) == "", "empty")
    for name, label, test in (("identical", "identical", ~is_source & P.is_identical(s, t)), ("brackets", "square_brackets", P.has_brackets(s)), ("all_caps", "all_caps", ~is_source & P.is_all_caps(t)), ("wip", "wip_markers", P.has_wip_marker(t))):
        if on[name]:
            reason = reason.when(test, label)
    return rows.withColumn("reason", reason)


def _i18n_lines(spark: SparkSession, path: str) -> DataFrame:
    """(kind, comma, key, text) of the lines of a JSON object that has a member to a line: kind is text, other (a value
    that is no text), bad (no member), or the line itself where it belongs to the frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for line in batch.column(0).to_pylist():
                if line in _FRAME:
                    out.append((line, False, None, None))
                    continue
                body = line.removesuffix(",")
                try:
                    members = list(json.loads("{" + body + "}").items())
                except ValueError:
                    members = []
                key, text = members[0] if len(members) == 1 and line.startswith('    "') else (None, None)
                kind = "bad" if key is None else "text" if isinstance(text, str) else "other"
                out.append((kind, body != line, key, text if kind == "text" else None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.bool_(), pa.string(), pa.string()))], ["kind", "comma", "key", "text"])

    return spark.read.text(path).mapInArrow(run, "kind string, comma boolean, key string, text string")


_FRAME = ("{", '  "entries": {', "  }", "}")


def _is_whole(lines: DataFrame) -> bool:
    """Whether lines are one object in its frame, with commas between members and no name twice."""
    member = F.col("kind").isin("text", "other")
    name = F.when(member, F.xxhash64("key"))
    frame = [F.count_if(F.col("kind") == x) for x in _FRAME]
    n, bad, commas, names, *counts = lines.agg(F.count_if(member), F.count_if(F.col("kind") == "bad"), F.count_if(member & F.col("comma")), F.count_distinct(name), *frame).first()
    return not bad and commas == max(n - 1, 0) and names == n and counts == [1] * len(_FRAME)


def read_i18n_json(spark: SparkSession, path: str) -> DataFrame:
    """(key, text) of a JSON object of strings, or of its "entries"; other values are left out. A file that is no
    JSON is an error. A file with a member to a line, as write_i18n() writes it, is read by lines on all cores; any
    other is one value, which a task takes as a whole (below 2 GB), in a single pass."""
    head, tail = files.ends(spark, path)
    if head.startswith(b'{\n  "entries": {\n') and tail.endswith(b"\n  }\n}\n") and not tail.endswith(b",\n  }\n}\n"):
        lines = _i18n_lines(spark, path)
        if _is_whole(lines):
            return lines.where("kind = 'text'").select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = json.loads(files.decode(content.as_py()))
                entries = data.get("entries") if isinstance(data, dict) else {}
                rows = [(k, v) for k, v in (entries if isinstance(entries, dict) else data).items() if isinstance(v, str)]
                for at in range(0, len(rows), 10_000):
                    part = rows[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in part], pa.string()) for k in (0, 1)], ["key", "text"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "key string, text string")


def read_i18n_properties(spark: SparkSession, path: str) -> DataFrame:
    """(key, text) of key=value lines; comments, blank lines, lines without = and empty values are left out."""
    line = F.regexp_replace("value", r"\r$", "")
    rows = spark.read.text(path).select(line.alias("line"))
    rows = rows.where((F.trim("line") != "") & ~F.ltrim("line").startswith("#") & F.contains("line", F.lit("=")))
    parts = F.split("line", "=", 2)
    return rows.select(F.trim(parts[0]).alias("key"), parts[1].alias("text")).where(F.trim("text") != "")


def read_i18n(spark: SparkSession, path: str, game: str, lang: str) -> DataFrame:
    """(game, lang, key, text) of a corpus file."""
    rows = read_i18n_json(spark, path) if path.lower().endswith(".json") else read_i18n_properties(spark, path)
    return rows.select(F.lit(game).alias("game"), F.lit(lang).alias("lang"), "key", "text")


def corpus_tokens(rows: DataFrame, *, as_glossary: bool = False) -> DataFrame:
    """(game, lang, token) of corpus strings that carry no work marks. Glossaries are split by language
    (contractions, elisions); corpus strings are not, unless ``as_glossary``."""
    mode = T.tokenizer_mode(F.col("lang")) if as_glossary else "default"
    kept = rows.where(~P.has_wip_marker(F.col("text")))
    return kept.select("game", "lang", F.explode(T.tokens(F.col("text"), mode)).alias("token")).distinct()


def read_token_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("token")).where("token <> ''")


def read_filtered_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(token) of a dictionary: the count in the first line and everything from a slash on are left out."""
    lines = files.decode(files.read_bytes(spark, path)).splitlines()[1:]
    words = [w for line in lines if (w := line.strip().split("/")[0].strip())]
    return spark.createDataFrame([(w,) for w in words], "token string")


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines; blank and broken lines are left out."""
    reader = spark.read.option("mode", "DROPMALFORMED")
    return (reader.schema(schema) if schema else reader).json(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return df.select(*[F.trim(F.coalesce(c, F.lit(""))).alias(c) for c in df.columns]).where("token <> ''")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A consolidated report from JSON lines or CSV (which has no nested evidence), in normal types."""
    from ..operators.reports import normalise_report

    df = read_jsonl(spark, path) if path.endswith(".jsonl") else spark.read.csv(path, header=True, multiLine=True, escape='"')
    return normalise_report(df.toDF(*[c.lstrip("﻿") for c in df.columns]))
