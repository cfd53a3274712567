"""Writers. Tables go through Spark's own writers; dictionaries and JSON documents are single files in an order,
whose lines executors sort and write, and whose parts are put together as bytes."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.materialise import cut, shared_path
from ..operators.reports import csv_report
from ..operators.wordforms import order_by_lower
from . import files


def _stream(spark: SparkSession, path: str, rows, encode) -> int:
    """Write rows one by one; the driver holds a partition of them at a time."""
    fs, where = files._fs(spark, path)
    out, n, buffer = fs.create(where, True), 0, bytearray()
    try:
        for row in rows:
            buffer += encode(row)
            n += 1
            if len(buffer) > 1 << 20:
                out.write(bytes(buffer))
                buffer = bytearray()
        out.write(bytes(buffer))
    finally:
        out.close()
    return n


def write_lines(spark: SparkSession, path: str, lines) -> int:
    """One file of the given lines."""
    return _stream(spark, path, lines, lambda line: f"{line}\n".encode())


def write_tokens(tokens: DataFrame, path: str) -> None:
    """One token a line in code point order, as a folder of ordered text files."""
    tokens.select("token").distinct().orderBy("token").write.mode("overwrite").text(path)


def write_token_file(tokens: DataFrame, path: str) -> int:
    rows = tokens.select("token").distinct().orderBy("token").toLocalIterator()
    return _stream(tokens.sparkSession, path, rows, lambda r: f"{r[0]}\n".encode())


def _quoted(value: Column) -> Column:
    """A text as JSON."""
    return F.btrim(F.to_json(F.array(value)), F.lit("[]"))


def _ordered_lines(lines: DataFrame, order: list, name: str) -> str:
    """The folder of part files to which executors write column ``line`` in an order."""
    folder = shared_path(lines.sparkSession, name)
    lines.orderBy(*order).select("line").write.text(folder)
    return folder


def _joined(spark: SparkSession, path: str, pieces: list[bytes | str], drop_end: int = 0) -> None:
    files.write_joined(spark, path, pieces, drop_end)
    for folder in pieces:
        if isinstance(folder, str):
            files.delete(spark, folder)


def write_sidecar(categories: DataFrame, keys: DataFrame, path: str) -> str:
    """Categories and glossary keys of tokens as one JSON document in order. A line is opened and closed by what it
    knows itself, so no category has to lie in one task."""
    spark = categories.sparkSession
    named = categories.select("category", "token_lower").where("category IS NOT NULL AND token_lower IS NOT NULL").distinct()
    bounds = named.groupBy("category").agg(F.min("token_lower").alias("first"), F.max("token_lower").alias("last"))
    opened = F.when(F.col("token_lower") == F.col("first"), F.concat(F.lit("    "), _quoted(F.col("category")), F.lit(": [\n"))).otherwise("")
    closed = F.when(F.col("token_lower") == F.col("last"), "\n    ],").otherwise(",")
    named = named.join(bounds, "category").withColumn("line", F.concat(opened, F.lit("      "), _quoted(F.col("token_lower")), closed))
    numbered = F.transform("keys", lambda k, i: F.struct(i.alias("nth"), k.alias("key")))
    keyed = keys.where("token_lower IS NOT NULL AND size(keys) > 0").groupBy("token_lower").agg(F.array_sort(F.flatten(F.collect_list(numbered))).alias("keys"))
    items = F.array_join(F.transform("keys", lambda k: F.concat(F.lit("      "), _quoted(k["key"]))), ",\n")
    keyed = keyed.withColumn("line", F.concat(F.lit("    "), _quoted(F.col("token_lower")), F.lit(": [\n"), items, F.lit("\n    ],")))
    parts = [_ordered_lines(named, ["category", "token_lower"], "by-category"), _ordered_lines(keyed, ["token_lower"], "by-token")]
    end = [b"\n" if files.part_files(spark, p) else b"" for p in parts]
    _joined(spark, path, [b'{\n  "by_category": {\n', parts[0], end[0] + b'  },\n  "by_token": {\n', parts[1], end[1] + b"  }\n}\n"], drop_end=2)
    return path


def _sidecar_lines(spark: SparkSession, path: str) -> DataFrame:
    """(block, nth, section, name, item, low, bad) of the lines of a sidecar that has an item, a list or a section to
    a line, wherever the file is split: lines before a block's first list have no section and no name yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, nth, section, name, before = None, 0, None, None, ""
        for batch in batches:
            out = []
            for line, at in zip(*(c.to_pylist() for c in batch.columns)):
                if at != block:
                    block, nth, section, name, before = at, 0, None, None, ""
                body, item, bad = line.removesuffix(","), None, False
                shuts = body in ("    ]", "  }", "}")
                # a comma, or an opened bracket, stands before what follows and only there
                if before and (before[-1] == "," if shuts else before[-1] not in ",[{"):
                    bad = True
                try:
                    if line.startswith("      "):
                        item = json.loads(body)
                        bad = bad or not isinstance(item, str)
                    elif line.startswith('    "'):
                        name, inside = next(iter(json.loads("{" + body + ("]}" if body.endswith("[") else "}")).items()))
                        bad = bad or inside != []
                    elif line in ('  "by_category": {', '  "by_token": {'):
                        section, name = line[3:-4], None
                    else:
                        bad = bad or not (shuts or line == "{")
                        before = line
                        if not bad:
                            continue
                except ValueError:
                    bad = True
                low = item.strip().lower() if isinstance(item, str) else None
                out.append((block, nth, section, name, item if isinstance(item, str) else None, low if low != item else None, bad))
                nth, before = nth + 1, line
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), (pa.int64(), pa.int64(), *[pa.string()] * 4, pa.bool_()))], names)

    names = ["block", "nth", "section", "name", "item", "low", "bad"]
    lines = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("block"))
    return lines.mapInArrow(run, "block long, nth long, section string, name string, item string, low string, bad boolean")


def _whole_sidecar(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A sidecar in any layout, taken by one task as a whole (below 2 GB)."""

    def read(content: bytes) -> tuple[list, list]:
        data = json.loads(files.decode(content))
        by_category = data.get("by_category", data) if isinstance(data, dict) else {}
        by_token = data.get("by_token", {}) if isinstance(data, dict) else {}
        pairs = [(c, str(t).strip().lower()) for c, ts in by_category.items() if isinstance(ts, list) for t in ts if str(t).strip()]
        return pairs, [(t, list(k)) for t, k in by_token.items()]

    def rows(nth: int, fields: tuple[str, str], kind: pa.DataType):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for content in batch.column(0):
                    found = read(content.as_py())[nth]
                    for at in range(0, len(found), 10_000):
                        part = found[at : at + 10_000]
                        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.string()), pa.array([r[1] for r in part], kind)], list(fields))

        return run

    raw = spark.read.format("binaryFile").load(path).select("content")
    pairs = raw.mapInArrow(rows(0, ("category", "token_lower"), pa.string()), "category string, token_lower string")
    return pairs, raw.mapInArrow(rows(1, ("token_lower", "keys"), pa.list_(pa.string())), "token_lower string, keys array<string>")


def read_sidecar(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(category, token_lower) and (token_lower, keys); the older form without keys is read too.

    A file in the layout of write_sidecar() is read by lines on all cores; any other is one value for one task."""
    head, tail = files.ends(spark, path)
    if not (head.startswith(b'{\n  "by_category": {\n') and tail.endswith(b"\n  }\n}\n")):
        return _whole_sidecar(spark, path)
    lines = cut(_sidecar_lines(spark, path), "sidecar-lines")
    if not lines.where("bad").isEmpty():
        return _whole_sidecar(spark, path)
    # where each block starts: one row for each split of the file
    state = F.max_by(F.struct("section", "name"), F.when(F.col("section").isNotNull() | F.col("name").isNotNull(), F.col("nth")))
    starts, now = [], (None, None)
    for block, last in sorted(lines.groupBy("block").agg(state).collect(), key=lambda r: r[0]):
        starts.append((block, *now))
        if last:
            now = (last[0], last[1]) if last[0] else (now[0], last[1])
    starts = spark.createDataFrame(starts, "block long, section_then string, name_then string")
    # a block's list may go on from the block before, its section too
    name = F.when(F.col("section").isNull() & F.col("name").isNull(), F.col("name_then")).otherwise(F.col("name"))
    rows = lines.join(F.broadcast(starts), "block").select("block", "nth", F.coalesce("section", "section_then").alias("section"), name.alias("name"), "item", "low")
    named = rows.where("section = 'by_category' AND item IS NOT NULL").select(F.col("name").alias("category"), F.coalesce("low", "item").alias("token_lower")).where("token_lower <> ''")
    items = F.array_sort(F.collect_list(F.when(F.col("item").isNotNull(), F.struct("block", "nth", "item"))))
    keyed = rows.where("section = 'by_token' AND name IS NOT NULL").groupBy(F.col("name").alias("token_lower")).agg(F.transform(items, lambda x: x["item"]).alias("keys"))
    return named, keyed


def write_filtered_dictionary(kept: DataFrame, path: str) -> int:
    """A count line and the kept tokens in order."""
    rows = kept.select("token").distinct()
    n = rows.count()
    lines = (r[0] for part in ([(str(n),)], rows.orderBy("token").toLocalIterator()) for r in part)
    _stream(kept.sparkSession, path, lines, lambda w: f"{w}\n".encode())
    return n


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with a header; lists joined by ' | '."""
    kinds = dict(df.dtypes)
    flat = df.select(*[F.array_join(c, " | ").alias(c) if kinds[c] == "array<string>" else F.col(c) for c in df.columns])
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_i18n(rows: DataFrame, path: str) -> None:
    """Corpus strings as JSON ({"entries": {..}}, of several texts of a key the largest) or, for paths that end so,
    properties. Both are in the order of keys."""
    spark = rows.sparkSession
    if path.endswith(".properties"):
        text = lambda c: F.coalesce(c, F.lit("None"))
        _joined(spark, path, [_ordered_lines(rows.withColumn("line", F.concat(text("key"), F.lit("="), text("text"))), ["key"], "properties")])
        return
    one = rows.groupBy(F.coalesce("key", F.lit("null")).alias("key")).agg(F.max("text").alias("text"))  # names of an object are unique
    members = _ordered_lines(one.withColumn("line", F.concat(F.lit("    "), _quoted(F.col("key")), F.lit(": "), _quoted(F.col("text")), F.lit(","))), ["key"], "entries")
    end = b"\n" if files.part_files(spark, members) else b""
    _joined(spark, path, [b'{\n  "entries": {\n', members, end + b"  }\n}\n"], drop_end=2)


def write_filtered_properties(spark: SparkSession, source: str, target: str, removed_keys: set[str]) -> int:
    """A properties file without the removed keys; comments and blank lines stay as they are."""
    lines = files.decode(files.read_bytes(spark, source)).splitlines(keepends=True)
    gone = lambda line: "=" in line and not line.lstrip().startswith("#") and line.partition("=")[0].strip() in removed_keys
    kept = [x for x in lines if not gone(x)]
    files.write_bytes(spark, target, "".join(kept).encode())
    return len(lines) - len(kept)


def write_removed(rows: DataFrame, path: str) -> None:
    """Corpus strings that the language filter removed, lowest confidence first."""
    write_csv(rows.where("is_wrong").orderBy("confidence", "key"), path)


def write_jsonl(df: DataFrame, path: str, **options) -> None:
    df.write.mode("overwrite").options(**options).json(path)


def write_wordforms(results: DataFrame, csv_path: str | None = None, jsonl_path: str | None = None) -> None:
    ordered = results.orderBy(*order_by_lower("base_word"))
    if csv_path:
        write_csv(ordered.drop("flag_evidence"), csv_path)
    if jsonl_path:
        write_jsonl(ordered, jsonl_path)


def write_flat_list(words: DataFrame, path: str) -> int:
    """A word list for word processors: UTF-16 with its mark, a word a line, case-insensitive order."""
    rows = words.select("token").distinct().orderBy(*order_by_lower("token")).toLocalIterator()
    first = True

    def encode(row) -> bytes:
        nonlocal first
        mark, first = (b"\xff\xfe" if first else b""), False
        return mark + f"{row[0]}\r\n".encode("utf-16-le")

    n = _stream(words.sparkSession, path, rows, encode)
    return n if n else _stream(words.sparkSession, path, [()], lambda _: b"\xff\xfe") - 1


def write_dictionary(words: DataFrame, path: str, flag_mode: str = "single") -> int:
    """A count line, then word/flags in case-insensitive order; columns token and assigned_flags."""
    rows = words.select("token", F.concat("token", T.join_flags(F.col("assigned_flags"), flag_mode)).alias("line"))
    n = rows.count()
    lines = (x for part in ([str(n)], (r["line"] for r in rows.orderBy(*order_by_lower("token")).toLocalIterator())) for x in part)
    _stream(words.sparkSession, path, lines, lambda w: f"{w}\n".encode())
    return n


def write_report(df: DataFrame, path: str, formats: tuple[str, ...] = ("csv", "jsonl")) -> dict[str, str]:
    """A consolidated report as JSON lines, flat CSV, or both, in folders of files that gzip compresses: names and
    lists repeat in every row."""
    out = {}
    if "jsonl" in formats:
        write_jsonl(df, out.setdefault("jsonl", f"{path}.jsonl"), compression="gzip")
    if "csv" in formats:
        csv_report(df).write.mode("overwrite").option("compression", "gzip").option("header", True).option("escape", '"').csv(out.setdefault("csv", f"{path}.csv"))
    return out


def write_bundle(spark: SparkSession, folder: str, name: str, dic: str, aff: str, reference: str | None = None) -> int:
    """A full dictionary: the reference's files where they are not there yet, and the generated pair."""
    copied = files.copy_missing(spark, reference, folder) if reference else 0
    for path, end in ((dic, "dic"), (aff, "aff")):
        files.write_bytes(spark, f"{folder}/{name}.{end}", files.read_bytes(spark, path))
    return copied


def remove_stale(spark: SparkSession, folder: str, pattern: str, keep: str | None = None) -> list[str]:
    """Delete what matches by name in a folder, except what matches ``keep``."""
    import re

    gone = [n for n, _ in files.names_in(spark, folder) if re.search(pattern, n) and not (keep and re.search(keep, n))]
    for name in gone:
        files.delete(spark, f"{folder}/{name}")
    return gone


def flat_list_probe(raw: bytes) -> dict:
    """Mark, line ends and number of words of a flat list."""
    text = files.decode(raw)
    return {"utf16_mark": raw[:2] == b"\xff\xfe", "crlf": "\r\n" in text and "\n" not in text.replace("\r\n", ""), "words": len(text.split())}
