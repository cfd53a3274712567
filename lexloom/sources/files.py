"""File types, small files as bytes or text through Spark, and discovery by name."""

from __future__ import annotations

import re
from pathlib import PurePosixPath

from pyspark.sql import SparkSession

from ..functions import constants as C

_KINDS = {".xlsx": "excel", ".xls": "excel", ".csv": "csv", ".tsv": "tsv", ".txt": "tsv", ".xliff": "xliff", ".xlf": "xliff", ".xml": "xliff"}


def file_type(path: str) -> str:
    """excel, csv, tsv or xliff by the file's ending, in any case."""
    found = _KINDS.get(PurePosixPath(path).suffix.lower())
    if not found:
        raise ValueError(f"Unsupported file type for: {path}")
    return found


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    if not path:
        return False
    fs, where = _fs(spark, path)
    return bool(fs.exists(where))


def names_in(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of what lies in a folder; nothing if it is not there."""
    fs, where = _fs(spark, folder)
    if not fs.exists(where):
        return []
    return sorted((s.getPath().getName(), bool(s.isDirectory())) for s in fs.listStatus(where))


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file (affix files, dictionaries' heads) from any store."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def decode(raw: bytes) -> str:
    """Text of UTF-16 with a mark, of UTF-8 with or without one, else of Latin-1."""
    if raw[:2] == b"\xff\xfe":
        try:
            return raw[2:].decode("utf-16-le")
        except UnicodeDecodeError:
            pass
    for encoding in ("utf-8-sig", "latin-1"):
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    raise AssertionError("latin-1 decodes everything")


def write_bytes(spark: SparkSession, path: str, raw: bytes) -> str:
    """Write one small file to any store."""
    fs, where = _fs(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(raw))
    finally:
        out.close()
    return path


def write_joined(spark: SparkSession, path: str, pieces: list[bytes | str], drop_end: int = 0) -> str:
    """One file of texts (bytes) and of the part files of folders (paths) in their order. The driver's JVM copies
    streams through one small buffer and sees no rows. ``drop_end`` bytes go from the end of each folder."""
    fs, where = _fs(spark, path)
    copy = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.copyLarge
    out = fs.create(where, True)
    try:
        for piece in pieces:
            if isinstance(piece, bytes):
                out.write(bytearray(piece))
                continue
            parts = part_files(spark, piece)
            for i, (part, size) in enumerate(parts):
                source = fs.open(part)
                try:
                    copy(source, out, 0, size - (drop_end if i + 1 == len(parts) else 0))
                finally:
                    source.close()
    finally:
        out.close()
    return path


def part_files(spark: SparkSession, folder: str) -> list[tuple]:
    """(path, bytes) of the part files of a folder that hold something, in the order in which they were numbered."""
    fs, where = _fs(spark, folder)
    found = [(s.getPath(), s.getLen()) for s in fs.listStatus(where) if s.getPath().getName().startswith("part-") and s.getLen()]
    return sorted(found, key=lambda x: (len(x[0].getName()), x[0].getName()))


def ends(spark: SparkSession, path: str, n: int = 64) -> tuple[bytes, bytes]:
    """The first and the last bytes of a file; nothing where the path is no single file."""
    fs, where = _fs(spark, path)
    if not fs.exists(where) or not (status := fs.getFileStatus(where)).isFile():
        return b"", b""
    source, size = fs.open(where), status.getLen()
    try:
        head = bytes(source.readNBytes(n))
        source.seek(max(0, size - n))
        return head, bytes(source.readNBytes(n))
    finally:
        source.close()


def delete(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return bool(fs.delete(where, True))


def copy_missing(spark: SparkSession, source: str, target: str) -> int:
    """Copy a folder's files into another where they are not there yet; how many were copied."""
    n = 0
    for name, folder in names_in(spark, source):
        if folder:
            n += copy_missing(spark, f"{source}/{name}", f"{target}/{name}")
        elif not exists(spark, f"{target}/{name}"):
            write_bytes(spark, f"{target}/{name}", read_bytes(spark, f"{source}/{name}"))
            n += 1
    return n


def language_prefix(code: str) -> str:
    short = (code or "").lower().replace("-", "").replace("_", "")[:2]
    if len(short) < 2:
        raise ValueError(f"Invalid language code: {code!r}")
    return short


def parse_pair(name: str, langs: set[str], games: set[str]) -> tuple[str, str] | None:
    """(lang, game) of a name like es_GAME or GAME_es, where a game's own name may have underscores."""
    stem = name.rsplit(".", 1)[0] if "." in name else name
    parts = [p for p in stem.strip().split("_") if p]
    if len(parts) < 2:
        return None
    for code, rest in ((parts[0], parts[1:]), (parts[-1], parts[:-1])):
        game = "_".join(rest).upper()
        if len(code.replace("-", "")) >= 2 and language_prefix(code) in langs and game in games:
            return language_prefix(code), game
    return None


def discover_exports(spark: SparkSession, root: str, langs: set[str], games: set[str]) -> dict:
    """(lang, game) pairs with a dictionary under root: bundles in Compressed_dics, lists in Flatlists."""
    games = {g.upper() for g in games}
    bundles = set()
    for name, folder in names_in(spark, f"{root}/Compressed_dics"):
        pair = parse_pair(name, langs, games) if folder else None
        if pair:
            lang, game = pair
            inside = {n for n, _ in names_in(spark, f"{root}/Compressed_dics/{name}")}
            if inside & {f"{lang}_{game}.dic", f"{game}_{lang}.dic"}:
                bundles.add(pair)
    lists = {p for name, folder in names_in(spark, f"{root}/Flatlists") if not folder and name.lower().endswith(".dic") and (p := parse_pair(name, langs, games))}
    pairs = sorted(bundles | lists)
    return {"pairs": pairs, "languages": sorted({p[0] for p in pairs}), "games": sorted({p[1] for p in pairs}), "from_compressed": sorted(bundles), "from_flatlists": sorted(lists)}


def resolve_export(spark: SparkSession, root: str, lang: str, game: str) -> dict[str, str | None]:
    """The first dictionary, affix file and flat list of a pair that exist, in either orientation of names."""
    names = (f"{lang}_{game}", f"{game}_{lang}")
    first = lambda paths: next((p for p in paths if exists(spark, p)), None)
    inside = lambda end: [f"{root}/Compressed_dics/{d}/{n}{end}" for d in names for n in names]
    return {"dic": first(inside(".dic")), "aff": first(inside(".aff")), "flat": first([f"{root}/Flatlists/{n}{end}" for n in names for end in (".DIC", ".dic")])}


def discover_reports(spark: SparkSession, folder: str) -> dict[tuple[str, str], str]:
    """(game, lang) to its consolidated report, JSON lines before CSV."""
    found: dict[tuple[str, str], str] = {}
    for name, _ in names_in(spark, folder):
        m = re.fullmatch(r"(.+)_([a-z]{2})_token_provenance_report\.(jsonl|csv)", name)
        if m and (m[3] == "jsonl" or (m[1], m[2]) not in found):
            found[m[1], m[2]] = f"{folder}/{name}"
    return found


def find_dictionary(spark: SparkSession, lang: str, configured: dict[str, str], folder: str = "dics", fallbacks: dict[str, list[str]] | None = None) -> dict:
    """The first place with both a .dic and an .aff for a language: the configured path, the same file in
    ``folder``, then the fallbacks; with what was looked at."""
    lang = language_prefix(lang)
    places = []
    if path := configured.get(lang):
        places += [path, f"{folder}/{PurePosixPath(path).name}", f"{folder}/{PurePosixPath(path).parent.name}/{PurePosixPath(path).name}"]
    places += [f"{folder}/{p}" for p in (fallbacks or {}).get(lang, [f"{lang}/{lang}.dic", f"{lang}.dic"])]
    checks = []
    for path in dict.fromkeys(re.sub(r"(?<!:)/+", "/", p) for p in places):
        aff = path.rsplit(".", 1)[0] + ".aff"
        there = exists(spark, path), exists(spark, aff)
        checks.append({"dic": path, "aff": aff, "dic_exists": there[0], "aff_exists": there[1]})
        if all(there):
            return {"lang": lang, "ok": True, "dic": path, "aff": aff, "checks": checks}
    return {"lang": lang, "ok": False, "dic": None, "aff": None, "checks": checks}


def token_files(spark: SparkSession, folder: str, lang: str) -> list[str]:
    """Token lists of a language in a folder."""
    return [f"{folder}/{n}" for n, d in names_in(spark, folder) if not d and re.search(rf"{lang}.*tokens.*\.txt$", n)]


def key_column(columns: list[str]) -> str | None:
    """The column of keys: one of the usual names, else the first that is no language column."""
    clean = {c: c.strip().lstrip("﻿").lower() for c in columns}
    named = next((c for c in columns if clean[c] in C.KEY_COLUMNS), None)
    return named or next((c for c in columns if not is_language_column(c)), None)


def is_language_column(column: str) -> bool:
    return bool(re.match(C.LANGUAGE_COLUMN, column.strip().lstrip("﻿"), re.IGNORECASE))


def term_column(columns: list[str], lang: str, fallback: bool = True) -> str:
    """The column of terms of a language; with ``fallback`` else the last language column."""
    short = language_prefix(lang)
    wanted = {lang.lower(), lang.replace("-", "_").lower(), *C.TERM_COLUMNS}
    low = {c: c.lower().lstrip("﻿") for c in columns}
    for c in columns:
        if low[c] in wanted or low[c] == short or low[c].startswith((f"{short}-", f"{short}_")):
            return c
    rest = [c for c in columns if is_language_column(c) and "(info)" not in c.lower()]
    if rest and fallback:
        return rest[-1]
    raise ValueError(f"no term column for {lang!r} among {columns}")
