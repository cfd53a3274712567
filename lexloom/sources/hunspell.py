"""Hunspell files: affix rules and directives, raw blocks, entries, and the custom files made from them.

Affix files have at most thousands of lines, so they are parsed on the driver and become small tables.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as T
from ..operators.affix import RULES
from . import files

FLAG_DIRECTIVES = ("NEEDAFFIX", "CIRCUMFIX", "ONLYINCOMPOUND", "FORBIDDENWORD", "KEEPCASE", "COMPOUNDBEGIN", "COMPOUNDMIDDLE", "COMPOUNDEND", "COMPOUNDFLAG", "COMPOUNDPERMITFLAG")


@dataclass
class Affixes:
    """Rules and directives of one affix file."""

    rules: list[dict] = field(default_factory=list)
    meta: dict = field(default_factory=lambda: {"flag_mode": "single", "encoding": "utf-8", "CHECKSHARPS": False, "COMPOUNDMIN": 3, "COMPOUNDRULE": []})
    flags: set[str] = field(default_factory=set)

    def table(self, spark: SparkSession, lang: str | None = None) -> DataFrame:
        names = [x.split()[0] for x in RULES.split(", ")]
        df = spark.createDataFrame([tuple(r[n] for n in names) for r in self.rules], RULES)
        return df.withColumn("lang", F.lit(lang)) if lang else df

    def skip_flags(self) -> list[str]:
        """Flags that mark words and are no affixes."""
        return [f for k in ("NEEDAFFIX", "CIRCUMFIX", "ONLYINCOMPOUND", "FORBIDDENWORD") if (f := self.meta.get(k))]


def flag_list(flags: str, mode: str) -> list[str]:
    if mode == "long":
        return [flags[i : i + 2] for i in range(0, len(flags) - 1, 2)]
    if mode == "num":
        return [f.strip() for f in flags.split(",") if f.strip()]
    return list(flags)


def declared_encoding(raw: bytes) -> str:
    for line in raw.decode("latin-1").splitlines():
        parts = line.split(None, 1)
        if len(parts) == 2 and parts[0].upper() == "SET":
            name = parts[1].strip().upper()
            return C.ENCODINGS.get(name, name.lower())
    return "utf-8"


def parse_affixes(raw: bytes) -> Affixes:
    """Rules and directives. A line of exactly four fields with Y or N and a number opens the rules of a flag;
    further lines of that flag are its rules."""
    out = Affixes()
    out.meta["encoding"] = declared_encoding(raw)
    opened: dict[tuple[str, str], bool] = {}
    current = None
    for line in raw.decode(out.meta["encoding"]).splitlines():
        parts = line.lstrip("﻿").split()
        if not parts or parts[0].startswith("#"):
            continue
        word = parts[0].upper()
        if word == "CHECKSHARPS":
            out.meta[word] = True
        elif len(parts) < 2:
            continue
        elif word == "FLAG":
            out.meta["flag_mode"] = {"long": "long", "num": "num", "utf-8": "utf8", "utf8": "utf8"}.get(parts[1].lower(), out.meta["flag_mode"])
        elif word in FLAG_DIRECTIVES:
            out.meta[word] = parts[1]
        elif word == "COMPOUNDMIN":
            out.meta[word] = int(parts[1]) if re.fullmatch(r"-?\d+", parts[1]) else out.meta[word]
        elif word == "COMPOUNDRULE":
            out.meta[word] += [] if parts[1].isdigit() else [parts[1]]
        elif word in ("PFX", "SFX") and len(parts) >= 4:
            key = (word, parts[1])
            if len(parts) == 4 and parts[2].upper() in "YN" and len(parts[2]) == 1 and parts[3].isdigit():
                opened.setdefault(key, parts[2].upper() == "Y")
                current = key
            elif key == current:
                add, _, more = ("" if parts[3] == "0" else parts[3]).partition("/")
                condition = parts[4] if len(parts) > 4 else "."
                out.rules.append({
                    "kind": word, "flag": parts[1], "cross_product": opened[key], "rule_no": len(out.rules),
                    "strip": "" if parts[2] == "0" else parts[2], "add": add, "add_flags": flag_list(more, out.meta["flag_mode"]), "condition": _valid(condition),
                })
    out.flags = {f for _, f in opened}
    return out


def _valid(condition: str) -> str:
    """A condition that is no pattern matches everything."""
    try:
        re.compile(f"(?:{condition})")
    except re.error:
        return "."
    return condition


def read_affixes(spark: SparkSession, path: str) -> Affixes:
    return parse_affixes(files.read_bytes(spark, path))


def raw_blocks(raw: bytes) -> dict:
    """Header lines, and the lines of each suffix and prefix flag in their order."""
    encoding = declared_encoding(raw)
    out = {"header": [], "SFX": {}, "PFX": {}, "encoding": encoding}
    for line in raw.decode(encoding, "replace").splitlines():
        parts = line.split()
        if len(parts) >= 2 and parts[0] in ("SFX", "PFX"):
            out[parts[0]].setdefault(parts[1], []).append(line)
        else:
            out["header"].append(line)
    return out


def normalise_header(lines: list[str]) -> list[str]:
    """A header whose WORDCHARS and TRY allow what the dictionaries need; what is there stays in order."""
    need = {"WORDCHARS": C.REQUIRED_WORDCHARS, "TRY": C.REQUIRED_TRY}
    out, seen = [], set()
    for line in lines:
        head, _, rest = line.strip().partition(" ")
        if head.upper() in need:
            name, have = head.upper(), rest.strip()
            seen.add(name)
            out.append(f"{name} {have + ''.join(c for c in need[name] if c not in have)}")
        else:
            out.append(line)
    return out + [f"{name} {chars}" for name, chars in need.items() if name not in seen]


def patch_header(lines: list[str]) -> tuple[list[str], list[dict]]:
    """A header in which TRY and WORDCHARS stand once, after SET and FLAG, and a table of what changed."""
    need = {"WORDCHARS": C.REQUIRED_WORDCHARS, "TRY": C.REQUIRED_TRY}
    have: dict[str, str] = {}
    rest = []
    for line in lines:
        head, _, chars = line.strip().partition(" ")
        if head.upper() in need:
            have[head.upper()] = "".join(dict.fromkeys(have.get(head.upper(), "") + chars.strip()))
        else:
            rest.append(line)
    made = {name: have.get(name, "") + "".join(c for c in chars if c not in have.get(name, "")) for name, chars in need.items()}
    at = max([i + 1 for i, line in enumerate(rest) if line.strip().split(" ")[0].upper() in ("SET", "FLAG")], default=0)
    changes = [{"directive": n, "before": have.get(n, ""), "after": made[n], "changed": have.get(n, "") != made[n]} for n in need]
    return rest[:at] + [f"{n} {c}" for n, c in made.items()] + rest[at:], changes


def custom_affixes(blocks: dict, used: set[str]) -> str:
    """The header made fit, and only the blocks of flags in use: suffixes, then prefixes."""
    lines = normalise_header(blocks["header"])
    for kind in ("SFX", "PFX"):
        for flag, block in blocks[kind].items():
            lines += block if flag in used else []
    return "\n".join(lines) + "\n"


def read_entries(spark: SparkSession, path: str, affixes: Affixes) -> DataFrame:
    """(word, base_lower, flags) of a base dictionary: the count line, morphological fields, trailing dots and
    forbidden words are left out."""
    encoding = {"utf-8": "UTF-8", "latin-1": "ISO-8859-1"}.get(affixes.meta["encoding"], affixes.meta["encoding"])
    if encoding == "UTF-8":
        lines = spark.read.text(path)
    else:  # the text source reads UTF-8 only
        lines = spark.read.csv(path, sep="\x01", encoding=encoding, quote="", schema="value string")
    return entries_of(lines, affixes)


def entries_of(lines: DataFrame, affixes: Affixes) -> DataFrame:
    value = F.trim(F.regexp_replace("value", "^﻿|\r$", ""))
    rows = lines.select(value.alias("line")).where((F.col("line") != "") & ~F.col("line").rlike(r"^\d+$"))
    head = F.get(F.split("line", "\t"), F.lit(0))
    parts = F.split(head, "/", 2)
    word = T.strip_dots(F.trim(parts[0]))
    flags = T.split_flags(F.get(F.split(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s"), F.lit(0)), affixes.meta["flag_mode"])
    rows = rows.select(word.alias("word"), F.lower(word).alias("base_lower"), flags.alias("flags")).where("word <> ''")
    forbidden = affixes.meta.get("FORBIDDENWORD")
    return rows.where(~F.array_contains("flags", forbidden)) if forbidden else rows


def read_head_words(spark: SparkSession, path: str) -> DataFrame:
    """(form): lower-case head words of a dictionary."""
    lines = files.decode(files.read_bytes(spark, path)).splitlines()[1:]
    words = {w.lower() for line in lines if (w := line.split("/")[0].split("\t")[0].strip())}
    return spark.createDataFrame([(w,) for w in sorted(words)], "form string")


def parse_export(raw: bytes, flag_mode: str = "single") -> list[tuple[str, list[str]]]:
    """(word, flags) of an exported dictionary or flat list, with or without a count line."""
    lines = [x.strip() for x in files.decode(raw).splitlines() if x.strip()]
    out = []
    for line in lines[1:] if lines and lines[0].isdigit() else lines:
        word, _, tail = line.partition("/")
        if word.strip():
            mode = "num" if "," in tail else flag_mode
            out.append((word.strip(), sorted(set(flag_list(tail.strip(), mode)))))
    return out


def read_export(spark: SparkSession, path: str, flag_mode: str = "single") -> DataFrame:
    return spark.createDataFrame(parse_export(files.read_bytes(spark, path), flag_mode), "word string, flags array<string>")
