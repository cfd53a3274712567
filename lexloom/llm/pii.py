"""Surrogates for personal data and secrets: keyed, type-consistent and format-preserving.

Detection finds e-mail addresses, telephone numbers, payment cards (by check digit), IPv4 addresses,
social security numbers, IBANs, access keys, passwords and tokens, and names of people (after a title
or a known first name).

A value's surrogate comes from a keyed permutation of all values of its own format: letters stay
letters of their case and script, digits stay digits, vowels of surnames stay vowels, punctuation and
country code stay, check digits are valid and public addresses stay public. A permutation gives
distinct values distinct surrogates. First names are drawn by key from names of the same gender and
script. A value gets one surrogate wherever it occurs, however it is written (case of e-mail
addresses, punctuation of numbers), so mentions of one person stay together.

Collision checks run over the table of all distinct values: a surrogate that two values share, that is
a value of the corpus, or that is its own value is drawn again with the next attempt number, until
none is left; where a format has too few values, as a name of one letter, the surrogate grows. Attempts other than the first are few; up to ``broadcast_rows`` of them are broadcast,
more are joined to the documents that need them.

Defined results: a null text stays null with no entities; an empty text stays empty; rows that share
an id are handled each; a null id is handled like any other; an empty table gives an empty table;
further columns are carried along, one named ``pii`` as ``input_pii``.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Carried, cut

#: first names by gender and script, for detection and as surrogates
FIRST = {
    "m:latin": "James John Robert Michael William David Richard Thomas Charles Daniel Matthew Anthony Pierre Hans Carlos Miguel Stefan Antoine".split(),
    "f:latin": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Sophie Greta Carmen Lucia Monika Claire".split(),
    "m:cyrillic": "Иван Дмитрий Сергей Алексей Николай Михаил Андрей Павел Олег Борис".split(),
    "f:cyrillic": "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Людмила Вера".split(),
}
TITLES = {
    "m": ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа"),
    "u": ("Dr", "Prof"),
}
GENDERED_ENDINGS = ("овна", "евна", "ович", "евич", "ова", "ева", "ина", "ская", "ский", "ов", "ев", "ин")
ALPHABETS = ("aeiouy", "bcdfghjklmnpqrstvwxz", "AEIOUY", "BCDFGHJKLMNPQRSTVWXZ", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ", "0123456789")
_GENDER = {name: key for key, names in FIRST.items() for name in names}
_TITLE = {t: g for g, ts in TITLES.items() for t in ts}

# begins only where a run of name characters does and never steps back, so long runs cost their length
_EMAIL = re.compile(r"(?<![A-Za-z0-9_%+-])(?<![A-Za-z0-9_%+-]\.)[A-Za-z0-9_%+-]++(?:\.[A-Za-z0-9_%+-]++)*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)")
_CARD = re.compile(r"(?<![\w.])\d(?:[ -]?\d){12,18}(?!\w)")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_PHONE = re.compile(r"(?<![\w.])(?:\+\d(?:[ .-]?\(\d{1,4}\)|[ .-]?\d){6,14}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)")
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_KEY = re.compile(r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\b(?:ghp_|sk-|xox[bp]-)[A-Za-z0-9-]{16,}")
_SECRET = re.compile(r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s*[=:]\s*[\"']?([A-Za-z0-9_+/.=-]{6,})[\"']?")
_NAME = re.compile(
    r"\b(?:(" + "|".join(sorted(_TITLE, key=len, reverse=True)) + r")\.?[ ](?=[^\W\d_a-zа-я])|(?=(?:" + "|".join(_GENDER) + r")[ ][^\W\d_a-zа-я]))"
    r"([^\W\d_]+(?:-[^\W\d_]+)*)(?:[ ]([^\W\d_a-zа-я][^\W\d_]+(?:[-'’][^\W\d_]+)*))?"
)


#: calling codes of one and two digits; all others have three
CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()


def code_length(digits: str) -> int:
    """How many of an international number's digits are its country's."""
    return next((n for n in (1, 2) if digits[:n] in CODES), 3)


@dataclass(frozen=True)
class Entity:
    start: int
    end: int
    kind: str
    value: str  # normalised: mentions with equal values are one entity


def luhn(digits: str) -> int:
    """0 for a valid number, else what its check digit is off."""
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _script(word: str) -> str:
    return "cyrillic" if re.search("[а-яё]", word.lower()) else "latin"


def find_entities(text: str) -> list[Entity]:
    """The entities of a text in order, without overlaps; kinds that come first win."""
    found: list[Entity] = []
    if "@" in text:
        found += [Entity(m.start(), m.end(), "email", m[0].lower()) for m in _EMAIL.finditer(text)]
    if re.search(r"\d", text):
        found += [Entity(*m.span(1), "secret", m[1]) for m in _SECRET.finditer(text) if re.search(r"\d", m[1])]
        found += [Entity(m.start(), m.end(), "key", m[0]) for m in _KEY.finditer(text)]
        found += [Entity(m.start(), m.end(), "iban", m[0].replace(" ", "")) for m in _IBAN.finditer(text)]
        found += [Entity(m.start(), m.end(), "ip", m[0]) for m in _IP.finditer(text)]
        found += [Entity(m.start(), m.end(), "card", _digits(m[0])) for m in _CARD.finditer(text) if luhn(_digits(m[0])) == 0]
        found += [Entity(m.start(), m.end(), "ssn", _digits(m[0])) for m in _SSN.finditer(text)]
        found += [Entity(m.start(), m.end(), "phone", ("+" if m[0][0] == "+" else "") + _digits(m[0])) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    for m in _NAME.finditer(text):
        title, one, two = m.groups()
        if not title and two is None:
            continue
        gender = _GENDER.get(one, "").split(":")[0] or _TITLE.get(title, "u")
        first, last = (2, 3) if two is not None else (None, 2)
        if first:
            found.append(Entity(*m.span(first), f"first:{'m' if gender == 'u' else gender}:{_script(one)}", one))
        found.append(Entity(*m.span(last), f"last:{_script(m[last])}", m[last]))
    out: list[Entity] = []  # by start, without overlaps
    for e in found:
        at = bisect_left(out, e.start, key=lambda x: x.start)
        if (at == 0 or out[at - 1].end <= e.start) and (at == len(out) or out[at].start >= e.end):
            out.insert(at, e)
    return out


class Permutation:
    """Keyed permutations of the numbers below n: a Feistel network, walked until it lands below n."""

    def __init__(self, key: bytes, tweak: str):
        self.key, self.tweak = key, tweak.encode()

    def _round(self, i: int, right: int, bits: int) -> int:
        out = b""
        while 8 * len(out) < bits:
            out += hmac.new(self.key, b"%b|%d|%d|%d" % (self.tweak, i, len(out), right), hashlib.sha256).digest()
        return int.from_bytes(out, "big") & ((1 << bits) - 1)

    def __call__(self, x: int, n: int, fits=lambda x: True) -> int:
        """``x`` permuted among the numbers below ``n`` that fit (``x`` is one of them)."""
        if n <= 1:
            return x
        half = max(1, -(-(n - 1).bit_length() // 2))
        while True:
            left, right = x >> half, x & ((1 << half) - 1)
            for i in range(8):
                left, right = right, left ^ self._round(i, right, half)
            x = left << half | right
            if x < n and fits(x):
                return x


def _alphabet(ch: str, letters: tuple[str, ...]) -> str:
    return next((a for a in letters if ch in a), None) or _block(ch)


@lru_cache(maxsize=4096)
def _block(ch: str) -> str:
    """Letters of any other script: those of the same 128 code points that are as ``ch`` capital, small or neither."""
    kind = unicodedata.category(ch)
    if kind not in ("Lu", "Ll", "Lo"):
        return ch
    first = ord(ch) // 128 * 128
    return "".join(c for c in map(chr, range(max(first, 128), first + 128)) if unicodedata.category(c) == kind) or ch


_PLAIN = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")


def _permute_text(p: Permutation, text: str, letters: tuple[str, ...]) -> str:
    """Each character replaced by one of its own alphabet; others stay."""
    sets = [_alphabet(ch, letters) for ch in text]
    x, n = 0, 1
    for ch, a in zip(text, sets):
        x, n = x * len(a) + a.index(ch), n * len(a)
    x, out = p(x, n), []
    for a in reversed(sets):
        x, k = divmod(x, len(a))
        out.append(a[k])
    return "".join(reversed(out))


#: after so many attempts a surrogate grows by a letter, as its format has too few values
PATIENCE = 8


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The surrogate of a normalised value, itself normalised. Formats of fixed length have room enough; the
    others grow after many collisions."""
    out = _surrogate(key, kind, value, attempt)
    if attempt < PATIENCE or kind in ("card", "ip", "phone", "ssn", "iban"):
        return out
    draw = hmac.new(key, f"more|{kind}|{value}|{attempt}".encode(), hashlib.sha256).digest()
    letters = _alphabet(next((c for c in reversed(value) if c.islower()), "a"), ALPHABETS if kind.startswith(("first", "last")) else _PLAIN)
    more = "".join(letters[b % len(letters)] for b in draw[: attempt // PATIENCE])
    return more + out if kind == "email" else out + more


def _surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    p = Permutation(key, f"{kind}|{attempt}|{len(value)}")
    if kind == "email":
        name, _, domain = value.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{_permute_text(p, name, _PLAIN)}@{_permute_text(p, host, _PLAIN)}.{top}"
    if kind == "card":
        body = value[0] + str(p(int(value[1:-1]), 10 ** (len(value) - 2))).zfill(len(value) - 2)
        return body + str((10 - luhn(body + "0")) % 10)
    if kind == "ip":
        public = lambda x: 0 < x >> 24 < 224 and x >> 24 not in (10, 127)
        x = sum(int(b) << 8 * (3 - i) for i, b in enumerate(value.split(".")))
        x = p(x, 1 << 32, public if public(x) else lambda y: not public(y))
        return ".".join(str(x >> 8 * (3 - i) & 255) for i in range(4))
    if kind == "phone":
        keep = 1 + code_length(value[1:]) if value[0] == "+" else 0
        rest, trunk = value[keep:], value[keep] in "01"
        fits = lambda x: (str(x).zfill(len(rest))[0] in "01") == trunk
        return value[:keep] + str(p(int(rest), 10 ** len(rest), fits)).zfill(len(rest))
    if kind == "key":
        head = re.match(r"AKIA|ASIA|ghp_|sk-|xox[bp]-", value)[0]
        return head + _permute_text(p, value[len(head) :], _PLAIN)
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+", value):
        return "%0*x" % (len(value), p(int(value, 16), 16 ** len(value)))
    if kind == "iban":
        body = _permute_text(p, value[4:], _PLAIN)
        return value[:2] + str(98 - int("".join(str(int(c, 36)) for c in body + value[:2] + "00")) % 97).zfill(2) + body
    if kind.startswith("first:"):
        names = FIRST[kind.removeprefix("first:")]
        draw = hmac.new(key, f"{kind}|{value}|{attempt}".encode(), hashlib.sha256).digest()
        return "-".join(names[draw[i] % len(names)] for i in range(1 + attempt // 4))
    if kind.startswith("last:"):
        end = next((e for e in GENDERED_ENDINGS if value.endswith(e)), "")
        return _permute_text(p, value[: len(value) - len(end)], ALPHABETS) + end
    return _permute_text(p, value, _PLAIN)


def render(mention: str, kind: str, new: str) -> str:
    """The normalised surrogate ``new`` in the format of a mention."""
    if kind == "email":
        return "".join(n.upper() if o.isupper() else n for o, n in zip(mention.ljust(len(new)), new))
    if kind in ("card", "ssn", "phone", "iban"):
        fresh = iter(new.removeprefix("+"))
        return "".join(next(fresh) if ch.isalnum() else ch for ch in mention)
    return new


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = sorted({(e.kind, e.value) for t in batch.column(0) for e in find_entities(t.as_py() or "")})
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.string()) for k in (0, 1)], ["kind", "value"])


def _drawn(key: bytes):
    @F.arrow_udf("string")
    def run(kinds: pa.Array, values: pa.Array, attempts: pa.Array) -> pa.Array:
        return pa.array([surrogate(key, k.as_py(), v.as_py(), a.as_py()) for k, v, a in zip(kinds, values, attempts)], pa.string())

    return run


def assign(values: DataFrame, key: bytes, *, most_rounds: int = 40) -> DataFrame:
    """(kind, value, attempt, surrogate) for distinct values, free of collisions."""
    drawn = cut(values.distinct().withColumn("attempt", F.lit(0)).withColumn("surrogate", _drawn(key)("kind", "value", "attempt")), "surrogates")
    for _ in range(most_rounds):
        real = drawn.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
        among = Window.partitionBy("kind", "surrogate").orderBy("attempt", "value")
        checked = drawn.withColumn("nth", F.row_number().over(among)).join(real, ["kind", "surrogate"], "left")
        # of names there are too few to keep clear of those in the corpus
        clash = (F.col("nth") > 1) | (F.col("surrogate") == F.col("value")) | (F.col("real").isNotNull() & ~F.col("kind").startswith("first:"))
        checked = cut(checked.select("kind", "value", "attempt", "surrogate", clash.alias("clash")), "surrogates")
        if checked.where("clash").isEmpty():
            return checked.drop("clash")
        again = F.when(F.col("clash"), F.col("attempt") + 1).otherwise(F.col("attempt"))
        drawn = cut(checked.select("kind", "value", again.alias("attempt")).withColumn("surrogate", _drawn(key)("kind", "value", "attempt")), "surrogates")
    raise RuntimeError(f"surrogates still collide after {most_rounds} rounds")


_OUT = "struct<text string, n_entities int, entities array<struct<kind: string, start: int, end: int, surrogate: string>>>"


def _replaced(key: bytes, attempts):
    """Texts with surrogates; attempts other than 0 come from a broadcast dict or with the row."""

    @F.arrow_udf(_OUT)
    def run(texts: pa.Array, own: pa.Array) -> pa.Array:
        shared, out = attempts.value, []
        draw = lru_cache(maxsize=50_000)(surrogate)
        for text, mine in zip(texts, own):
            text = text.as_py()
            found = find_entities(text) if text else []
            if not found:
                out.append({"text": text, "n_entities": 0, "entities": []})
                continue
            local = {(x["kind"], x["value"]): x["attempt"] for x in mine.as_py() or ()}
            parts, at, listed = [], 0, []
            for e in found:
                nth = local.get((e.kind, e.value), shared.get((e.kind, e.value), 0))
                new = render(text[e.start : e.end], e.kind, draw(key, e.kind, e.value, nth))
                parts += [text[at : e.start], new]
                at = e.end
                listed.append({"kind": e.kind, "start": e.start, "end": e.end, "surrogate": new})
            out.append({"text": "".join([*parts, text[at:]]), "n_entities": len(listed), "entities": listed})
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("surrogate", pa.string())])
        return pa.array(out, pa.struct([("text", pa.string()), ("n_entities", pa.int32()), ("entities", pa.list_(kind))]))

    return run


def _values_by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(h, e.kind, e.value) for h, t in zip(batch.column(0).to_pylist(), batch.column(1)) for e in find_entities(t.as_py() or "")]
        kinds = (pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(3)], ["ll_hash", "kind", "value"])


def replace_pii(docs: DataFrame, text_col: str = "text", *, key: bytes, broadcast_rows: int = 100_000) -> DataFrame:
    """``docs`` with ``text_col`` replaced and a struct column ``pii``: text, n_entities, and the entities
    with kind, start and end in the old text, and surrogate (never the old value)."""
    spark, carried = docs.sparkSession, Carried(docs, "pii")
    text = carried.name(text_col)
    assigned = assign(docs.select(text_col).mapInArrow(_values, "kind string, value string"), key)
    later = assigned.where("attempt > 0").select("kind", "value", "attempt")
    n, none = later.count(), F.lit(None).cast("array<struct<kind: string, value: string, attempt: int>>")
    if n <= broadcast_rows:
        shared = spark.sparkContext.broadcast({(r["kind"], r["value"]): r["attempt"] for r in later.collect()})
        rows = carried.df.withColumn("ll_own", none)
    else:
        shared = spark.sparkContext.broadcast({})
        hashed = carried.df.withColumn("ll_hash", F.xxhash64(text))
        mine = hashed.select("ll_hash", text).mapInArrow(_values_by_row, "ll_hash long, kind string, value string").distinct()
        mine = mine.join(later, ["kind", "value"]).groupBy("ll_hash").agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("ll_own"))
        rows = hashed.join(mine, "ll_hash", "left")
    rows = rows.withColumn("pii", _replaced(key, shared)(F.col(text), F.col("ll_own")))
    return rows.select(*carried.back(**{text_col: F.col("pii.text")}), "pii")
