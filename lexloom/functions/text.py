"""Normalisation of strings as column expressions. All run inside the JVM unless the docstring says
otherwise; ``(?U)`` makes Java's classes follow Unicode."""

from __future__ import annotations

import html
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C

#: named entities that are decoded without Python; every numeric one needs ``decode_entities(full=True)``
COMMON_ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "#39": "'", "#x27": "'", "nbsp": " ", "hellip": "…", "ndash": "–", "mdash": "—", "laquo": "«", "raquo": "»", "amp": "&"}


def replace_matches(text: Column, pattern: str, new: Callable[[Column], Column]) -> Column:
    """``text`` with each match of ``pattern`` replaced by ``new`` of the match."""
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)) if "(" not in pattern.replace("(?:", "").replace("(?=", "").replace("(?U)", "").replace("(?iU)", "") else F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    made = F.concat(F.transform(matches, new), F.array(F.lit("")))
    return F.array_join(F.zip_with(between, made, lambda a, b: F.concat(a, b)), "")


def language_code(code: Column) -> Column:
    """Two lower-case letters of a locale such as es-ES; null if there are fewer."""
    short = F.substring(F.regexp_replace(F.lower(code), "[-_]", ""), 1, 2)
    return F.when(F.char_length(short) == 2, short)


def decode_entities(text: Column, full: bool = False) -> Column:
    """HTML entities decoded once. ``full`` knows all names and numbers, in Arrow batches of Python."""
    if full:

        @F.arrow_udf("string")
        def run(values: pa.Array) -> pa.Array:
            return pa.array([html.unescape(x) if x is not None and "&" in x else x for x in values.to_pylist()], pa.string())

        return run(text)
    for name, char in COMMON_ENTITIES.items():  # the ampersand comes last, so nothing is decoded twice
        text = F.replace(text, F.lit(f"&{name};"), F.lit(char))
    return text


def squeeze(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), "^ | $", "")


def strip_escaped_tags(text: Column, full_entities: bool = False) -> Column:
    """Escaped markup removed: line and paragraph breaks leave a space, other tags nothing; then
    entities are decoded and white space is tidied."""
    text = F.regexp_replace(text, r"(?i)&lt;/?br\s*/?&gt;", " ")
    text = F.regexp_replace(text, r"(?i)&lt;/?p\s*/?&gt;", " ")
    text = F.regexp_replace(text, r"(?i)&lt;p\s+[^&]*&gt;", " ")
    text = F.regexp_replace(text, r"&lt;[^&]*&gt;", "")
    return squeeze(decode_entities(text, full_entities))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that it names several times, the value evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip_raw_tags(text: Column) -> Column:
    """Markup of web pages removed: scripts, styles and comments with their content, then tags."""
    for tag in ("script", "style"):
        text = F.regexp_replace(text, rf"(?is)<{tag}\b.*?</{tag}\s*>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    return squeeze(decode_entities(F.regexp_replace(text, r"<[^>]*>", " ")))


def strip_control_escapes(text: Column) -> Column:
    """Literal backslash-n, -r and -t as spaces."""
    return F.regexp_replace(text, r"\\+[nrt]", " ")


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, C.URL, "")


def strip_emails(text: Column) -> Column:
    return F.regexp_replace(text, "(?U)" + C.EMAIL, "")


def expand_contractions(text: Column) -> Column:
    """English contractions written out, an initial capital kept."""
    known = F.create_map(*[F.lit(x) for pair in C.ENGLISH_CONTRACTIONS.items() for x in pair])
    pattern = r"(?iU)\b(?:" + "|".join(C.ENGLISH_CONTRACTIONS) + r")\b"

    def new(match: Column) -> Column:
        long = F.element_at(known, F.lower(match))
        first = F.substring(match, 1, 1)
        return F.when(first != F.lower(first), F.concat(F.upper(F.substring(long, 1, 1)), F.substring(long, F.lit(2), F.char_length(long)))).otherwise(long)

    return replace_matches(text, pattern, new)


def split_portuguese(text: Column) -> Column:
    """d'Á as de Á, l'Á as le Á, amá-lo as amár lo."""
    text = F.regexp_replace(text, rf"(?U)\bd'([{C.PORTUGUESE_CAPITALS}])", "de $1")
    text = F.regexp_replace(text, rf"(?U)\bl'([{C.PORTUGUESE_CAPITALS}])", "le $1")
    return F.regexp_replace(text, rf"(?U)([{C.PORTUGUESE_VOWELS}])-([lm][eoasá]s?)\b", "$1r $2")


def strip_french_elisions(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?iU)\b{C.FRENCH_CLITICS}(?=[{C.FRENCH_VOWELS}])", "")


def _replace_once(text: Column, old: Column, new: Column) -> Column:
    at = F.locate_(old, text) if hasattr(F, "locate_") else F.position(old, text)
    rest = F.substring(text, (at + F.char_length(old)).cast("int"), F.char_length(text))
    return F.when(at == 0, text).otherwise(F.concat(F.substring(text, F.lit(1), (at - 1).cast("int")), new, rest))


_BRACKET = r"\{\[([~]?[<>=]?\d+\*?)\]\?([^:}]*):([^}]*)\}"
_TILDE = r"\{~([^}]+)\}"
MORPH_WORD = r"\S*\{[~\[][^}]+\}(?:\{[~\[][^}]+\})*\S*"


def _bracket_forms(word: Column) -> Column:
    one, two, three = (F.regexp_extract_all(word, F.lit(_BRACKET), F.lit(k)) for k in (1, 2, 3))
    choices = F.zip_with(F.zip_with(one, two, lambda a, b: F.struct(a.alias("n"), b.alias("x"))), three, lambda a, b: F.struct(a["n"].alias("n"), a["x"].alias("x"), b.alias("y")))

    def step(forms: Column, c: Column) -> Column:
        literal = F.concat(F.lit("{["), c["n"], F.lit("]?"), c["x"], F.lit(":"), c["y"], F.lit("}"))
        return F.array_distinct(F.flatten(F.transform(forms, lambda f: F.array(_replace_once(f, literal, c["x"]), _replace_once(f, literal, c["y"])))))

    return F.aggregate(choices, F.array(word), step)


def _tilde_forms(word: Column) -> Column:
    raw = F.flatten(F.transform(F.regexp_extract_all(word, F.lit(_TILDE), F.lit(1)), lambda s: F.split(s, "~")))
    marks = F.transform(F.filter(raw, lambda s: s != ""), lambda s: F.struct(F.substring(s, 1, 1).alias("k"), F.substring(s, F.lit(2), F.char_length(s)).alias("s")))
    root = F.regexp_replace(word, _TILDE, "")
    of = lambda *kinds: F.filter(marks, lambda m: m["k"].isin(*kinds))
    with_root = lambda found: F.transform(found, lambda m: F.concat(root, m["s"]))
    bare = F.when(F.exists(marks, lambda m: m["k"].isin("s", "m")), F.array().cast("array<string>")).otherwise(F.array(root))
    both = F.flatten(F.transform(of("f"), lambda g: F.transform(of("p"), lambda n: F.concat(root, g["s"], n["s"]))))
    crossed = F.concat(bare, with_root(of("m")), with_root(of("f")), with_root(of("p")), both)
    plain = F.concat(bare, with_root(marks))
    made = F.array_distinct(F.when((F.size(of("m", "f")) > 0) & (F.size(of("s", "p")) > 0), crossed).otherwise(plain))
    return F.when(F.size(marks) > 0, made).otherwise(F.array(word))


def expand_morphology(text: Column) -> Column:
    """Morphology marks written out: a word with {~m..~f..} or {[n]?a:b} marks becomes all of its forms,
    joined by spaces. Words without marks stay."""
    return replace_matches(text, MORPH_WORD, lambda w: F.array_join(F.flatten(F.transform(_bracket_forms(w), _tilde_forms)), " "))


def _escaped(chars: str) -> str:
    return "".join("\\" + c if c in r"\[]^-&|(){}.+*?$/#~<>=@!%`\"',;:" else c for c in chars)


_CLASS = rf"[^\s{_escaped(C.PUNCTUATION)}]"
TOKEN = rf"(?U){_CLASS}+(?:[-']{_CLASS}+)*"


def is_good_token(token: Column) -> Column:
    """Neither short, nor one character repeated, nor digits, a time, or digits joined to a word."""
    low = F.lower(token)
    # few tokens begin with a digit, and only those can be digits, times or digits with a word
    digits = token.rlike(r"(?U)^\d+$") | token.rlike("(?iU)" + C.TIME_TOKEN) | token.rlike(r"(?U)^\d+-\w+$")
    return (F.char_length(token) >= 3) & (F.replace(low, F.substring(low, 1, 1), F.lit("")) != "") & ~(token.rlike(r"(?U)^\d") & digits)


def raw_tokens(text: Column) -> Column:
    """All runs of letters and digits, inner hyphens and apostrophes kept, in order."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def tokens(text: Column, mode: str | Column = "default", *, full_entities: bool = False, morphology: bool = True) -> Column:
    """The distinct good tokens of a text, in order of first use. ``mode``: english, portuguese, french or
    default, or a column that says which."""
    clean = strip_control_escapes(strip_escaped_tags(text, full_entities))
    if morphology:
        clean = once(clean, lambda c: F.when(F.contains(c, F.lit("{~")) | F.contains(c, F.lit("{[")), expand_morphology(c)).otherwise(c))
    clean = strip_emails(strip_urls(clean))
    steps = {"english": expand_contractions, "portuguese": split_portuguese, "french": strip_french_elisions}

    def made(which: str) -> Column:
        found = F.transform(raw_tokens(steps.get(which, lambda t: t)(clean)), lambda t: F.regexp_replace(t, r"^['-]+|['-]+$", ""))
        if which == "english":
            found = F.transform(found, lambda t: F.regexp_replace(t, "'[sS]$", ""))
        elif which == "french":
            found = F.transform(found, strip_french_elisions)
        return F.filter(F.array_distinct(found), is_good_token)

    if isinstance(mode, str):
        return made(mode)
    return F.when(mode == "english", made("english")).when(mode == "portuguese", made("portuguese")).when(mode == "french", made("french")).otherwise(made("default"))


def tokenizer_mode(lang: Column) -> Column:
    """The tokeniser's mode for a language."""
    known = F.create_map(*[F.lit(x) for pair in C.TOKENIZER_MODES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, language_code(lang)), F.lit("default"))


def first_word_lower(text: Column) -> Column:
    """The first word of letters, lower-case, without hyphens and apostrophes at its ends; '' if none."""
    return F.lower(F.regexp_replace(F.regexp_extract(text, rf"[{C.LETTER}][{C.LETTER}'’-]*", 0), "^['’-]+|['’-]+$", ""))


def plural_forms(info: Column) -> Column:
    """The quoted forms of a plural description such as One: "X", Other: "Y"."""
    return F.coalesce(F.regexp_extract_all(info, F.lit(C.PLURAL_INFO), F.lit(1)), F.array().cast("array<string>"))


def title_case_words(text: Column) -> Column:
    """Each word with a capital first and lower-case rest."""
    word = rf"[{C.LETTER}]+(?:[-'’][{C.LETTER}]+)*"
    return replace_matches(text, word, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.char_length(w)))))


def clean_annotated_term(term: Column, exceptions: dict[str, str] | None = None) -> Column:
    """A term without notes: a leading [note] leaves its first word, other [..] and (..) go, separators
    are tidied, and all capitals become title case. ``exceptions`` maps whole terms to what they become."""
    word = rf"[{C.LETTER}]+(?:[-'’][{C.LETTER}]+)*"
    text = F.regexp_replace(F.coalesce(term, F.lit("")), r"(?U)^\s+|\s+$", "")
    head = F.regexp_extract(F.regexp_extract(text, r"^\s*\[([^\]]*)\]", 1), word, 0)
    led = F.when(text.rlike(r"^\[[^\]]*\]"), head).otherwise(text)
    led = F.regexp_replace(F.regexp_replace(led, r"\[[^\]]*\]", " "), r"\([^)]*\)", " ")
    led = F.regexp_replace(F.regexp_replace(led, r"(?U)\s+", " "), r"\s*([,;:])\s*", "$1 ")
    led = F.regexp_replace(F.trim(led), "[ ,;:]+$", "")
    letters = F.regexp_replace(led, rf"[^{C.LETTER}]", "")
    out = F.when((letters != "") & (letters == F.upper(letters)) & (letters != F.lower(letters)), title_case_words(led)).otherwise(led)
    for old, new in (exceptions or {}).items():
        out = F.when(text == old, F.lit(new)).otherwise(out)
    return out


def strip_placeholders(text: Column) -> Column:
    """Text for language detection: [..] and {..} as spaces."""
    return squeeze(F.regexp_replace(F.regexp_replace(text, r"\[[^\]]*\]", " "), r"\{[^}]*\}", " "))


def word_stats(text: Column) -> Column:
    """words, letters and the share of letters, of a text prepared for detection."""
    words = F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))
    letters = F.char_length(F.regexp_replace(text, r"\P{L}", ""))
    return F.struct(words.alias("words"), letters.alias("letters"), (letters / F.greatest(F.char_length(text), F.lit(1))).alias("share"))


def strip_dots(word: Column) -> Column:
    return F.regexp_replace(word, r"\.+$", "")


def sharp_s_variants(form: Column, both_ways: bool = False) -> Column:
    """The form, with ss for ß, and if asked with ß for ss."""
    made = [form, F.replace(form, F.lit("ß"), F.lit("ss"))] + ([F.replace(form, F.lit("ss"), F.lit("ß"))] if both_ways else [])
    return F.array_distinct(F.array(*made))


def split_flags(flags: Column, mode: str) -> Column:
    """Flags of a dictionary entry or rule: single characters, pairs (long) or numbers (num)."""
    if mode == "long":
        return F.regexp_extract_all(flags, F.lit("(?s)(..)"), F.lit(1))
    if mode == "num":
        return F.filter(F.transform(F.split(flags, ","), lambda f: F.trim(f)), lambda f: f != "")
    return F.filter(F.split(flags, ""), lambda f: f != "")


def join_flags(flags: Column, mode: str = "single") -> Column:
    """A slash and the sorted flags; '' without any."""
    joined = F.array_join(F.array_sort(flags), "," if mode == "num" else "")
    return F.when(F.size(flags) > 0, F.concat(F.lit("/"), joined)).otherwise(F.lit(""))


def missing_chars(have: Column, need: str) -> Column:
    """``have`` with those characters of ``need`` appended that it lacks."""
    lacking = F.array_except(F.array(*[F.lit(c) for c in need]), F.split(have, ""))
    return F.concat(have, F.array_join(lacking, ""))


def pipe_list(value: Column) -> Column:
    """Parts of a list joined by |, trimmed, empty ones dropped."""
    parts = F.transform(F.split(F.coalesce(value, F.lit("")), r"\|"), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def as_flag(value: Column) -> Column:
    """true for 1, true, yes and y."""
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin("1", "true", "yes", "y"), F.lit(False))


def source_entity(keys: Column) -> Column:
    """kind:id of the first of several glossary keys joined by |, or the key itself."""
    first = F.trim(F.get(F.split(F.coalesce(keys, F.lit("")), r"\|", 2), F.lit(0)))
    parts = F.filter(F.transform(F.split(first, r"\."), lambda p: F.trim(p)), lambda p: p != "")
    return F.when(F.size(parts) >= 2, F.concat_ws(":", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))).otherwise(first)


def evidence_summary(evidence: Column) -> Column:
    """base:flag:hits/derived of each piece of evidence, joined by ' ; '."""
    one = lambda e: F.concat(e["base_word"], F.lit(":"), e["flag"], F.lit(":"), e["hit_count"].cast("string"), F.lit("/"), e["derived_count"].cast("string"))
    return F.array_join(F.transform(evidence, one), " ; ")


def length_bucket(token: Column) -> Column:
    n = F.char_length(F.trim(token))
    return F.when(n <= 4, "1-4").when(n <= 8, "5-8").when(n <= 12, "9-12").otherwise("13+")


def natural_key(value: Column) -> Column:
    """A sort key: case and accents ignored, digit runs by value."""
    folded = F.lower(F.trim(value))
    plain = F.translate(folded, "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")
    return replace_matches(plain, r"\d+", lambda d: F.lpad(d, 20, "0"))


def key_category(key_part: Column) -> Column:
    """The first category with a pattern in one glossary key; null if none."""
    out = F.lit(None).cast("string")
    for category, patterns in reversed(C.KEY_CATEGORIES.items()):
        hit = F.lit(False)
        for p in patterns:
            hit = hit | key_part.rlike(p.replace("(?i)", "(?iU)") if p.startswith("(?i)") else "(?U)" + p)
        out = F.when(hit, category).otherwise(out)
    return out
