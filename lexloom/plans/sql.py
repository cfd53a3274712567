"""Pieces of DuckDB SQL that several queries' reference statements share."""

from __future__ import annotations

from ..functions import constants as C
from ..functions.text import COMMON_ENTITIES


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replaced(expression: str, pattern: str, new: str) -> str:
    return f"regexp_replace({expression}, {quoted(pattern)}, {quoted(new)}, 'g')"


def stripped_tags(expression: str) -> str:
    """Escaped markup removed, entities decoded, white space tidied."""
    for pattern, new in ((r"(?i)&lt;/?br\s*/?&gt;", " "), (r"(?i)&lt;/?p\s*/?&gt;", " "), (r"(?i)&lt;p\s+[^&]*&gt;", " "), (r"&lt;[^&]*&gt;", "")):
        expression = replaced(expression, pattern, new)
    return squeezed(decoded(expression))


def decoded(expression: str) -> str:
    for name, char in COMMON_ENTITIES.items():
        expression = f"replace({expression}, {quoted('&' + name + ';')}, {quoted(char)})"
    return expression


def squeezed(expression: str) -> str:
    return replaced(replaced(expression, r"\s+", " "), "^ | $", "")


def cleaned(expression: str) -> str:
    """A text as the tokeniser sees it."""
    expression = replaced(stripped_tags(expression), r"\\+[nrt]", " ")
    return replaced(replaced(expression, C.URL, ""), C.EMAIL, "")


_CLASS = r"[^\s" + "".join("\\" + c if c in r"\[]^-" else c for c in C.PUNCTUATION) + "]"
TOKEN = rf"{_CLASS}+(?:[-']{_CLASS}+)*"


def raw_tokens(expression: str) -> str:
    return f"list_transform(regexp_extract_all({cleaned(expression)}, {quoted(TOKEN)}), lambda t: {replaced('t', chr(94) + chr(91) + chr(39) + '-]+|[' + chr(39) + '-]+$', '')})"


GOOD = (
    "length(t) >= 3 AND replace(lower(t), lower(t)[1], '') <> '' AND NOT regexp_matches(t, '^\\p{Nd}+$')"
    f" AND NOT regexp_matches(t, {quoted('(?i)' + C.TIME_TOKEN)}) AND NOT regexp_matches(t, '^\\d+-[\\p{{L}}\\p{{N}}_]+$')"
)


def tokens(expression: str) -> str:
    """The distinct good tokens of a text, in default mode."""
    return f"list_distinct(list_filter({raw_tokens(expression)}, lambda t: {GOOD}))"


TOK = f"tok AS MATERIALIZED (SELECT doc_id, lang, source, unnest({tokens('text')}) AS token FROM documents)"

#: rules of the small affix tables that queries share: lang, kind, flag, strip, add, condition
RULES = [
    ("en", "SFX", "D", "", "ed", "."),
    ("en", "SFX", "G", "", "ing", "[^e]"),
    ("en", "SFX", "S", "e", "es", "e"),
    ("en", "SFX", "S", "", "es", "[^e]"),
    ("en", "PFX", "R", "", "re", "[^aeiou]"),
    ("de", "SFX", "N", "", "en", "."),
    ("de", "SFX", "U", "", "ung", "[^e]"),
    ("de", "PFX", "G", "", "ge", "."),
    ("es", "SFX", "S", "", "os", "."),
    ("es", "SFX", "A", "o", "as", "o"),
    ("fr", "SFX", "E", "", "eau", "."),
    ("fr", "SFX", "M", "e", "ment", "e"),
]
RULES_CTE = "rules(lang, kind, flag, strip, addn, cond) AS (VALUES " + ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in RULES) + ")"

#: dictionary entries: short words of at least five documents, with all flags of their language
ENTRIES_CTE = """entries AS MATERIALIZED (SELECT lang, lower(token) AS base FROM tok WHERE length(token) BETWEEN 3 AND 4 GROUP BY 1, 2 HAVING count(DISTINCT doc_id) >= 5)"""

SUFFIXED = "left({w}, length({w}) - length(strip)) || addn"
ONE_CTE = f"""one AS MATERIALIZED (
  SELECT e.lang, e.base, r.flag, r.kind,
         CASE r.kind WHEN 'SFX' THEN {SUFFIXED.format(w='e.base')} ELSE addn || substr(e.base, length(strip) + 1) END AS form
  FROM entries e JOIN rules r ON e.lang = r.lang
  WHERE (r.kind = 'SFX' AND ends_with(e.base, strip) AND (cond = '.' OR regexp_matches(e.base, '(?:' || cond || ')$')))
     OR (r.kind = 'PFX' AND starts_with(e.base, strip) AND (cond = '.' OR regexp_matches(e.base, '^(?:' || cond || ')')))
)"""
CROSSED_CTE = """crossed AS MATERIALIZED (
  SELECT o.lang, o.base, r.addn || o.form AS form
  FROM one o JOIN rules r ON o.lang = r.lang AND r.kind = 'PFX' AND o.kind = 'SFX'
  WHERE cond = '.' OR regexp_matches(o.form, '^(?:' || cond || ')')
)"""
FORMS_CTE = "forms AS MATERIALIZED (SELECT DISTINCT lang, base, form FROM (SELECT lang, base, form FROM one UNION ALL SELECT lang, base, form FROM crossed UNION ALL SELECT lang, base, base FROM entries))"
CASES_CTE = "cases AS MATERIALIZED (SELECT lang, lower(token) AS low, list_sort(list(DISTINCT token)) AS spellings FROM tok GROUP BY 1, 2)"


def statement(*ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(ctes)} {select}"


AFFIX = (TOK, RULES_CTE, ENTRIES_CTE, ONE_CTE, CROSSED_CTE, FORMS_CTE)
