"""Row predicates and the reasons for which glossary rows are left out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C
from .text import word_stats


def has_wip_marker(text: Column) -> Column:
    return F.coalesce(F.contains(text, F.lit("[!]")) | text.rlike("(?i)" + C.WIP_MARKER), F.lit(False))


def is_identical(source: Column, target: Column) -> Column:
    return F.coalesce(source == target, F.lit(False))


def has_brackets(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\[.+\]"), F.lit(False))


def is_all_caps(text: Column) -> Column:
    """Some cased letter, no lower-case one, longer than two."""
    return F.coalesce((text == F.upper(text)) & (text != F.lower(text)) & (F.char_length(text) > 2), F.lit(False))


def is_blank(text: Column) -> Column:
    return text.isNull() | text.rlike(r"(?U)^\s*$")


def skip_reason(source: Column, target: Column, *, identical: bool = True, brackets: bool = True, all_caps: bool = True, wip: bool = True) -> Column:
    """Why a translation is left out, the first that holds; null if it stays."""
    out = F.when(is_blank(target), "empty_target")
    for on, name, test in (
        (identical, "identical", is_identical(source, target)),
        (brackets, "square_brackets", has_brackets(source)),
        (all_caps, "all_caps", is_all_caps(target)),
        (wip, "wip_markers", has_wip_marker(target)),
    ):
        if on:
            out = out.when(test, name)
    return out


def is_shortcut_key(key: Column) -> Column:
    return F.coalesce(key.rlike(r"(?U)^emoticon\.\d+\.shortcut"), F.lit(False))


def is_morse_key(key: Column) -> Column:
    return F.coalesce(key.rlike(r"(?iU)\bmorse\b"), F.lit(False))


def is_possessive(token: Column) -> Column:
    return F.coalesce(F.trim(token).rlike("(?i)^.*(?:'|’)s$"), F.lit(False))


def needs_detection(clean: Column) -> Column:
    """False for texts with too few letters to tell a language."""
    s = word_stats(clean)
    short_caps = (clean == F.upper(clean)) & (clean != F.lower(clean)) & (s["letters"] <= 4)
    return (s["words"] > 0) & (s["letters"] >= 3) & (s["share"] >= 0.35) & ~short_caps


def is_wrong_language(target_score: Column, en_score: Column, fr_score: Column, words: Column, lang: str, *, min_words: int = 7, min_confidence: float = 0.12) -> Column:
    """Long texts: the target language scores under ``min_confidence``. Short texts: under both English
    and French (never for French; against French alone for English)."""
    if lang == "fr":
        short = F.lit(False)
    elif lang == "en":
        short = target_score < fr_score
    else:
        short = (target_score < en_score) & (target_score < fr_score)
    return F.when(words >= min_words, target_score < min_confidence).otherwise(short)


def starts_sentence(before: Column) -> Column:
    """Whether a word after the text ``before`` begins a sentence."""
    return F.coalesce(before.rlike(r"(?U)^\s*$|[.!?:;]\s*$"), F.lit(True))
