"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation estimates how
accurate each rule is, and the posterior probability of good quality replaces all-must-pass.

Plan. One pass turns each whole text into counts and a vote pattern (base-3 number, one digit a
rule). Patterns are counted over all documents: at most ``3**len(RULES)`` rows however large the
corpus, so EM runs on that table on the driver and sees every document. Posteriors go back by a join
with the same bounded table.

Defined results: a null or empty text has all counts 0 and fails the base rules; repeated rows count
once each; an empty table gives an empty table; further columns are carried along, one named ``quality``
as ``input_quality``.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, Carried, cut, give_back

SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_plain_words", "n_distinct")

#: name, ratio, good where the ratio lies in the first interval, bad where it lies outside of the second, else abstain.
RULES = (
    ("symbols", lambda s: s["n_symbols"] / s["n_words"], (0.0, 0.02), (0.0, 0.1)),
    ("word_length", lambda s: s["word_chars"] / s["n_words"], (3.0, 10.0), (2.0, 15.0)),
    ("repeats", lambda s: s["n_repeat_words"] / s["n_words"], (0.0, 0.25), (0.0, 0.5)),
    ("dup_lines", lambda s: s["n_dup_lines"] / max(s["n_lines"], 1), (0.0, 0.2), (0.0, 0.5)),
    ("plain_words", lambda s: s["n_plain_words"] / s["n_words"], (0.7, 1.0), (0.4, 1.0)),
    ("variety", lambda s: s["n_distinct"] / s["n_words"] ** 0.5, (3.0, 1e18), (1.5, 1e18)),
    ("length", lambda s: s["n_words"], (50.0, 1e18), (20.0, 1e18)),
)
ABSTAIN, GOOD, BAD = 0, 1, 2

_WORD = re.compile(WORD)
_SYMBOL = re.compile(r"[#*$%&|<>]")
_PLAIN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*[.,;:!?…)\"”»]*|[(\"“«¿¡][^\W\d_]+[.,;:!?…)\"”»]*|\d+[.,]?")


def signals_of(text: str | None) -> dict[str, int]:
    """The counts of one whole text."""
    text = text or ""
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    n = len(words)
    repeated = 0
    if n >= 3:
        windows = Counter(zip(words, words[1:], words[2:]))
        if len(windows) < n - 2:
            reach = 0  # words before this position are counted
            for i, window in enumerate(zip(words, words[1:], words[2:])):
                if windows[window] > 1:
                    repeated += i + 3 - max(i, reach)
                    reach = i + 3
    kinds = Counter(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(_SYMBOL.findall(text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated,
        "n_lines": len(lines),
        "n_plain_words": sum(k for w, k in kinds.items() if _PLAIN.fullmatch(w)),
        "n_distinct": len(kinds),
    }


def votes_of(s: dict[str, int]) -> list[int]:
    """A vote a rule; a text without words gets bad votes of all."""
    if not s["n_words"]:
        return [BAD] * len(RULES)
    out = []
    for _, ratio, (lo, hi), (least, most) in RULES:
        x = ratio(s)
        out.append(GOOD if lo <= x <= hi else BAD if not least <= x <= most else ABSTAIN)
    return out


def pattern_of(votes: list[int]) -> int:
    return sum(v * 3**j for j, v in enumerate(votes))


def _signals(text: Column) -> Column:
    """Signals and pattern of a text column, one Arrow batch at a time."""

    @F.arrow_udf("struct<" + ", ".join(f"{c} long" for c in SIGNALS) + ", pattern int>")
    def run(texts: pa.Array) -> pa.Array:
        rows = [signals_of(t.as_py()) for t in texts]
        cols = [pa.array([r[c] for r in rows], pa.int64()) for c in SIGNALS]
        give_back()
        return pa.StructArray.from_arrays([*cols, pa.array([pattern_of(votes_of(r)) for r in rows], pa.int32())], [*SIGNALS, "pattern"])

    # evaluated once: a filter on the result would otherwise be pushed below and score every text again
    return run.asNondeterministic()(text)


def fit(counts: dict[int, int], *, rounds: int = 200, prior: tuple = ((3.0, 7.0), (49.0, 1.0)), tol: float = 1e-9) -> tuple[dict[int, float], np.ndarray, float]:
    """EM over vote patterns: the posterior of each pattern, the accuracies (class, rule) and the
    share of good documents.

    Given the class, a rule that votes is right with its accuracy for that class and rules are
    independent; an abstention says nothing. A Beta ``prior`` for each class, bad and good, fixes which is which: a bad document fails few rules.
    """
    if not counts:
        return {}, np.full((2, len(RULES)), 0.9), 0.5
    patterns = np.array(sorted(counts))
    weight = np.array([counts[p] for p in patterns], float)
    votes = np.stack([(patterns // 3**j) % 3 for j in range(len(RULES))], 1)
    right = np.stack([votes == BAD, votes == GOOD]).astype(float)  # for the bad class, for the good class
    voted = (votes != ABSTAIN).astype(float)
    accuracy, good = np.array([[p[0] / sum(p)] * len(RULES) for p in prior]), 0.8
    for _ in range(rounds):
        logs = [np.log(p) + right[c] @ np.log(accuracy[c]) + (voted - right[c]) @ np.log(1 - accuracy[c]) for c, p in ((0, 1 - good), (1, good))]
        post = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
        mass = np.stack([1 - post, post]) * weight
        new = np.stack([(prior[c][0] - 1 + mass[c] @ right[c]) / (sum(prior[c]) - 2 + mass[c] @ voted) for c in (0, 1)])
        new = np.clip(new, 1e-4, 1 - 1e-4)
        share = float(np.clip((mass[1].sum() + 1) / (weight.sum() + 2), 1e-4, 1 - 1e-4))
        moved = max(np.abs(new - accuracy).max(), abs(share - good))
        accuracy, good = new, share
        if moved < tol:
            break
    return dict(zip(patterns.tolist(), post.tolist())), accuracy, good


def base_failed(signals: Column) -> Column:
    return (signals["n_words"] < 50) | (100 * signals["n_repeat_words"] > 50 * signals["n_words"])


def posterior_table(scored: DataFrame, pattern: Column) -> DataFrame:
    """(ll_pattern, posterior) fitted on all rows; at most 3**7 = 2,187 rows."""
    spark = scored.sparkSession
    counts = {r[0]: r[1] for r in scored.groupBy(pattern.alias("p")).count().collect()}
    posterior, _, _ = fit(counts)
    return spark.createDataFrame(list(posterior.items()), "ll_pattern int, ll_posterior double")


def quality(docs: DataFrame, text_col: str = "text", *, threshold: float = 0.5, materialise: bool = False) -> DataFrame:
    """``docs`` with a struct column ``quality``: the signals, ``base_failed``, ``posterior`` (probability
    of good quality) and ``kept`` (not failed, posterior at least ``threshold``).

    ``materialise`` writes the scored rows once instead of scoring twice; texts then come back as null.
    """
    carried = Carried(docs, "quality")
    text = carried.name(text_col)
    scored = carried.df.withColumn("ll_signals", _signals(F.col(text)))
    if materialise:
        scored = cut(scored.withColumn(text, F.lit(None).cast("string")), "quality")
    table = F.broadcast(posterior_table(scored, F.col("ll_signals.pattern")))
    out = scored.join(table, scored["ll_signals.pattern"] == table["ll_pattern"])
    failed, post = base_failed(F.col("ll_signals")), F.col("ll_posterior")
    fields = [F.col(f"ll_signals.{c}").alias(c) for c in SIGNALS]
    made = F.struct(*fields, failed.alias("base_failed"), post.alias("posterior"), (~failed & (post >= threshold)).alias("kept"))
    return out.select(*carried.back(), made.alias("quality"))
