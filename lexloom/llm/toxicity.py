"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Training runs on the driver over a bounded sample of labelled documents (``max_toxic`` and
``max_clean`` rows, those with the smallest hash of their id; of a text longer than ``max_chars``, stretches
from all over it, chosen by hash and cut out on the executors). Documents are labelled, tokens are
not, so tokens get labels first: a word of a toxic document is toxic if it or a piece of it is found
almost only in toxic documents, more often than chance allows (log-likelihood ratio), counting near
copies once. The chain then has two states, clean and toxic; a token's evidence is the sum of the
weights of its hashed character pieces and its whole word, and transitions tie neighbours together.
Forward-backward gives each token's marginal; a document's score is a logistic function of its
largest marginal and its expected number of toxic tokens, fitted on the same sample.

Scoring reads whole texts on the executors; the model is an array of ``2**BITS`` weights.

Defined results: a null or empty text has no tokens and gets the score of a text without evidence;
null ids, labels and labels without a document are not trained on, contradictory labels count as
toxic; without labels of both kinds every score is 0.5 and there are no spans; repeated rows are
scored alike; an empty table gives an empty table; an input column named like an output comes back with
``input_`` before its name.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Carried

BITS = 20
TOKEN = re.compile(r"\w+(?:[*@$!#]+\w+)*")
PAD = 5
_CAP = 30.0


_MIX = np.uint64(0x9E3779B97F4A7C15)


def piece_table(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words: each word and its character 3- to 5-grams, with its ends marked. One array
    of feature numbers for all, and where each word's begin."""
    marked = ["^" + w.lower() + "$" for w in words]
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) for w in marked], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(begin + sizes, sizes) - np.arange(len(chars))  # characters from here to the word's end
    features, owners = [], []
    with np.errstate(over="ignore"):
        for n in (3, 4, 5):
            at = np.flatnonzero(left >= n)
            h = np.full(len(at), n, np.uint64)
            for k in range(n):
                h = h * _MIX + chars[at + k] + np.uint64(1)
            features.append(h)
            owners.append(owner[at])
        whole = np.add.reduceat((chars + np.uint64(1)) * _powers(len(chars), sizes, begin), begin) if len(words) else np.zeros(0, np.uint64)
        features.append(whole + np.uint64(77))
        owners.append(np.arange(len(words)))
        h = np.concatenate(features) * np.uint64(0xD6E8FEB86659FD93)
    number = (h >> np.uint64(64 - BITS)).astype(np.int64)
    who = np.concatenate(owners)
    order = np.argsort(who, kind="stable")
    return number[order], np.searchsorted(who[order], np.arange(len(words)))


def _powers(n: int, sizes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    table = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(int(sizes.max(initial=0)), _MIX, np.uint64))])
    return table[np.arange(n) - np.repeat(begin, sizes)]


@dataclass
class Model:
    weights: np.ndarray  # log-odds of toxic against clean, by feature
    bias: float
    chain: np.ndarray  # log of the 2 x 2 transition factors
    score: np.ndarray  # constant, largest marginal, expected count

    def evidence(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        features, begin = piece_table(words)
        return np.clip(np.add.reduceat(self.weights[features], begin) + self.bias, -_CAP, _CAP)


_STRETCH = 256


def _step(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Log-odds that a message of log-odds x brings to the next position."""
    x = np.exp(np.clip(x, -50, 50))
    return np.log((a[0, 1] + a[1, 1] * x) / (a[0, 0] + a[1, 0] * x))


def _run(a: np.ndarray, e: np.ndarray, starts: np.ndarray, sizes: np.ndarray, incoming: np.ndarray) -> np.ndarray:
    """Messages along stretches of ``e``, all stretches at once; ``incoming`` is nan where one begins a
    sequence."""
    out = np.zeros(len(e))
    order = np.argsort(-sizes, kind="stable")
    starts, sizes, incoming = starts[order], sizes[order], incoming[order]
    begins = np.isnan(incoming)
    out[starts] = e[starts] + np.where(begins, 0.0, _step(a, np.where(begins, 0.0, incoming)))
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    for t in range(1, longest):
        at = starts[: active[t]] + t
        out[at] = e[at] + _step(a, out[at - 1])
    return out


def _messages(a: np.ndarray, e: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Forward messages of all sequences. Long ones are cut into stretches: what a stretch does to any
    message is a fractional linear map, so maps are multiplied up for all stretches at once, messages
    handed from stretch to stretch, and then all stretches run side by side. Exact at any length."""
    per = -(-lengths // _STRETCH)
    level = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    starts = np.repeat(np.cumsum(lengths) - lengths, per) + level * _STRETCH
    sizes = np.minimum(np.repeat(lengths, per) - level * _STRETCH, _STRETCH)
    incoming, last = np.full(len(starts), np.nan), level + 1 == np.repeat(per, per)
    if (per > 1).any():
        head, middle = np.flatnonzero((level == 0) & ~last), np.flatnonzero((level > 0) & ~last)
        whole = np.full(len(head), _STRETCH)
        sent = np.full(len(starts), np.nan)
        sent[head] = _run(a, e, starts[head], whole, np.full(len(head), np.nan))[starts[head] + _STRETCH - 1]
        p, q, r, s = np.ones(len(middle)), np.zeros(len(middle)), np.zeros(len(middle)), np.ones(len(middle))
        for t in range(_STRETCH):
            up = np.exp(np.clip(e[starts[middle] + t], -_CAP, _CAP))
            p, q, r, s = up * (a[1, 1] * p + a[0, 1] * r), up * (a[1, 1] * q + a[0, 1] * s), a[1, 0] * p + a[0, 0] * r, a[1, 0] * q + a[0, 0] * s
            scale = np.maximum(np.maximum(p, q), np.maximum(r, s))
            p, q, r, s = p / scale, q / scale, r / scale, s / scale
        place = np.zeros(len(starts), np.int64)
        place[middle] = np.arange(len(middle))
        for k in range(1, int(per.max())):
            now = np.flatnonzero(level == k)
            incoming[now] = sent[now - 1]
            on = now[~last[now]]
            x, m = np.exp(np.clip(incoming[on], -50, 50)), place[on]
            sent[on] = np.log((p[m] * x + q[m]) / (r[m] * x + s[m]))
    return _run(a, e, starts, sizes, incoming)


def marginals(chain: np.ndarray, evidence: list[np.ndarray]) -> list[np.ndarray]:
    """Log-odds of the toxic state at each position of each sequence, by forward-backward."""
    a, lengths = np.exp(chain), np.array([len(x) for x in evidence], np.int64)
    if not lengths.sum():
        return [np.zeros(0) for _ in evidence]
    some = lengths > 0
    e = np.concatenate([x for x in evidence if len(x)]).astype(float)
    forward = _messages(a, e, lengths[some])
    # backward messages are forward ones of the reversed sequences and the transposed chain
    backward = _messages(a.T, e[::-1], lengths[some][::-1])[::-1]
    return np.split(forward + backward - e, np.cumsum(lengths)[:-1])


def _near_copies(texts: list[str], size: int = 16) -> list[int]:
    """A group for each text: texts that share half of a sketch of their word triples with its first."""
    leaders, sketches, group = defaultdict(list), {}, []
    for i, text in enumerate(texts):
        words = text.split()
        triples = {zlib.crc32(" ".join(words[j : j + 3]).encode("utf-8", "surrogatepass")) for j in range(max(1, len(words) - 2))}
        sketch = set(sorted(triples)[:size])
        shared = Counter(x for h in sketch for x in leaders[h][:50])
        best = max(shared, key=lambda x: (shared[x], -x), default=None)
        if best is not None and 2 * shared[best] >= min(len(sketch), len(sketches[best])):
            group.append(best)
            continue
        group.append(i)
        sketches[i] = sketch
        for h in sketch:
            leaders[h].append(i)
    return group


def _toxic_features(docs: list[set[str]], toxic: list[bool], groups: list[int], *, least_llr: float = 12.0, least_share: float = 0.8) -> np.ndarray:
    """A flag for each feature: found almost only in toxic documents, beyond chance."""
    counts, totals = np.zeros((2, 1 << BITS)), [0, 0]
    members = defaultdict(list)
    for i, (bad, g) in enumerate(zip(toxic, groups)):
        members[g, bad].append(i)
    for (_, bad), rows in members.items():
        words = set().union(*(docs[i] for i in rows))
        if words:
            counts[int(bad), np.unique(piece_table(list(words))[0])] += 1
        totals[bad] += 1
    base = totals[1] / max(1, sum(totals))
    n0, n1 = counts
    n = n0 + n1
    with np.errstate(divide="ignore", invalid="ignore"):
        llr = n1 * np.log(n1 / (n * base)) + np.where(n0 > 0, n0 * np.log(n0 / (n * (1 - base))), 0.0)
    return (n1 >= 3) & (n1 >= least_share * n) & (np.nan_to_num(llr, nan=0.0) >= least_llr)


def _fit_chain(words: list[str], windows: np.ndarray, labels: np.ndarray, *, rounds: int = 80, rate: float = 0.15, decay: float = 1e-5) -> tuple[np.ndarray, float, np.ndarray]:
    """Maximum likelihood of the labelled windows (rows of word numbers, -1 for padding) by gradient
    ascent with adaptive steps; returns feature weights, bias and transitions."""
    flat, ends = piece_table(words)
    owner = np.repeat(np.arange(len(words)), np.diff(np.append(ends, len(flat))))
    weights, bias, chain = np.zeros(1 << BITS), -2.0, np.log(np.array([[0.9, 0.1], [0.5, 0.5]]))
    n, width = windows.shape
    real = windows >= 0
    steps = [np.full(1 << BITS, 1e-8), 1e-8, np.full((2, 2), 1e-8)]
    observed = np.array([[np.sum((labels[:, :-1] == i) & (labels[:, 1:] == j)) for j in (0, 1)] for i in (0, 1)], float)
    for _ in range(rounds):
        word_e = np.add.reduceat(weights[flat], ends) + bias
        e = np.where(real, np.clip(word_e[np.maximum(windows, 0)], -_CAP, _CAP), -_CAP)
        psi = np.exp(chain)
        alpha, beta = np.empty((width, n, 2)), np.ones((width, n, 2))
        node = np.stack([np.exp(-np.maximum(e, 0)), np.exp(np.minimum(e, 0))], 2).transpose(1, 0, 2)  # scaled to at most 1
        alpha[0] = node[0] / node[0].sum(1, keepdims=True)
        for t in range(1, width):
            alpha[t] = node[t] * (alpha[t - 1] @ psi)
            alpha[t] /= alpha[t].sum(1, keepdims=True)
        for t in range(width - 2, -1, -1):
            beta[t] = (node[t + 1] * beta[t + 1]) @ psi.T
            beta[t] /= beta[t].sum(1, keepdims=True)
        post = alpha * beta
        post /= post.sum(2, keepdims=True)
        expected = np.zeros((2, 2))
        for t in range(width - 1):
            pair = alpha[t][:, :, None] * psi[None] * (node[t + 1] * beta[t + 1])[:, None, :]
            expected += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
        miss = np.where(real, labels - post[:, :, 1].T, 0.0)
        word_g = np.bincount(windows[real], miss[real], minlength=len(words))
        gradient = [np.bincount(flat, word_g[owner], minlength=1 << BITS) - decay * n * weights, miss.sum(), observed - expected]
        for k, g in enumerate(gradient):
            steps[k] = steps[k] + g * g
        weights += rate * gradient[0] / np.sqrt(steps[0])
        bias += rate * gradient[1] / math.sqrt(steps[1])
        chain = chain + rate * gradient[2] / np.sqrt(steps[2])
        chain -= chain[0, 0]
    return weights, float(bias), chain


def document_features(log_odds: np.ndarray) -> tuple[float, float, float]:
    if not len(log_odds):
        return 1.0, -12.0, 0.0
    return 1.0, float(np.clip(log_odds.max(), -12, 12)), math.log1p(float((1 / (1 + np.exp(-np.clip(log_odds, -50, 50)))).sum()))


def _fit_score(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * beta)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(texts: list[str], toxic: list[bool], *, toxic_weight: float = 1.0, seed: int = 7, negatives_per_doc: int = 4) -> Model | None:
    """A model from labelled documents; None unless both labels occur."""
    if len(set(toxic)) < 2:
        return None
    tokens = [TOKEN.findall(t) for t in texts]
    groups = _near_copies(texts)
    bad = _toxic_features([{w.lower() for w in ws} for ws in tokens], toxic, groups)
    known = sorted({w.lower() for ws in tokens for w in ws})
    features, begin = piece_table(known) if known else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    hit = dict(zip(known, np.logical_or.reduceat(bad[features], begin).tolist())) if known else {}
    number: dict[str, int] = {}
    rng = np.random.default_rng(seed)
    windows, labels = [], []
    first = set()
    for i, (ws, is_toxic) in enumerate(zip(tokens, toxic)):
        if (groups[i], is_toxic) in first:
            continue
        first.add((groups[i], is_toxic))
        marks = [is_toxic and hit[w.lower()] for w in ws]
        centres = [j for j, m in enumerate(marks) if m][:20] + (rng.integers(0, len(ws), negatives_per_doc).tolist() if ws else [])
        for c in centres:
            span = range(c - PAD, c + PAD + 1)
            windows.append([number.setdefault(ws[j].lower(), len(number)) if 0 <= j < len(ws) else -1 for j in span])
            labels.append([int(0 <= j < len(ws) and marks[j]) for j in span])
    if not windows or not any(map(any, labels)):
        windows, labels = windows or [[-1] * (2 * PAD + 1)], labels or [[0] * (2 * PAD + 1)]
        number = number or {"": 0}
    weights, bias, chain = _fit_chain(list(number), np.array(windows), np.array(labels))
    model = Model(weights.astype(np.float32), bias, chain, np.zeros(3))
    memo = dict(zip(known, model.evidence(known).tolist()))
    found = [np.array([memo[w.lower()] for w in ws]) for ws in tokens]
    x = np.array([document_features(m) for m in marginals(chain, found)])
    y = np.array(toxic, float)
    model.score = _fit_score(x, y, np.where(y > 0, toxic_weight, 1.0))
    return model


class _Memo(dict):
    """Evidence of the words met last, computed for many new words at a time."""

    def of(self, model: Model, texts: list[list[str]], most: int = 300_000) -> list[np.ndarray]:
        new = list({w for ws in texts for w in ws if w not in self})
        if len(self) + len(new) > most:
            self.clear()
            new = list({w for ws in texts for w in ws})
        # at most 50,000 words and, unless one word has more, 500,000 characters at a time
        part, chars = [], 0
        for w in new:
            if part and (len(part) == 50_000 or chars + len(w) > 500_000):
                self.update(zip(part, model.evidence(part).tolist()))
                part, chars = [], 0
            part.append(w)
            chars += len(w)
        if part:
            self.update(zip(part, model.evidence(part).tolist()))
        return [np.fromiter(map(self.__getitem__, ws), np.float32, len(ws)) for ws in texts]


def scorer(model):
    """A column function: text -> struct of score, number of toxic tokens and their spans (code point
    offsets, end exclusive). ``model`` is a broadcast variable holding a Model or None."""

    @F.arrow_udf("struct<score double, n_toxic int, spans array<struct<start: int, end: int>>>")
    def run(texts: pa.Array) -> pa.Array:
        m = model.value
        kind = pa.struct([("score", pa.float64()), ("n_toxic", pa.int32()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
        if m is None:
            return pa.array([{"score": 0.5, "n_toxic": 0, "spans": []}] * len(texts), kind)
        if not hasattr(m, "memo"):
            m.memo = _Memo()
        memo, out = m.memo, []
        for at in range(0, len(texts), 1000):
            block = [t.as_py() or "" for t in texts[at : at + 1000]]
            evidence = memo.of(m, [TOKEN.findall(t) for t in block])
            for text, odds in zip(block, marginals(m.chain, evidence)):
                score = 1 / (1 + math.exp(-max(-40.0, min(40.0, float(np.dot(document_features(odds), m.score))))))
                hits = set(np.flatnonzero(odds > 0).tolist())
                spans = [{"start": t.start(), "end": t.end()} for j, t in enumerate(TOKEN.finditer(text)) if j in hits] if hits else []
                out.append({"score": score, "n_toxic": len(spans), "spans": spans})
        return pa.array(out, kind)

    return run


def _stretches(doc: Column, text: Column, most: int, size: int = 1000) -> Column:
    """``text``, or of a longer one ``most`` characters in stretches chosen by hash, in their order."""
    every = F.sequence(F.lit(0), F.floor((F.char_length(text) - 1) / size).cast("int"))
    chosen = F.slice(F.array_sort(F.transform(every, lambda k: F.struct(F.xxhash64(doc, k).alias("h"), k.alias("k")))), 1, max(1, most // size))
    parts = F.transform(F.array_sort(F.transform(chosen, lambda x: x["k"])), lambda k: F.substring(text, k * size + 1, F.lit(size)))
    return F.when(F.char_length(text) <= most, text).otherwise(F.array_join(parts, " "))


def fit_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *, max_toxic: int = 1000, max_clean: int = 2000, max_chars: int = 20_000) -> Model | None:
    """Train on at most ``max_toxic`` + ``max_clean`` labelled documents and ``max_chars`` characters of each."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("ll_id")).agg((F.max(label_col) > 0).alias("ll_toxic"))
    totals = {r[0]: r[1] for r in known.groupBy("ll_toxic").count().collect()}
    by_hash = lambda toxic, most: known.where(F.col("ll_toxic") == toxic).orderBy(F.xxhash64("ll_id"), "ll_id").limit(most)
    chosen = by_hash(True, max_toxic).unionByName(by_hash(False, max_clean))
    texts = docs.select(F.col(id_col).alias("ll_id"), F.coalesce(text_col, F.lit("")).alias("ll_text")).join(F.broadcast(chosen), "ll_id")
    rows = sorted(texts.select("ll_id", _stretches(F.col("ll_id"), F.col("ll_text"), max_chars).alias("ll_text"), "ll_toxic").collect())
    rows = list({r[0]: r for r in rows}.values())
    toxic = [r[2] for r in rows]
    n1, n0 = sum(toxic), len(toxic) - sum(toxic)
    share = (totals.get(True, 0) / max(1, n1)) / max(1e-9, totals.get(False, 0) / max(1, n0))
    return train([r[1] for r in rows], toxic, toxic_weight=max(0.05, min(20.0, share)))


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *, threshold: float = 0.7, **bounds) -> DataFrame:
    """``docs`` with held_out, score, predicted, n_toxic and spans. Labels of held-out ids (crc32 of the
    id as text, modulo 3, is 1) are never looked at."""
    model = fit_on(docs, labels.where(~held_out(F.col(id_col))), id_col, text_col, label_col, **bounds)
    carried = Carried(docs, "held_out", "score", "predicted", "n_toxic", "spans")
    found = scorer(docs.sparkSession.sparkContext.broadcast(model))(F.col(carried.name(text_col)))
    return carried.df.withColumn("ll_found", found).select(
        *carried.back(),
        held_out(F.col(carried.name(id_col))).alias("held_out"),
        F.col("ll_found.score").alias("score"),
        (F.col("ll_found.score") >= threshold).cast("int").alias("predicted"),
        F.col("ll_found.n_toxic").alias("n_toxic"),
        F.col("ll_found.spans").alias("spans"),
    )
