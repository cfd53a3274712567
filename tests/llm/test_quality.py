from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lexloom.llm import quality as Q

WS = " \t\n\x0b\x0c\r"


def brute(text):
    text = text or ""
    words = [w for w in "".join(" " if c in WS else c for c in text).split(" ") if w]
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if line.strip(WS):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab #*\n\t é\x0b", max_size=120))
def test_signals_against_brute_force(text):
    s = Q.signals_of(text)
    assert (s["n_words"], s["word_chars"], s["n_symbols"], s["n_dup_lines"], s["n_repeat_words"]) == brute(text)


GOOD = "The quiet river runs past seven old mills, and nobody knows which of them was first built. " + " ".join(f"Word{c}{d} stands{d}{c} near {c}home{d}." for c in "abcdefghijkl" for d in "xyz")
JUNK = " ".join(f"w{i}%%% x$$$ &&&" for i in range(60))
LOOP = "again and again the same words " * 40


def test_em_prefers_clean_documents_and_rejects_junk(spark):
    rows = [(i, GOOD + f" tail{i}") for i in range(60)] + [(100 + i, JUNK) for i in range(6)] + [(200 + i, LOOP) for i in range(6)]
    rows += [(300, None), (301, ""), (302, "few words only"), (303, GOOD * 200)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, quality int, pattern int")
    for materialise in (True, False):
        out = {r["doc_id"]: r["quality"] for r in Q.quality(df, materialise=materialise).collect()}
        assert all(out[i]["kept"] for i in range(60))
        assert not any(out[i]["kept"] for i in (*range(100, 106), *range(200, 206), 300, 301, 302))
        assert out[300]["n_words"] == 0 and out[300]["base_failed"]
    assert Q.quality(spark.createDataFrame([], df.schema)).count() == 0


def test_fit_matches_em_written_out():
    rng = np.random.default_rng(0)
    docs = []
    for good in rng.random(2000) < 0.8:
        votes = [0 if rng.random() < 0.2 else (1 if good == (rng.random() < 0.85) else 2) for _ in Q.RULES]
        docs.append(votes)
    counts = Counter(Q.pattern_of(v) for v in docs)
    posterior, accuracy, share = Q.fit(dict(counts), rounds=30, tol=0)
    acc, p = np.array([[0.3] * len(Q.RULES), [0.98] * len(Q.RULES)]), 0.8
    for _ in range(30):
        post = []
        for v in docs:
            like = [1 - p, p]
            for c in (0, 1):
                for j, x in enumerate(v):
                    if x:
                        like[c] *= acc[c, j] if (x == 1) == (c == 1) else 1 - acc[c, j]
            post.append(like[1] / sum(like))
        post = np.array(post)
        for c, mass in ((0, 1 - post), (1, post)):
            for j in range(len(Q.RULES)):
                voted = np.array([v[j] != 0 for v in docs])
                right = np.array([v[j] == (1 if c else 2) for v in docs])
                acc[c, j] = np.clip(((2, 48)[c] + mass[right].sum()) / ((8, 48)[c] + mass[voted].sum()), 1e-4, 1 - 1e-4)
        p = (post.sum() + 1) / (len(docs) + 2)
    for v, x in zip(docs, post):
        assert abs(posterior[Q.pattern_of(v)] - x) < 1e-6
    assert abs(share - p) < 1e-9 and np.allclose(accuracy, acc)


def test_all_documents_are_fitted_and_get_the_posterior_of_their_pattern(spark):
    texts = [GOOD + f" tail{i}" for i in range(20)] + [JUNK] * 4 + [LOOP] * 5 + ["few words only"] * 7 + [None]
    counts = Counter(Q.pattern_of(Q.votes_of(Q.signals_of(t))) for t in texts)
    posterior, _, _ = Q.fit(dict(counts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["quality"] for r in Q.quality(df).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        assert abs(out[i]["posterior"] - posterior[Q.pattern_of(Q.votes_of(Q.signals_of(t)))]) < 1e-9
