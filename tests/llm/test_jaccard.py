import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexloom.llm import jaccard as J
from lexloom.llm.components import components


def brute_sets(rows, n):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = {}
    for i, t in rows:
        w = (t or "").translate(low).replace("\t", " ").replace("\n", " ").split(" ")
        w = [x for x in w if x]
        out[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    return out


def brute_components(rows, n, percent):
    sets = brute_sets(rows, n)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed, sizes, vocabulary=3000):
    """Groups of near copies of all sizes, chains, shared passages, exact copies, short and empty texts."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(60)]
    rows, i = [], 0
    for size in sizes:
        base = [f"w{rng.randrange(vocabulary)}" for _ in range(size)] + (passage if rng.random() < 0.3 else [])
        for _ in range(rng.randrange(1, 7)):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + max(1, len(text) // 40))):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            rows.append((i, " ".join(text) if rng.random() < 0.8 else " ".join(text).upper()))
            i += 1
            if rng.random() < 0.4:  # the next differs from this one, so similarity runs in chains
                base = text
    rows += [(i, None), (i + 1, ""), (i + 2, "one"), (i + 3, "ONE"), (i + 4, "one two"), (i + 5, "one  two\n"), (i + 6, " \t\n")]
    return rows


@pytest.mark.parametrize(("n", "percent", "seed"), [(3, 90, 1), (3, 90, 2), (5, 80, 3), (2, 80, 4)])
def test_components_against_brute_force(spark, n, percent, seed):
    rng = random.Random(seed)
    rows = corpus(seed, [rng.choice([3, 9, 10, 11, 12, 15, 19, 20, 21, 25, 29, 30, 40, 60, 150, 400]) for _ in range(90)])
    df = spark.createDataFrame([(i, t, 5, "k") for i, t in rows], "doc_id long, text string, n int, cls string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df, n_gram=n, percent=percent).collect()}
    assert got == brute_components(rows, n, percent)
    assert len({c for _, c in got.values()}) < len(rows) - 30


@pytest.mark.parametrize("boundary", [2, 10, 15, 21, 30])
def test_any_boundary_gives_the_same_links(spark, monkeypatch, boundary):
    monkeypatch.setattr(J, "best_boundary", lambda *a, **k: boundary)
    rows = corpus(7, [8, 9, 10, 11, 13, 18, 19, 20, 22, 28, 31, 33] * 3, vocabulary=60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df, n_gram=1, percent=90).collect()}
    assert got == brute_components(rows, 1, 90)


def test_frequent_passages_and_large_group(spark, monkeypatch):
    rng = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(40))
    base = [f"b{k}" for k in range(120)]
    rows = [(i, passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(25))) for i in range(150)]
    for i in range(150, 330):
        text = list(base)
        for _ in range(rng.randrange(0, 4)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join(base)) for i in range(330, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df, n_gram=3, percent=90).collect()}
    assert got == brute_components(rows, 3, 90)


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (2, "a b c d e"), (2, "other words are here now")], "doc_id long, text string")
    got = sorted([tuple(r) for r in J.jaccard_components(df, n_gram=3, percent=90).collect()], key=str)
    assert got == sorted([(None, 3, None), (3, 3, 2), (2, 3, 2), (2, 3, 2)], key=str)
    assert J.jaccard_components(df.limit(0)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB é\n\t", max_size=30), max_size=8), st.integers(1, 4))
def test_shingles_count_distinct_windows(texts, n):
    found = list(J.shingles_of(pa.array(texts, pa.string()), n))
    sets = brute_sets(list(enumerate(texts)), n)
    assert [len(x) for x in found] == [len(sets[i]) for i in range(len(texts))]
    for x in found:
        assert (np.diff(x.astype(object)) > 0).all()


def test_long_text_in_blocks():
    words = [f"w{i % 977}{i % 31}" for i in range(400_000)]
    x = J.shingles(" ".join(words), 3)
    assert len(x) == len(set(zip(words, words[1:], words[2:])))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 28), st.integers(0, 4), st.integers(0, 4), st.sampled_from([80, 90]))
def test_similar_small_sets_share_a_signature(n, lost, added, percent):
    x = J.mix64(np.arange(n, dtype=np.uint64))
    y = np.sort(np.concatenate([x[lost:], J.mix64(np.arange(1000, 1000 + added, dtype=np.uint64))]))
    both, united = max(0, n - lost), n + added
    if both and 100 * both >= percent * united and len(y) < 30:
        a, b = (set(J.subset_signatures(np.sort(s), 30, percent).tolist()) for s in (x, y))
        assert a & b


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 150), st.floats(0, 0.3), st.floats(0, 0.3), st.sampled_from([50, 80, 90]), st.sampled_from([0, 0.3, 0.9, 1]), st.integers(0, 2**32))
def test_similar_sets_share_a_part(n, lost, added, percent, often, seed):
    rng = np.random.default_rng(seed)
    x = np.unique(J.mix64(rng.integers(0, 2**62, n).astype(np.uint64)))
    y = np.unique(np.concatenate([x[int(lost * len(x)) :], J.mix64(rng.integers(0, 2**62, int(added * n)).astype(np.uint64))]))
    both = len(np.intersect1d(x, y))
    if len(y) and 100 * both >= percent * (len(x) + len(y) - both):
        frequent = np.sort(np.array([t for t in np.union1d(x, y) if rng.random() < often], np.uint64))
        a, b = (J.part_signatures(s, J._is_frequent(s, frequent)[0], percent) for s in (x, y))
        assert len(np.intersect1d(a, b))


def test_size_groups_hold_similar_sizes():
    for percent in (50, 80, 90, 100):
        for n in range(1, 400):
            keys = {k: p for k, _, p in J.part_counts(n, percent)}
            for m in range(n, 100 * n // percent + 1):
                shared = {k for k, _, p in J.part_counts(m, percent) if keys.get(k) == p}
                assert J.size_group(n, percent)[0] in shared
                differ = {d for k, d, _ in J.part_counts(m, percent) if k == J.size_group(n, percent)[0]}
                assert n + m - 2 * J.least_overlap(n, m, percent) <= max(differ)


def test_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(1000, 2000), (2000, 1500)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 2000: 1000, 1500: 1000}
    assert components(links.limit(0)).count() == 0
