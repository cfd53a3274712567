import hashlib
import random
from itertools import combinations

import numpy as np
import pytest

from lexloom.llm import fingerprint as S
from lexloom.llm.common import cut

SCHEMA = "doc_id long, text string, fp_hi string"


def rows_of(n, seed=1):
    rng = random.Random(seed)
    return [(i * 3, " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 11))) for _ in range(rng.randrange(0, 120))), "x") for i in range(n)]


@pytest.mark.parametrize("per_bucket", [1, 7, 1000])
def test_edited_texts_and_likeness(spark, per_bucket):
    rows = rows_of(60) + [(500, None, "x"), (501, "", "x"), (502, "é ü 𝔘𝔘 word", "x"), (503, " \t\n", "x"), (504, "long word " * 20000, "x"), (505, rows_of(60)[3][1], "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r["doc_id"]: r for r in S.op_columns(cut(S.edited_fingerprints(df, rows_per_bucket=per_bucket), "fps")).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(out) == len(rows)
    for k, (i, t, _) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)]
        half = len(t) // 2
        edited = t[: len(t) - half] + (after[1] or "")[:half]
        r = out[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        apart = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1") / 128
        assert abs(r["near_edited"] - (1 - apart(r["fingerprint"], r["edited_fingerprint"]))) < 1e-12
        assert abs(r["near_next"] - (1 - apart(r["fingerprint"], out[after[0]]["fingerprint"]))) < 1e-12
    assert out[9]["fingerprint"] == out[505]["fingerprint"] and int(out[500]["fingerprint"], 16) == 0


def test_single_rows_ties_and_empty(spark):
    one = spark.createDataFrame([(4, "only one document here", "x")], SCHEMA)
    r = S.op_columns(cut(S.edited_fingerprints(one), "fps")).first()
    assert r["near_next"] == 1.0
    assert S.op_columns(cut(S.edited_fingerprints(one.limit(0)), "fps")).count() == 0
    tied = spark.createDataFrame([(4, "a first text", "x"), (4, "a second text", "x"), (None, "no id", "x"), (4, "a first text", "x")], SCHEMA)
    assert S.op_columns(cut(S.edited_fingerprints(tied), "fps")).count() == 4
    assert S.fingerprints(tied).count() == 2


def test_votes_against_brute_force(spark):
    rows = rows_of(40, seed=5)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: (r["fp_hi"], r["fp_lo"]) for r in S.fingerprints(df).collect()}
    words = sorted({w for _, t, _ in rows for w in t.split()})
    hashed = spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", "xxhash64(w) AS a", "xxhash64(1, w) AS b").collect()
    h = {r["w"]: (r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in hashed}
    for i, t, _ in rows:
        votes = np.zeros((2, 64))
        for w in t.split():
            weight = 1 if len(w) <= 3 else 4 * (min(len(w), 16) - 3)
            for k in (0, 1):
                votes[k] += weight * np.array([1 if h[w][k] >> b & 1 else -1 for b in range(64)])
        want = [sum(1 << b for b in range(64) if votes[k][b] > 0) for k in (0, 1)]
        if i in got:
            assert [x & (2**64 - 1) for x in got[i]] == want
        else:
            assert t == ""


@pytest.mark.parametrize(("radius", "keep"), [(3, 2), (5, 3), (0, 1)])
def test_search_finds_all_within_the_radius(spark, radius, keep):
    rng = random.Random(radius)
    base = [(rng.getrandbits(64), rng.getrandbits(64)) for _ in range(30)]
    fps = set(base)
    for hi, lo in base:
        for _ in range(6):
            flips = rng.sample(range(128), rng.randrange(0, radius + 3))
            x = (hi << 64 | lo) ^ sum(1 << b for b in flips)
            fps.add((x >> 64, x & (2**64 - 1)))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    fps = sorted((signed(a), signed(b)) for a, b in fps)
    df = spark.createDataFrame(fps + fps[:5], "fp_hi long, fp_lo long")
    got = {(r["q_hi"], r["q_lo"], r["fp_hi"], r["fp_lo"]): r["distance"] for r in S.hamming_search(df, df, radius=radius, keep=keep).collect()}
    mask = 2**64 - 1
    apart = lambda a, b: bin((a[0] ^ b[0]) & mask).count("1") + bin((a[1] ^ b[1]) & mask).count("1")
    want = {(*a, *a): 0 for a in fps}
    for a, b in combinations(fps, 2):
        if apart(a, b) <= radius:
            want[(*a, *b)] = want[(*b, *a)] = apart(a, b)
    assert got == want


def test_query_counts_documents_within_the_radius(spark):
    rng = random.Random(9)
    base = " ".join(f"word{rng.randrange(5000)}" for _ in range(400))
    rows = [(i, base if i % 3 else base + " more") for i in range(0, 900, 10)] + [(i, f"own text {i} " * 5) for i in range(1, 40)] + [(1000, None), (1100, ""), (None, base)]
    out = S.op_columns(cut(S.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")), "fps")).collect()
    far = lambda a, b: (int(a["fingerprint"], 16) ^ int(b["fingerprint"], 16)).bit_count()
    for r in out:
        within = [x for x in out if far(r, x) <= 3]
        if r["doc_id"] is not None and r["doc_id"] % 100 == 0:
            assert (r["n_within"], r["first_within"]) == (len(within), min(x["doc_id"] for x in within if x["doc_id"] is not None))
        else:
            assert r["n_within"] is None and r["first_within"] is None
