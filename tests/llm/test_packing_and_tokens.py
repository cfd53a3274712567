import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexloom.llm.packing import CapacityTree, best_fit_decreasing, pack
from lexloom.llm.tokens import at_limit, context_table, encoder, length_histogram, public_path

PATH = public_path("byte_bpe_50k.json")


def piecewise_bfd(lengths, window):
    """Best-fit decreasing one piece at a time: the remaining capacities of all sequences."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(left) if r >= n]
        if fits:
            i = min(fits, key=lambda i: left[i])
            left[i] -= n
        else:
            left.append(window - n)
    return Counter(left)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_histogram_packing_equals_piece_by_piece(lengths):
    packing = best_fit_decreasing(Counter(lengths), 40)
    used, ranks = defaultdict(list), defaultdict(list)
    for length, lo, hi, first, per, offset in packing.placements:
        ranks[length].append((lo, hi))
        for k in range(hi - lo):
            used[first + k // per].append((offset + k % per * length, length))
    for length, n in Counter(lengths).items():
        at = 0
        for lo, hi in sorted(ranks[length]):
            assert lo == at
            at = hi
        assert at == n
    left = []
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        left.append(40 - at)
    assert len(used) == packing.n_sequences and Counter(left) == piecewise_bfd(lengths, 40)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 64), max_size=20), st.integers(0, 64))
def test_capacity_tree(capacities, size):
    tree = CapacityTree(64)
    for c in capacities:
        tree.add(c, 1)
    assert tree.tightest(size) == min((c for c in capacities if c >= size), default=None)


def test_encoder_matches_the_library():
    from tokenizers import Tokenizer

    slow, fast = Tokenizer.from_file(PATH), encoder(PATH)
    rng = random.Random(1)
    texts = ["", " ", "a<|endoftext|>b", "Ünïcødé ㅎ 𝔘   x", "\ud800", "a" * 3000, "\n\n\t  x's'll 12345 !!??"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x2FFF)])) for _ in range(200)) for _ in range(50)]
    for t in texts:
        if "\ud800" not in t:
            assert fast(t).tolist() == slow.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("window", [16, 2048])
def test_pack_round_trip(spark, window):
    encode = encoder(PATH)
    rows = [(i, "word number %d " % i * (i % 37)) for i in range(300)] + [(500, None), (501, ""), (502, "long text " * 9000), (7, "same id again"), (None, "no id")]
    rows += [(600 + i, "one copy of a text") for i in range(400)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, length string, offset int")
    out = pack(df, path=PATH, window=window).collect()
    want = Counter()
    for i, t in rows:
        ids = np.append(encode(t or ""), 1).astype("<u4")
        for at in range(0, len(ids), window):
            piece = ids[at : at + window]
            want[i, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in out) == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    total = sum(r["length"] for r in out)
    assert len(sequences) <= total / window * 1.1 + 2
    assert pack(df.limit(0), path=PATH, window=window).count() == 0


def test_context_limits_against_brute_force(spark):
    encode = encoder(PATH)
    texts = ["some words " * (k % 23) for k in range(200)] + [None, "", "long " * 5000]
    lengths = [len(encode(t or "")) for t in texts]
    df = spark.createDataFrame([(t, 1) for t in texts], "text string, length int")
    table = context_table(length_histogram(df, path=PATH), block=16)
    rows = table.collect()
    assert sorted(r["context_limit"] for r in rows) == sorted(set(lengths))
    for r in rows:
        limit = r["context_limit"]
        assert r["n_docs"] == lengths.count(limit)
        assert r["docs_at_least"] == sum(x >= limit for x in lengths)
        assert r["tokens_at_least"] == sum(x for x in lengths if x >= limit)
        assert r["truncated_total"] == sum(min(x, limit) for x in lengths) and r["total_tokens"] == sum(lengths)
        assert abs(r["quantile"] - sum(x <= limit for x in lengths) / len(lengths)) < 1e-12
    for limit in (0, 1, 7, 30, 10**6):
        got = at_limit(table, limit).first()
        assert got["truncated_total"] == sum(min(x, limit) for x in lengths) and got["docs_cut"] == sum(x > limit for x in lengths)
    assert context_table(length_histogram(df.limit(0), path=PATH)).count() == 0
