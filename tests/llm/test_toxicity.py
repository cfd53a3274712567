import random
import zlib

import numpy as np
import pytest

from lexloom.llm import toxicity as X


@pytest.mark.parametrize("lengths", [(0, 1, 2, 5, 0), (255, 256, 257, 3), (512, 513, 1300, 1), (0,), ()])
def test_marginals_against_forward_backward(lengths):
    rng = np.random.default_rng(len(lengths))
    chain = np.log(np.array([[0.9, 0.1], [0.3, 0.7]])) + rng.normal(size=(2, 2))
    sequences = [rng.normal(size=n) * 4 for n in lengths]
    a = np.exp(chain)
    for e, got in zip(sequences, X.marginals(chain, sequences)):
        node = np.stack([np.ones(len(e)), np.exp(e)], 1)
        alpha, beta = node.copy(), np.ones_like(node)
        for t in range(1, len(e)):
            alpha[t] = node[t] * (alpha[t - 1] @ a)
            alpha[t] /= alpha[t].sum()
        for t in range(len(e) - 2, -1, -1):
            beta[t] = a @ (node[t + 1] * beta[t + 1])
            beta[t] /= beta[t].sum()
        p = alpha * beta
        assert len(got) == len(e) and np.allclose(np.log(p[:, 1] / p[:, 0]), got, atol=1e-7)


BAD, STEMS = ["grubling", "wretchle", "blightor"], ["vorka", "zemmu"]


def corpus(n, seed=4, noise=0.0):
    """Clean words, and in toxic texts a few marks: whole words or stems with free endings."""
    rng = random.Random(seed)
    syllables = "ta re mo li su ne po ka di ro".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows = []
    for i in range(n):
        toxic = rng.random() < 0.2
        words = [word() for _ in range(rng.choice([8, 60, 400]))]
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                mark = rng.choice(BAD) if rng.random() < 0.6 else rng.choice(STEMS) + word()
                words.insert(rng.randrange(len(words)), mark)
        rows.append((i, " ".join(words).capitalize(), int(toxic) if rng.random() >= noise else 1 - int(toxic), int(toxic)))
    return rows


def test_held_out_accuracy_and_spans(spark):
    rows = corpus(1500)
    docs = spark.createDataFrame([(i, t, "x") for i, t, *_ in rows] + [(5000, None, "x"), (5001, "", "x"), (None, "clean tare", "x"), (5002, "tare mo li " * 30000 + "grubling", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, label) for i, _, label, _ in rows] + [(None, 1), (7000, 1), (1, None)], "doc_id long, toxic int")
    out = X.score_toxicity(docs, labels)
    assert out.columns[:3] == ["doc_id", "text", "input_score"]
    out = out.collect()
    assert {r["input_score"] for r in out} == {"x"}
    assert len(out) == len(rows) + 4
    got, truth = {r["doc_id"]: r for r in out}, {i: t for i, _, _, t in rows}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out if r["doc_id"] is not None)
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 300
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    assert got[5000]["score"] == got[5001]["score"] < 0.5 and got[5000]["spans"] == []
    assert got[5002]["predicted"] == 1
    texts = {i: t for i, t, *_ in rows}
    spans = [texts[r["doc_id"]][s["start"] : s["end"]].lower() for r in held for s in r["spans"]]
    assert np.mean([s in BAD or s.startswith(tuple(STEMS)) for s in spans]) > 0.95


def test_labels_of_held_out_documents_are_never_used(spark):
    rows = corpus(600, seed=8)
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows], "doc_id long, text string")
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    scores = []
    for flip in (False, True):
        labels = spark.createDataFrame([(i, 1 - y if flip and held(i) else y) for i, _, y, _ in rows], "doc_id long, toxic int")
        scores.append(sorted((r["doc_id"], r["score"]) for r in X.score_toxicity(docs, labels).collect()))
    assert scores[0] == scores[1]


def test_noisy_labels(spark):
    rows = corpus(1500, seed=9, noise=0.03)
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y, _ in rows], "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in X.score_toxicity(docs, labels).collect()}
    held = [(out[i]["predicted"], t) for i, _, _, t in rows if out[i]["held_out"]]
    assert np.mean([p == t for p, t in held]) > 0.95


def test_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 1)], [(1, 0), (2, 0)]):
        out = X.score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert [(r["score"], r["predicted"], r["spans"]) for r in out] == [(0.5, 0, [])] * 2
    assert X.score_toxicity(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_features_are_the_same_alone_and_together():
    words = ["a", "loser", "Loser", "ünïcode", "x" * 200, "a-b"]
    flat, begin = X.piece_table(words)
    parts = np.split(flat, begin[1:])
    for w, part in zip(words, parts):
        assert sorted(part.tolist()) == sorted(X.piece_table([w])[0].tolist())
    assert sorted(parts[1].tolist()) == sorted(parts[2].tolist())


def test_what_follows_character_64_of_a_token_counts():
    clean, toxic = "_".join(["tare"] * 20), "_".join(["tare"] * 20 + ["grubling"])
    rows = [(t, bool(y)) for _, t, y, _ in corpus(600, seed=3)]
    rows += [("_".join([*"tare mo li su ne".split() * 5, m]), m == "grubling") for m in ["grubling", "kadiro"] * 20]
    model = X.train([t for t, _ in rows], [y for _, y in rows])
    low, high = model.evidence([clean, toxic])
    assert high > low
    words = [clean, toxic, "a" * 5000, "b"]
    flat, begin = X.piece_table(words)
    assert [len(x) for x in np.split(flat, begin[1:])] == [1 + sum(max(0, len(w) + 3 - n) for n in (3, 4, 5)) for w in words]
    memo = X._Memo()
    assert np.allclose(memo.of(model, [words, ["x" * 600_000, "b"]])[0], model.evidence(words), atol=1e-4)
