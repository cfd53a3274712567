import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexloom.llm.line_dedup import dedup_lines
from lexloom.llm.mixing import SCHEDULES, invert, mix, segments, training_stream

WS = " \t\n\x0b\x0c\r"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LINE = "a line that is shared by several documents"


def brute_lines(rows, min_chars=20, min_docs=3):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(WS).translate(low)
    seen = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                seen[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(seen[key(x)]) < min_docs or i == max(seen[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_lines_against_brute_force(spark):
    rows = [
        (1, f"{LINE}\nown one"), (2, f"  {LINE.upper()}\t\n\nshort"), (3, f"x\n{LINE}"), (4, None), (5, ""), (6, f"{LINE}\n{LINE}"),
        (None, LINE), (7, "two documents hold this line only\nend"), (8, "two documents hold this line only"), (9, "É" * 25), (10, "é" * 25), (11, "É" * 25),
        (11, "É" * 25), (12, "short line\n" * 5), (13, "word " * 30_000),
    ]
    df = spark.createDataFrame([(i, t, "extra") for i, t in rows], "doc_id long, text string, ll_key string")
    out = dedup_lines(df).select("doc_id", F.col("line_dedup.n_lines"), F.col("line_dedup.n_dropped"), F.sha2(F.encode("text", "UTF-8"), 256), "ll_key").collect()
    assert sorted([tuple(r)[:4] for r in out], key=str) == brute_lines(rows)
    assert {r[4] for r in out} == {"extra"}


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert dedup_lines(empty).count() == 0
    assert mix(empty).count() == 0
    assert training_stream(empty).count() == 0


def corpus(spark):
    rows = [(i, " ".join(["w"] * (i % 50)), "en", None if i % 10 == 0 else f"s{i % 4}" if i % 3 else "hot", 0) for i in range(1, 400)]
    rows += [(1000, None, "en", "s1", 0), (1001, "", "en", "none", 0), (7, "same id again", "en", "s1", 0), (2000, "x " * 3000, "en", "s3", 0)]
    return spark.createDataFrame(rows, DOCS), rows


def brute_targets(sizes):
    """Water-filling by repeated sharing."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, fixed, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while True:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return fixed | {s: left * weight[s] / total for s in open_}
        for s in over:
            fixed[s] = 2.0 * sizes[s]
        left -= sum(fixed[s] for s in over)
        open_ -= over


def test_mix_meets_targets(spark):
    df, rows = corpus(spark)
    out = mix(df).collect()
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for _, t, _, s, _ in rows:
        sizes[s] += len((t or "").split())
    want, taken = brute_targets(sizes), defaultdict(int)
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.5
    again = mix(df.repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_stream_takes_what_the_plan_says_in_order(spark):
    df, rows = corpus(spark)
    stream = training_stream(df).collect()
    assert [r["mix"]["position"] for r in stream] == sorted(r["mix"]["position"] for r in stream)
    assert all(len(r["text"].split()) == r["mix"]["taken"] for r in stream)
    plan = {(r["doc_id"], r["size"]): r["taken"] for r in mix(df).collect()}
    got = defaultdict(int)
    whole = {(i, len((t or "").split())): t for i, t, *_ in rows}
    for r in stream:
        size = next(k for k in whole if k[0] == r["doc_id"] and whole[k].startswith(r["text"]))
        got[size] += r["mix"]["taken"]
    assert got == {k: v for k, v in plan.items() if v}


@settings(max_examples=40, deadline=None)
@given(st.integers(0, len(SCHEDULES) - 1), st.floats(0, 1))
def test_schedules_integrate_to_one(slot, time):
    done = 0.0
    for begin, at, weight, slope in segments(SCHEDULES[slot]):
        if time >= at:
            t = time - at
            done = begin + weight * t + slope * t * t / 2
    assert 0 <= done <= 1 + 1e-9
    last = segments(SCHEDULES[slot])[-1]
    t = 1 - last[1]
    assert abs(last[0] + last[2] * t + last[3] * t * t / 2 - 1) < 1e-9


def test_inverse_of_the_schedule(spark):
    for slot, knots in enumerate(SCHEDULES):
        rows = spark.range(101).select(F.col("id"), invert(F.col("id") / 100, F.lit(slot)).alias("t")).collect()
        for r in rows:
            begin, at, weight, slope = [s for s in segments(knots) if r["t"] >= s[1] - 1e-12][-1]
            t = r["t"] - at
            assert abs(begin + weight * t + slope * t * t / 2 - r["id"] / 100) < 1e-9
