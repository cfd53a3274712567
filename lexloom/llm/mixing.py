"""Mixing sources to target weights with a time-varying curriculum. DataFrame operations only.

Targets. Sources share ``share`` times all tokens by weight; none takes more than ``max_repeats``
times its own size, and what a capped source leaves is shared again. That water level has a closed
form: order the sources by cap over weight, and the first whose share at the running level fits
under its cap fixes the level for all that follow.

Curriculum. Each source's weight follows a piecewise linear schedule over training time 0..1. Its
integral, scaled to the target, is the source's cumulative token demand; a document that begins at
token c of its source's stream is read at the time at which the demand reaches c, so its training
position is the inverse of the integral at c. Output is range-sorted by position.

Streams. A source's documents run in the order of md5(seed, id). Their running token sums need no
task that holds a whole source: hashes are cut into buckets of a bounded share of the rows, bucket
sums are accumulated in a small table, and a window runs within each bucket.

Defined results: a null text has size 0; null sources are one source, last; a document of size 0 and
a source of size 0 take 0; repeated rows are documents of their own; an empty table gives an empty
table; the stream depends on ids and sizes only, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Carried, cut, group_target

#: weights over training time, by the slot of a source: knots of (time, relative weight).
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 0.75), (0.5, 1.25), (1.0, 0.75)),
)


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def segments(knots: tuple[tuple[float, float], ...]) -> list[tuple[float, float, float, float]]:
    """(demand share at its start, start time, weight there, slope) of each linear piece; the whole
    integral is scaled to 1."""
    area = sum((b - a) * (v + w) / 2 for (a, v), (b, w) in zip(knots, knots[1:]))
    out, done = [], 0.0
    for (a, v), (b, w) in zip(knots, knots[1:]):
        out.append((done, a, v / area, (w - v) / (b - a) / area))
        done += (b - a) * (v + w) / 2 / area
    return out


def invert(share: Column, slot: Column, schedules=SCHEDULES) -> Column:
    """Training time at which a source in ``slot`` has read ``share`` of its target."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        value = None
        for begin, at, weight, slope in segments(knots):
            left = share - begin
            # weight * t + slope * t**2 / 2 = left, in a form that also holds for slope 0
            t = 2 * left / (weight + F.sqrt(F.greatest(F.lit(0.0), weight * weight + 2 * slope * left)))
            value = at + t if value is None else F.when(share >= begin, at + t).otherwise(value)
        out = F.when(slot == k, value).otherwise(out)
    return out


def source_targets(slim: DataFrame, *, weights=(3, 1, 2), share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """A row for each source: ll_source, n_docs, source_size, slot, target.

    The two windows run over one row a source, after aggregation.
    """
    totals = slim.groupBy("ll_source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("ll_source").isNull(), "ll_source")) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    whole, before = Window.partitionBy(F.lit(0)), by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    t = totals.withColumn("rank", rank).withColumn("w", w).withColumn("cap", F.col("source_size") * max_repeats)
    t = t.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("open_w", F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    t = t.withColumn("level", (F.sum("source_size").over(whole) * F.lit(share) - F.col("capped")) / F.col("open_w"))
    t = t.withColumn("fits", F.col("level") * F.col("w") <= F.col("cap"))
    t = t.withColumn("level", F.min_by(F.when(F.col("fits"), F.col("level")), F.when(F.col("fits"), F.struct(F.col("cap") / F.col("w"), "rank"))).over(whole))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("w"), F.col("cap").cast("double")))
    return t.select("ll_source", "n_docs", "source_size", (F.col("rank") % len(SCHEDULES)).alias("slot"), target.alias("target"))


def plan_mix(slim: DataFrame, *, keep: tuple[str, ...] = (), seed: str = "mix", weights=(3, 1, 2), share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """From (ll_id, ll_source, size) rows: those with source_size, target, ``start`` (tokens before the
    document in its source's stream), ``parts`` (an array of (epoch, taken, position) for what the mix
    reads of it) and ``taken``, their sum.

    ``keep`` names further columns that come along and break ties. An epoch is one pass over the source's stream; the pass in which the target is reached is cut
    inside a document, so each source's total is its target rounded to a whole token.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("ll_id").cast("string"), F.lit(""))))
    slim = cut(slim.withColumn("ll_hash", digest), "mix-slim")
    targets = source_targets(slim, weights=weights, share=share, max_repeats=max_repeats)
    per = group_target(slim.count())
    buckets = F.ceil(F.col("n_docs") / per).cast("long")
    bucket = F.floor(F.conv(F.substring("ll_hash", 1, 8), 16, 10).cast("long") * F.col("n_buckets") / F.lit(2**32)).cast("long")
    targets = cut(targets.withColumn("n_buckets", buckets).withColumn("ll_skey", F.coalesce(F.concat(F.lit("s"), "ll_source"), F.lit("null"))), "mix-targets")
    slim = slim.withColumn("ll_skey", F.coalesce(F.concat(F.lit("s"), "ll_source"), F.lit("null"))).drop("ll_source")
    rows = slim.join(targets, "ll_skey").withColumn("ll_bucket", bucket)
    sums = rows.groupBy("ll_skey", "ll_bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("ll_skey").orderBy("ll_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("ll_skey", "ll_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ll_offset"))
    within = Window.partitionBy("ll_skey", "ll_bucket").orderBy("ll_hash", "ll_id", "size", *keep).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ll_inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(offsets, ["ll_skey", "ll_bucket"]).withColumn("start", F.col("ll_inside") + F.col("ll_offset"))
    goal, parts = F.floor(F.col("target") + 0.5).cast("long"), []
    for epoch in range(max_repeats):
        begin = F.col("start") + epoch * F.col("source_size")
        got = F.greatest(F.lit(0), F.least(F.col("size"), goal - begin)).cast("long")
        parts.append(F.struct(F.lit(epoch).alias("epoch"), got.alias("taken"), invert(begin / F.greatest(F.col("target"), F.lit(1.0)), F.col("slot")).alias("position")))
    rows = rows.withColumn("parts", F.filter(F.array(*parts), lambda p: p["taken"] > 0))
    taken = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["taken"])
    return rows.select("ll_id", *keep, "ll_source", "size", "source_size", "target", "start", "parts", taken.alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The plan for ``docs`` measured in words, one row a document, range-sorted by its first position
    (documents that the mix leaves out come last). Options as for plan_mix()."""
    slim = docs.select(F.col(id_col).alias("ll_id"), F.col(source_col).cast("string").alias("ll_source"), words_in(F.col(text_col)).alias("size"))
    plan = plan_mix(slim, **options).withColumn("position", F.get("parts", F.lit(0))["position"])
    return plan.orderBy(F.col("position").asc_nulls_last(), "ll_id").withColumnsRenamed({"ll_id": id_col, "ll_source": source_col})


def training_stream(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as the mix reads them, in training order: a document once an epoch that
    reads it, its text cut after the words taken; a struct column ``mix`` has epoch, taken and position.

    Texts meet their part of the plan by id, source, size and a hash, in one shuffle; of rows equal in all
    four each takes one part. A second shuffle sorts them. An input column named ``mix`` comes back as
    ``input_mix``.
    """
    on = ["ll_key", "ll_src", "ll_size", "ll_text"]
    carried = Carried(docs, "mix")
    text = carried.name(text_col)
    marked = lambda c: F.coalesce(F.concat(F.lit("s"), c), F.lit("null"))
    keyed = carried.df.withColumns({
        "ll_key": F.coalesce(F.col(carried.name(id_col)).cast("string"), F.lit("null")),
        "ll_src": marked(F.col(carried.name(source_col)).cast("string")),
        "ll_size": words_in(F.col(text)),
        "ll_text": F.xxhash64(text),
    })
    slim = keyed.select(F.col("ll_key").alias("ll_id"), F.col(carried.name(source_col)).cast("string").alias("ll_source"), F.col("ll_size").alias("size"), "ll_text")
    plan = plan_mix(slim, keep=("ll_text",), **options).select(F.col("ll_id").alias("ll_key"), marked(F.col("ll_source")).alias("ll_src"), F.col("size").alias("ll_size"), "ll_text", "start", "parts")
    plan = plan.groupBy(*on).agg(F.array_sort(F.collect_list(F.struct("start", "parts"))).alias("ll_copies")).where(F.exists("ll_copies", lambda c: F.size(c["parts"]) > 0))
    rows = keyed.join(plan, on).withColumn("ll_nth", F.row_number().over(Window.partitionBy(*on).orderBy(F.lit(0))))
    rows = rows.withColumn("mix", F.explode(F.get("ll_copies", F.col("ll_nth") - 1)["parts"]))
    # a word with the white space around it, so that a whole text comes back as it was
    pieces = F.split(F.col(text), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    first_is_space = F.when(F.col(text).rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    head = F.array_join(F.slice(pieces, F.lit(1), (F.col("mix.taken") + first_is_space).cast("int")), "")
    read = F.when(F.col("mix.taken") < F.col("ll_size"), head).otherwise(F.col(text))
    return rows.orderBy("mix.position", "ll_key").select(*carried.back(**{text_col: read}), "mix")
