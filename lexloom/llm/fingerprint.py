"""SimHash document fingerprints and the search within a Hamming radius. DataFrame operations only.

Fingerprint. The terms of a text are its words; a term weighs 1 if it has up to three characters and
four times the further characters (sixteen at most count) otherwise, so that words which every text
has say little. Each of 128 hash bits gets the term's weight as a vote, for or against, and the sign
of the sum is the bit. Votes are summed two bits to a long, 64 sums in all, in one grouped pass over
the exploded words.

Search. Fingerprints are cut into ``radius + keep`` blocks; of two within the radius at least ``keep``
blocks are equal, so one table for each choice of ``keep`` blocks, joined on those bits, finds every
pair. Equal fingerprints are one entry of the tables.

Neighbours. The next document in descending id order comes from windows over id ranges of bounded
size (their limits are quantiles of the ids); the first row of each range is copied into the range
before it, so no task sorts the whole table and a text is shuffled once.

Defined results: a null text is empty; a text without words has fingerprint 0; a null id orders after
all others; rows that share an id are ordered by a hash of their text; a table of one row follows
itself; an empty table gives an empty table.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE

BITS = 128
_LANES = (1 << 32) | 1


def _weight(word: Column) -> Column:
    n = F.least(F.char_length(word), F.lit(16))
    return F.when(n <= 3, 1).otherwise(4 * (n - 3)).cast("long")


def _words(text: Column) -> Column:
    return F.split(F.trim(text, F.lit(SPACE)), r"[\x20\x09-\x0D]+")


def simhash(rows: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """A row for each distinct ``keys`` with ``fp_hi`` and ``fp_lo``, the two halves of the fingerprint of
    its texts together."""
    words = rows.select(*keys, F.explode(_words(F.col(text_col))).alias("ll_word"))
    words = words.select(*keys, F.xxhash64("ll_word").alias("h0"), F.xxhash64(F.lit(1), "ll_word").alias("h1"), F.when(F.col("ll_word") == "", 0).otherwise(_weight(F.col("ll_word"))).alias("w"))
    lane = lambda h, i: F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_LANES)) * F.col("w")
    sums = [F.sum(lane(h, i)).alias(f"{h}_{i}") for h in ("h0", "h1") for i in range(32)]
    sums = words.groupBy(*keys).agg(F.sum("w").alias("w"), *sums)

    def half(h: str) -> Column:
        out = F.lit(0).cast("long")
        for i in range(32):
            votes = F.col(f"{h}_{i}")
            for bit, ones in ((i, votes.bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(votes, 32))):
                mask = 1 << bit if bit < 63 else -(1 << 63)
                out = out.bitwiseOR(F.when(2 * ones > F.col("w"), F.lit(mask)).otherwise(F.lit(0)).cast("long"))
        return out

    return sums.select(*keys, half("h0").alias("fp_hi"), half("h1").alias("fp_lo"))


def as_text(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def distance(hi_a: Column, lo_a: Column, hi_b: Column, lo_b: Column) -> Column:
    return F.bit_count(hi_a.bitwiseXOR(hi_b)) + F.bit_count(lo_a.bitwiseXOR(lo_b))


def likeness(hi_a: Column, lo_a: Column, hi_b: Column, lo_b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - distance(hi_a, lo_a, hi_b, lo_b) / F.lit(float(BITS))


def _tables(hi: Column, lo: Column, radius: int, keep: int) -> Column:
    """The key of a fingerprint in each block table."""
    n = radius + keep
    edges = [BITS * k // n for k in range(n + 1)]

    def bits(a: int, b: int) -> Column:
        parts = []
        for word, base in ((lo, 0), (hi, 64)):
            x, y = max(a, base) - base, min(b, base + 64) - base
            if x < y:
                mask = (1 << (y - x)) - 1
                v = F.shiftrightunsigned(word, x)
                parts.append(v if mask == (1 << 64) - 1 else v.bitwiseAND(F.lit(mask)))
        return F.concat_ws(".", *[p.cast("string") for p in parts])

    blocks = [bits(a, b) for a, b in zip(edges, edges[1:])]
    return F.array(*[F.concat_ws(":", F.lit(t), *[blocks[k] for k in chosen]) for t, chosen in enumerate(combinations(range(n), keep))])


def hamming_search(queries: DataFrame, corpus: DataFrame, *, radius: int = 3, keep: int = 2) -> DataFrame:
    """Pairs of distinct fingerprints (q_hi, q_lo, fp_hi, fp_lo, distance) within ``radius``: one from
    ``queries``, one from ``corpus``, both with columns fp_hi and fp_lo. Join rows back by fingerprint."""
    q = queries.select(F.col("fp_hi").alias("q_hi"), F.col("fp_lo").alias("q_lo")).distinct()
    c = corpus.select("fp_hi", "fp_lo").distinct()
    q = q.withColumn("ll_key", F.explode(_tables(F.col("q_hi"), F.col("q_lo"), radius, keep)))
    c = c.withColumn("ll_key", F.explode(_tables(F.col("fp_hi"), F.col("fp_lo"), radius, keep)))
    d = distance(F.col("q_hi"), F.col("q_lo"), F.col("fp_hi"), F.col("fp_lo"))
    return q.join(c, "ll_key").withColumn("distance", d).where(F.col("distance") <= radius).drop("ll_key").distinct()


def id_buckets(ids: DataFrame, id_col: str, *, rows_per_bucket: int = 1000, max_buckets: int = 16384) -> tuple[Column, list[tuple]]:
    """A column that numbers id ranges of about equal counts, and (bucket, largest id) of each that has rows."""
    n = ids.count()
    k = max(1, min(max_buckets, n // rows_per_bucket))
    splits = []
    if k > 1:
        shares = F.array(*[F.lit(i / k) for i in range(1, k)])
        splits = sorted(set(ids.agg(F.percentile_approx(id_col, shares, max(10_000, 20 * k))).first()[0] or []))
    side = max(1, round(len(splits) ** 0.5))
    groups = [splits[i : i + side] for i in range(0, len(splits), side)]
    if not groups:
        bucket = F.lit(0)
    else:
        below = lambda values: F.size(F.filter(values, lambda x: x < F.col(id_col)))
        tops = F.array(*[F.lit(g[-1]) for g in groups])
        table = F.array(*[F.array(*[F.lit(x) for x in g]) for g in groups], F.array(F.lit(splits[-1])))
        bucket = F.coalesce(below(tops) * side + below(F.element_at(table, below(tops) + 1)), F.lit(0))
    tops = ids.groupBy(bucket.alias("b")).agg(F.max(id_col).alias("top")).collect()
    return bucket, sorted(((r["b"], r["top"]) for r in tops), key=lambda r: r[0])


def with_next(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """(ll_bucket, ll_row, ll_id, ll_text, ll_next): each row with the text of the next in descending id
    order; after the last comes the first."""
    slim = docs.select(F.col(id_col).alias("ll_id"), F.coalesce(F.col(text_col), F.lit("")).alias("ll_text"))
    bucket, tops = id_buckets(slim.select("ll_id"), "ll_id", **options)
    # the first row of each range is also the last of the range before it
    before = {b: tops[(i + 1) % len(tops)][0] for i, (b, _) in enumerate(tops)}
    top, prior = F.lit(None), F.lit(None).cast("int")
    if tops:
        kind = slim.schema["ll_id"].dataType
        pick = lambda values, t: F.element_at(F.array(*[F.lit(v).cast(t) for v in values]), F.col("ll_bucket") + 1)
        known = dict(tops)
        spread = range(max(known) + 1)
        top, prior = pick([known.get(b) for b in spread], kind), pick([before.get(b) for b in spread], "int")
    rows = slim.withColumn("ll_bucket", bucket)
    copies = F.array(F.struct(F.col("ll_bucket").alias("b"), F.lit(False).alias("copy")), F.when(F.col("ll_id").eqNullSafe(top), F.struct(prior.alias("b"), F.lit(True).alias("copy"))))
    rows = rows.withColumn("ll_at", F.explode(F.filter(copies, lambda x: x.isNotNull())))
    rows = rows.select("ll_id", "ll_text", F.col("ll_at.b").alias("ll_bucket"), F.col("ll_at.copy").alias("ll_copy"), F.xxhash64("ll_text").alias("ll_tie"))
    order = Window.partitionBy("ll_bucket").orderBy("ll_copy", F.col("ll_id").desc_nulls_last(), "ll_tie", "ll_text")
    rows = rows.withColumn("ll_next", F.lead("ll_text").over(order)).withColumn("ll_row", F.row_number().over(order))
    return rows.where(~F.col("ll_copy")).select("ll_bucket", "ll_row", "ll_id", "ll_text", "ll_next")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, fp_hi, fp_lo and the fingerprint as text; rows that share an id share one."""
    rows = docs.select(F.col(id_col).alias("ll_id"), F.coalesce(F.col(text_col), F.lit("")).alias("ll_text"))
    out = simhash(rows, ["ll_id"], "ll_text")
    return out.select(F.col("ll_id").alias(id_col), "fp_hi", "fp_lo", as_text(F.col("fp_hi"), F.col("fp_lo")).alias("fingerprint"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Each document's fingerprint beside that of its edited text, whose last half is replaced by the
    beginning of the next document, and beside that of the next document."""
    rows = with_next(docs, id_col, text_col, **options)
    n = F.char_length("ll_text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long"))
    edited = F.concat(F.substring(F.col("ll_text"), F.lit(1), n - half), F.substring(F.col("ll_next"), F.lit(1), half))
    rows = rows.withColumn("ll_edited", edited).withColumn("edited_sha256", F.sha2(F.encode(F.col("ll_edited"), "UTF-8"), 256))
    both = F.array(F.struct(F.lit(0).alias("which"), F.col("ll_text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("ll_edited").alias("t")))
    keys = ["ll_bucket", "ll_row", "ll_id", "n_chars", "edited_sha256"]
    rows = rows.select(*keys, F.explode(both).alias("ll_v")).select(*keys, F.col("ll_v.which").alias("which"), F.col("ll_v.t").alias("t"))
    fps = simhash(rows, [*keys, "which"], "t")
    side = lambda c, k: F.max(F.when(F.col("which") == k, F.col(c)))
    docs_fp = fps.groupBy(*keys).agg(side("fp_hi", 0).alias("hi"), side("fp_lo", 0).alias("lo"), side("fp_hi", 1).alias("e_hi"), side("fp_lo", 1).alias("e_lo"))
    return docs_fp


def documents_within(fps: DataFrame, asked: Column, *, radius: int = 3, keep: int = 2) -> DataFrame:
    """For each distinct fingerprint (q_hi, q_lo) of the rows that are ``asked``: how many documents of ``fps``
    (ll_id, hi, lo) have one within ``radius``, and the smallest id among them. Pairs are of distinct
    fingerprints; copies are counted, not expanded."""
    corpus = fps.groupBy(F.col("hi").alias("fp_hi"), F.col("lo").alias("fp_lo")).agg(F.count("*").alias("n"), F.min("ll_id").alias("first"))
    queries = fps.where(asked).select(F.col("hi").alias("fp_hi"), F.col("lo").alias("fp_lo"))
    pairs = hamming_search(queries, corpus, radius=radius, keep=keep).join(corpus, ["fp_hi", "fp_lo"])
    return pairs.groupBy("q_hi", "q_lo").agg(F.sum("n").alias("n_within"), F.min("first").alias("first_within"))


def op_columns(fps: DataFrame, id_col: str = "doc_id", *, radius: int = 3, every: int = 100) -> DataFrame:
    """The columns of the query, with the likeness to the next document, whose fingerprint comes from the
    same table: rows are numbered along the descending order, and row k meets row k + 1. Rows whose id is
    divisible by ``every`` are queries of the Hamming search against all rows: ``n_within`` documents (itself
    included) lie within ``radius``, ``first_within`` is the smallest id of them; other rows have null there.
    """
    asked = F.col("ll_id") % every == 0
    near = documents_within(fps, asked, radius=radius)
    sizes = fps.groupBy("ll_bucket").agg(F.max("ll_row").alias("n"))
    down = Window.orderBy(F.desc("ll_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    offsets = sizes.select("ll_bucket", F.coalesce(F.sum("n").over(down), F.lit(0)).alias("ll_before"), F.sum("n").over(whole).alias("ll_all"))
    rows = fps.join(F.broadcast(offsets), "ll_bucket").withColumn("ll_at", F.col("ll_before") + F.col("ll_row") - 1)
    after = rows.select(F.pmod(F.col("ll_at") - 1, F.col("ll_all")).alias("ll_at"), F.col("hi").alias("n_hi"), F.col("lo").alias("n_lo"))
    near = rows.where(asked).select("ll_at", F.col("hi").alias("q_hi"), F.col("lo").alias("q_lo")).join(near, ["q_hi", "q_lo"]).select("ll_at", "n_within", "first_within")
    rows = rows.join(after, "ll_at").join(near, "ll_at", "left")
    c = F.col
    return rows.select(
        c("ll_id").alias(id_col),
        "n_chars",
        "edited_sha256",
        as_text(c("hi"), c("lo")).alias("fingerprint"),
        as_text(c("e_hi"), c("e_lo")).alias("edited_fingerprint"),
        likeness(c("hi"), c("lo"), c("e_hi"), c("e_lo")).alias("near_edited"),
        likeness(c("hi"), c("lo"), c("n_hi"), c("n_lo")).alias("near_next"),
        "n_within",
        "first_within",
    )
