"""Packing into training sequences by best-fit decreasing.

Documents longer than a window are first cut into full windows; what is left of each is a piece of
1 to ``window`` tokens. Best-fit decreasing treats pieces of one length alike, so it runs exactly on
the histogram of piece lengths, which has at most ``window`` rows however large the corpus is: a
segment tree indexed by remaining capacity finds the tightest open window, and windows with the same
remaining capacity are handled as intervals of sequence numbers. The result says which ranks of each
length go to which sequences; ranks are given to pieces by salted windows, so a length that a third
of the documents share is spread, and a join places every piece.

Defined results: a null text is empty, so its document is the end id alone; rows that share an id are
documents of their own; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, group_target
from .tokens import encoder

#: more placement rows than this are joined by shuffle
BROADCAST_ROWS = 100_000


class CapacityTree:
    """Segment tree over remaining capacities 0..n: how many entries each has; finds the smallest
    capacity of at least a size that has one."""

    def __init__(self, n: int):
        self.base = 1 << n.bit_length()
        self.count = [0] * (2 * self.base)

    def add(self, capacity: int, by: int) -> None:
        i = self.base + capacity
        while i:
            self.count[i] += by
            i //= 2

    def tightest(self, size: int) -> int | None:
        i = self.base + size
        if self.count[i]:
            return size
        while i > 1:
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                while i < self.base:
                    i *= 2
                    if not self.count[i]:
                        i += 1
                return i - self.base
            i //= 2
        return None


@dataclass
class Packing:
    """Placements: pieces of ``length`` with ranks in [rank_lo, rank_hi) go ``per`` to a sequence, from
    sequence ``first`` on, the first of each at ``offset``."""

    n_sequences: int = 0
    placements: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)


def best_fit_decreasing(histogram: dict[int, int], window: int) -> Packing:
    """Best-fit decreasing over a histogram of lengths (1..window), the same sequences as piece by piece."""
    out, tree, spare = Packing(), CapacityTree(window), {}

    def put(first: int, n: int, capacity: int) -> None:
        if n and capacity:
            spare.setdefault(capacity, []).append((first, n))
            tree.add(capacity, 1)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, per = window, window // length
                first, n = out.n_sequences, -(-left // per)
                out.n_sequences += n
            else:
                first, n = spare[capacity].pop()
                tree.add(capacity, -1)
                per = capacity // length
            full = min(n, left // per)  # sequences that take as many of this length as fit
            if full:
                out.placements.append((length, rank, rank + full * per, first, per, window - capacity))
                put(first, full, capacity - per * length)
                rank, left = rank + full * per, left - full * per
            used = full
            if full < n and 0 < left < per:
                out.placements.append((length, rank, rank + left, first + full, left, window - capacity))
                put(first + full, 1, capacity - left * length)
                used, left = full + 1, 0
            put(first + used, n - used, capacity)
    return out


def _pieces(path: str, window: int, end_id: int):
    names = ["ll_id", "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), np.array([end_id], "<u4")
        for batch in batches:
            rows = ([], [], [], [], [])
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([encode(text.as_py() or "").astype("<u4"), end])
                for at in range(0, len(ids), window):
                    piece = ids[at : at + window]
                    for out, x in zip(rows, (doc, at, len(piece), zlib.crc32(piece.tobytes()), len(ids))):
                        out.append(x)
            kinds = [batch.schema.field(0).type, *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names)

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, path: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """A row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``ids_crc32`` is over the piece's ids as little-endian unsigned 32-bit numbers; offsets in a
    sequence are gapless from 0.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    pieces = docs.select(F.col(id_col).alias("ll_id"), F.col(text_col).alias("ll_text")).mapInArrow(
        _pieces(path, window, end_id), f"ll_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    )
    return place(cut(pieces, "pieces"), window=window).withColumnRenamed("ll_id", id_col)


def place(pieces: DataFrame, *, window: int) -> DataFrame:
    """``pieces`` (ll_id, start, length, ...) with their sequence_id and offset."""
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``window`` rows
    packing = best_fit_decreasing(histogram, window)
    per = group_target(sum(histogram.values()))
    salts = spark.createDataFrame([(k, -(-n // per)) for k, n in histogram.items()], "length long, ll_salts long")
    salted = pieces.join(F.broadcast(salts), "length").withColumn("ll_salt", F.pmod(F.xxhash64("ll_id", "start"), F.col("ll_salts"))).drop("ll_salts")
    counts = salted.groupBy("length", "ll_salt").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("ll_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "ll_salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ll_before"))
    within = Window.partitionBy("length", "ll_salt").orderBy("ll_id", "start", "ids_crc32")
    ranked = salted.withColumn("ll_rank", F.row_number().over(within) - 1).join(before, ["length", "ll_salt"]).withColumn("ll_rank", F.col("ll_rank") + F.col("ll_before"))
    where = spark.createDataFrame(packing.placements, "ll_length long, ll_lo long, ll_hi long, ll_first long, ll_per long, ll_offset long")
    where = F.broadcast(where) if len(packing.placements) <= BROADCAST_ROWS else where
    fits = (F.col("length") == F.col("ll_length")) & (F.col("ll_rank") >= F.col("ll_lo")) & (F.col("ll_rank") < F.col("ll_hi"))
    nth = F.col("ll_rank") - F.col("ll_lo")
    return ranked.join(where, fits).select(
        *pieces.columns,
        (F.col("ll_first") + F.floor(nth / F.col("ll_per"))).cast("long").alias("sequence_id"),
        (F.col("ll_offset") + (nth % F.col("ll_per")) * F.col("length")).cast("long").alias("offset"),
    )
