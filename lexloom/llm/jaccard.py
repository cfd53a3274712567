"""N-gram Jaccard join, size-aware: small sets enumerate fixed-size subsets, large sets scan inverted
lists, and the boundary between them is the one of least estimated cost.

A document's set holds the 64-bit hashes of its distinct word n-grams. Documents with equal sets are
one class and are handled once. Two sets of sizes n and m are similar only if they share at least
c(n, m) elements:

* Sets below the boundary emit a signature for each of their subsets of the sizes c(n, m) that
  partners can ask for; similar sets have one in common.
* Other sets emit their prefix: the first ``n - ceil(t n) + 1`` elements of a global order; similar
  sets have one in common. In that order elements of frequent n-grams come last, by frequency, so that
  passages which many documents share make no long lists. Sets just below the boundary do both.

Signatures and prefix elements make inverted lists of classes. Within a list, two classes are
compared only if their sizes allow it and if their parity sketches differ in no more bits than similar
sets can (each element in one set only flips one bit, so this never drops a link). First every class
meets the heads of its lists; what those links connect needs no further comparison. Classes that still
share a list with one they are not connected to are compared through longer keys: the set is cut by
hash range into more parts than similar sets can differ in elements, so similar sets agree on a whole
part, and only classes with a part in common meet: first, for some rounds, the head of each part's list,
then those in pairs that are still not connected. A list of elements is thus never paired with itself. Links are decided by exact intersection, and their components are the result.

Defined results: a null or empty text has an empty set and is its own component; a text with fewer
words than n is one n-gram; rows with a null id are not linked and have a null component; rows that
share an id are documents of their own; an empty table gives an empty table. Elements are compared by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, give_back
from .components import components

_U = np.uint64
_MULT = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
SKETCH = 256
#: most slots of the bitmap that tells whose sets to read
SLOTS = 1 << 26
#: how often classes meet new heads of their lists before they meet each other
ROUNDS = 3
#: how many of a class's parts tell whether a pair was met in a list before
FIRST_PARTS = 8


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 18
_SPACE = np.array([x == 32 or 9 <= x <= 13 for x in range(256)])
_LOWER = np.array([x + 1 + 32 * (65 <= x <= 90) for x in range(256)], _U)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(np.concatenate([np.ones(1, _U), np.cumprod(np.full(n - 1, x, _U))]) for x in (_BASE, _INVERSE))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of ``data``, A-Z lower-cased: a polynomial in its bytes from prefix
    sums, mixed. Runs over blocks that end at white space, so memory follows the block, not the text."""
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = at + _BLOCK
        while end < len(data) and not data[end - 1 : end].isspace():
            end += 1
        b = np.frombuffer(data, np.uint8, min(end, len(data)) - at, at)
        space = _SPACE[b]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
        first, last = edge[::2], edge[1::2]
        up, down = _powers(1 << max(19, int(len(b)).bit_length()))
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, _U), np.cumsum(_LOWER[b] * up[: len(b)], dtype=_U)])
            hashes.append(mix64((sums[last] - sums[first]) * down[first] + _MULT[4]))
        starts.append(first + at)
        at = min(end, len(data))
    return (np.concatenate(hashes), np.concatenate(starts)) if hashes else (np.zeros(0, _U), np.zeros(0, np.int64))


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        total = np.full(max(0, len(h) - k + 1), k, _U)
        for i in range(k):
            total = total * _MULT[i % 5] + h[i : len(h) - k + 1 + i]
    return mix64(total)


def shingles_of(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its n-grams of words, many texts at a time."""
    block, size = [], 0
    for text in texts:
        block.append((text.as_py() or "").encode("utf-8", "surrogatepass"))
        size += len(block[-1])
        if size >= _BLOCK:
            yield from _block_shingles(block, n)
            block, size = [], 0
    yield from _block_shingles(block, n)


def _block_shingles(block: list[bytes], n: int) -> Iterator[np.ndarray]:
    hashes, starts = _word_hashes(b" ".join(block))
    begins = np.cumsum([0] + [len(x) + 1 for x in block])
    words = np.searchsorted(starts, begins)  # of each text in hashes
    grams = _grams(hashes, n)
    for a, b in zip(words[:-1].tolist(), words[1:].tolist()):
        if b - a >= n:
            x = np.sort(grams[a : b - n + 1])
            yield x[np.concatenate([[True], x[1:] != x[:-1]])]
        else:
            yield _grams(hashes[a:b], b - a) if b > a else np.zeros(0, _U)


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of words of a text, A-Z lower-cased."""
    return next(shingles_of(pa.array([text], pa.string()), n))


def least_overlap(n: int, m: int, percent: int) -> int:
    """Smallest intersection of sets of these sizes with 100 * intersection >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


@lru_cache(maxsize=4096)
def subset_sizes(n: int, boundary: int, percent: int) -> tuple[int, ...]:
    """The sizes of common subsets that partners below the boundary can ask of a set of n elements."""
    partners = range(max(1, -(-percent * n // 100)), min(100 * n // percent, boundary - 1) + 1)
    return tuple(sorted({least_overlap(n, m, percent) for m in partners}))


def n_subsets(n: int, boundary: int, percent: int) -> int:
    return sum(comb(n, c) for c in subset_sizes(n, boundary, percent))


def subset_signatures(x: np.ndarray, boundary: int, percent: int) -> np.ndarray:
    """A hash of each such subset: of the sum of its elements and its size."""
    n, out = len(x), []
    with np.errstate(over="ignore"):
        total = x.sum(dtype=_U)
        for c in subset_sizes(n, boundary, percent):
            left_out = np.array(list(combinations(range(n), n - c)), dtype=np.int64).reshape(comb(n, c), n - c)
            out.append(mix64((total - x[left_out].sum(1, dtype=_U)) * _MULT[1] + _U(c)))
    return np.concatenate(out) if out else np.zeros(0, _U)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def best_boundary(sizes: dict[int, int], mean_list: float, percent: int, most: int = 41) -> int:
    """The size from which sets scan inverted lists: the least cost of signatures emitted by smaller
    sets, and of elements emitted and list entries read by the others."""
    def cost(x: int) -> float:
        enumerated = sum(k * n_subsets(n, x, percent) for n, k in sizes.items() if n < x)
        scanned = sum(k * prefix_length(n, percent) * (1 + mean_list) for n, k in sizes.items() if 100 * n >= percent * x and n < most)
        return enumerated + scanned

    return min(range(2, most), key=lambda x: (cost(x), x))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(_U).view(np.int64)


def class_of(x: np.ndarray) -> np.uint64:
    """One hash for a whole set."""
    with np.errstate(over="ignore"):
        return mix64(x.sum(dtype=_U, keepdims=True) * _MULT[0] + _U(len(x)))[0]


def sketch_bits(n: int) -> int:
    """Width of the parity sketch of a set: a power of two, about a bit an element."""
    return max(SKETCH, 1 << (n - 1).bit_length()) if n else SKETCH


def parity(x: np.ndarray, bits: int) -> np.ndarray:
    """For each of ``bits`` buckets whether it holds an odd number of elements, as 64-bit words."""
    odd = np.bincount((x & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _describe(n_gram: int):
    names = ["ll_id", "n", "cls", "s0", "s1", "s2", "s3", "wide"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, classes, sketches, wide = [], [], [], []
            for x in shingles_of(batch.column(1), n_gram):
                sizes.append(len(x))
                classes.append(class_of(x))
                wide.append(parity(x, sketch_bits(len(x))))
                sketches.append(np.bitwise_xor.reduce(wide[-1].reshape(-1, SKETCH // 64), axis=0))
            s = np.array(sketches, np.int64).reshape(-1, 4)
            ends = np.cumsum([0] + [len(x) for x in wide], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(wide or [np.zeros(0, np.int64)])))
            cols = [batch.column(0), pa.array(sizes, pa.int32()), pa.array(_signed(np.array(classes, _U))), *[pa.array(np.ascontiguousarray(s[:, k])) for k in range(4)], lists]
            yield pa.RecordBatch.from_arrays(cols, names)
            give_back()

    return run


def _low_elements(n_gram: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = _U(int(share * 2**64))
        for batch in batches:
            parts = [x[: np.searchsorted(x, limit)].copy() for x in shingles_of(batch.column(0).unique(), n_gram)]
            yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(parts or [np.zeros(0, _U)])))], ["token"])
            give_back()

    return run


def _postings(n_gram: int, percent: int, boundary: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = frequent.value  # sorted
        for batch in batches:
            out, owners, seen = [], [], set()
            for x in shingles_of(batch.column(0).unique(), n_gram):
                n, cls = len(x), class_of(x).view(np.int64)
                if not n or cls in seen:
                    continue
                seen.add(cls)
                if n < boundary:
                    found = subset_signatures(x, boundary, percent)
                    out.append(found), owners.append(np.full(len(found), cls, np.int64))
                if 100 * n >= percent * boundary:
                    p = prefix_length(n, percent)
                    often, at = _is_frequent(x, tokens)
                    first = x[~often][:p].copy()
                    if len(first) < p:
                        rest = x[often]
                        first = np.concatenate([first, rest[np.lexsort((rest, counts[at[often]]))][: p - len(first)]])
                    out.append(first), owners.append(np.full(len(first), cls, np.int64))
            empty = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(out)) if out else empty[0]), pa.array(np.concatenate(owners or empty))], ["token", "cls"])
            give_back()

    return run


@lru_cache(maxsize=1 << 16)
def size_group(n: int, percent: int) -> tuple[int, int]:
    """(number, largest size) of the group of sizes that ``n`` is in: the sizes from that of the first
    member up to its largest similar partner, so similar sets are in one group or in two that adjoin."""
    group, most = 0, 100 // percent
    while most < n:
        group, most = group + 1, 100 * (most + 1) // percent
    return group, most


@lru_cache(maxsize=1 << 16)
def part_counts(n: int, percent: int) -> list[tuple[int, int, int]]:
    """(key, differences, parts) for each group whose members, as the smaller set, a set of ``n`` elements can
    be similar to: in at most how many elements the two differ, and into how many parts both are cut."""
    out, (group, _) = [], size_group(n, percent)
    for key in (group, group - 1):
        most = size_group(n, percent)[1] if key == group else _group_end(key, percent)
        if key >= 0 and n <= 100 * most // percent:
            differ = (most + 100 * most // percent) * (100 - percent) // (100 + percent)
            out.append((key, differ, differ + 1 + int(np.ceil(_empty_share(percent) * (differ + 1)))))
    return out


def _empty_share(percent: int) -> float:
    """How many parts more than needed are cut, as some are empty: twice those of a set a fifth of whose
    elements are frequent, with as many parts as differences."""
    differences = (100 - percent) / (100 + percent) * (1 + 100 / percent) * 100 / percent  # an element of the smallest set of a group
    return min(1.0, max(0.02, 2 * float(np.exp(-0.8 / max(differences, 1e-9)))))


@lru_cache(maxsize=1 << 12)
def _group_end(group: int, percent: int) -> int:
    most = 100 // percent
    for _ in range(group):
        most = 100 * (most + 1) // percent
    return most


def part_signatures(x: np.ndarray, often: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a sorted set, of which similar sets have one in common.

    Sets that differ in at most d elements agree on at least p - d of p parts. Parts are made of the
    elements that are not frequent; empty ones make no key unless more than p - d - 1 are empty. Such a set
    also makes keys of parts of all its elements, and if of those as many are empty, keys of the empty ones:
    two sets with few empty parts agree on one that is not empty, and two with many have such keys both.
    """
    out, rare = [], x[~often]
    with np.errstate(over="ignore"):
        for key, differ, parts in part_counts(len(x), percent):
            for tier, y in enumerate((rare, x)):
                at = ((y >> _U(32)) * _U(parts)) >> _U(32)  # never falls, as y is sorted
                first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(y) else np.zeros(0, np.int64)
                salt = mix64(np.array([key * 4 + tier], _U) * _MULT[2])[0]
                if len(first):
                    out.append(mix64(mix64(np.add.reduceat(y, first) + at[first] * _MULT[3]) + salt))
                if parts - len(first) < parts - differ:
                    break
                if tier:
                    empty = np.setdiff1d(np.arange(parts, dtype=_U), at[first])
                    out.append(mix64(mix64(empty * _MULT[3] + _MULT[1]) + salt))
    return np.concatenate(out) if out else np.zeros(0, _U)


def _is_frequent(x: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``x`` are among the sorted ``tokens``, and where."""
    at = np.minimum(np.searchsorted(tokens, x), max(0, len(tokens) - 1))
    return (tokens[at] == x if len(tokens) else np.zeros(len(x), bool)), at


def _bitmap(ids: DataFrame) -> tuple[int, np.ndarray]:
    """How many slots there are, and a bit for each that an id of ``ids`` (one column) falls into: a filter for
    tables that should not be shuffled. Its size has a bound, beyond which it lets more through."""
    column = ids.columns[0]
    slots = min(SLOTS, 1 << max(16, (64 * ids.count()).bit_length()))
    words = ids.select(_slot(column, slots).alias("slot")).groupBy(F.shiftright("slot", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")).toArrow()  # at most slots / 64 rows
    bits = np.zeros(slots >> 6, np.int64)
    bits[words.column("w").to_numpy()] = words.column("bits").to_numpy()
    return slots, bits


def _slot(column: str, slots: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(slots))


def _wanted(slots: pa.Array, bits: np.ndarray) -> pa.Array:
    at = slots.to_numpy()
    return pa.array((bits[at >> 6] >> (at & 63)) & 1 == 1)


def _parts(percent: int, frequent, wanted):
    """(part, cls) from (cls, elements, slot) of the classes whose slot is in the bitmap ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, _ = frequent.value
        for batch in batches:
            batch = batch.filter(_wanted(batch.column(2), wanted.value))
            found = []
            for e in batch.column(1):
                x = np.sort(e.values.to_numpy(zero_copy_only=False).view(_U))
                found.append(part_signatures(x, _is_frequent(x, tokens)[0], percent))
            owners = np.repeat(batch.column(0).to_numpy(), np.array([len(f) for f in found], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(found or [np.zeros(0, _U)]))), pa.array(owners)], ["part", "cls"])
            give_back()

    return run


def _sets(n_gram: int, wanted):
    """(cls, elements) of the texts whose slot is in the bitmap ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column(0).filter(_wanted(batch.column(1), wanted.value))
            for at in range(0, len(part), 500):
                found = list(shingles_of(part.slice(at, 500), n_gram))
                ends = np.cumsum([0] + [len(x) for x in found], dtype=np.int32)
                values = pa.array(_signed(np.concatenate(found or [np.zeros(0, _U)])))
                yield pa.RecordBatch.from_arrays([pa.array(_signed(np.array([class_of(x) for x in found], _U))), pa.ListArray.from_arrays(pa.array(ends), values)], ["cls", "elements"])
            give_back()

    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, n_gram: int = 5, percent: int = 80, most_frequent: int = 500_000) -> DataFrame:
    """(id, n_shingles, component_id): documents link when their sets of ``n_gram`` words have a Jaccard
    similarity of at least ``percent`` / 100; the component is the smallest id reachable by links.

    Frequencies are counted for the elements in the lowest part of the hash range, where prefixes lie; those above ``max(64, elements / most_frequent)`` documents, at most ``most_frequent``
    of them, are broadcast. Which elements count as frequent changes the work, never the links.
    """
    spark, frequent_share = docs.sparkSession, min(1.0, 0.02 + 1.7 * (1 - percent / 100))
    scratch = Scratch(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("ll_id"), F.col(text_col).alias("ll_text"))
    described = scratch.cut(slim.mapInArrow(_describe(n_gram), f"ll_id {kind}, n int, cls long, s0 long, s1 long, s2 long, s3 long, wide array<long>"), "shingle-sets")
    classes = scratch.cut(described.where("n > 0").groupBy("cls").agg(F.min("ll_id").alias("rep"), *[F.max(c).alias(c) for c in ("n", "s0", "s1", "s2", "s3")]).where("rep is not null"), "shingle-classes")

    total = classes.agg(F.sum("n")).first()[0] or 0
    limit = max(64, -(-total // most_frequent))
    counted = slim.where(F.col("ll_id").isNotNull()).select("ll_text").mapInArrow(_low_elements(n_gram, frequent_share), "token long").groupBy("token").count()
    counted = scratch.cut(counted.where("count > 1"), "shingle-counts")
    squares, singles = counted.where(F.col("count") <= limit).agg(F.sum(F.col("count") * F.col("count")), F.sum("count")).first()
    often = counted.where(F.col("count") > limit).collect()  # at most total / limit rows
    tokens = np.array([r[0] for r in often], np.int64).view(_U)
    order = np.argsort(tokens)
    frequent = spark.sparkContext.broadcast((tokens[order], np.array([r[1] for r in often], np.int64)[order]))
    sizes = {r[0]: r[1] for r in classes.where("n <= 60").groupBy("n").count().collect()}
    boundary = best_boundary(sizes, (squares or 0) / max(1, frequent_share * total, singles or 0), percent)

    made = slim.where(F.col("ll_id").isNotNull()).select("ll_text").mapInArrow(_postings(n_gram, percent, boundary, frequent), "token long, cls long")
    by_token = Window.partitionBy("token")
    # each list has a head of its own, so a class meets as many heads as it has lists
    lists = made.repartition(F.col("token")).distinct().withColumn("least", F.min("cls").over(by_token)).withColumn("most", F.max("cls").over(by_token))
    lists = lists.withColumn("head", F.min_by("cls", F.xxhash64("token", "cls")).over(by_token))
    lists = lists.where("least < most").withColumn("long", F.count("*").over(by_token) > limit)
    sketch = classes.select("cls", "n", "s0", "s1", "s2", "s3")
    entries = scratch.cut(lists.select("token", "cls", "head", "long").join(sketch, "cls"), "list-entries")

    wide = described.where("n > 0").select("cls", "wide")
    links = _links(scratch, classes, wide, entries, slim, frequent, n_gram, percent)
    found = components(links).select(F.col("node").alias("rep"), "component")
    of_class = classes.select("cls", "rep").join(found, "rep", "left").select("cls", F.coalesce("component", "rep").alias("component"))
    of_class = scratch.cut(of_class, "class-components")
    slim_rows = scratch.cut(described.select("ll_id", "n", "cls"), "shingle-rows")
    scratch.free("shingle-sets", "shingle-classes", "links")
    out = slim_rows.join(of_class, "cls", "left")
    own = F.when((F.col("n") > 0) & F.col("ll_id").isNotNull(), F.col("component")).otherwise(F.col("ll_id"))
    return out.select(F.col("ll_id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def _similar_sizes(percent: int):
    """Whether two classes a and b may be similar by their sizes and sketches."""
    na, nb = F.col("a.n"), F.col("b.n")
    apart = sum((F.bit_count(F.col(f"a.s{k}").bitwiseXOR(F.col(f"b.s{k}"))) for k in range(4)), F.lit(0))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (apart <= _most_apart(na, nb, percent))


def _most_apart(n: Column, m: Column, percent: int) -> Column:
    """In how many elements similar sets of these sizes can differ."""
    return n + m - 2 * F.ceil(percent * (n + m) / F.lit(100.0 + percent) - 1e-9)


def _verified(scratch: Scratch, pairs: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar, written. Their sketches of about a bit an element,
    which fold to the narrower of two, come first; of what is left only the sets are read and intersected."""
    of = lambda df, side, **names: df.select(F.col("cls").alias(side), *[F.col(c).alias(f"{side}_{new}") for new, c in names.items()])
    pairs = scratch.cut(pairs, "pairs")
    known = pairs.join(of(sketches, "a", n="n", w="wide"), "a").join(of(sketches, "b", n="n", w="wide"), "b")
    half = lambda w, k: F.slice(w, (F.size(w) / 2).cast("int") * k + 1, (F.size(w) / 2).cast("int"))
    fold = lambda w, other: F.when(F.size(w) > F.size(other), F.zip_with(half(w, 0), half(w, 1), lambda x, y: x.bitwiseXOR(y))).otherwise(w)
    a, b = F.col("a_w"), F.col("b_w")
    apart = F.aggregate(F.zip_with(fold(a, b), fold(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    close = scratch.cut(known.where(apart <= _most_apart(F.col("a_n"), F.col("b_n"), percent)).select("a", "b"), "close-pairs")
    asked = scratch.cut(close.select(F.col("a").alias("cls")).unionByName(close.select(F.col("b").alias("cls"))).distinct(), "asked-classes")
    sets = sets.join(asked, "cls", "left_semi")
    shared = F.size(F.array_intersect("a_e", "b_e"))
    united = F.size("a_e") + F.size("b_e") - shared
    found = close.join(of(sets, "a", e="elements"), "a").join(of(sets, "b", e="elements"), "b").where(100 * shared >= percent * united).select("a", "b").distinct()
    found = scratch.cut(found, "verified")
    scratch.forget("pairs", "close-pairs", "asked-classes")
    return found


def _links(scratch: Scratch, classes: DataFrame, wide: DataFrame, entries: DataFrame, slim: DataFrame, frequent, n_gram: int, percent: int) -> DataFrame:
    """Links (a, b) between smallest ids of classes, enough to connect all that are connected.

    ``entries`` are the lists' classes with their sketches; a list is long if it holds more classes than an
    element that is not frequent has documents. Only short lists are looked through entry by entry.
    """
    spark = slim.sparkSession
    sketch = ["cls", "n", "s0", "s1", "s2", "s3"]
    similar = _similar_sizes(percent)
    short = entries.where("NOT long")
    other = (F.col("a.token") == F.col("b.token")) & (F.col("a.cls") != F.col("b.cls"))

    # classes that have any partner to be compared with, their wide sketches, and their sets; which
    # texts to read for the sets is told by a bitmap
    entries = scratch.cut(short.alias("a").join(short.alias("b"), other & similar, "left_semi").unionByName(entries.where("long")), "entries-with-partner")
    scratch.free("list-entries")
    involved = scratch.cut(entries.select("cls").distinct().join(classes.select("cls", "rep", "n"), "cls"), "involved")
    slots, bits = _bitmap(involved.select("rep"))
    texts = slim.where(F.col("ll_id").isNotNull()).select("ll_text", _slot("ll_id", slots).alias("slot"))
    sets = scratch.cut(texts.mapInArrow(_sets(n_gram, spark.sparkContext.broadcast(bits)), "cls long, elements array<long>"), "sets")
    sketches = wide.join(involved.select("cls", "n", "rep"), "cls").groupBy("cls").agg(F.max("n").alias("n"), F.max_by("wide", "n").alias("wide"))
    sketches = scratch.cut(sketches, "wide-sketches")

    # every class against the heads of its lists
    heads = entries.where("cls <> head").select("token", F.struct(*sketch).alias("a"), F.col("head"))
    tops = entries.where("cls = head").select("token", F.struct(*sketch).alias("b"))
    heads = heads.join(tops, "token").where(similar).select(F.col("a.cls").alias("a"), F.col("b.cls").alias("b")).distinct()
    stars = _verified(scratch, heads, sketches, sets, percent)

    # what the heads connect is not compared again
    near = scratch.cut(components(stars).withColumnsRenamed({"node": "cls", "component": "hub"}), "hubs")
    grouped = entries.join(near, "cls", "left").withColumn("hub", F.coalesce("hub", "cls"))
    left = grouped.where("NOT long")
    open_ = left.alias("a").join(left.alias("b"), other & (F.col("a.hub") != F.col("b.hub")) & similar, "left_semi").select("cls", "hub")
    mixed = grouped.where("long").groupBy("token").agg(F.min("hub").alias("x"), F.max("hub").alias("y")).where("x < y").select("token")
    open_ = scratch.cut(open_.unionByName(grouped.where("long").join(mixed, "token", "left_semi").select("cls", "hub")).distinct(), "open-classes")
    scratch.free("entries-with-partner")
    slots, bits = _bitmap(open_.select("cls"))
    parts = sets.select("cls", "elements", _slot("cls", slots).alias("slot")).mapInArrow(_parts(percent, frequent, spark.sparkContext.broadcast(bits)), "part long, cls long")
    meet = _of_several(parts.repartition(F.col("part")), "cls").join(open_, "cls")
    meet = _of_several(meet, "hub").distinct().join(classes.select(*sketch), "cls")
    meet = scratch.cut(meet, "part-entries-0")

    # classes meet the heads of their parts, drawn anew each round, until no link is new; what is then left meets in pairs
    links = stars
    differ = (F.col("a.part") == F.col("b.part")) & (F.col("a.hub") != F.col("b.hub")) & similar
    both = lambda df: df.select(F.col("a.cls").alias("a"), F.col("b.cls").alias("b")).distinct()
    for nth in range(1, ROUNDS + 1):
        rank = F.row_number().over(Window.partitionBy("part").orderBy(F.xxhash64(F.lit(nth), "cls"), "cls"))
        tops = meet.withColumn("rank", rank).where("rank = 1").drop("rank")
        new = _verified(scratch, both(meet.alias("a").join(tops.alias("b"), differ)), sketches, sets, percent)
        if new.isEmpty():
            break
        links = links.unionByName(new)
        hubs = meet.select("cls", "hub").distinct()
        joined = new.join(hubs.select(F.col("cls").alias("a"), F.col("hub").alias("x")), "a").join(hubs.select(F.col("cls").alias("b"), F.col("hub").alias("y")), "b")
        merged = components(joined.select(F.col("x").alias("a"), F.col("y").alias("b"))).withColumnsRenamed({"node": "hub", "component": "to"})
        rows = meet.join(merged, "hub", "left").withColumn("hub", F.coalesce("to", "hub")).drop("to")
        meet = scratch.cut(_of_several(rows, "hub"), f"part-entries-{nth}")
        scratch.free(f"part-entries-{nth - 1}")
    # a pair meets in the list of the smallest part that both have, as far as their first parts tell
    low = meet.groupBy("cls").agg(F.slice(F.array_sort(F.collect_set("part")), 1, FIRST_PARTS).alias("low"))
    meet = meet.join(low, "cls")
    smallest = F.coalesce(F.array_min(F.array_intersect("a.low", "b.low")) >= F.col("a.part"), F.lit(True))
    pairs = both(meet.alias("a").join(meet.alias("b"), differ & (F.col("a.cls") < F.col("b.cls")) & smallest))
    found = links.unionByName(_verified(scratch, pairs, sketches, sets, percent)).distinct()
    ids = involved.select("cls", "rep")
    found = found.join(ids.select(F.col("cls").alias("a"), F.col("rep").alias("ra")), "a").join(ids.select(F.col("cls").alias("b"), F.col("rep").alias("rb")), "b")
    found = scratch.cut(found.select(F.col("ra").alias("a"), F.col("rb").alias("b")), "links")
    scratch.free(*[name for name in scratch.paths if name not in ("links", "shingle-sets", "shingle-classes")])
    return found


def _of_several(rows: DataFrame, column: str) -> DataFrame:
    """The rows of the parts that have more than one value of ``column``."""
    by_part = Window.partitionBy("part")
    rows = rows.withColumn("x", F.min(column).over(by_part)).withColumn("y", F.max(column).over(by_part))
    return rows.where("x < y").drop("x", "y")
