"""Line dedup: explode normalised lines, hash them, count distinct documents per hash, drop the
lines of frequent hashes and reassemble what stays by position.

Plan. One pass over the texts emits the distinct 128-bit keys of each document (never the lines
themselves). Distinct documents per key are counted in two steps, first by (key, document), so a
line that a third of the documents share is spread over all tasks. The keys over the threshold are
written out; joining them with the keys again gives each document the list of keys it loses. Both
sides of that join are plain exchanges, so AQE splits a key that many documents hold. The text
itself is shuffled once, to meet its list.

Defined results: a null or empty text is one empty line; a null id takes no part in the counts and
its row stays as it is; rows that share an id count as one document and lose the same lines;
an empty table gives an empty table; further columns are carried along unchanged, one named
``line_dedup`` as ``input_line_dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Carried, cut, give_back


def _key(line: str, min_chars: int) -> bytes | None:
    import xxhash

    line = line.strip(SPACE)
    # bytes.lower() touches A-Z only
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass").lower()) if len(line) >= min_chars else None


def _keys_of(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                found = {k for line in text.split("\n") if (k := _key(line, min_chars)) is not None}
                ids += [doc] * len(found)
                keys += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(keys, pa.binary())], ["ll_id", "ll_key"])
            give_back()

    return run


def _reassemble(min_chars: int):
    @F.arrow_udf("struct<text string, n_lines long, n_dropped long>")
    def run(texts: pa.Array, drops: pa.Array) -> pa.Array:
        out, lines, dropped = [], [], []
        for text, drop in zip(texts, drops):
            text, drop = text.as_py() or "", drop.as_py()
            if not drop:
                out.append(text), lines.append(text.count("\n") + 1), dropped.append(0)
                continue
            drop, parts = set(drop), text.split("\n")
            kept = [x for x in parts if _key(x, min_chars) not in drop]
            out.append("\n".join(kept)), lines.append(len(parts)), dropped.append(len(parts) - len(kept))
        give_back()
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], ["text", "n_lines", "n_dropped"])

    return run.asNondeterministic()  # not evaluated again for a filter on its result


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with ``text_col`` replaced by the lines that stay, and a struct column ``line_dedup``
    with the new text, the number of lines before and the number dropped.

    A line whose key (stripped, A-Z lower-cased, of at least ``min_chars`` code points) occurs in at
    least ``min_docs`` distinct documents stays only in the document with the largest id.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    carried = Carried(docs, "line_dedup")
    doc, text = carried.name(id_col), carried.name(text_col)
    slim = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("ll_id"), F.col(text_col).alias("ll_text"))
    keys = slim.mapInArrow(_keys_of(min_chars), f"ll_id {kind}, ll_key binary")
    frequent = cut(
        keys.groupBy("ll_key").agg(F.count_distinct("ll_id").alias("ll_docs"), F.max("ll_id").alias("ll_keep")).where(F.col("ll_docs") >= min_docs).select("ll_key", "ll_keep"),
        "line-keys",
    )
    lost = keys.join(frequent, "ll_key").where("ll_id <> ll_keep").groupBy("ll_id").agg(F.collect_set("ll_key").alias("ll_drop"))
    joined = carried.df.join(lost, F.col(doc) == F.col("ll_id"), "left")
    done = joined.withColumn("line_dedup", _reassemble(min_chars)(F.col(text), F.col("ll_drop")))
    return done.select(*carried.back(**{text_col: F.col("line_dedup.text")}), "line_dedup")
