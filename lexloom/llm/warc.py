"""WARC archives: written by Spark's text sink, read back by a reader that salvages damaged files.

Writing. Records are uncompressed WARC/1.1; a page's payload is text, so a record is text too and the
sink can write it to any store that Spark reaches, in files of a bounded number of records. Of pages
with equal payloads the one with the smallest id is a response and the others are revisits of it,
which carry their HTTP head but not the payload. Equal payloads are found by digest: the digests that
occur twice or more are written out and joined back, so AQE can split one that many pages hold.

Reading. Each file is scanned once. A record, plain or a gzip member, counts when its framing holds
and its payload has the digest that its header names. After a failed check the reader looks for the
next version line or gzip member at which a whole record stands, goes on there, and reports the bytes
between as a gap.

Defined results: a null html is an empty payload; a null url is left out of the header; pages that
share an id and a payload are all responses if they have the smallest id; a null id becomes an empty
record name and comes back null; an empty table gives empty archives.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, new_path

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
READ = "kind string, file string, offset long, length long, reason string, warc_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def base32_of_sha1(hexadecimal: Column) -> Column:
    """Upper-case base32 of a SHA-1 given as 40 hexadecimal digits."""
    out = []
    for i in range(8):  # 20 bits at a time
        v = F.conv(F.substring(hexadecimal, 1 + 5 * i, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(ALPHABET), F.shiftright(v, k).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for k in (15, 10, 5, 0)]
    return F.concat(*out)


def warc_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, min_revisit_bytes: int = 0) -> DataFrame:
    """A column ``value`` with one record per row of ``pages``, without the last line end."""
    slim = pages.select(F.col(id_col).alias("ll_id"), F.col(url_col).alias("ll_url"), F.coalesce(html_col, F.lit("")).alias("ll_html"))
    slim = slim.withColumn("ll_sha1", F.sha1("ll_html")).withColumn("ll_bytes", F.octet_length("ll_html"))
    seen = slim.where(F.col("ll_bytes") >= min_revisit_bytes).groupBy("ll_sha1").agg(F.min("ll_id").alias("ll_first"), F.count("*").alias("n"))
    repeated = cut(seen.where((F.col("n") > 1) & F.col("ll_first").isNotNull()).select("ll_sha1", "ll_first"), "payloads")
    rows = slim.join(repeated, "ll_sha1", "left")
    again = F.col("ll_first").isNotNull() & ~F.col("ll_first").eqNullSafe(F.col("ll_id"))
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("ll_bytes").cast("string"), F.lit(CRLF * 2))
    block_bytes = F.octet_length(head) + F.when(again, 0).otherwise(F.col("ll_bytes"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit(CRLF))
    url = F.regexp_replace("ll_url", r"[\x00-\x20\x7f]", "%20")
    return rows.select(
        F.concat(
            F.lit(f"WARC/1.1{CRLF}"),
            line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
            line("WARC-Record-ID", name(F.col("ll_id"))),
            line("WARC-Date", F.lit(DATE)),
            F.coalesce(line("WARC-Target-URI", url), F.lit("")),
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_sha1(F.col("ll_sha1")))),
            F.when(again, F.concat(line("WARC-Refers-To", name(F.col("ll_first"))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
            line("Content-Type", F.lit("application/http;msgtype=response")),
            line("Content-Length", block_bytes.cast("string")),
            F.lit(CRLF),
            head,
            F.when(again, F.lit("")).otherwise(F.col("ll_html")),
            F.lit(CRLF),
        ).alias("value")
    )


def write_warc(records: DataFrame, path: str, *, records_per_file: int = 1000) -> None:
    """Write records as plain WARC files of at most ``records_per_file`` records each."""
    records.select("value").write.option("lineSep", CRLF).option("maxRecordsPerFile", records_per_file).text(path)


_FIELD = re.compile(rb"([!-9;-~]+):[ \t]*([^\r\n]*(?:\r?\n[ \t]+[^\r\n]*)*)\r?\n")
_FOLD = re.compile(rb"\r?\n[ \t]+")
_EMPTY = re.compile(rb"\r?\n")
_START = re.compile(rb"WARC/1\.[01]\r?\n|\x1f\x8b\x08")
_VERSION = re.compile(rb"WARC/1\.[01]\r?\n")
_ID = re.compile(rb"<urn:x-page:(-?\d+)>")
_CHUNK = 1 << 16


def _differs(digest: bytes, content: bytes) -> bool:
    """Whether a labelled digest is not that of ``content``; one of an algorithm not known here says nothing.
    Bare digests are SHA-1."""
    label, _, value = digest.rpartition(b":")
    name = (label or b"sha1").lower().replace(b"-", b"").decode("ascii", "replace")
    if not value or name not in ("sha1", "sha256", "sha512", "md5"):
        return False
    found = hashlib.new(name, content, usedforsecurity=False).digest()
    return value.upper().rstrip(b"=") not in (base64.b32encode(found).rstrip(b"="), found.hex().upper().encode())


def _record(data: bytes, at: int) -> tuple[dict | None, int, str]:
    """The plain record at ``at``: its fields, where it ends, or why it fails."""
    if not (m := _VERSION.match(data, at)):
        return None, at, "no version line"
    fields, pos = {}, m.end()
    while m := _FIELD.match(data, pos):
        fields[m[1].lower()] = _FOLD.sub(b" ", m[2]).strip()
        pos = m.end()
    if not (m := _EMPTY.match(data, pos)):
        return None, at, "broken header"
    begin = m.end()
    if not fields.get(b"content-length", b"").isdigit():
        return None, at, "no length"
    end = begin + int(fields[b"content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        return None, at, "broken framing"
    block = data[begin:end]
    head, found, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields.get(b"warc-type", b""), fields.get(b"warc-payload-digest", b"")
    http = kind in (b"response", b"request") and b"http" in fields.get(b"content-type", b"http").lower()
    if kind == b"revisit":
        payload = None
    elif not http:
        payload = block
    elif not found:
        return None, at, "no HTTP head"
    if payload is not None and _differs(digest, payload):
        return None, at, "digest differs"
    if _differs(fields.get(b"warc-block-digest", b""), block):
        return None, at, "block digest differs"
    digest = digest.removeprefix(b"sha1:")
    length = len(payload) if payload is not None else None
    if length is None and (m := re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)):
        length = int(m[1])
    text = lambda b: b.decode("utf-8", "replace") if b is not None else None
    got = {"warc_type": text(kind), "record_id": text(fields.get(b"warc-record-id")), "target_uri": text(fields.get(b"warc-target-uri"))}
    got |= {"refers_to": text(fields.get(b"warc-refers-to")), "payload_digest": text(digest), "payload_bytes": length, "payload": payload}
    return got, end + 4, ""


def _member(data: bytes, at: int) -> tuple[list[dict], int, str]:
    """The records of the gzip member at ``at``; none if it is damaged."""
    z, parts, pos = zlib.decompressobj(31), [], at
    view = memoryview(data)
    try:  # in chunks, so what follows the member is neither copied nor unpacked
        while not z.eof and pos < len(data):
            chunk = view[pos : pos + _CHUNK]
            parts.append(z.decompress(chunk))
            pos += len(chunk)
    except zlib.error as e:
        return [], at, f"gzip: {e}"
    if not z.eof:
        return [], at, "gzip: cut short"
    plain, after = b"".join(parts), pos - len(z.unused_data)
    found, pos = [], 0
    while pos < len(plain):
        got, pos, why = _record(plain, pos)
        if why:
            return [], at, why
        found.append(got)
    return found, after, ""


def salvage(data: bytes) -> Iterator[dict]:
    """Records of an archive in order, and the gaps between them that had to be left out."""
    pos, gap, why = 0, None, ""
    while pos < len(data):
        zipped = data.startswith(b"\x1f\x8b\x08", pos)
        found, end, bad = _member(data, pos) if zipped else _record(data, pos)
        if bad:
            gap, why = (pos, bad) if gap is None else (gap, why)
            m = _START.search(data, pos + 1)
            pos = m.start() if m else len(data)
            continue
        if gap is not None:
            yield {"kind": "gap", "offset": gap, "length": pos - gap, "reason": why}
            gap = None
        for got in found if zipped else [found]:
            yield {"kind": "record", "offset": pos, "length": end - pos} | got
        pos = end
    if gap is not None:
        yield {"kind": "gap", "offset": gap, "length": len(data) - gap, "reason": why}


def read_warc(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """Records and gaps of all archives under ``path``; ``kind`` tells which. Without ``payloads`` that
    column is null, though each payload was checked."""
    names = [x.split()[0] for x in READ.split(", ")]
    kinds = [pa.int64() if "long" in x else pa.binary() if "binary" in x else pa.string() for x in READ.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for x in salvage(content.as_py() or b""):
                    rows.append([file if c == "file" else None if c == "payload" and not payloads else x.get(c) for c in names])
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, READ)


def page_name(column: str) -> Column:
    """The page id in a record's name."""
    return F.regexp_extract(column, r"<urn:x-page:(-?\d+)>", 1).try_cast("long")


def archive(pages: DataFrame, **options) -> str:
    """Write ``pages`` as archives in the shared folder and return their path."""
    path = new_path(pages.sparkSession, "warc")
    write_warc(warc_records(pages, **options), path)
    return path
