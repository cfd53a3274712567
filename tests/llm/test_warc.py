import base64
import gzip
import hashlib
import random

from pyspark.sql import functions as F

from lexloom.llm import warc as W
from lexloom.llm.common import new_path


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


PAGES = [
    (1, "http://a.example/", "<p>one</p>"), (2, "http://b.example/ x\r\ny", "<p>one</p>"), (3, None, None), (4, "http://c.example/", ""),
    (5, "http://d.example/", "WARC/1.1\r\nWARC-Type: response\r\n\r\nnot a record\r\n\r\n"), (6, "http://e.example/", "é" * 50_000), (7, "http://f.example/", "\r\n\r\n\r\n"),
    (9, "http://g.example/", "<p>one</p>"), (1, "http://a.example/", "<p>one</p>"), (None, "http://h.example/", "no id"),
]
SCHEMA = "page_id long, url string, html string"


def test_round_trip_with_revisits(spark):
    df = spark.createDataFrame([(*p, "x") for p in PAGES], SCHEMA + ", ll_sha1 string")
    rows = W.read_warc(spark, W.archive(df)).collect()
    assert len(rows) == len(PAGES) and all(r["kind"] == "record" for r in rows)
    first = {}
    for i, _, h in sorted((p for p in PAGES if p[0] is not None), key=lambda p: p[0]):
        first.setdefault(h or "", i)
    want = sorted(str((i, digest(h), len((h or "").encode()), "response" if i is None or first[h or ""] == i else "revisit")) for i, _, h in PAGES)
    got = []
    for r in rows:
        name = r["record_id"].removeprefix("<urn:x-page:").removesuffix(">")
        i = int(name) if name else None
        got.append(str((i, r["payload_digest"], r["payload_bytes"], r["warc_type"])))
        if r["warc_type"] == "response":
            html = next(h for j, _, h in PAGES if j == i)
            assert bytes(r["payload"]).decode() == (html or "")
        else:
            assert r["refers_to"] == f"<urn:x-page:{first[next(h for j, _, h in PAGES if j == i) or '']}>"
    assert sorted(got) == want
    assert W.read_warc(spark, W.archive(df.limit(0))).count() == 0


def test_small_payloads_are_never_revisits(spark):
    df = spark.createDataFrame(PAGES, SCHEMA)
    rows = W.read_warc(spark, W.archive(df, min_revisit_bytes=11)).collect()
    assert {r["warc_type"] for r in rows} == {"response"}


def raw_record(i, payload):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:{i}>\r\nWARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def names(found):
    # a damaged name cannot be told from a good one: no check covers the header
    return [int(m[1]) for x in found if x["kind"] == "record" and (m := W._ID.fullmatch((x["record_id"] or "").encode()))]


def test_salvage_finds_all_undamaged_records():
    rng = random.Random(3)
    records = [raw_record(i, bytes(rng.randrange(256) for _ in range(rng.randrange(300)))) for i in range(40)]
    for zipped in (False, True):
        parts = [gzip.compress(r) if zipped else r for r in records]
        data = b"".join(parts)
        assert names(W.salvage(data)) == list(range(40))
        for trial in range(60):
            hurt = {rng.randrange(40) for _ in range(rng.randrange(1, 4))}
            broken = list(parts)
            for k in hurt:
                p = bytearray(broken[k])
                how = rng.randrange(3)
                at = rng.randrange(len(p))
                broken[k] = bytes(p[:at]) if how == 0 else bytes(p[:at] + bytes([p[at] ^ 0xFF]) + p[at + 1 :]) if how == 1 else bytes(p[:at]) + b"junk" * 5 + bytes(p[at:])
            data = b"".join(broken)
            found = list(W.salvage(data))
            got = names(found)
            assert set(range(40)) - hurt <= set(got), (zipped, trial, hurt)
            # records and gaps cover the file without overlap
            at = 0
            for x in found:
                assert x["offset"] == at and x["length"] > 0
                at += x["length"]
            assert at == len(data)


def test_damaged_file_through_spark(spark, tmp_path):
    good = [raw_record(i, b"payload %d" % i) for i in range(5)]
    (tmp_path / "a.warc").write_bytes(good[0] + b"garbage" + good[1] + good[2][:-30] + good[3] + good[4])
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(good[0]) + b"\x1f\x8b\x08broken" + gzip.compress(good[1]))
    (tmp_path / "c.warc").write_bytes(b"")
    rows = W.read_warc(spark, str(tmp_path)).orderBy("file", "offset").collect()
    assert [r["kind"] for r in rows if r["file"].endswith("a.warc")] == ["record", "gap", "record", "gap", "record", "record"]
    assert [r["kind"] for r in rows if r["file"].endswith("gz")] == ["record", "gap", "record"]


def test_base32_column(spark):
    texts = ["", "a", "é", "x" * 1000]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", W.base32_of_sha1(F.sha1("t")).alias("d")).collect()
    assert all(r["d"] == digest(r["t"]) for r in rows)
    assert new_path(spark, "x") != new_path(spark, "x")


def test_digests_of_other_algorithms_and_folded_headers():
    body = b"z" * 700
    sha256 = hashlib.sha256(body).hexdigest().encode()

    def record(extra):
        return b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x-page:1>\r\n" + extra + b"Content-Length: 700\r\n\r\n" + body + b"\r\n\r\n"

    good = [b"", b"X-Long: a\r\n  b\r\n\tc\r\n", b"WARC-Payload-Digest: sha256:" + sha256 + b"\r\n", b"WARC-Block-Digest: sha-256:" + sha256.upper() + b"\r\n", b"WARC-Payload-Digest: blake9:abc\r\n"]
    good += [b"WARC-Payload-Digest: md5:" + base64.b32encode(hashlib.md5(body).digest()).rstrip(b"=") + b"\r\n"]
    bad = [b"WARC-Payload-Digest: sha256:" + sha256[:-1] + b"0" + b"\r\n" if sha256[-1:] != b"0" else b"WARC-Payload-Digest: sha256:1\r\n", b"WARC-Block-Digest: sha1:AAAA\r\n"]
    assert [[x["kind"] for x in W.salvage(record(g))] for g in good] == [["record"]] * len(good)
    assert [[x["kind"] for x in W.salvage(record(b))] for b in bad] == [["gap"]] * len(bad)


def test_many_gzip_members_take_linear_time():
    import time

    rng = random.Random(3)
    member = [gzip.compress(b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 9000\r\n\r\n" + rng.randbytes(9000) + b"\r\n\r\n", 1) for _ in range(50)]
    began = time.perf_counter()
    assert sum(x["kind"] == "record" for x in W.salvage(b"".join(member) * 120)) == 6000
    assert time.perf_counter() - began < 15
