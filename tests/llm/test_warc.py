import gzip
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from riskframe.llm import warc
from riskframe.session import scratch_path

COLS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def plain(rows):
    raw = [(i, (h or "").encode()) for i, h in rows]
    best = {}
    for i, b in raw:
        if len(b) >= 1000 and i is not None:
            best[b] = max(i, best.get(b, i))
    return [(i, len(b), hashlib.sha1(b).hexdigest(), *(("response", None) if b not in best or i == best[b] else ("revisit", best[b])))
            for i, b in raw]


@pytest.fixture(scope="module")
def odd_pages(spark):
    same, longer = "<p>équal</p>" * 100, "".join(f"<p>日本 {i}\r\n\r\n</p>" for i in range(9000))
    rows = [(1, "http://a/", None), (2, None, ""), (3, "http://a/\r\nX: y", same), (4, "u", same), (9, "u", same), (5, "u", "small"),
            (6, "u", "small"), (7, "u", longer), (8, "u", longer + "x"), (10, "u", longer), (11, "u", "WARC/1.1\r\n\r\n" * 90),
            (12, "u", "x" * 999), (13, "u", "x" * 999), (14, "u", "x" * 1000), (15, "u", "x" * 1000)]
    rows += [rows[4], rows[9], (None, "u", same), (None, "u", "y" * 2000), (None, "u", "y" * 2000)]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string").repartition(3)


@pytest.mark.parametrize("segment_bytes", [warc.SEGMENT_BYTES, 700])
def test_round_trip(spark, odd_pages, same, segment_bytes):
    rows = [(r.page_id, r.html) for r in odd_pages.collect()]
    path = scratch_path(spark, "warc")
    same(warc.round_trip(odd_pages, path, segment_bytes), COLS, plain(rows))
    got = sorted(r.payload for r in warc.read_archives(spark, path, payloads=True).where("record_type = 'response'").collect())
    want = sorted((h or "").encode() for (i, h), p in zip(rows, plain(rows)) if p[3] == "response")
    assert got == want


def test_oracle_and_empty(spark, same):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    con = duckdb.connect()
    con.execute("create view pages as select * from '/root/testdata/sf0.001/pages.parquet'")
    same(warc.round_trip(pages), COLS, [tuple(r) for r in con.execute(warc.ORACLE).fetchall()])
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_segments_are_checked(spark, odd_pages):
    segs = spark.createDataFrame([("<urn:x-page:1:0>", 1, None, bytearray(b"ab"), "u", "00" * 20), ("<urn:x-page:1:0>", 3, 4, bytearray(b"cd"), "u", None)],
                                 "origin string, segment int, total long, payload binary, url string, payload_digest string")
    with pytest.raises(Exception, match="missing"):
        warc.reassembled(segs).collect()
    short = segs.withColumn("segment", F.when(F.col("segment") == 3, 2).otherwise(1)).withColumn("total", F.lit(9).cast("long"))
    with pytest.raises(Exception, match="4 bytes of 9"):
        warc.reassembled(short).collect()


def test_framing():
    for n in (0, 1, 4095, 4096, 4097, 20000):
        b = bytes(range(256)) * (n // 256 + 1)
        assert warc.dechunked(warc.chunked(b[:n])) == b[:n]
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: z\r\n\r\n") == b"abc"
    raw = gzip.compress(b"a" * 10**6) + gzip.compress(b"b" * 10)
    assert b"".join(warc.inflated(raw)) == b"a" * 10**6 + b"b" * 10
