"""WARC archives: write records, read them back, reassemble segmented ones.

`write_archives` turns each page into a WARC/1.1 record whose block is an HTTP
response in chunked transfer coding. Equal payloads of at least 1000 bytes are
stored once, in the page with the largest id; the others are revisit records
that name it. A block above `SEGMENT_BYTES` is cut: the first segment is the
record itself, the rest are continuation records with the origin's identifier
and a segment number, the last one with the total length. Spark's text writer
makes the files (the record separator is its line separator, gzip its codec), so
archives go to whatever store Spark writes to.

`read_archives` inflates each archive as a stream. Whole records are decoded on
the spot. Segments are grouped by origin identifier, ordered by segment number,
checked for gaps and against the total length, and joined before the chunked
framing is decoded. A group is one payload. Payload digests are verified.

Defined results: null html is an empty payload; records below 1000 bytes never
refer to others; rows without a page_id have the smallest id, and equal payloads
whose rows all lack one are all responses; a repeated row is a record of its
own, and copies of the row with the largest id are all responses; an empty table
gives no records; extra columns are ignored; a null url is left out.
"""
from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import BATCH_ROWS, small_batches, written
from riskframe.session import scratch_path

MIN_SHARED_BYTES = 1000
SEGMENT_BYTES = 32 << 10      # block bytes in one record
CHUNK_BYTES = 4 << 10         # bytes in one chunk of the transfer coding
RECORDS_PER_FILE = 2000       # bounds an archive at about 64 MB inflated

_END = "\r\n\r\n"


# Framing.

def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """`payload` in chunked transfer coding."""
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for c in (payload[i:i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        eol = body.index(b"\r\n", at)
        n = int(body[at:eol].split(b";", 1)[0], 16)
        at = eol + 2
        if n == 0:
            return b"".join(out)
        if body[at + n:at + n + 2] != b"\r\n":
            raise ValueError("chunk is shorter than its size")
        out.append(body[at:at + n])
        at += n + 2


def http_parts(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and decoded body of an HTTP response."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("latin-1").split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    return fields, dechunked(body) if fields.get("transfer-encoding") == "chunked" else body


def record_head(fields: list[tuple[str, str | int | None]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n").encode()


def base32_sha1(hexed: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexed)).decode()


def records_of(page_id: int | None, row: int, url: str | None, payload: bytes, digest: str, refers_to: int | None,
               revisit: bool, segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The record of a page without the closing separator, in as many segments as it takes."""
    me = f"<urn:x-page:{'' if page_id is None else page_id}:{row}>"
    common = [("WARC-Target-URI", None if url is None else quote(url, safe="/:?#[]@!$&'()*+,;=%~-._")), ("WARC-Date", "1970-01-01T00:00:00Z"),
              ("WARC-Payload-Digest", base32_sha1(digest)), ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        yield record_head([("WARC-Type", "revisit"), ("WARC-Record-ID", me), ("WARC-Refers-To", f"<urn:x-page:{refers_to}>"),
                           ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), *common,
                           ("Content-Length", len(block))]) + block
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    pieces = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(pieces) == 1:
        yield record_head([("WARC-Type", "response"), ("WARC-Record-ID", me), *common, ("Content-Length", len(block))]) + block
        return
    for n, piece in enumerate(pieces, 1):
        last = ("WARC-Segment-Total-Length", len(block) if n == len(pieces) else None)
        if n == 1:
            head = [("WARC-Type", "response"), ("WARC-Record-ID", me), ("WARC-Segment-Number", 1), *common]
        else:
            head = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{me[:-1]}:{n}>"), ("WARC-Segment-Origin-ID", me),
                    ("WARC-Segment-Number", n), ("WARC-Date", "1970-01-01T00:00:00Z"), last]
        yield record_head([*head, ("Content-Length", len(piece))]) + piece


def inflated(raw: bytes, step: int = 1 << 18) -> Iterator[bytes]:
    """The bytes of a gzip file (any number of members) in pieces; plain files pass as they are."""
    if raw[:2] != b"\x1f\x8b":
        yield raw
        return
    z, at, tail = zlib.decompressobj(31), 0, b""
    while tail or at < len(raw):
        if not tail:
            tail, at = raw[at:at + step], at + step
        yield z.decompress(tail, step)
        tail = z.unconsumed_tail
        if z.eof:
            tail, z = z.unused_data, zlib.decompressobj(31)
    yield z.flush()


def parse(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of a stream."""
    held, source = bytearray(), iter(pieces)

    def fill() -> bool:
        for data in source:
            held.extend(data)
            return True
        return False

    while True:
        while held.find(b"\r\n\r\n") < 0:
            if not fill():
                if held.strip():
                    raise ValueError("archive ends inside a record's header")
                return
        end = held.find(b"\r\n\r\n")
        lines = held[:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n, start = int(fields["Content-Length"]), end + 4
        while len(held) < start + n + 4:
            if not fill():
                raise ValueError("archive ends inside a record's block")
        block = bytes(held[start:start + n])
        if held[start + n:start + n + 4] != b"\r\n\r\n":
            raise ValueError("record is not closed")
        del held[:start + n + 4]
        yield fields, block


# Spark jobs.

def classified(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, revisit and refers_to per page."""
    p = (pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
         .withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long")))
    shared = (p.where(F.col("payload_bytes") >= MIN_SHARED_BYTES).groupBy("payload_digest")
              .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
              .where("n > 1 and first is not null").select(F.col("payload_digest").alias("__d"), "first"))
    j = p.join(shared, (p["payload_digest"] == shared["__d"]) & (p["payload_bytes"] >= MIN_SHARED_BYTES), "left")
    return (j.withColumn("revisit", F.expr("first is not null and not (page_id <=> first)"))
            .withColumn("refers_to", F.expr("if(revisit, first, null)")).drop("__d", "first"))


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write gzipped WARC files below `path`."""
    small_batches(pages.sparkSession)

    def rows(batches):
        names = ("page_id", "row", "url", "payload", "payload_digest", "refers_to", "revisit")
        for b in batches:
            out: list[bytes] = []
            for r in zip(*(b.column(n).to_pylist() for n in names)):
                out += records_of(*r, segment_bytes=segment_bytes)
                if len(out) >= BATCH_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    # the row number only has to be unique within what is written
    (classified(pages).withColumn("row", F.monotonically_increasing_id()).mapInArrow(rows, "value binary")
     .select(F.col("value").cast("string")).write.option("lineSep", _END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


_PARSED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
                     ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64())])
_PARSED_SQL = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
               "payload binary, origin string, segment int, total long")


def _hex(field: str) -> str:
    return base64.b32decode(field.removeprefix("sha1:")).hex()


def _page(record_id: str) -> int | None:
    digits = record_id.removeprefix("<urn:x-page:").rstrip(">").split(":")[0]
    return int(digits) if digits else None


def decoded(fields: dict[str, str], block: bytes, payloads: bool) -> dict:
    """The row of a whole record."""
    http, body = http_parts(block)
    row = {"page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"]}
    digest = _hex(fields["WARC-Payload-Digest"])
    if fields["WARC-Type"] == "revisit":
        return row | {"refers_to": _page(fields["WARC-Refers-To"]), "payload_bytes": int(http["content-length"]), "payload_digest": digest}
    own = hashlib.sha1(body).hexdigest()
    if own != digest:
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']} does not match")
    return row | {"payload_bytes": len(body), "payload_digest": own, "payload": body if payloads else None}


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest (and payload) of every page in the archives."""
    def rows(batches):
        for b in batches:
            for raw in b.column("content"):
                out = []
                for fields, block in parse(inflated(raw.as_py())):
                    if "WARC-Segment-Number" in fields:
                        n = int(fields["WARC-Segment-Number"])
                        total = fields.get("WARC-Segment-Total-Length")
                        out.append({"origin": fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"]), "segment": n,
                                    "total": total and int(total), "payload": block, "url": fields.get("WARC-Target-URI"),
                                    "record_type": fields["WARC-Type"],
                                    "payload_digest": _hex(fields["WARC-Payload-Digest"]) if n == 1 else None})
                    else:
                        out.append(decoded(fields, block, payloads))
                    if len(out) >= BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(out, schema=_PARSED)
                        out = []
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_PARSED)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")      # one archive at a time
    try:
        parsed = written(spark.read.format("binaryFile").load(path).select("content").mapInArrow(rows, _PARSED_SQL), "warc-records")
    finally:
        small_batches(spark)
    whole = parsed.where("origin is null").drop("origin", "segment", "total")
    return whole.unionByName(reassembled(parsed.where("origin is not null"), payloads))


def reassembled(segments: DataFrame, payloads: bool = False) -> DataFrame:
    """The pages of segmented records, one group per origin."""
    def rows(batches):
        for b in batches:
            out = []
            for origin, parts in zip(b.column("origin").to_pylist(), b.column("parts").to_pylist()):
                parts.sort(key=lambda x: x["segment"])
                total = parts[-1]["total"]
                if [x["segment"] for x in parts] != list(range(1, len(parts) + 1)) or total is None:
                    raise ValueError(f"segments of {origin} are missing or repeated")
                block = b"".join(x["payload"] for x in parts)
                if len(block) != total:
                    raise ValueError(f"segments of {origin} hold {len(block)} bytes of {total}")
                fields = {"WARC-Type": "response", "WARC-Record-ID": origin, "WARC-Payload-Digest": base32_sha1(parts[0]["payload_digest"])}
                out.append(decoded(fields, block, payloads) | {"url": parts[0]["url"]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(list(_PARSED)[:7]))

    return (segments.groupBy("origin").agg(F.collect_list(F.struct("segment", "total", "payload", "url", "payload_digest")).alias("parts"))
            .mapInArrow(rows, _PARSED_SQL.split(", origin")[0]))


def round_trip(pages: DataFrame, path: str | None = None, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write the pages as archives and report what reading them gives."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, segment_bytes)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB SQL for `round_trip` over table pages.
ORACLE = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
s AS (SELECT payload_digest AS d, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN s ON payload_digest = d
"""
