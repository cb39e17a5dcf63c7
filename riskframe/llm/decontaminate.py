"""Benchmark decontamination with one Aho-Corasick automaton over normalised items.

Every item (test question or answer) is normalised to words: ASCII capitals are
lower-cased and a word is a run of ASCII letters, digits and non-ASCII
characters. A window is 13 consecutive words of an item; an item of fewer words
is one window. All distinct windows become the patterns of one automaton. A
document is normalised the same way and scanned once; each match is mapped to
the range of document words it covers and from there to code-point offsets of
the original text.

The benchmark is the stated query set: it is read in blocks of bounded size, one
automaton per block, and every block scans all rows. No row is shuffled.

Defined results: a null or wordless text has no words, no hits and is clean; an
item whose text is null or has no words matches nothing; an item with a text but a null id
hits words like any other and has no id to be counted in n_items or listed; equal items all count; rows
are judged one by one, so repeated rows repeat their result; an empty benchmark
leaves every document clean; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import own_names, small_batches

WINDOW = 13
#: Bytes of benchmark text in one automaton (about 60 times this in a worker's memory).
BLOCK_BYTES = 2 << 20

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORD_BYTE = [48 <= c <= 57 or 97 <= c <= 122 or c >= 128 for c in range(256)]
#: UTF-8 bytes to normalised bytes: capitals lowered, separators to a space.
_NORMAL = bytes(c if _WORD_BYTE[c] else 32 for c in _LOWER)

_HITS = "array<struct<start:int,end:int,items:array<string>>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_NORMAL).split()


def item_windows(text: str | None, size: int = WINDOW) -> set[bytes]:
    """The windows of one item, each as words joined by single spaces."""
    w = words_of(text)
    if not w:
        return set()
    return {b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))}


def build_automaton(items: list[tuple[str | None, str | None]], size: int = WINDOW):
    """Automaton over the windows of (item_id, text) pairs, or None without windows."""
    import ahocorasick
    owners: dict[bytes, list[str]] = {}
    for item_id, text in items:
        for w in item_windows(text, size):
            ids = owners.setdefault(w, [])
            if item_id is not None:
                ids.append(item_id)
    if not owners:
        return None
    auto = ahocorasick.Automaton()
    for w, ids in owners.items():
        key = f" {w.decode('latin-1')} "
        auto.add_word(key, (len(key), w.count(b" ") + 1, ids))
    auto.make_automaton()
    return auto


def scan(words: list[bytes], auto) -> list[tuple[int, int, list[str]]]:
    """Matches as (first word, word after the last, item ids)."""
    if auto is None or not words:
        return []
    line = " " + b" ".join(words).decode("latin-1") + " "
    found = [(end - n + 1, k, ids) for end, (n, k, ids) in auto.iter(line)]
    if not found:
        return []
    starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
    first = np.searchsorted(starts, [f[0] for f in found])
    return [(int(i), int(i) + k, ids) for i, (_, k, ids) in zip(first, found)]


def char_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as code-point offsets (end exclusive) of the original text."""
    raw = text.encode()
    mask = np.array(_WORD_BYTE)[np.frombuffer(raw.translate(_LOWER), np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [(int(chars[edge[2 * a]]), int(chars[edge[2 * b - 1]])) for a, b in ranges]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str | None, str]]]:
    """The items in blocks of bounded bytes; the driver holds one block at a time."""
    block, held = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t"))
    for r in rows.where("t is not null").toLocalIterator():
        if block and held + len(r.t) > block_bytes:
            yield block
            block, held = [], 0
        block.append((r.i, r.t))
        held += len(r.t)
    if block:
        yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES,
                       size: int = WINDOW) -> DataFrame:
    """`docs` (doc_id, text, ...) plus hits: word ranges with the items found there.

    The columns of `docs` pass unchanged; `__hits` is the added column.
    """
    spark = docs.sparkSession
    small_batches(spark)
    out = docs.withColumn("__hits", F.expr(f"cast(array() as {_HITS})"))
    hit_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("items", pa.list_(pa.string()))]))
    for block in benchmark_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def add_hits(batches, shared=shared):
            auto = build_automaton(shared.value, size)
            for b in batches:
                at = b.schema.get_field_index("__hits")
                new = [old + [{"start": s, "end": e, "items": ids} for s, e, ids in scan(words_of(t), auto)]
                       for t, old in zip(b.column("text").to_pylist(), b.column(at).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(new, hit_type) if i == at else c for i, c in enumerate(b.columns)], names=b.schema.names)

        out = out.mapInArrow(add_hits, out.schema)
    return out


def digest(hits: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the hit spans."""
    def rows(batches):
        for b in batches:
            out = []
            for d, t, hs in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("__hits").to_pylist()):
                n = len(words_of(t))
                ranges = merged([(h["start"], h["end"]) for h in hs])
                n_hit = sum(e - s for s, e in ranges)
                items = sorted({i for h in hs for i in h["items"]})
                spans = char_spans(t, ranges) if ranges else []
                out.append({"doc_id": d, "n_words": n, "n_hit": n_hit, "n_items": len(items),
                            "items_sha256": hashlib.sha256(",".join(items).encode()).hexdigest(),
                            "contaminated": n_hit > 0 and 20 * n_hit >= n,
                            "spans": ",".join(f"{s}:{e}" for s, e in spans)})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("spans", pa.string())]))

    return hits.select("doc_id", "text", "__hits").mapInArrow(
        rows, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans string")


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The verdict per document (see `digest`)."""
    small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return digest(find_contamination(small, benchmark, block_bytes))


@own_names
def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` without the contaminated rows; all columns as they were."""
    hits = find_contamination(docs, benchmark, block_bytes)

    def clean(batches):
        for b in batches:
            keep = []
            for t, hs in zip(b.column("text").to_pylist(), b.column("__hits").to_pylist()):
                n_hit = sum(e - s for s, e in merged([(h["start"], h["end"]) for h in hs])) if hs else 0
                keep.append(not (n_hit > 0 and 20 * n_hit >= len(words_of(t))))
            yield b.filter(pa.array(keep, pa.bool_())).drop_columns(["__hits"])

    return hits.mapInArrow(clean, docs.schema)
