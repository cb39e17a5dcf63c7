"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte positions. For every adjacent pair that the
vocabulary can merge, the position waits in the bucket of the merge's rank. A
two-level bitmap marks the non-empty buckets, 256 ranks to a word, so
find-first-set on two words gives the next rank however many buckets exist.
Positions whose pair has changed since they were queued are skipped when popped.
Within a rank positions leave in text order, and a merge that makes a pair of a
lower rank possible yields to it, so the merges are those of the textbook rule
(lowest rank, leftmost first). A pre-token of n bytes costs O(n log n) for any n,
so a megabyte without a space is no special case; and all new pre-tokens of a
slice of texts share one queue, as parts of one list that no pair connects.

A text is cut at spaces that follow a non-space character. No pre-token crosses
such a cut (a space starts the next pre-token, and white-space runs stay whole),
so pieces encode independently and recurring pieces are remembered, in two
generations of bounded size.

Defined results: null and empty texts have no ids, the hash is that of no bytes;
every row gives one row, repeated rows included; extra columns are ignored.
"""
from __future__ import annotations

import base64
import functools
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches

#: Remembered pieces and pre-tokens per worker and generation (about 220 bytes each), and the longest remembered.
CACHE_PIECES = 250_000
CACHE_TOKENS = 600_000
CACHE_CHARS = 48
#: Characters encoded at once.
SLICE_CHARS = 2 << 20

_SPACE_PAIR = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")


_BIT = [1 << k for k in range(256)]


class Encoder:
    """Ranks, pre-token pattern and the bounded memory of pieces already encoded."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex
        self.ranks = ranks
        self.by_id = [b""] * (max(ranks.values()) + 1)
        for token, r in ranks.items():
            self.by_id[r] = token
        self.find = regex.compile(pattern).findall
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.new_tokens: dict[str, bytes] = {}
        self.old_tokens: dict[str, bytes] = {}

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens. They share one queue: no pair crosses from one to the next."""
        raw = b"".join(words)
        n = len(raw)
        get, by_id, bit = self.ranks.get, self.by_id, _BIT
        size = [1] * n                # bytes of the part that starts here; 0 once merged away
        prev = list(range(-1, n - 1))
        end: list[int] = []           # where the pre-token of a position ends
        at = 0
        for word in words:
            if word:
                prev[at] = -1
                at += len(word)
                end += [at] * len(word)
        # the queue: buckets of positions by rank; bit r % 256 of low[r // 256] and bit r // 256 of top mark a bucket
        buckets: dict[int, list[int]] = {}
        low: dict[int, int] = {}
        top = 0
        again = [(r, i) for i in range(n - 1) if end[i] != i + 1 and (r := get(raw[i:i + 2])) is not None]
        while True:
            for r, i in again:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    w = r >> 8
                    low[w] = low.get(w, 0) | bit[r & 255]
                    top |= bit[w]
            if not top:
                break
            w = (top & -top).bit_length() - 1          # find-first-set, upper then lower word
            x = low[w]
            rank = w << 8 | (x & -x).bit_length() - 1
            x &= x - 1
            low[w] = x
            if not x:
                top &= top - 1
            bucket = buckets.pop(rank)
            bucket.sort()
            length = len(by_id[rank])
            again = []
            wait = 0                  # positions before this wait for a lower rank in their pre-token
            for i in bucket:
                if i < wait:
                    again.append((rank, i))
                    continue
                a = size[i]
                j = i + a
                e = end[i]
                if not a or j >= e or a + size[j] != length or get(raw[i:i + length]) != rank:
                    continue          # stale: the pair at i is no longer the one that was queued
                size[i] = length
                size[j] = 0
                j = i + length
                if j < e:
                    prev[j] = i
                    r = get(raw[i:j + size[j]])
                    if r is not None:
                        again.append((r, i))
                        if r < rank:
                            wait = e
                k = prev[i]
                if k >= 0:
                    r = get(raw[k:j])
                    if r is not None:
                        again.append((r, k))
                        if r < rank:
                            wait = e
        out, i, at = [], 0, 0
        for word in words:
            at += len(word)
            ids = []
            while i < at:
                a = size[i]
                ids.append(get(raw[i:i + a]))
                i += a
            out.append(ids)
        return out

    def tokens(self, texts: set[str]) -> dict[str, bytes]:
        """Ids of pre-tokens as little-endian 32-bit integers, from memory or merged now."""
        known, old, out, todo = self.new_tokens, self.old_tokens, {}, []
        for t in texts:
            got = known.get(t) or old.get(t)
            if got is None:
                raw = t.encode()
                r = self.ranks.get(raw)
                if r is None:
                    todo.append((t, raw))
                    continue
                got = r.to_bytes(4, "little")
            out[t] = got
        for (t, _), ids in zip(todo, self.merge([raw for _, raw in todo])):
            out[t] = struct.pack(f"<{len(ids)}I", *ids)
        if len(known) + len(out) > CACHE_TOKENS:
            self.old_tokens, self.new_tokens = known, {}
        self.new_tokens.update((t, x) for t, x in out.items() if len(t) <= CACHE_CHARS)
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        known, old, unseen = self.new, self.old, {}
        parts = []
        for text in texts:
            first, *rest = _CUT.split(text) if _SPACE_PAIR.search(text) else text.split(" ")
            keys = [first, *[" " + p for p in rest]]
            for k in keys:
                if k not in known and k not in unseen:
                    got = old.get(k)
                    unseen[k] = got if got is not None else self.find(k)
            parts.append(keys)
        todo = {k: v for k, v in unseen.items() if type(v) is list}
        ids = self.tokens({t for v in todo.values() for t in v})
        for k, v in todo.items():
            unseen[k] = b"".join([ids[t] for t in v])
        known.update(unseen)
        out = [b"".join([known[k] for k in keys]) for keys in parts]
        for k in unseen:
            if len(k) > CACHE_CHARS:
                del known[k]
        if len(known) >= CACHE_PIECES:
            self.old, self.new = known, {}
        return out

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """`encode_batch` over slices of bounded size."""
        held, chars = [], 0
        for t in texts:
            held.append(t or "")
            chars += len(held[-1])
            if chars >= SLICE_CHARS:
                yield from self.encode_batch(held)
                held, chars = [], 0
        if held:
            yield from self.encode_batch(held)

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.by_id.__getitem__, memoryview(ids).cast("I")))


@functools.lru_cache(2)
def load(path: str, pattern: str) -> Encoder:
    """The encoder of a rank file; one per worker process."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return Encoder(ranks, pattern)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers as P
    return P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def _encoder(vocabulary: tuple[str, str] | None) -> Encoder:
    # the rank file is installed with the package on every executor, so its path is resolved there
    return load(*(vocabulary or default_vocabulary()))


def encode_texts(docs: DataFrame, column: str = "text", ids: str = "ids", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """`docs` plus a binary column of ids (little-endian unsigned 32-bit); null text gives no ids."""
    small_batches(docs.sparkSession)
    schema = docs.withColumn(ids, F.lit(b"")).schema

    def rows(batches):
        enc = _encoder(vocabulary)
        for b in batches:
            col = pa.array(list(enc.encode_all(b.column(column).to_pylist())), pa.binary())
            if ids in b.schema.names:
                at = b.schema.get_field_index(ids)
                yield b.set_column(at, pa.field(ids, pa.binary()), col)
            else:
                yield b.append_column(pa.field(ids, pa.binary()), col)

    return docs.mapInArrow(rows, schema)


def decode_ids(df: DataFrame, ids: str = "ids", column: str = "decoded", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """`df` plus the bytes its ids stand for."""
    small_batches(df.sparkSession)
    schema = df.withColumn(column, F.lit(b"")).schema

    def rows(batches):
        enc = _encoder(vocabulary)
        for b in batches:
            col = pa.array([enc.decode(x or b"") for x in b.column(ids).to_pylist()], pa.binary())
            if column in b.schema.names:
                yield b.set_column(b.schema.get_field_index(column), pa.field(column, pa.binary()), col)
            else:
                yield b.append_column(pa.field(column, pa.binary()), col)

    return df.mapInArrow(rows, schema)


def digest(docs: DataFrame, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode, then decode the ids, in one pass."""
    small_batches(docs.sparkSession)

    def rows(batches):
        enc = _encoder(vocabulary)
        for b in batches:
            n, hi, hd = [], [], []
            for ids in enc.encode_all(b.column("text").to_pylist()):
                n.append(len(ids) // 4)
                hi.append(hashlib.sha256(ids).hexdigest())
                hd.append(hashlib.sha256(enc.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(hi, pa.string()), pa.array(hd, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
