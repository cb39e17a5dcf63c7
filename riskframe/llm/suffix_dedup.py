"""Removal of long repeated strings with a logarithmic family of suffix indexes.

A suffix index over every byte would be many times the corpus, so it is sparse:
of each `LENGTH`-byte window the content picks one 200-byte gram, the one with
the least hash, and equal windows pick equal grams wherever they stand. A run of
consecutive windows with the same pick is one entry: the gram's fingerprint (the
key by which suffixes are ordered), a digest of the run's whole string, and its
place. That is about one entry per 110 bytes. Suffixes are ordered by
fingerprint rather than by letters: neighbours in either order share the gram,
and only that matters here.

`SuffixFamily` keeps levels of entries sorted by key. A new batch gets an index
of its own, which is merge-scanned against itself and every level: keys that
occur twice mark possible long matches. Then levels of the same size class merge,
so n batches leave O(log n) levels and rewrite each entry O(log n) times.

Exactness comes after: of all entries under matched keys, runs whose whole
string recurs are repeated throughout. Where a key has several different runs,
one of each is fetched from its text, and the fingerprints of its windows are
compared: a window is repeated if its fingerprint occurs twice. Keys are streamed
sorted, many at a time; a key with very many different runs is compared by a
distributed aggregation instead, so no group grows in one task. Runs travel as
their bytes, about a fifth of their fingerprints' size, and fingerprints are made
where they are compared. Spans go to the texts by one join, where each is checked
against the text. Fetching and that join are one query over the same exchange of
the texts, so those move once after indexing.

Defined results: a null text is empty; texts shorter than `LENGTH` keep all;
matches never cross texts; repeated rows are texts of their own and thus repeat
each other; rows that share a doc_id, or have none, are told apart by the run
fingerprints; extra columns pass or are ignored; an empty table gives no rows.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import own_names, python_rows, small_batches, written
from riskframe.llm.neardup import _STEP, _odd, mixed

LENGTH = 400                 # bytes of a string whose repetition counts
GRAM = 200                   # bytes of a gram; any window holds LENGTH - GRAM + 1
BLOCK = 1 << 20              # windows handled at once
MANY_RUNS = 20_000           # different runs under one key from which it is compared by aggregation
_STREAM_WINDOWS = 2 << 20
_JOINED = 1 << 18            # bytes of short runs whose windows are fingerprinted at once

_U = np.uint64
_BYTE = _odd(256, 21)
_ENTRY = "key long, run long, doc_id long, start long, windows int, self boolean"


_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        n = 1 << (n - 1).bit_length()
        both = []
        for x in (_STEP, pow(_STEP, -1, 1 << 64)):
            p = np.full(n, x, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        _powers = tuple(both)
    return _powers


class Prints:
    """Fingerprints of substrings of a byte string by prefix sums; equal strings have equal prints at any place.

    Modulo 2^64 some strings of special structure collide, so these prints only
    choose grams and propose matches; `run_digest` and `window_prints` decide.
    """

    def __init__(self, x: np.ndarray) -> None:
        self.power, self.inverse = _power_tables(len(x) + 1)
        self.sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(_BYTE[x] * self.power[:len(x)], out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        """Prints of all substrings of this length."""
        d = self.sums[length:] - self.sums[:-length]
        return mixed(d * self.inverse[:len(d)] + _U(length))


def run_digest(raw: bytes) -> int:
    """64-bit keyed digest of a run's whole string."""
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8, key=b"run").digest(), "little", signed=True)


_P = 2 ** 31 - 1
_BASES = (1_270_543_417, 2_013_265_921 % _P)


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo the prime 2^31 - 1, for 0 <= x < 2^62."""
    x = (x & _P) + (x >> 31)
    x = (x & _P) + (x >> 31)
    return np.where(x >= _P, x - _P, x)


_prime_tables: dict[int, np.ndarray] = {}


def _prime_powers(base: int, n: int) -> np.ndarray:
    p = _prime_tables.get(base, np.ones(1, np.int64))
    while len(p) < n:
        p = np.concatenate([p, _mod(p * pow(base, len(p), _P))])
    _prime_tables[base] = p
    return p[:n]


_PRIME_BYTE = np.random.default_rng(31).integers(1, _P, (len(_BASES), 256), dtype=np.int64)
_INVERSES = tuple(pow(b, -1, _P) for b in _BASES)


def window_prints(x: np.ndarray, length: int) -> np.ndarray:
    """62-bit prints of all substrings of `length` bytes: two polynomials modulo the prime 2^31 - 1."""
    out = np.zeros(len(x) - length + 1, np.int64)
    for base, inv, table in zip(_BASES, _INVERSES, _PRIME_BYTE):
        sums = np.zeros(len(x) + 1, np.int64)
        # prefix sums of terms below 2^31 stay below 2^62 for 2^31 bytes
        np.cumsum(_mod(table[x] * _prime_powers(base, len(x))), out=sums[1:])
        inverse = _prime_powers(inv, len(out))
        out = (out << 31) | _mod(_mod(sums[length:] - sums[:-length]) * inverse)
    return out


def prints_of(runs: list[bytes], length: int) -> list[np.ndarray]:
    """`window_prints` of many strings, of which short ones are joined and handled at once."""
    out, at = [], 0
    while at < len(runs):
        end, size = at + 1, len(runs[at])
        while end < len(runs) and size + len(runs[end]) <= _JOINED:
            size += len(runs[end])
            end += 1
        prints = window_prints(np.frombuffer(b"".join(runs[at:end]), np.uint8), length)
        starts = np.cumsum([0, *map(len, runs[at:end])])
        out += [prints[s:e - length + 1] for s, e in zip(starts[:-1], starts[1:])]
        at = end
    return out


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    n = len(h) - w + 1
    p = np.concatenate([h, np.full(-len(h) % w, ~_U(0))]).reshape(-1, w)
    left = np.minimum.accumulate(p, axis=1).ravel()
    right = np.minimum.accumulate(p[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


def runs_of(raw: bytes, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> list[tuple[np.ndarray, ...]]:
    """Entries of a text, block by block: key, run print, first window, number of windows, whether a gram recurs inside."""
    out, w = [], length - gram + 1
    whole = np.frombuffer(raw, np.uint8)
    for at in range(0, len(whole) - length + 1, block):
        x = whole[at:at + block + length - 1]
        prints = Prints(x)
        h = prints.all(gram)
        low = sliding_min(h, w)
        a = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        z = np.concatenate([a[1:], [len(low)]])
        key = low[a]
        # occurrences of the gram inside a run: at starts of its own windows, and behind the last of them
        inside = np.add.reduceat((h[:len(low)] == low).astype(np.int64), a)
        tail = z[:, None] + np.arange(w - 1)
        behind = (h[np.minimum(tail, len(h) - 1)] == key[:, None]) & (tail < len(h))
        run = [run_digest(raw[i:j]) for i, j in zip((a + at).tolist(), (z + at + length - 1).tolist())]
        out.append((key.view(np.int64), np.array(run, np.int64), a + at, (z - a).astype(np.int32), inside + behind.sum(1) > 1))
    return out


def entries(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """The sparse suffixes of all rows."""
    small_batches(docs.sparkSession)
    names = ["key", "run", "doc_id", "start", "windows", "self"]

    def rows(batches):
        for b in batches:
            parts, ids = [], []
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                for r in runs_of((t or "").encode(), length, gram, block):
                    parts.append(r)
                    ids += [d] * len(r[0])
            if parts:
                key, run, start, windows, twice = (np.concatenate(c) for c in zip(*parts))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(run), pa.array(ids, pa.int64()), pa.array(start),
                                                  pa.array(windows), pa.array(twice)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, _ENTRY)


class SuffixFamily:
    """Levels of sparse suffix indexes in the shared folder, and the keys that occur twice."""

    def __init__(self, spark: SparkSession, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> None:
        self.spark, self.length, self.gram, self.block = spark, length, gram, block
        self.levels: list[tuple[int, DataFrame]] = []        # (number of batches in it, entries sorted by key)
        self.matched: DataFrame | None = None                # keys that occur twice

    def insert(self, docs: DataFrame) -> None:
        """Index a batch, scan it against itself and the levels, and merge levels of equal size."""
        new = written(entries(docs, self.length, self.gram, self.block).repartition("key").sortWithinPartitions("key"), "suffix-level")
        # one scan over the batch's keys and all levels': a key of the batch that occurs twice is matched
        seen = new.select("key", F.lit(1).alias("new"), F.col("self").cast("int").alias("n"))
        for _, level in self.levels:
            seen = seen.union(level.select("key", F.lit(0), F.lit(0)))
        keys = (seen.groupBy("key").agg(F.sum("new").alias("new"), (F.count("*") + F.sum("n")).alias("n"))
                .where("new > 0 and n > 1").select("key"))
        if self.matched is not None:
            keys = keys.union(self.matched)
        self.matched = written(keys.distinct(), "suffix-matches")
        self.levels.append((1, new))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, b), (m, a) = self.levels.pop(), self.levels.pop()
            self.levels.append((n + m, written(a.union(b).repartition("key").sortWithinPartitions("key"), "suffix-level")))

    def candidates(self) -> DataFrame:
        """Entries under matched keys, over all levels."""
        every = self.levels[0][1]
        for _, level in self.levels[1:]:
            every = every.union(level)
        return every.join(self.matched, "key", "left_semi")

    def spans(self, docs: DataFrame, many_runs: int = MANY_RUNS) -> DataFrame:
        """(doc_id, spans): per document its entries with repeated windows; mask null means all of them."""
        cand = written(self.candidates(), "suffix-candidates")
        runs = written(cand.groupBy("key", "run").agg(F.count("*").alias("n"), F.max("self").alias("self"),
                                                      F.min(F.struct("doc_id", "start", "windows")).alias("at")), "suffix-runs")
        # keys whose runs are compared: several different ones, or a single one in which the gram recurs
        compared = written(runs.groupBy("key").agg(F.count("*").alias("runs"), F.max(F.expr("n = 1 and self")).alias("lone"))
                           .where("runs > 1 or lone").select("key", (F.col("runs") > many_runs).alias("many")), "suffix-compared")
        found = (runs.where("n > 1").select("key", "run", F.lit(None).cast("binary").alias("mask"))
                 .union(self.masks(docs, runs.join(compared, "key"), not compared.where("many").isEmpty())))
        return (cand.select("key", "run", "doc_id", "start", "windows").join(found, ["key", "run"])
                .groupBy("doc_id").agg(F.collect_set(F.struct("start", "windows", "run", "mask")).alias("__spans")))

    def masks(self, docs: DataFrame, runs: DataFrame, any_many: bool) -> DataFrame:
        """(key, run, mask) of runs that occur once: which of their windows are repeated under the key, as packed bits."""
        length = self.length

        def cut(batches):
            for b in batches:
                out = {"key": [], "run": [], "once": [], "raw": []}
                for text, picked in python_rows(b, "text", "picked"):
                    whole = (text or "").encode()
                    for r in picked:
                        raw = whole[r["start"]:r["start"] + r["windows"] + length - 1]
                        if len(raw) == r["windows"] + length - 1 and run_digest(raw) == r["run"]:
                            for c, v in zip(out.values(), (r["key"], r["run"], r["once"], raw)):
                                c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(out["key"], pa.int64()), pa.array(out["run"], pa.int64()),
                                                  pa.array(out["once"], pa.bool_()), pa.array(out["raw"], pa.binary())], names=list(out))

        def fetched(runs: DataFrame) -> DataFrame:
            at = (runs.select(F.col("at.doc_id").alias("__d"), F.struct(
                    "key", "run", (F.col("n") == 1).alias("once"), F.col("at.start").alias("start"), F.col("at.windows").alias("windows")).alias("r"))
                  .groupBy("__d").agg(F.collect_list("r").alias("picked")))
            # rows that share a doc_id may both fit: they give the run twice
            return (_by_doc(docs.select("doc_id", "text"), at, "inner").select("text", "picked")
                    .mapInArrow(cut, "key long, run long, once boolean, raw binary"))

        def stream(batches):
            held, windows, last = [], 0, None
            for b in batches:
                key = b.column("key").to_numpy()
                edge = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
                for s, e in zip(edge, edge[1:]):
                    if s == e:
                        continue
                    if held and key[s] != last and windows >= _STREAM_WINDOWS:
                        yield repeated(pa.Table.from_batches(held), length)
                        held, windows = [], 0
                    part = b.slice(s, e - s)
                    held.append(part)
                    windows += pc.sum(pc.binary_length(part.column("raw"))).as_py() - (length - 1) * len(part)
                    last = key[s]
            if held:
                yield repeated(pa.Table.from_batches(held), length)

        few = (fetched(runs.where("not many")).repartition("key").sortWithinPartitions("key")
               .select("key", "run", "once", "raw").mapInArrow(stream, "key long, run long, mask binary"))
        if not any_many:
            return few

        def printed(batches):
            for b in batches:
                prints = prints_of(b.column("raw").to_pylist(), length)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("key", "run", "once")), pa.array(prints, pa.list_(pa.int64()))],
                                                 names=["key", "run", "once", "prints"])

        window = (fetched(runs.where("many")).groupBy("key", "run", "once").agg(F.min("raw").alias("raw"))
                  .mapInArrow(printed, "key long, run long, once boolean, prints array<long>")
                  .select("key", "run", "once", F.posexplode("prints").alias("pos", "print")))
        twice = window.groupBy("key", "print").agg(F.count("*").alias("n")).where("n > 1").select("key", "print")
        places = window.where("once").join(twice, ["key", "print"]).groupBy("key", "run").agg(F.collect_set("pos").alias("places"))

        def pack(batches):
            for b in batches:
                bits = []
                for p in b.column("places"):
                    m = np.zeros(1 + max(p.as_py()), np.uint8)
                    m[p.values.to_numpy()] = 1
                    bits.append(np.packbits(m).tobytes())
                yield pa.RecordBatch.from_arrays([b.column("key"), b.column("run"), pa.array(bits, pa.binary())], names=["key", "run", "mask"])

        return few.union(places.mapInArrow(pack, "key long, run long, mask binary"))


def repeated(t: pa.Table, length: int) -> pa.RecordBatch:
    """Masks of the runs of a table of whole keys that occur once: windows whose print occurs twice in it."""
    keys, runs, once, raws = (t.column(c).to_pylist() for c in ("key", "run", "once", "raw"))
    at = sorted({k: i for i, k in reversed(list(enumerate(zip(keys, runs))))}.values())
    prints = prints_of([raws[i] for i in at], length)
    _, back, count = np.unique(np.concatenate(prints), return_inverse=True, return_counts=True)
    hit = (count[back] > 1).astype(np.uint8)
    ends = np.cumsum([len(p) for p in prints])
    masks = [(i, np.packbits(hit[s:e]).tobytes()) for i, s, e in zip(at, [0, *ends[:-1]], ends) if once[i] and hit[s:e].any()]
    return pa.RecordBatch.from_arrays([pa.array([keys[i] for i, _ in masks], pa.int64()), pa.array([runs[i] for i, _ in masks], pa.int64()),
                                       pa.array([m for _, m in masks], pa.binary())], names=["key", "run", "mask"])


def removed(raw: bytes, spans: list[dict] | None, length: int = LENGTH) -> np.ndarray:
    """Which bytes go; spans whose run is not what the text holds at that place belong to another row."""
    cover = np.zeros(len(raw) + 1, np.int32)
    for s in spans or ():
        a, n = s["start"], s["windows"]
        part = raw[a:a + n + length - 1]
        if len(part) < n + length - 1 or run_digest(part) != s["run"]:
            continue
        if s["mask"] is None:
            cover[a] += 1
            cover[a + len(part)] -= 1
        else:
            at = a + np.flatnonzero(np.unpackbits(np.frombuffer(s["mask"], np.uint8)))
            np.add.at(cover, at, 1)
            np.add.at(cover, at + length, -1)
    return np.cumsum(cover[:-1]) > 0


def _by_doc(docs: DataFrame, per_doc: DataFrame, how: str) -> DataFrame:
    """`docs` with the columns of `per_doc`, a row for each `__d`; rows without a doc_id meet that without `__d`."""
    per_doc = per_doc.hint("shuffle_hash")
    return docs.join(per_doc, docs["doc_id"].cast("long").eqNullSafe(per_doc["__d"]), how).drop("__d")


def _with_spans(docs: DataFrame, family: SuffixFamily, many_runs: int) -> DataFrame:
    return _by_doc(docs, family.spans(docs, many_runs).withColumnRenamed("doc_id", "__d"), "left")


def indexed(docs: DataFrame, batches: int = 1, **sizes) -> SuffixFamily:
    """A family that holds `docs`, inserted in so many batches."""
    family = SuffixFamily(docs.sparkSession, **sizes)
    for i in range(batches):
        family.insert(docs if batches == 1 else docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == i))
    return family


def digest(docs: DataFrame, batches: int = 1, many_runs: int = MANY_RUNS, **sizes) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    family = indexed(docs, batches, **sizes)
    length = family.length

    def rows(batches):
        for b in batches:
            out = []
            for d, t, spans in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "__spans"))):
                raw = (t or "").encode()
                if not spans:
                    out.append({"doc_id": d, "n_bytes": len(raw), "n_removed": 0, "n_spans": 0, "kept_sha256": hashlib.sha256(raw).hexdigest()})
                    continue
                gone = removed(raw, spans, length)
                starts = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append({"doc_id": d, "n_bytes": len(raw), "n_removed": int(gone.sum()), "n_spans": starts,
                            "kept_sha256": hashlib.sha256(kept).hexdigest()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                                                                    ("n_spans", pa.int64()), ("kept_sha256", pa.string())]))

    return _with_spans(docs, family, many_runs).mapInArrow(
        rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


@own_names
def drop_repeats(docs: DataFrame, batches: int = 1, many_runs: int = MANY_RUNS, **sizes) -> DataFrame:
    """`docs` with the repeated bytes cut from the texts (a character cut in two is replaced); all columns as they were."""
    schema = docs.schema
    family = indexed(docs, batches, **sizes)
    length = family.length

    def rows(batches):
        for b in batches:
            new = []
            for t, spans in zip(b.column("text").to_pylist(), b.column("__spans").to_pylist()):
                if t is not None and spans:
                    raw = t.encode()
                    t = np.frombuffer(raw, np.uint8)[~removed(raw, spans, length)].tobytes().decode("utf-8", "replace")
                new.append(t)
            b = b.drop_columns(["__spans"])
            yield b.set_column(b.schema.get_field_index("text"), pa.field("text", pa.string()), pa.array(new, pa.string()))

    return _with_spans(docs, family, many_runs).mapInArrow(rows, schema)
