"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

A line's key is the line stripped of ASCII white space at both ends with A-Z
lower-cased; keys of at least 20 code points count. The exact state of a
`LineIndex` is a table of references (key, doc_id, lines), append-only: adding a
document appends its references, deleting it appends the same references with a
negative count. Summed per key they give the number of documents that hold it
and the largest doc_id among them. Keys are 128-bit BLAKE2b digests.

Beside it stand cuckoo filters, one per shard of the key space, that hold the
*active* keys (in at least `min_docs` documents). They answer, in 2 bytes a key,
which lines need a look at the exact table. A batch of insertions or deletions
changes the references of some keys; only keys that become active or cease to be
are inserted into or deleted from their shard's filter. A shard that outgrows
its filter is rebuilt from the exact table, as are all shards when their number
doubles.

Cleaning sends (key, doc_id) pairs and the filters to tasks by (shard, salt),
sorted so that a task meets a shard's filter first and then streams the pairs
past it; the salt spreads a line that a third of all documents hold. Pairs that
pass are checked against the exact counts by a join. Nothing is collected or
broadcast, and no task holds more than one filter and one batch.

Defined results: a null or empty text is one empty line and stays; a line is
dropped if its key is active and the document isn't the largest doc_id holding
it, so a document keeps all its copies of a line or none; rows that share a
doc_id are one holder and are each cleaned; rows without a doc_id hold their
lines as one document which never is the largest; extra columns pass.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import own_names, small_batches, written
from riskframe.session import scratch_path

MIN_CHARS = 20
MIN_DOCS = 3
SHARD_KEYS = 32_768      # keys a shard's filter is sized for
MIN_SHARDS = 16
SALTS = 64

_SPACE = " \t\n\x0b\x0c\r"
_SLOTS = 4
_KEYS = "k1 long, k2 long, doc_id long, n long"


def line_key(line: str) -> bytes | None:
    """Digest of the line's key, or None where the line is too short to count."""
    s = line.strip(_SPACE)
    if len(s) < MIN_CHARS:
        return None
    return hashlib.blake2b(s.encode().lower(), digest_size=16).digest()   # bytes.lower() knows A-Z only


class CuckooFilter:
    """Buckets of four 16-bit fingerprints with insertion and deletion; 0 marks a free slot."""

    KICKS = 500

    def __init__(self, table: np.ndarray) -> None:
        self.table = table
        self.mask = len(table) - 1

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1
        while buckets * _SLOTS * 0.84 < max(1, keys):
            buckets *= 2
        return cls(np.zeros((buckets, _SLOTS), np.uint16))

    @classmethod
    def of(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, np.uint16).reshape(-1, _SLOTS).copy())

    def raw(self) -> bytes:
        return self.table.tobytes()

    def places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and both buckets of keys, from the half of the key that doesn't choose the shard."""
        u = k2.astype(np.int64).view(np.uint64)
        tag = (u & np.uint64(0xFFFF)).astype(np.uint16)
        tag[tag == 0] = 1
        first = (u >> np.uint64(20)).astype(np.int64) & self.mask
        return tag, first, self.other(first, tag)

    def other(self, bucket, tag):
        return (bucket ^ (np.asarray(tag, np.int64) * 0x5BD1E995)) & self.mask

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        tag, a, b = self.places(k1, k2)
        return (self.table[a] == tag[:, None]).any(1) | (self.table[b] == tag[:, None]).any(1)

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        """Add distinct keys; False if the filter is full and must be rebuilt larger."""
        rng = np.random.default_rng(len(k1))
        for t, a, b in zip(*(x.tolist() for x in self.places(k1, k2))):
            for at in (a, b):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = t
                    break
            else:
                at = b
                for _ in range(self.KICKS):
                    s = int(rng.integers(_SLOTS))
                    t, self.table[at, s] = int(self.table[at, s]), t
                    at = int(self.other(at, t))
                    free = np.flatnonzero(self.table[at] == 0)
                    if len(free):
                        self.table[at, free[0]] = t
                        break
                else:
                    return False
        return True

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Remove keys that were inserted."""
        for t, a, b in zip(*(x.tolist() for x in self.places(k1, k2))):
            for at in (a, b):
                held = np.flatnonzero(self.table[at] == t)
                if len(held):
                    self.table[at, held[0]] = 0
                    break

    @classmethod
    def build(cls, k1: np.ndarray, k2: np.ndarray) -> CuckooFilter:
        size = max(len(k1), 1)
        while True:
            f = cls.sized(size)
            if f.insert(k1, k2):
                return f
            size *= 2


def references(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, n): how many lines of each key a row holds."""
    small_batches(docs.sparkSession)

    def rows(batches):
        for b in batches:
            keys, ids, ns = [], [], []
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                held: dict[bytes, int] = {}
                for x in (t or "").split("\n"):
                    k = line_key(x)
                    if k is not None:
                        held[k] = held.get(k, 0) + 1
                keys += held
                ids += [d] * len(held)
                ns += held.values()
            k = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy()), pa.array(ids, pa.int64()),
                                              pa.array(ns, pa.int64())], names=["k1", "k2", "doc_id", "n"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, _KEYS)


class LineIndex:
    """Exact references, counts of active keys and shard filters, in the shared folder."""

    def __init__(self, spark: SparkSession, path: str | None = None, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS) -> None:
        self.spark, self.min_docs, self.shard_keys = spark, min_docs, shard_keys
        self.path = path or scratch_path(spark, "line-index")
        self.refs: DataFrame | None = None
        self.active = spark.createDataFrame([], "k1 long, k2 long, keep long")
        self.shards = 0
        self.filters = spark.createDataFrame([], "shard int, filter binary")

    # The exact tables.

    def insert(self, docs: DataFrame) -> None:
        """Count the lines of new documents."""
        self._change(references(docs))

    def delete(self, docs: DataFrame) -> None:
        """Take documents back; `docs` holds their texts as inserted."""
        self._change(references(docs).withColumn("n", -F.col("n")))

    def _change(self, change: DataFrame) -> None:
        change.write.mode("append").parquet(f"{self.path}/refs")
        self.refs = self.spark.read.schema(_KEYS).parquet(f"{self.path}/refs")
        # references of one key and document first, then documents of one key: both sums combine in the map tasks
        holders = self.refs.groupBy("k1", "k2", "doc_id").agg(F.sum("n").alias("n")).where("n > 0")
        active = written(holders.groupBy("k1", "k2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keep"))
                         .where(F.col("docs") >= self.min_docs).drop("docs"), "active-lines")
        self._update_filters(self.active, active)
        self.active = active

    # The filters.

    def _shard(self, shards: int):
        return F.pmod("k1", F.lit(shards)).cast("int")

    def _update_filters(self, before: DataFrame, after: DataFrame) -> None:
        wanted = max(MIN_SHARDS, self.shards)
        keys = after.count()
        while keys > wanted * self.shard_keys:
            wanted *= 2
        if wanted != self.shards:      # more shards: all are built from the exact table
            before, self.filters = before.limit(0), self.filters.limit(0)
            self.shards = wanted
        change = (before.select("k1", "k2", F.lit(-1).alias("d")).union(after.select("k1", "k2", F.lit(1).alias("d")))
                  .groupBy("k1", "k2").agg(F.sum("d").alias("d")).where("d != 0"))

        # one task per shard, bounded by the keys a shard is sized for
        rows = (change.select(self._shard(self.shards).alias("shard"), "k1", "k2", "d")
                .union(after.select(self._shard(self.shards).alias("shard"), "k1", "k2", F.lit(0).cast("long"))))

        def shard(key, held: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            add, gone, full = rows[rows.d > 0], rows[rows.d < 0], rows[rows.d == 0]
            f = CuckooFilter.of(held["filter"].iloc[0]) if len(held) else None
            if f is not None:
                f.delete(gone.k1.to_numpy(), gone.k2.to_numpy())
                if not f.insert(add.k1.to_numpy(), add.k2.to_numpy()):
                    f = None
            if f is None:
                f = CuckooFilter.build(full.k1.to_numpy(), full.k2.to_numpy())
            return pd.DataFrame({"shard": [key[0]], "filter": [f.raw()]})

        self.filters = written(self.filters.groupBy("shard").cogroup(rows.groupBy("shard")).applyInPandas(
            shard, "shard int, filter binary"), "line-filters")

    # Cleaning.

    def drops(self, docs: DataFrame) -> DataFrame:
        """(doc_id, drop): the keys that each document must lose, as arrays of 16-byte digests."""
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
        pairs = (references(docs).select(self._shard(self.shards).alias("shard"), salt.alias("salt"), F.lit(1).alias("kind"),
                                         F.lit(None).cast("binary").alias("filter"), "k1", "k2", "doc_id"))
        filters = (self.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
                   .select("shard", "salt", F.lit(0).alias("kind"), "filter", F.lit(None).cast("long").alias("k1"),
                           F.lit(None).cast("long").alias("k2"), F.lit(None).cast("long").alias("doc_id")))

        def probe(batches):
            at, f = None, None
            for b in batches:
                shard, kind = b.column("shard").to_numpy(), b.column("kind").to_numpy()
                k1 = b.column("k1").fill_null(0).to_numpy()
                k2 = b.column("k2").fill_null(0).to_numpy()
                keep = np.zeros(len(kind), bool)
                starts = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (kind[1:] == 0)])) if len(kind) else []
                for s, e in zip(starts, [*starts[1:], len(kind)]):
                    if kind[s] == 0:
                        at, f = shard[s], CuckooFilter.of(b.column("filter")[int(s)].as_py())
                        s += 1
                    if s < e and f is not None and shard[s] == at:
                        keep[s:e] = f.contains(k1[s:e], k2[s:e])
                yield b.select(["k1", "k2", "doc_id"]).filter(pa.array(keep))

        near = (filters.unionByName(pairs).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
                .mapInArrow(probe, "k1 long, k2 long, doc_id long"))
        out = near.join(self.active, ["k1", "k2"]).where("not doc_id <=> keep")

        def digests(batches):
            for b in batches:
                k = np.stack([b.column("k1").to_numpy(), b.column("k2").to_numpy()], 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x.tobytes() for x in k], pa.binary())], names=["doc_id", "k"])

        return (out.select("k1", "k2", "doc_id").mapInArrow(digests, "doc_id long, k binary")
                .groupBy("doc_id").agg(F.collect_set("k").alias("__drop")))

    def _joined(self, docs: DataFrame) -> DataFrame:
        drops = self.drops(docs.select("doc_id", "text")).withColumnRenamed("doc_id", "__doc")
        return docs.join(drops.hint("shuffle_hash"), docs["doc_id"].cast("long").eqNullSafe(drops["__doc"]), "left").drop("__doc")

    def clean(self, docs: DataFrame) -> DataFrame:
        """`docs` without the dropped lines; all columns as they were. A null text stays null."""
        schema = docs.schema

        def rows(batches):
            for b in batches:
                new = [t if t is None or not drop else "\n".join(kept_lines(t, set(drop))[1])
                       for t, drop in zip(b.column("text").to_pylist(), b.column("__drop").to_pylist())]
                b = b.drop_columns(["__drop"])
                yield b.set_column(b.schema.get_field_index("text"), pa.field("text", pa.string()), pa.array(new, pa.string()))

        return self._joined(docs).mapInArrow(rows, schema)

    def digest(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_lines, n_dropped, kept_sha256 per row."""
        def rows(batches):
            for b in batches:
                out = []
                for d, t, drop in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "__drop"))):
                    n, kept = kept_lines(t or "", set(drop or ()))
                    out.append({"doc_id": d, "n_lines": n, "n_dropped": n - len(kept),
                                "kept_sha256": hashlib.sha256("\n".join(kept).encode()).hexdigest()})
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()),
                                                                        ("n_dropped", pa.int64()), ("kept_sha256", pa.string())]))

        small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        return self._joined(small).mapInArrow(rows, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def kept_lines(text: str, drop: set[bytes]) -> tuple[int, list[str]]:
    """Number of lines and those that stay."""
    lines = text.split("\n")
    return len(lines), lines if not drop else [x for x in lines if line_key(x) not in drop]


def indexed(docs: DataFrame) -> LineIndex:
    """An index that holds `docs`."""
    index = LineIndex(docs.sparkSession)
    index.insert(docs)
    return index


def dedup_digest(docs: DataFrame) -> DataFrame:
    return indexed(docs).digest(docs)


@own_names
def dedup_lines(docs: DataFrame) -> DataFrame:
    return indexed(docs).clean(docs)


#: DuckDB SQL for the digest over table documents.
ORACLE = r"""
WITH lines AS (
  SELECT doc_id, pos, line, k FROM (
    SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents))),
active AS (SELECT k, max(doc_id) AS keep FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT l.doc_id, l.pos, l.line, (a.k IS NOT NULL AND l.doc_id <> a.keep) AS gone FROM lines l LEFT JOIN active a ON l.k = a.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INTEGER)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
