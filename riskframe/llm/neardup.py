"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct word shingles. Its SetSketch has `M`
registers; register j is `floor(1 - log_b(min h_j))` over the set, where h_j
hashes shingles to exponential variates: a truncated minimum on an exponential
scale. Registers merge by maximum, so a long text is sketched in slices, and two
registers agree with a probability close to the Jaccard similarity J.

1. Documents with equal sets form a class (key: 128-bit digest of the set).
2. `BANDS` bands of `ROWS` registers put classes into buckets. At J = 0.8 two
   classes share no bucket with a probability of 5e-8, and about 13 on average.
3. In each bucket every member is paired with one leader, another one in every
   bucket. No other pair is made: the rows are at most classes x bands.
4. A pair's J is estimated jointly with the known set sizes by likelihood from
   the counts of greater, smaller and equal registers. Only pairs for which
   J >= 0.8 is out of the question (6 standard errors) go.
5. Each class's best pair is verified on the full sets. Verified links give
   components by min-label propagation with pointer jumping; pairs that met in
   a bucket of two and run between components are verified next. Later links
   merge whole components, so their graph has components as vertices.
6. Buckets of three or more that still hold several components may hide links
   between members of which neither was the leader. Their members of different
   components are compared in the task that reads the bucket, in blocks of
   bounded size, first by estimate and then on the full sets. Only links that
   merge components leave the task, and with them the components are final.

Defined results: words are runs of anything but ASCII white space after A-Z is
lower-cased, and are told apart by a 64-bit keyed digest of their bytes; fewer words
than a shingle are one shingle; a text without words
(null, empty) links with nothing; rows with equal sets link whatever their
doc_id; rows without a doc_id link with nothing, are kept and have a null
component; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import own_names, small_batches, written

M, BANDS, ROWS = 128, 32, 4
BASE, RATE, TOP = 1.001, 20.0, 65_535        # b, a and the largest register value of the sketch
PERCENT = 80                                 # links: 100 * intersection >= PERCENT * union
LOG_MARGIN = 18.0                            # log-likelihood by which J >= 0.8 must lose: 6 standard errors
BLOCK_SHINGLES = 500_000                     # shingles of bucket members that one block holds, more or less
TASK_ROWS = 500_000                          # edges for each task that writes labels

_SLICE = 1 << 16
_WORDS_KEPT = 50_000                         # digests of words a worker remembers, about 8 MB
_U = np.uint64


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) << _U(1) | _U(1)


_STEP = 0x9E3779B97F4A7C15
_XOR, _MUL = _odd(M, 12), _odd(M, 13)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = (h ^ h >> _U(30)) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ h >> _U(27)) * _U(0x94D049BB133111EB)
    return h ^ h >> _U(31)


class _Digests(dict):
    """64-bit keyed digests of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        d = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=b"words").digest(), "little")
        return d


_digests = _Digests()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words: digests of their bytes, so that no structure of a word makes two collide."""
    return np.fromiter(map(_digests.__getitem__, words), np.uint64, len(words))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    w = word_hashes((text or "").encode().lower().split())      # bytes: A-Z and ASCII white space only
    if not len(w):
        return w
    if len(w) < words:
        h = _U(len(w)) * np.ones(1, np.uint64)
        for x in w:
            h = mixed(h * _U(_STEP) + x)
        return h
    h = np.full(len(w) - words + 1, words, np.uint64)
    for k in range(words):
        h = h * _U(_STEP) + w[k:len(w) - words + 1 + k]
    return np.unique(mixed(h))


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Smallest hash per set and register; none of the sets is empty."""
    out = np.full((len(sets), M), ~_U(0))
    group: list[int] = []
    held = 0

    def flush() -> None:
        x = np.concatenate([sets[i] for i in group])
        starts = np.cumsum([0] + [len(sets[i]) for i in group[:-1]])
        for j in range(M):
            out[group, j] = np.minimum.reduceat((x ^ _XOR[j]) * _MUL[j], starts)

    for i, s in enumerate(sets):
        if len(s) > _SLICE:                     # in slices, merged
            for at in range(0, len(s), _SLICE):
                x = s[at:at + _SLICE]
                for j in range(M):
                    out[i, j] = min(out[i, j], ((x ^ _XOR[j]) * _MUL[j]).min())
            continue
        group.append(i)
        held += len(s)
        if held >= _SLICE:
            flush()
            group, held = [], 0
    if group:
        flush()
    return out


def registers(low: np.ndarray) -> np.ndarray:
    """SetSketch registers of minima: truncated, exponentially spaced."""
    h = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(h) / math.log(BASE)), 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """Bucket keys (docs x bands): band values hashed with the band's number."""
    bands = np.ascontiguousarray(regs).view(np.uint64).reshape(len(regs), BANDS)
    return mixed(bands + mixed(np.arange(1, BANDS + 1, dtype=np.uint64))).view(np.int64)


_GRID = np.linspace(0.0, 1.0, 201)


def estimate(more: np.ndarray, less: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood J and how much log-likelihood J >= PERCENT loses to it.

    `more` and `less` count registers in which the first is greater or smaller.
    """
    na, nb = na.astype(float)[:, None], nb.astype(float)[:, None]
    u, v = na / (na + nb), nb / (na + nb)
    most = np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / math.log(BASE)

    grid = _GRID[None, :]
    ok = grid <= most + 1e-9
    j = np.minimum(grid, most)
    a, b = p(u - v * j), p(v - u * j)
    ll = more[:, None] * np.log(a) + less[:, None] * np.log(b) + (M - more - less)[:, None] * np.log(np.maximum(1 - a - b, 1e-9))
    ll = np.where(ok, ll, -np.inf)
    at = ll.argmax(1)
    best, value = _GRID[at], ll[np.arange(len(at)), at]
    wanted = np.where(_GRID[None, :] >= PERCENT / 100 - 1e-9, ll, -np.inf).max(1)
    return best, value - wanted


def plausible(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated J of register pairs, and whether a link is possible at all."""
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    j, loss = estimate((ra > rb).sum(1), (ra < rb).sum(1), na, nb)
    return j, (100 * small >= PERCENT * large) & (loss <= LOG_MARGIN)


# Spark jobs.

def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n (set size), key (digest of the set; null without words), sketch and text digest of every row."""
    small_batches(docs.sparkSession)

    def rows(batches):
        for b in batches:
            sets = [shingles(t, words) for t in b.column("text").to_pylist()]
            some = [i for i, s in enumerate(sets) if len(s)]
            regs = registers(minima([sets[i] for i in some])) if some else []
            keys, sk = [None] * len(sets), [None] * len(sets)
            for i, r in zip(some, regs):
                keys[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                sk[i] = r.tobytes()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array(keys, pa.binary()), pa.array(sk, pa.binary()), b.column("digest")],
                                             names=["doc_id", "n", "key", "sketch", "digest"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_digest()).mapInArrow(
        rows, "doc_id long, n long, key binary, sketch binary, digest binary")


def text_digest() -> Column:
    return F.unhex(F.sha2("text", 256)).alias("digest")


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, M)


def banded(classes: DataFrame) -> DataFrame:
    """(bucket, band, cid) for every class and band."""
    def rows(batches):
        for b in batches:
            k = band_keys(_registers(b.column("sketch")))
            cid = np.repeat(b.column("cid").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(k.ravel()), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(k))), pa.array(cid)],
                                             names=["bucket", "band", "cid"])

    return classes.select("cid", "sketch").mapInArrow(rows, "bucket long, band int, cid long")


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """`pairs` (a, b, alone) whose likelihood admits a link, with the estimate j."""
    def side(s):
        return classes.select(F.col("cid").alias(s), F.col("n").alias(f"n{s}"), F.col("sketch").alias(f"s{s}"))

    def rows(batches):
        for b in batches:
            j, ok = plausible(_registers(b.column("sa")), _registers(b.column("sb")), b.column("na").to_numpy(), b.column("nb").to_numpy())
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), b.column("alone"), pa.array(j)],
                                             names=["a", "b", "alone", "j"]).filter(pa.array(ok))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(rows, "a long, b long, alone boolean, j double")


def full_sets(cids: DataFrame, docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(cid, set): the full sets of these classes, built again from the text of their first document."""
    need = cids.join(classes.select("cid", "key", "rep"), "cid")

    def rows(batches):
        for b in batches:
            ids, out = [], []
            for cid, key, text in zip(*(b.column(c).to_pylist() for c in ("cid", "key", "text"))):
                s = shingles(text, words)
                if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == key:      # rows may share a doc_id
                    ids.append(cid)
                    out.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=["cid", "set"])

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(need, "rep")
    return written(texts.select("cid", "key", "text").mapInArrow(rows, "cid long, set array<long>"), "near-sets")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The `pairs` (a, b) linked by their full sets."""
    both = (pairs.select("a", "b").join(sets.select(F.col("cid").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("set").alias("sb")), "b")
            .withColumn("inter", F.size(F.array_intersect("sa", "sb"))))
    return both.where(f"100 * inter >= {PERCENT} * (size(sa) + size(sb) - inter)").select("a", "b")


def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """`pairs` whose ends are in different components, with these as la and lb."""
    return (pairs.join(labels.withColumnsRenamed({"v": "a", "label": "la"}), "a", "left")
            .join(labels.withColumnsRenamed({"v": "b", "label": "lb"}), "b", "left")
            .withColumns({"la": F.coalesce("la", "a"), "lb": F.coalesce("lb", "b")}).where("la != lb"))


def compact(df: DataFrame, rows: int) -> DataFrame:
    """`df` in as many partitions as `rows` rows need, and no fewer than the cluster runs at once."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


def components(edges: DataFrame) -> DataFrame:
    """(v, label): the smallest vertex reachable, for every vertex of an edge (a, b).

    Each round every vertex takes the least label next to it and then its
    label's label, so labels travel in leaps and long chains take few rounds.
    All joins are on unique labels; a vertex with very many edges is split by
    the adaptive skew join and its minima combine before the shuffle.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    rows = both.count()
    labels = written(compact(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("l")).selectExpr("v", "least(v, l) as label"), rows), "labels")
    while True:
        near = (both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy(F.col("a").alias("v"))
                .agg(F.min("label").alias("near")))
        step = labels.join(near, "v").selectExpr("v", "label as old", "least(label, near) as l")
        jump = labels.select(F.col("v").alias("l"), F.col("label").alias("far"))
        new = written(compact(step.join(jump, "l").selectExpr("v", "old", "least(l, far) as label"), rows), "labels")
        labels = new.select("v", "label")
        if new.where("label < old").isEmpty():
            return labels


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """`labels` after `links` (a, b) between components: these are merged as vertices of a graph of their own."""
    tops = components(across(links, labels).select(F.col("la").alias("a"), F.col("lb").alias("b")))
    tops = tops.withColumnRenamed("label", "top")
    old = (labels.join(tops.withColumnRenamed("v", "label"), "label", "left")
           .select("v", F.coalesce("top", "label").alias("label")))
    new = tops.join(labels, "v", "left_anti").select("v", F.col("top").alias("label"))
    return written(old.union(new), "labels")


def hidden_links(docs: DataFrame, classes: DataFrame, buckets: DataFrame, labels: DataFrame, words: int) -> DataFrame:
    """Links (a, b) across components inside buckets of three or more members, verified on full sets.

    A bucket is cut into blocks of about `BLOCK_SHINGLES`, and each pair of
    blocks is one group. A pair is looked at in the first band that it shares,
    and only if its members are still apart, so a group reports a spanning
    forest and never its pairs.
    """
    comp = labels.select(F.col("v").alias("cid"), "label")
    rows = (banded(classes).join(buckets.where("n > 2").select("bucket"), "bucket").join(comp, "cid", "left")
            .withColumn("label", F.coalesce("label", "cid")).join(classes.select("cid", F.col("n").alias("size")), "cid"))
    mixed_up = (rows.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.sum("size").alias("all"))
                .where("x < y").select("bucket", F.ceil(F.col("all") / BLOCK_SHINGLES).cast("int").alias("blocks")))
    rows = written(rows.join(mixed_up, "bucket"), "mixed-buckets")
    sets = full_sets(rows.select("cid").distinct(), docs, classes, words)
    rows = (rows.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("bucket", "band", "cid", "label", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block")
            .join(classes.select("cid", "sketch"), "cid").join(sets, "cid"))

    def compare(key, g):
        cid, label, block, band = (g.column(c).to_numpy() for c in ("cid", "label", "block", "band"))
        label, split = label.copy(), key[1].as_py() != key[2].as_py()
        regs, sets = _registers(g.column("sketch")), g.column("set").combine_chunks()
        flat, size = sets.flatten().to_numpy().view(np.uint64), sets.value_lengths().to_numpy().astype(np.int64)
        start = np.cumsum(size) - size
        bands = np.ascontiguousarray(regs).view(np.uint64).reshape(len(regs), BANDS)
        a, b = [], []
        for i in range(len(cid) - 1):
            k = np.arange(i + 1, len(cid))
            k = k[(label[k] != label[i]) & ((block[k] != block[i]) | (not split))]
            if len(k):
                k = k[(bands[k] == bands[i]).argmax(1) == band[i]]
            if len(k):
                k = k[plausible(np.broadcast_to(regs[i], (len(k), M)), regs[k], np.broadcast_to(size[i], len(k)), size[k])[1]]
            if len(k):
                own = flat[start[i]:start[i] + size[i]]
                theirs = np.concatenate([flat[start[x]:start[x] + size[x]] for x in k])
                hit = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
                inter = np.add.reduceat(hit.astype(np.int64), np.cumsum(size[k]) - size[k])
                for x in k[100 * inter >= PERCENT * (size[i] + size[k] - inter)]:
                    if label[x] != label[i]:
                        a.append(cid[i])
                        b.append(cid[x])
                        label[label == label[x]] = label[i]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("bucket", "lo", "hi").applyInArrow(compare, "a long, b long")


def near_components(docs: DataFrame, words: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of `docs` (doc_id, text)."""
    return _labelled(docs, words).select("doc_id", "n_shingles", "component_id", "kept")


def _labelled(docs: DataFrame, words: int) -> DataFrame:
    """`near_components` with the text digest of each row and the label of its component (null without words)."""
    sk = written(sketches(docs, words), "sketches")
    classes = written(sk.where("key is not null and doc_id is not null").groupBy("key")
                      .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
                      .withColumn("cid", F.monotonically_increasing_id()), "classes")     # written once, so the ids stay
    bands = banded(classes)
    turn = F.xxhash64("bucket")
    buckets = written(bands.groupBy("bucket").agg(F.min(F.col("cid").bitwiseXOR(turn)).alias("lead"), F.count("*").alias("n"))
                      .where("n > 1").select("bucket", F.col("lead").bitwiseXOR(turn).alias("lead"), "n"), "buckets")
    star = (bands.join(buckets, "bucket").where("cid != lead")
            .groupBy(F.least("cid", "lead").alias("a"), F.greatest("cid", "lead").alias("b")).agg(F.max(F.col("n") == 2).alias("alone")))
    cand = written(estimated(star, classes), "candidates")
    best = (cand.select("a", "b", "j", F.explode(F.array("a", "b")).alias("cid")).groupBy("cid")
            .agg(F.max(F.struct("j", "a", "b")).alias("x")).select("x.a", "x.b").distinct())
    sets = full_sets(cand.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), docs, classes, words)
    labels = components(verified(best, sets))
    # pairs that met alone in a bucket; larger buckets are compared in full below
    for more in (lambda: verified(across(cand.where("alone"), labels), sets),
                 lambda: hidden_links(docs, classes, buckets, labels, words)):
        links = written(more(), "links")
        if not links.isEmpty():
            labels = joined(labels, links)
    named = classes.join(labels.withColumnRenamed("v", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    by_key = named.select("key", "label").join(least, "label").select("key", "component_id", "label")
    return (sk.select("doc_id", "digest", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key"))
            .join(by_key, "key", "left")
            .select("doc_id", "n_shingles", "digest", "label", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.expr("doc_id <=> component_id")))


@own_names
def keep_one(docs: DataFrame, words: int = 5) -> DataFrame:
    """`docs` with one row of each component; all columns as they were.

    The row with the component's smallest doc_id stays; of the component's rows
    that repeat that doc_id the first by text. Rows without words are components
    of their own, and equal ones of one doc_id count once. Rows without a doc_id
    all stay.
    """
    from pyspark.sql.window import Window
    kept = (_labelled(docs, words).where("kept and doc_id is not null")
            .select(F.col("doc_id").alias("__id"), F.coalesce("digest", F.lit(b"")).alias("__x"), F.col("label").alias("__l")).distinct())
    named = docs.withColumn("__d", F.col("doc_id").cast("long"))
    own = (named.where("__d is not null").withColumn("__t", F.coalesce(text_digest(), F.lit(b"")))
           .join(kept, (F.col("__d") == F.col("__id")) & (F.col("__t") == F.col("__x"))))
    part = Window.partitionBy("__d", "__l", F.when(F.col("__l").isNull(), F.col("__t"))).orderBy("text")
    one = own.withColumn("__r", F.row_number().over(part)).where("__r = 1")
    return one.select(*docs.columns).union(named.where("__d is null").select(*docs.columns))


#: DuckDB SQL for `near_components(words=4)` over table documents.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS g FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id
      JOIN n na ON na.doc_id = x.doc_id JOIN n nb ON nb.doc_id = y.doc_id
      GROUP BY x.doc_id, y.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
sym AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS v, doc_id AS c FROM documents UNION SELECT r.v, sym.b FROM r JOIN sym ON sym.a = r.c),
c AS (SELECT v, min(c) AS component_id FROM r GROUP BY v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.v = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
