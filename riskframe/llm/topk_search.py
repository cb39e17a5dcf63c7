"""Exact top-k search by inner product: three phases under a uniform threshold.

Components are scaled to integers, floor(256 x). They are cut into SLICES lists;
an entry's score is the sum of its scores on the lists. Rows stay where they are:
a task scores its rows list by list against a block of queries.

1. Gather: from every list, each block of rows takes the best entries per query;
   their totals are true scores, and the k-th best of all of them, the cutoff, is
   no higher than the k-th best score of the table.
2. Collect: the cutoffs are broadcast. An entry with a total of at least the cutoff
   scores at least cutoff / SLICES on some list, so only entries above that uniform
   threshold on a list are collected.
3. Resolve: the totals of collected entries are completed from their other lists;
   those of at least the cutoff stay, the best k per task and query, ties to the
   smaller id. One window per query ranks what the tasks send.

Phases 1 and 3 send at most k + 1 rows per task and query, however many rows tie,
so copies of one vector that hold a third of the table cost no more than others.
Queries are broadcast in blocks of QUERY_BLOCK rows, one pass over the vectors per
block; the driver holds one block. Blocks' results are written as they finish.

Scores are exact: products that fit 53 bits go through floating-point matrix
products, larger ones through integers.

Defined results: vectors that are null, or hold a null or non-finite component,
take no part, as query or candidate; vectors meet only those of their own length;
rows that repeat a vec_id are rows each, and a query leaves out one row equal to
itself; a null vec_id is a candidate that loses every tie; components beyond
2^53 and scores beyond 64 bits count as the nearest value inside; fewer candidates
than k are all returned; an empty table gives no rows; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches, written
from riskframe.session import scratch_path

SCALE = 256
SLICES = 4
#: Queries broadcast at once: 2 MB at 64 components of 8 bytes.
QUERY_BLOCK = 4096
_LIMIT = 2.0 ** 53
_LOW, _HIGH = -2 ** 63, 2 ** 63 - 1


def scaled(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of floor(SCALE x)) of the usable vectors, one pair per vector length."""
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    at = column.offsets.to_numpy()
    sizes = np.diff(at)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ok = column.is_valid().to_numpy(zero_copy_only=False) & (bad[at[1:]] == bad[at[:-1]])
    for size in np.unique(sizes[ok]):
        rows = np.flatnonzero(ok & (sizes == size))
        taken = values[at[rows][:, None] + np.arange(size)]
        yield rows, np.clip(np.floor(SCALE * taken), -_LIMIT, _LIMIT)


class Block:
    """A bounded block of queries of one length, with their numbers and cutoffs."""

    def __init__(self, numbers: list[int], vectors: list[np.ndarray], cutoffs: dict[int, int] | None = None):
        self.numbers = np.array(numbers, dtype=np.int64)
        self.matrix = np.array(vectors).T                      # components x queries
        self.peak = int(np.abs(self.matrix).max(initial=0))
        cutoffs = cutoffs or {}
        self.cutoffs = np.array([cutoffs.get(n, _LOW) for n in numbers], dtype=np.int64)

    def lists(self, rows: np.ndarray) -> list[np.ndarray]:
        """Scores of `rows` against the queries on each list (one list where floats would not be exact)."""
        size = rows.shape[1]
        if int(np.abs(rows).max(initial=0)) * self.peak * size < _LIMIT:
            cuts = [size * i // SLICES for i in range(SLICES + 1)]
            return [(rows[:, a:b] @ self.matrix[a:b]).astype(np.int64) for a, b in zip(cuts, cuts[1:]) if b > a or size == 0]
        whole = np.frompyfunc(int, 1, 1)
        return [np.clip(whole(rows) @ whole(self.matrix), _LOW, _HIGH).astype(np.int64)]


def blocks_by_length(queries: list[tuple[int, np.ndarray]], cutoffs=None) -> dict[int, Block]:
    by = {}
    for n, v in queries:
        by.setdefault(len(v), []).append((n, v))
    return {size: Block([n for n, _ in own], [v for _, v in own], cutoffs) for size, own in by.items()}


def heads(vectors: DataFrame, shared, k: int) -> DataFrame:
    """Phase 1: (qn, score), true scores of the best entries of each list, at most k per task and query."""

    def rows(batches):
        blocks = blocks_by_length(shared.value)
        best = {size: np.full((0, len(b.numbers)), _LOW, dtype=np.int64) for size, b in blocks.items()}
        for batch in batches:
            for _, m in scaled(batch.column("vec")):
                block = blocks.get(m.shape[1])
                if block is None:
                    continue
                lists = block.lists(m)
                total = sum(lists)
                n = min(k, len(m))
                at = np.concatenate([np.argpartition(x, len(m) - n, axis=0)[len(m) - n:] for x in lists])
                at.sort(axis=0)
                seen = np.take_along_axis(total, at, axis=0)
                seen[1:][at[1:] == at[:-1]] = _LOW             # an entry that heads several lists is one entry
                both = np.concatenate([best[m.shape[1]], seen])
                best[m.shape[1]] = np.partition(both, len(both) - k, axis=0)[-k:] if len(both) > k else both
        for size, found in best.items():
            q = np.broadcast_to(blocks[size].numbers, found.shape)
            real = found > _LOW
            yield pa.RecordBatch.from_arrays([pa.array(q[real]), pa.array(found[real])], ["qn", "score"])

    return vectors.select("vec").mapInArrow(rows, "qn long, score long")


def best_of(q: np.ndarray, score: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best entries of each query: higher score, then smaller id, unknown ids last."""
    order = np.lexsort((ids, ~known, ~score, q))        # ~score: descending, without overflow
    q, score, ids, known = q[order], score[order], ids[order], known[order]
    first = np.searchsorted(q, q, side="left")
    top = np.arange(len(q)) - first < k
    return q[top], score[top], ids[top], known[top]


def entries(vectors: DataFrame, shared, cutoffs, k: int) -> DataFrame:
    """Phases 2 and 3: (qn, vec_id, score) of entries that reach their query's cutoff, at most k per task and query."""

    def rows(batches):
        blocks = blocks_by_length(shared.value, cutoffs.value)
        none = tuple(np.empty(0, dtype=t) for t in (np.int64, np.int64, np.int64, bool))
        found = none
        for batch in batches:
            ids = batch.column("vec_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            for at, m in scaled(batch.column("vec")):
                block = blocks.get(m.shape[1])
                if block is None:
                    continue
                lists = block.lists(m)
                least = (block.cutoffs + len(lists) - 1) // len(lists)   # score >= cutoff / lists, in integers
                enough = lists[0] >= least
                for x in lists[1:]:
                    enough |= x >= least
                r, c = np.nonzero(enough)
                total = sum(x[r, c] for x in lists)
                reach = total >= block.cutoffs[c]
                r, c, total = r[reach], c[reach], total[reach]
                new = block.numbers[c], total, ids[at[r]], known[at[r]]
                found = best_of(*(np.concatenate(x) for x in zip(found, new)), k)
        q, score, ids, known = found
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids, mask=~known), pa.array(score)], ["qn", "vec_id", "score"])

    return vectors.select("vec_id", "vec").mapInArrow(rows, "qn long, vec_id long, score long")


def query_blocks(queries: DataFrame, size: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """(number, vec_id, scaled vector) of the usable queries, streamed in lists of `size`."""
    number, block = 0, []
    for r in queries.toLocalIterator():
        vec = pa.array([r.vec], pa.list_(pa.float64()))
        for _, m in scaled(vec):
            block.append((number, r.vec_id, m[0]))
            number += 1
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


_RESULT = "query_id long, rank int, vec_id long, score long"


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          leave_out_self: bool = True, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k best rows of `vectors` for each row of `queries`: (query_id, rank, vec_id, score).

    With leave_out_self, queries are rows of `vectors` too and each leaves out its own row.
    """
    spark = vectors.sparkSession
    small_batches(spark)

    def parsed(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))

    # products dwarf the reading: enough files to keep all cores busy, whatever files the table came in
    tasks = 2 * spark.sparkContext.defaultParallelism
    rows = written(parsed(vectors).repartition(max(tasks, vectors.rdd.getNumPartitions())), "vectors")
    asked = written(parsed(queries), "queries")
    want = k + 1 if leave_out_self else k
    path = scratch_path(spark, "topk")
    empty = spark.createDataFrame([], _RESULT)
    empty.write.mode("append").parquet(path)
    for block in query_blocks(asked, query_block):
        shared = spark.sparkContext.broadcast([(n, v) for n, _, v in block])
        best = F.row_number().over(Window.partitionBy("qn").orderBy(F.col("score").desc()))
        gathered = heads(rows, shared, want).withColumn("at", best).where(F.col("at") <= want)
        cut = gathered.groupBy("qn").agg(F.min("score").alias("cut"), F.count(F.lit(1)).alias("n")).where(F.col("n") == want)
        cutoffs = spark.sparkContext.broadcast({r.qn: r.cut for r in cut.collect()})
        own = spark.createDataFrame(
            [(n, i, int(min(max(sum(int(x) ** 2 for x in v), _LOW), _HIGH)) if leave_out_self else None) for n, i, v in block],
            "qn long, query_id long, own_score long")
        order = Window.partitionBy("qn").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
        ranked = (entries(rows, shared, cutoffs, want).withColumn("at", F.row_number().over(order)).where(F.col("at") <= want)
                  .join(F.broadcast(own), "qn"))          # at most query_block rows
        mine = F.when((F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own_score")), F.col("at"))
        self_at = F.coalesce(F.min(mine).over(Window.partitionBy("qn")), F.lit(want + 1))
        out = (ranked.withColumn("self_at", self_at).where(F.col("at") != F.col("self_at"))
               .withColumn("rank", F.col("at") - (F.col("at") > F.col("self_at")).cast("int")).where(F.col("rank") <= k))
        out.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
        shared.unpersist()
        cutoffs.unpersist()
    return spark.read.schema(_RESULT).parquet(path)


def search_table(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """Rows whose vec_id is divisible by `every` against all other rows."""
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k)


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.id, q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.id <> c.id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
