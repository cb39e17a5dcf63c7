"""Filter interaction audit: what each of several document filters adds to the others.

Every document gets a mask of the filters it fails. A coalition S of filters
removes the documents that fail any of its members, v(S). The Hart-Mas-Colell
potential of that removal game is P(empty) = 0 and

    P(S) = (v(S) + sum over i in S of P(S without i)) / |S|,

taken level by level over the coalitions, and the Shapley value of filter i is
P(all) - P(all without i). P is kept times n!, which makes every division exact.
An order of filters removes v(first k) - v(first k-1) documents at step k: the
steps of all orders are differences of coalitions, so no order is ever run.

Only the masks are computed per document. Copies (filter E) are found through the
SHA-256 of the text: the smallest doc_id per digest is combined map-side and
joined back on (digest, doc_id), so a text that a third of all rows share is one
row per task before the shuffle and its copies meet nowhere. After that the data
are a table of parts x 32 masks.

Defined results: a null text is empty (fails A, is a copy of other empty texts);
a null source is part ''; a row without a doc_id is no copy, makes none and has no
labels; rows that repeat a doc_id are counted each, and those at the smallest
doc_id of their text are no copies; a doc_id with several label rows has a label
where any of them is 1; null labels are 0; an empty table gives no rows; extra
columns are ignored.
"""
from __future__ import annotations

import hashlib
import itertools
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches, written

#: Fixed values of the five filters.
LETTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT = 65      # percent of words
MOST_CAPITALS = 5        # percent of code points
MARKS = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(65, 91))
_COUNTS = ("n", "good", "toxic")


def failed(text: str) -> int:
    """Bits of the filters A to D that a text fails."""
    raw = text.encode()
    words = raw.split()          # bytes split at exactly [\x20\x09-\x0D]
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return ((len(words) < LEAST_WORDS)
            | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
            | (100 * capitals > MOST_CAPITALS * len(text)) << 2
            | (MARKS.search(raw) is not None) << 3)


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask) per document; mask has the bits of A to D."""
    small_batches(docs.sparkSession)

    def rows(batches):
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary()),
                 pa.array([failed(t) for t in texts], pa.int32())], ["doc_id", "part", "digest", "mask"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       "text").mapInArrow(rows, "doc_id long, part string, digest binary, mask int")


def patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail, and their labels."""
    rows = written(masks(docs), "filter-masks")
    known = rows.where(F.col("doc_id").isNotNull())
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    label = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"),
                           F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))
             .where(F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    copy = F.when(F.col("first"), 0).otherwise(1 << LETTERS.index("E"))
    judged = known.join(first, ["digest", "doc_id"], "left").join(label, "doc_id", "left").select(
        "part", F.col("mask").bitwiseOR(copy).alias("mask"), "good", "toxic")
    rest = rows.where(F.col("doc_id").isNull()).select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    return judged.unionByName(rest).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def games(patterns: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, total, v_n, v_good, v_toxic): what each coalition removes, an array by coalition mask."""
    coalitions = range(1 << len(letters))

    def removed(count: str) -> Column:
        return F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(count)).otherwise(0)) for s in coalitions])

    return patterns.groupBy("part").agg(F.sum("n").alias("total"), *[removed(c).alias(f"v_{c}") for c in _COUNTS])


def potentials(games: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Adds `potential`: n! P(S) by coalition mask, from the smaller coalitions to the grand one."""
    n, out = len(letters), games.withColumn("p_0", F.lit(0).cast("long"))
    for size in range(1, n + 1):
        level = []
        for members in itertools.combinations(range(n), size):
            s = sum(1 << i for i in members)
            without = " + ".join(f"p_{s ^ 1 << i}" for i in members)
            level.append(F.expr(f"({math.factorial(n)} * v_n[{s}] + {without}) div {size}").alias(f"p_{s}"))
        out = out.select("*", *level)
    names = [f"p_{s}" for s in range(1 << n)]
    return out.withColumn("potential", F.array(*names)).drop(*names)


def steps(games: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step, from coalition values and potentials alone."""
    n = len(letters)
    orders = ",".join(map("".join, itertools.permutations(letters)))

    def coalition(text: Column) -> Column:
        return sum((F.when(F.instr(text, x) > 0, 1 << i).otherwise(0) for i, x in enumerate(letters)), F.lit(0))

    d = (potentials(games, letters)
         .select("*", F.explode(F.split(F.lit(orders), ",")).alias("filter_order"))
         .select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
         .withColumn("before", coalition(F.expr("substring(filter_order, 1, step - 1)")))
         .withColumn("own", coalition(F.expr("substring(filter_order, step, 1)"))))
    after = F.col("before") + F.col("own")
    everyone = (1 << n) - 1

    def lost(count: str) -> Column:
        return F.col(f"v_{count}")[after] - F.col(f"v_{count}")[F.col("before")]

    others = F.lit(everyone) - F.col("own")
    return d.select(
        "part", "filter_order", "step", (F.col("total") - F.col("v_n")[after]).alias("kept"), lost("n").alias("removed"),
        (F.col("v_n")[F.col("own")] - lost("n")).alias("redundant"),
        (F.col("v_n")[everyone] - F.col("v_n")[others]).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"),
        (F.col("potential")[everyone] - F.col("potential")[others]).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over `docs`: every order and step per part, and 120 times each filter's Shapley value."""
    return steps(games(patterns(docs, labels)))


_SPACE = r"[\x20\x09-\x0D]+"
ORACLE = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{_SPACE}'), lambda x: x <> '') AS ws FROM d),
m AS (
  SELECT doc_id, part,
    len(ws) < 50 AS fa,
    100 * len(list_distinct(ws)) < 65 * len(ws) AS fb,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS fc,
    regexp_matches(t, '[#$%&*|]') AS fd,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), FALSE) AS fe
  FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, [x for x in [CASE WHEN fa THEN 'A' END, CASE WHEN fb THEN 'B' END, CASE WHEN fc THEN 'C' END,
    CASE WHEN fd THEN 'D' END, CASE WHEN fe THEN 'E' END] if x IS NOT NULL] AS fails,
    count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
o(filter_order) AS (
  SELECT '' UNION ALL
  SELECT filter_order || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) y
  WHERE length(filter_order) < 5 AND NOT contains(filter_order, x)),
s AS (
  SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o WHERE length(filter_order) = 5),
r AS (
  SELECT part, filter_order, step, filter_order[step] AS own,
    sum(n) FILTER (WHERE NOT list_has_any(fails, string_split(filter_order[1:step], ''))) AS kept,
    sum(n) FILTER (WHERE here) AS removed,
    sum(n) FILTER (WHERE list_contains(fails, filter_order[step]) AND NOT here) AS redundant,
    sum(n) FILTER (WHERE fails = [filter_order[step]]) AS unique_fails,
    sum(good) FILTER (WHERE here) AS good_lost, sum(toxic) FILTER (WHERE here) AS toxic_lost
  FROM (SELECT *, list_contains(fails, filter_order[step]) AND (step = 1 OR NOT list_has_any(fails,
          string_split(filter_order[1:step - 1], ''))) AS here FROM c CROSS JOIN s) x
  GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""
