"""Source divergence audit by in-mapper stripes.

Each task folds whole documents into hash stripes: per (lang, term) the document
frequency and the occurrences by source. When the stripes hold SPILL_CELLS cells
they are spilled as rows; rows are dealt and sorted by (lang, term) and merged
as a stream, some thousand rows at a time. A term that every document holds is
thus one row per task and spill, and a lang or source that holds a third of all
rows is spread over its terms.

In stripes a group (lang, source) goes by a 64-bit code, a hash of both names under
a salt. The groups that occur are listed first and the salt is changed until their
codes differ, so codes never confuse two groups.

Merged stripes of terms in at least LEAST_DOCS documents of the lang are kept and
give everything else directly: V (kept terms per lang), N (occurrences of them per
group), p = 1 + floor(10^9 (count + 1) / (N + V)) and the divergence terms
f = floor((p - q)^2 / q), all in integers. For pairs of sources, terms that both
lack have the same f: that share is V f(no occurrence), and a stripe only adds
the differences of its own sources' rows and columns.

Groups reach the tasks in broadcast tiles of GROUP_TILE groups; a table of more
groups takes one pass over the kept stripes per pair of tiles, so neither the
broadcast nor a task's sums grow with the groups.

Defined results: null text, lang and source are ''; a group without terms has all
its pairs and no terms; a lang of one source has no pairs; a lang without kept
terms has pairs of value 0; repeated rows are documents each; a missing doc_id
does not matter; an empty table gives no rows; extra columns are ignored.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches, written

LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
#: (term, group) cells a task folds before it spills them: about 200 MB.
SPILL_CELLS = 1_000_000
#: Stripes merged or emitted at once.
MERGE_ROWS = 20_000
#: Numbers held at once while the cells of some stripes meet all groups of a tile: 8 MB.
CHUNK_NUMBERS = 1_000_000
#: Groups broadcast at once; a task's sums for two tiles take at most 8 bytes per pair (32 MB).
GROUP_TILE = 2048

#: Bytes that are no part of a term become spaces, A-Z lower case; bytes of other characters stay.
_FOLD = bytes(32 if b < 0x80 and not chr(b).isalpha() else b + 32 if 65 <= b <= 90 else b for b in range(256))

STRIPE = "lang string, term string, df long, codes array<long>, counts array<long>"
_STRIPE = pa.schema([("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()),
                     ("codes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of letters and characters beyond ASCII, A-Z lower-cased, as UTF-8."""
    return (text or "").encode().translate(_FOLD).split()


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, pa.int64()))


class Stripes:
    """Hash stripes of one task: per lang and term a document frequency and counts by group, grown by whole documents."""

    def __init__(self):
        self.counts: dict[str, dict[int, Counter]] = {}
        self.df: dict[str, Counter] = {}

    def fold(self, lang: str, code: int, text: str | None) -> None:
        found = terms(text)
        self.counts.setdefault(lang, {}).setdefault(code, Counter()).update(found)
        self.df.setdefault(lang, Counter()).update(set(found))

    def cells(self) -> int:
        return sum(map(len, self.df.values())) + sum(len(c) for groups in self.counts.values() for c in groups.values())

    def spill(self) -> Iterator[pa.RecordBatch]:
        """All stripes as batches, terms in the order in which they were met; the stripes are empty afterwards."""
        for lang, df in self.df.items():
            number = dict(zip(df, range(len(df))))
            groups = self.counts[lang]
            at = np.fromiter((number[t] for c in groups.values() for t in c), np.int64)
            counts = np.fromiter((n for c in groups.values() for n in c.values()), np.int64)
            codes = np.repeat(np.fromiter(groups, np.int64), [len(c) for c in groups.values()])
            order = np.argsort(at, kind="stable")
            sizes = np.bincount(at, minlength=len(df))
            whole = pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(df)), pa.array(list(df), pa.binary()).cast(pa.string()),
                 pa.array(np.fromiter(df.values(), np.int64)), _lists(codes[order], sizes), _lists(counts[order], sizes)], schema=_STRIPE)
            for i in range(0, len(df), MERGE_ROWS):
                yield whole.slice(i, MERGE_ROWS)
        self.counts.clear()
        self.df.clear()


def fold(docs: DataFrame, spill_cells: int = SPILL_CELLS) -> DataFrame:
    """Partial stripes of (lang, code, text): each task's, spilled whenever they reach `spill_cells`."""
    small_batches(docs.sparkSession)

    def rows(batches):
        own = Stripes()
        for b in batches:
            for lang, code, text in zip(*(b.column(n).to_pylist() for n in ("lang", "code", "text"))):
                own.fold(lang, code, text)
            if own.cells() >= spill_cells:
                yield from own.spill()
        yield from own.spill()

    return docs.select("lang", "code", "text").mapInArrow(rows, STRIPE)


def merged(rows: pa.Table) -> pa.Table:
    """Neighbouring partial stripes of one key as one stripe each."""
    rows = rows.combine_chunks()
    if rows.num_rows < 2:
        return rows
    lang, term = (rows.column(c) for c in ("lang", "term"))
    new = pc.or_(pc.not_equal(lang.slice(1), lang.slice(0, len(lang) - 1)), pc.not_equal(term.slice(1), term.slice(0, len(term) - 1)))
    new = np.concatenate([[True], new.to_numpy(zero_copy_only=False)])
    starts = np.flatnonzero(new)
    key = np.cumsum(new) - 1
    codes, counts = (rows.column(c).combine_chunks() for c in ("codes", "counts"))
    cell_key = np.repeat(key, pc.list_value_length(codes).to_numpy(zero_copy_only=False))
    codes, counts = codes.flatten().to_numpy(), counts.flatten().to_numpy()
    order = np.lexsort((codes, cell_key))
    cell_key, codes, counts = cell_key[order], codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (cell_key[1:] != cell_key[:-1]) | (codes[1:] != codes[:-1])])[:len(codes)])
    sizes = np.bincount(cell_key[first], minlength=len(starts))
    sums = np.add.reduceat(counts, first) if len(first) else counts
    df = np.add.reduceat(rows.column("df").to_numpy(), starts)
    return pa.Table.from_arrays([lang.take(starts), term.take(starts), pa.array(df), _lists(codes[first], sizes), _lists(sums, sizes)],
                                schema=_STRIPE)


def merge(partial: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """One stripe per (lang, term) in at least `least_docs` documents, merged as a sorted stream."""

    def rows(batches):
        held, n = [], 0

        def done(last: bool):
            whole = merged(pa.Table.from_batches(held, _STRIPE))
            ready = whole if last else whole.slice(0, whole.num_rows - 1)      # the last key may go on
            held[:] = [] if last else whole.slice(whole.num_rows - 1).to_batches()
            return ready.filter(pc.greater_equal(ready.column("df"), least_docs)).combine_chunks().to_batches()

        for b in batches:
            held.append(b.cast(_STRIPE) if b.schema != _STRIPE else b)
            n += b.num_rows
            if n >= MERGE_ROWS:
                yield from done(False)
                n = 0
        yield from done(True)

    return partial.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(rows, STRIPE)


def share(count, n, v):
    """p = 1 + floor(SCALE (count + 1) / (n + v)) by long division in two steps, exact while n + v < 2^48."""
    high, rest = np.divmod((count + 1) * 31250, n + v)
    return 1 + high * 32000 + rest * 32000 // (n + v)


def divergence(p, q):
    """f = floor((p - q)^2 / q); p and q are at most SCALE + 1, so the square fits 64 bits."""
    return (p - q) * (p - q) // q


def coded_groups(docs: DataFrame) -> tuple[DataFrame, int]:
    """(lang, source, code) of every occurring group, and the salt under which all codes differ."""
    names = written(docs.select("lang", "source").distinct(), "groups")
    salt = 0
    while True:
        groups = names.withColumn("code", code_of(salt))
        if groups.groupBy("code").count().where("count > 1").limit(1).count() == 0:
            return groups, salt
        salt += 1


def code_of(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), "lang", "source")


def group_totals(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """Adds n, lang_n and v to the groups; n counts occurrences of kept terms."""
    cells = kept.select(F.explode(F.arrays_zip("codes", "counts")).alias("c"))
    n = cells.groupBy(F.col("c.codes").alias("code")).agg(F.sum("c.counts").alias("n"))
    of_lang = kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("lang_n"))
    zero = F.lit(0).cast("long")
    return (groups.join(n, "code", "left").join(of_lang, "lang", "left")
            .select("lang", "source", "code", *[F.coalesce(c, zero).alias(c) for c in ("n", "lang_n", "v")]))


def tiles(groups: DataFrame, size: int) -> Iterator[list[tuple]]:
    """The rows of `groups`, streamed in lists of `size`, langs together."""
    tile = []
    for r in groups.toLocalIterator():
        tile.append(tuple(r))
        if len(tile) == size:
            yield tile
            tile = []
    if tile:
        yield tile


class _Tile:
    """Groups of one lang in a tile: names, n, codes in ascending order and the p of a term they lack."""

    def __init__(self, rows: list[tuple]):
        rows = sorted(rows, key=lambda r: r[2])
        self.names = [r[1] for r in rows]
        self.codes, self.n = (np.array([r[i] for r in rows], dtype=np.int64) for i in (2, 3))
        self.lang_n, self.v = rows[0][4], rows[0][5]
        self.absent = share(np.int64(0), self.n, self.v) if self.v else self.n

    def __len__(self) -> int:
        return len(self.names)

    def shares(self, row: np.ndarray, codes: np.ndarray, counts: np.ndarray, rows: int):
        """(dense p by term and group; rows, groups and p of the cells whose group is in the tile)."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self) - 1)
        mine = self.codes[at] == codes
        row, at = row[mine], at[mine]
        p = share(counts[mine], self.n[at], self.v)
        dense = np.tile(self.absent, (rows, 1))
        dense[row, at] = p
        return dense, row, at, p


def by_lang(tile: list[tuple]) -> dict[str, _Tile]:
    langs = {}
    for r in tile:
        langs.setdefault(r[0], []).append(r)
    return {lang: _Tile(rows) for lang, rows in langs.items()}


_PART = "kind string, lang string, source string, item string, value long"
_PART_PA = pa.schema([("kind", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def best_terms(found: list[pa.Table], top: int) -> list[pa.Table]:
    """The first `top` term rows of each (lang, source): by value, then by the term's UTF-8."""
    if not found:
        return found
    t = pa.concat_tables(found).sort_by([("lang", "ascending"), ("source", "ascending"), ("value", "descending"), ("item", "ascending")]).combine_chunks()
    n = t.num_rows
    if n < 2:
        return [t]
    new = [True, *(np.logical_or(*(pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
                                   for c in (t.column("lang"), t.column("source"))))).tolist()]
    starts = np.flatnonzero(new)
    rank = np.arange(n) - np.repeat(starts, np.diff([*starts, n]))
    return [t.filter(pa.array(rank < top))]


def emit(kept: DataFrame, left: list[tuple], right: list[tuple], top_terms: int) -> DataFrame:
    """What the kept stripes give for groups of tile `left` against groups of tile `right`.

    Rows of kind 'pair' are a task's sum of f over its stripes less the f of terms that
    neither source holds; rows of kind 'term' (the same tile on both sides only) are the
    first `top_terms` of a task with p > q for each group.
    """
    shared = kept.sparkSession.sparkContext.broadcast((left, right))

    def rows(batches):
        one_tile = shared.value[0] == shared.value[1]
        lt, rt = map(by_lang, shared.value)
        langs = lt.keys() & rt.keys()
        base = {x: divergence(lt[x].absent[:, None], rt[x].absent[None, :]) for x in langs if lt[x].v}
        sums = {x: np.zeros((len(lt[x]), len(rt[x])), dtype=np.int64) for x in langs}
        found, n_found = [], 0
        for b in batches:
            for lang in pc.unique(b.column("lang")).to_pylist():
                if lang not in langs:
                    continue
                own = b.filter(pc.equal(b.column("lang"), lang))
                l, r, none, total = lt[lang], rt[lang], base[lang], sums[lang]
                sizes = pc.list_value_length(own.column("codes")).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(sizes)), sizes)
                codes, counts = (own.column(c).flatten().to_numpy() for c in ("codes", "counts"))
                p, p_row, p_at, p_own = l.shares(row, codes, counts, len(sizes))
                q, q_row, q_at, q_own = r.shares(row, codes, counts, len(sizes))
                step = max(1, CHUNK_NUMBERS // max(len(l), len(r)))
                held = np.zeros(p.shape, dtype=bool)
                held[p_row, p_at] = True
                for i in range(0, len(p_row), step):          # rows of sources that hold the term
                    t, g, x = p_row[i:i + step], p_at[i:i + step], p_own[i:i + step]
                    np.add.at(total, g, divergence(x[:, None], q[t]) - none[g])
                for i in range(0, len(q_row), step):          # columns of such sources, but for the rows done above
                    t, h, x = q_row[i:i + step], q_at[i:i + step], q_own[i:i + step]
                    np.add.at(total.T, h, np.where(held[t], 0, divergence(p[t], x[:, None]) - none.T[h]))
                if one_tile:
                    overall = share(np.bincount(row, counts, len(sizes)).astype(np.int64), np.int64(l.lang_n), l.v)[p_row]
                    more = p_own > overall
                    n = int(more.sum())
                    names = pa.array(l.names, pa.string()).take(pa.array(p_at[more]))
                    found.append(pa.Table.from_arrays(
                        [pa.repeat("term", n), pa.repeat(lang, n), names, own.column("term").take(pa.array(p_row[more])),
                         pa.array(divergence(p_own, overall)[more])], schema=_PART_PA))
                    n_found += n
            if n_found > 50 * MERGE_ROWS:
                found = best_terms(found, top_terms)
                n_found = 0
        for t in best_terms(found, top_terms):
            yield from t.combine_chunks().to_batches()
        for lang, m in sums.items():
            for i, s in enumerate(lt[lang].names):
                others = np.array([x != s for x in rt[lang].names])
                n = int(others.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat("pair", n), pa.repeat(lang, n), pa.repeat(s, n),
                     pa.array(rt[lang].names, pa.string()).filter(pa.array(others)), pa.array(m[i][others])], schema=_PART_PA)

    return kept.mapInArrow(rows, _PART)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, spill_cells: int = SPILL_CELLS,
          group_tile: int = GROUP_TILE) -> DataFrame:
    """Per (lang, source): its divergence from each other source of the lang, and the terms it overuses most."""
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    names, salt = coded_groups(docs)
    kept = written(merge(fold(docs.withColumn("code", code_of(salt)), spill_cells), least_docs), "stripes")
    groups = written(group_totals(names, kept), "group-totals").orderBy("lang", "source")
    # terms that neither source of a pair holds; a pair is one row of the result
    other = groups.select("lang", F.col("source").alias("item"), F.col("n").alias("item_n"))
    base = (groups.join(other, "lang").where(F.col("source") != F.col("item"))
            .withColumn("p", F.expr(f"IF(v > 0, 1 + {SCALE}L div (n + v), 0L)"))
            .withColumn("q", F.expr(f"IF(v > 0, 1 + {SCALE}L div (item_n + v), 1L)"))
            .select(F.lit("pair").alias("kind"), "lang", "source", "item", F.expr("v * ((p - q) * (p - q) div q)").alias("value")))
    found = base
    for left in tiles(groups, group_tile):
        for right in tiles(groups, group_tile):
            if {r[0] for r in left} & {r[0] for r in right}:
                found = found.unionByName(emit(kept, left, right, top_terms))
    found = written(found, "divergences")
    order = [F.col("value").desc(), F.col("item")]
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    pairs = (found.where(F.col("kind") == "pair").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank")))
    top = (found.where(F.col("kind") == "term")
           .select("lang", "source", F.lit("term").alias("part"), "item", "value", rank.alias("rank"))
           .where(F.col("rank") <= top_terms))
    return pairs.unionByName(top)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (
  SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY ALL),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (
  SELECT lang, source, coalesce(any_value(v.v), 0) AS v,
    coalesce((SELECT sum(c.c) FROM c WHERE c.lang = d.lang AND c.source = d.source), 0) AS n
  FROM d LEFT JOIN v USING (lang) GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (g.n + g.v) AS p
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
l AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c) + 1)) // (any_value(ln.n) + any_value(ln.v)) AS q
  FROM p JOIN (SELECT lang, sum(n) AS n, any_value(v) AS v FROM g GROUP BY lang) ln USING (lang) GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT p.lang, p.source, q.source AS item, sum((p.p - q.p) * (p.p - q.p) // q.p) AS value
    FROM p JOIN p q ON p.lang = q.lang AND p.term = q.term AND p.source <> q.source GROUP BY ALL) x
    ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
o AS (
  SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, value, rank FROM (
    SELECT lang, source, term, (p - q) * (p - q) // q AS value,
      row_number() OVER (PARTITION BY lang, source ORDER BY (p - q) * (p - q) // q DESC, encode(term)) AS rank
    FROM p JOIN l USING (lang, term) WHERE c > 0 AND p > q) x WHERE rank <= 200)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM o
"""
