"""Shared Spark primitives used by every operator.

K1 clean_nan      NaN -> null on floating columns (one projection)
K2 long_form      wide features -> (keys, feature, value) via unpivot
K3 bin_index      bin ordinal of x against a sorted edge array; `with_bin_index`
                  / `bin_index_fast` are unrolled binary searches compiled by
                  whole-stage codegen (`bin_index` is the lambda form)
K4 score_hist     (group, score) -> positives / count; every ranking metric
                  starts from this partially aggregated table
K5 prefix_sum     ordered running sums without a global sort of rows: the input
                  is cut into approximate-quantile buckets (as many as its rows
                  need), summed inside each bucket with a window and shifted by
                  per-bucket offsets
K6 safe_ratio     division that never raises under ANSI mode
K7 checks_frame   check rows derived from one aggregate row
K8 exact_quantiles exact linear-interpolated quantiles: a sketch brackets the
                  wanted ranks, and one pass counts rows outside and values inside
round_dp          round half up on the binary value, shared with the SQL oracle
"""
from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

CHECK_SCHEMA = T.StructType([
    T.StructField("check_seq", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("severity", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("limit", T.DoubleType()),
    T.StructField("message", T.StringType()),
])

# Buckets used by the two-level prefix sum. Each bucket holds roughly
# 1/PREFIX_BUCKETS of a group's rows, so a task never sees a whole group.
PREFIX_BUCKETS = 64
# Sketch accuracy per bucket: the rank error of an edge is a quarter of a bucket's
# share, whatever the number of buckets. The edges only balance load.
ACCURACY_PER_BUCKET = 4
# Entries (rows x array length) up to which a counted table is broadcast: 32 MB of doubles.
BROADCAST_ENTRIES = 4_000_000


def counted_side(df: DataFrame, rows: int, width: int = 1) -> DataFrame:
    """`df`, marked for broadcast only if its known size (`rows` of `width` entries) is small."""
    return F.broadcast(df) if rows * width <= BROADCAST_ENTRIES else df


# ---------------------------------------------------------------- K1
def clean_nan(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every float/double column (single projection)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name)
            cols.append(F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- K2
def long_form(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
              name: str = "feature", value: str = "value") -> DataFrame:
    """Unpivot `cols` (cast to double) into (keys..., feature, value)."""
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(keys), list(cols), name, value)


# ---------------------------------------------------------------- K3
def bin_index(x: Column, edges: Column, max_edges: int, right_closed: bool = False) -> Column:
    """Number of edges <= x (left-closed bins) or < x (right-closed bins).

    Binary search written with `aggregate` over a fixed number of steps, so
    the cost per row is O(log n) comparisons, all inside the JVM. A null x
    gives null.
    """
    steps = max(1, math.ceil(math.log2(max_edges + 1)))

    def step(acc, _i):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        e = F.try_element_at(edges, mid + 1)
        below = (e < x) if right_closed else (e <= x)
        moved = F.when(below, F.struct((mid + 1).alias("lo"), hi.alias("hi"))).otherwise(
            F.struct(lo.alias("lo"), mid.alias("hi")))
        return F.when(lo < hi, moved).otherwise(acc)

    start = F.struct(F.lit(0).alias("lo"), F.size(edges).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda acc: acc["lo"])
    return F.when(x.isNull(), F.lit(None).cast("int")).otherwise(found)


def upper_bound_sql(x: str, edges: str, n: int, right_closed: bool = False, block_col: str | None = None) -> str:
    """SQL text: number of the first `n` entries of sorted `edges` that are <= x (or < x).

    An unrolled binary search -- nested CASE over array positions -- so it
    compiles into whole-stage code instead of running an interpreted lambda.
    Entries past the array's end read as NULL and count as greater than x, so
    shorter (de-duplicated) edge arrays work unchanged. Beyond 64 entries the
    search runs in two stages (which block of 64, then where inside it) so the
    expression stays small for any n up to 4096.
    """
    op = "<" if right_closed else "<="

    def below(pos: str) -> str:
        return f"coalesce(try_element_at({edges}, {pos}) {op} {x}, false)"

    def build(lo: int, hi: int, pos) -> str:
        if lo >= hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {below(pos(mid))} THEN {build(mid + 1, hi, pos)} ELSE {build(lo, mid, pos)} END"

    if n <= 64:
        body = build(0, n, lambda i: str(i + 1))
    else:
        block = 64
        m = -(-n // block)
        # block j is "fully below" when its last entry (1-based position min((j+1)*64, n)) is below x
        blk = block_col or build(0, m, lambda j: str(min((j + 1) * block, n)))
        fine = build(0, block, lambda i: f"({blk} * {block} + {i + 1})")
        body = f"least({blk} * {block} + {fine}, {n})"
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE {body} END"


def block_index_sql(x: str, edges: str, n: int, right_closed: bool = False, block: int = 64) -> str:
    """SQL text: number of leading 64-entry blocks of `edges` lying entirely below x."""
    op = "<" if right_closed else "<="
    m = -(-n // block)

    def build(lo: int, hi: int) -> str:
        if lo >= hi:
            return str(lo)
        mid = (lo + hi) // 2
        pos = min((mid + 1) * block, n)
        return (f"CASE WHEN coalesce(try_element_at({edges}, {pos}) {op} {x}, false) "
                f"THEN {build(mid + 1, hi)} ELSE {build(lo, mid)} END")
    return build(0, m)


def with_bin_index(df: DataFrame, x: str, edges: str, n: int, out: str, right_closed: bool = False) -> DataFrame:
    """Add `out` = number of edges <= x (< x); two projected steps beyond 64 edges."""
    if n <= 64:
        return df.withColumn(out, F.expr(upper_bound_sql(x, edges, n, right_closed)))
    d = df.withColumn("_blk", F.expr(block_index_sql(x, edges, n, right_closed)))
    return d.withColumn(out, F.expr(upper_bound_sql(x, edges, n, right_closed, block_col="_blk"))).drop("_blk")


def bin_index_fast(x: str, edges: str, max_edges: int, right_closed: bool = False) -> Column:
    """Column form of `upper_bound_sql` (x and edges are column names or SQL text)."""
    return F.expr(upper_bound_sql(x, edges, max_edges, right_closed))


# ---------------------------------------------------------------- K4
def score_hist(df: DataFrame, score: str = "score", label: str = "label",
               group_cols: Sequence[str] = ()) -> DataFrame:
    """Distinct-score table: (group..., score, pos, n). Partial aggregation runs map-side."""
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
              .groupBy(*group_cols, score)
              .agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- K5
ROWS_PER_BUCKET = 1_000_000


def prefix_sum(df: DataFrame, group_cols: Sequence[str], order_col: str,
               sum_cols: Sequence[str], descending: bool = False,
               n_buckets: int = PREFIX_BUCKETS, materialized: bool = False) -> DataFrame:
    """Add `<c>_before` (sum over strictly earlier rows of the group) and `<c>_total`.

    Rows must be unique per (group_cols, order_col) -- aggregate first (K4).
    The input (an aggregate, so usually far smaller than the raw rows) is
    materialized. One aggregate over it gives approximate-quantile bucket edges,
    totals and the row count; more than ROWS_PER_BUCKET rows a bucket ask for more
    edges once. Then: bucket by binary search -> running sum inside (group,
    bucket) -> offsets from the per-bucket totals (at most groups x buckets
    rows), so no task ever holds a whole group. Edges and offsets are broadcast
    where the counted groups allow it and joined on their keys otherwise; without
    groups the edges are constants of the plan.
    """
    g = list(group_cols)
    if not materialized:
        df = materialize(df)

    def cut(n: int) -> DataFrame:
        probs = [i / n for i in range(1, n)]
        return df.groupBy(*g).agg(
            F.percentile_approx(F.col(order_col).cast("double"), probs, ACCURACY_PER_BUCKET * n).alias("_edges"),
            F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"{c}_total") for c in sum_cols])

    def measured(n: int) -> tuple[DataFrame, int, int]:
        """(edges, rows, groups)"""
        if not g:
            edges = cut(n)
            row = edges.first()
            # a total keeps its column's type: as a bare literal a long would be an int, and products of totals overflow
            consts = [F.lit(row._edges or []).cast("array<double>").alias("_edges"),
                      *[F.lit(row[t]).cast(edges.schema[t].dataType).alias(t) for t in (f"{c}_total" for c in sum_cols)]]
            return df.select("*", *consts), row._rows, 1
        edges = materialize(cut(n))
        row = edges.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.count(F.lit(1))).first()
        return edges.drop("_rows"), row[0], row[1]

    # about ROWS_PER_BUCKET rows per (group, bucket) task, whatever the input size
    edges, rows, groups = measured(n_buckets)
    if rows > n_buckets * ROWS_PER_BUCKET:
        n_buckets = -(-rows // ROWS_PER_BUCKET)
        edges, rows, groups = measured(n_buckets)
    with_edges = df.join(counted_side(edges, groups, n_buckets), g) if g else edges
    b = with_bin_index(with_edges, f"CAST(`{order_col}` AS DOUBLE)", "_edges", n_buckets - 1, "_bk")
    if descending:
        b = b.withColumn("_bk", F.lit(n_buckets) - F.col("_bk"))
    b = b.drop("_edges")

    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w_in = Window.partitionBy(*g, "_bk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = b.select("*", *[F.coalesce(F.sum(c).over(w_in), F.lit(0)).alias(f"_{c}_local")
                            for c in sum_cols])

    w_bk = Window.partitionBy(*g).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (b.groupBy(*g, "_bk").agg(*[F.sum(c).alias(f"_{c}_bsum") for c in sum_cols])
                .select(*g, "_bk", *[F.coalesce(F.sum(f"_{c}_bsum").over(w_bk), F.lit(0))
                                     .alias(f"_{c}_off") for c in sum_cols]))
    out = local.join(counted_side(offsets, groups, n_buckets), [*g, "_bk"])
    return out.select(
        *[F.col(c) for c in df.columns],
        *[F.col(f"{c}_total") for c in sum_cols],
        *[(F.col(f"_{c}_local") + F.col(f"_{c}_off")).alias(f"{c}_before") for c in sum_cols])


# ---------------------------------------------------------------- K6
def safe_ratio(a: Column, b: Column, floor: float | None = None) -> Column:
    """a / b with a floor on the denominator (reference's max(b, eps)) or null on 0."""
    if floor is not None:
        return a / F.greatest(b.cast("double"), F.lit(float(floor)))
    return F.try_divide(a.cast("double"), b.cast("double"))


def clip(c: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """pandas `.clip`: null stays null (least/greatest would skip it)."""
    out = c
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(c.isNull(), c).otherwise(out)


def round_dp(c: Column | str, dp: int) -> Column:
    """Round half up to `dp` decimals as floor(x * 10^dp + 0.5) / 10^dp.

    Plain IEEE operations, so Spark and the SQL oracle (which spells the same
    formula) give bit-identical results; F.round instead rounds the decimal
    text of the double and disagrees with binary rounding on ties such as
    0.9617695. Magnitudes >= 1e12 fall back to F.round (no long overflow).
    """
    c = F.col(c) if isinstance(c, str) else c
    c = c.cast("double")
    k = float(10 ** dp)
    return F.when(F.abs(c) < 1e12, F.floor(c * k + 0.5) / k).otherwise(F.round(c, dp))


def sql_round_dp(e: str, dp: int) -> str:
    """SQL spelling of `round_dp` for the oracle."""
    k = f"{float(10 ** dp)!r}::DOUBLE"
    return f"(CASE WHEN ABS({e}) < 1e12 THEN FLOOR(CAST({e} AS DOUBLE) * {k} + 0.5) / {k} ELSE ROUND({e}, {dp}) END)"


def r6(c: Column | str) -> Column:
    """Round a double to 6 dp (output normalisation shared with the SQL oracle)."""
    return round_dp(c, 6)


# ---------------------------------------------------------------- K7
def check_row(seq: int | Column, name: str | Column, passed: Column, severity: Column | str,
              value: Column | float | None, limit: Column | float | None,
              message: Column | str) -> Column:
    def lit(x, t):
        if isinstance(x, Column):
            return x.cast(t)
        return F.lit(x).cast(t)
    return F.struct(
        lit(seq, "int").alias("check_seq"), lit(name, "string").alias("name"),
        lit(passed, "boolean").alias("passed"), lit(severity, "string").alias("severity"),
        lit(value, "double").alias("value"), lit(limit, "double").alias("limit"),
        lit(message, "string").alias("message"))


def checks_frame(agg_row: DataFrame, rows: Iterable[Column]) -> DataFrame:
    """Explode check structs computed from a (single-row) aggregate frame."""
    rows = list(rows)
    if not rows:
        spark = agg_row.sparkSession
        return spark.createDataFrame([], CHECK_SCHEMA)
    return agg_row.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def severity(passed: Column, fail_severity: str = "error") -> Column:
    return F.when(passed, F.lit("info")).otherwise(F.lit(fail_severity))


def fmt_num(c: Column, dp: int) -> Column:
    """Fixed-decimal text of an (already rounded) double."""
    return F.format_string(f"%.{dp}f", c)


# ---------------------------------------------------------------- K8
# Sketch accuracy: ranks of a sketch are off by at most 1/SKETCH_ACCURACY of a group's rows.
SKETCH_ACCURACY = 10_000
# Groups up to this size are ranked whole. In larger ones a sketch's rank error exceeds five rows.
SMALL_GROUP = 50_000
# Rows of a bracket (six rank errors) beyond which a finer sketch is taken.
BRACKET_ROWS = 4_000_000


def _targets(sizes: DataFrame, g: list[str], probs: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """(want, ends): per group and prob the interpolation position and the two needed ranks."""
    targets = F.explode(F.array(*[F.struct(F.lit(i).alias("q_idx"), F.lit(float(p)).alias("prob"))
                                  for i, p in enumerate(probs)])).alias("t")
    want = (sizes.select(*g, "n", targets).select(*g, "n", "t.q_idx", "t.prob")
                 .withColumn("_pos", F.col("prob") * (F.col("n") - 1).cast("double"))
                 .withColumn("_lo_rank", F.floor("_pos").cast("long"))
                 .withColumn("_hi_rank", F.ceil("_pos").cast("long"))
                 .withColumn("_frac", F.col("_pos") - F.floor("_pos")))
    ends = want.select(*g, "q_idx", F.explode(F.array(
        F.struct(F.lit(0).alias("_end"), F.col("_lo_rank").alias("_rank")),
        F.struct(F.lit(1).alias("_end"), F.col("_hi_rank").alias("_rank")))).alias("e")).select(
        *g, "q_idx", "e._end", "e._rank")
    return want, ends


def _interpolate(want: DataFrame, hit: DataFrame, g: list[str]) -> DataFrame:
    pv = hit.groupBy(*g, "q_idx").agg(
        F.max(F.when(F.col("_end") == 0, F.col("_v"))).alias("_lo_v"),
        F.max(F.when(F.col("_end") == 1, F.col("_v"))).alias("_hi_v"))
    res = want.join(pv, [*g, "q_idx"], "left")
    q = F.when(F.col("_lo_v") == F.col("_hi_v"), F.col("_lo_v")).otherwise(
        F.col("_lo_v") + (F.col("_hi_v") - F.col("_lo_v")) * F.col("_frac"))
    # every wanted rank lies in its bracket by the sketch's guarantee; were it ever to fail, it fails loudly
    missed = F.raise_error(F.lit("exact_quantiles: a rank lies outside its bracket")).cast("double")
    return res.select(*g, "q_idx", "prob", "n", F.when(q.isNull(), missed).otherwise(q).alias("quantile"))


def _brackets(base: DataFrame, g: list[str], probs: Sequence[float], accuracy: int) -> DataFrame:
    """(group, n, _cuts, _fine): bounds around the wanted ranks, and which intervals between cuts lie inside any."""
    slack, m = 3.0 / accuracy, len(probs)
    around = [max(0.0, p - slack) for p in probs] + [min(1.0, p + slack) for p in probs]
    s = base.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_v", around, accuracy).alias("_s"))
    s = s.where(F.col("n") > 0).select(*g, "n", F.when(F.col("n") <= SMALL_GROUP, F.array().cast("array<double>"))
                                       .otherwise(F.col("_s")).alias("_s"))
    spans = F.arrays_zip(F.slice("_s", 1, m).alias("lo"), F.slice("_s", m + 1, m).alias("hi"))
    s = s.select(*g, "n", F.array_sort(F.array_distinct("_s")).alias("_cuts"), spans.alias("_spans"))

    def inside(i: Column) -> Column:
        left, right = F.try_element_at("_cuts", i), F.try_element_at("_cuts", i + 1)
        return F.exists("_spans", lambda x: F.coalesce((x["lo"] <= left) & (x["hi"] >= right), F.lit(False)))

    n_cuts = F.size("_cuts")
    fine = F.transform(F.sequence(F.lit(0), n_cuts), lambda i: (n_cuts == 0) | ((i > 0) & inside(F.greatest(i, F.lit(1)))))
    return s.select(*g, "n", "_cuts", fine.alias("_fine"))


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolated quantiles per group.

    Returns (group..., q_idx, prob, n, quantile). Nulls are ignored; an empty
    group yields no rows. Interpolation: lo + (hi - lo) * frac with
    pos = prob * (n - 1) -- the definition numpy's and DuckDB's linear
    quantiles share.

    Two passes. (1) A mergeable sketch brackets every wanted rank between two of the
    group's values, and counts the group; a group so large that a bracket holds more
    than BRACKET_ROWS rows has it taken again, finer. (2) One aggregate counts rows by
    the cell they fall in, where the brackets' bounds and the intervals between
    them are the cells, and by value where the cell lies inside a bracket. Ranks then
    come from exact counts: of cells first, of the few values of the cell after.
    What is shuffled is a few thousandths of the rows, combined map-side.
    """
    g = list(group_cols)
    base = df.where(F.col(value_col).isNotNull()).select(*g, F.col(value_col).cast("double").alias("_v"))
    accuracy = SKETCH_ACCURACY
    while True:
        sketch = materialize(_brackets(base, g, probs, accuracy))
        groups, largest = sketch.agg(F.count(F.lit(1)), F.max("n")).first()
        finer = -(-6 * (largest or 0) // BRACKET_ROWS)
        if finer <= accuracy:
            break
        accuracy = finer
    n_cuts = 2 * len(probs)
    cuts = counted_side(sketch.drop("n"), groups, 2 * n_cuts)
    j = base.join(cuts, g) if g else base.crossJoin(cuts)
    # one search (a second in the same stage would outgrow what the JIT compiles): cuts up to v, and whether the last one is v
    j = with_bin_index(j, "_v", "_cuts", n_cuts, "_upto")
    j = j.withColumn("_at_cut", F.coalesce(F.try_element_at("_cuts", F.greatest(F.col("_upto"), F.lit(1))) == F.col("_v"), F.lit(False)))
    cell = 2 * F.col("_upto") - F.col("_at_cut").cast("int")
    # read twice below; materialized, it is one pass over the rows
    hist = materialize(j.select(*g, cell.alias("_cell"),
                                F.when(F.col("_at_cut") | F.element_at("_fine", F.col("_upto") + 1), F.col("_v")).alias("_v"))
                       .groupBy(*g, "_cell", "_v").agg(F.count(F.lit(1)).alias("_k")))
    # groups x cells rows
    w_cells = Window.partitionBy(*g).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (hist.groupBy(*g, "_cell").agg(F.sum("_k").alias("_in"))
             .withColumn("_before", F.coalesce(F.sum("_in").over(w_cells), F.lit(0))))
    want, ends = _targets(counted_side(sketch.select(*g, "n"), groups), g, probs)
    # cell and rank inside it of every needed order statistic (groups x probs x 2 rows)
    located = (cells.join(counted_side(ends, groups, 2 * len(probs)), g) if g else cells.crossJoin(ends)).where(
        (F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_in"))).select(
        *g, "q_idx", "_end", "_cell", (F.col("_rank") - F.col("_before")).alias("_local"))
    w_in = Window.partitionBy(*g, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = hist.where(F.col("_v").isNotNull()).withColumn("_lower", F.coalesce(F.sum("_k").over(w_in), F.lit(0)))
    hit = ranked.join(counted_side(located, groups, 2 * len(probs)), [*g, "_cell"]).where(
        (F.col("_lower") <= F.col("_local")) & (F.col("_local") < F.col("_lower") + F.col("_k")))
    return _interpolate(want, hit, g)


def quantile_array(df: DataFrame, group_cols: Sequence[str], value_col: str,
                   probs: Sequence[float], alias: str = "edges") -> DataFrame:
    """exact_quantiles collected into one ordered array per group (small table)."""
    g = list(group_cols)
    q = exact_quantiles(df, g, value_col, probs)
    return q.groupBy(*g).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("q_idx", "quantile"))),
                    lambda s: s["quantile"]).alias(alias),
        F.first("n").alias("n"))
