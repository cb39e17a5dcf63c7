"""Exploratory profile aggregates (E1-E19): the tables behind the notebook's charts.

Every profile is one aggregation (or a K2 long-form aggregation grouped by
feature) over the episode table; quantile-based bands use the exact K8
quantiles; pairwise correlations are moments in a single aggregate row.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.prims import (bin_index_fast, clip, counted_side, exact_quantiles, long_form, quantile_array, round_dp,
                               with_bin_index)
from ..session import materialize
from .quality import pearson_expr

MODEL_FEATURES = C.RAW_FEATURE_COLUMNS


def overview(df: DataFrame, group_col: str = C.GROUP_ID_COL, date_col: str = C.DATE_COL) -> DataFrame:
    """Rows, distinct borrowers, first/last draw date, column counts by type."""
    kinds = {"int": 0, "double": 0, "string": 0, "date": 0, "other": 0}
    for f in df.schema.fields:
        t = f.dataType
        k = ("int" if isinstance(t, (T.IntegerType, T.LongType, T.ShortType)) else
             "double" if isinstance(t, (T.DoubleType, T.FloatType)) else
             "string" if isinstance(t, T.StringType) else
             "date" if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "other")
        kinds[k] += 1
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(group_col).alias("n_borrowers"),
                  F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date")).select(
        "*", *[F.lit(v).cast("long").alias(f"n_{k}_columns") for k, v in kinds.items()])


def null_counts(df: DataFrame, only_nonzero: bool = True) -> DataFrame:
    """Null count per column (E2); by default only columns that have nulls."""
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    longf = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_null"))
                                           for c in df.columns])).alias("s")).select("s.*")
    return longf.where(F.col("n_null") > 0) if only_nonzero else longf


def describe(df: DataFrame, cols: Sequence[str] = MODEL_FEATURES, dp: int = 3) -> DataFrame:
    """mean, sample std, min, median, max per feature, rounded."""
    lf = long_form(df, [], cols).where(F.col("value").isNotNull())
    stats = lf.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                      F.min("value").alias("min"), F.max("value").alias("max"))
    med = exact_quantiles(lf, ["feature"], "value", [0.5]).select("feature", F.col("quantile").alias("median"))
    j = stats.join(med, "feature")
    return j.select("feature", *[round_dp(c, dp).alias(c) for c in ("mean", "std", "min", "median", "max")])


def class_balance(df: DataFrame, target: str = C.TARGET_COL) -> DataFrame:
    """Counts and shares per class plus the majority/minority ratio."""
    g = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    tot = g.agg(F.sum("n").alias("_tot"), F.max(F.when(F.col(target) == 0, F.col("n"))).alias("_n0"),
                F.max(F.when(F.col(target) == 1, F.col("n"))).alias("_n1"))
    return g.crossJoin(F.broadcast(tot)).select(
        target, "n", (F.col("n") / F.col("_tot")).alias("share"),
        F.try_divide(F.col("_n0").cast("double"), F.col("_n1")).alias("imbalance_ratio"))


def rate_by_quantile_band(df: DataFrame, cols_bins, target: str = C.TARGET_COL) -> DataFrame:
    """Default rate per quantile band (E5): linear-quantile edges, right-closed bins,
    lowest edge included (pandas qcut). Duplicate edges are merged (qcut would raise).

    All (column, n_quantiles) specs share one long-form pass: one exact-quantile
    job over the union of the specs' probabilities, one binning pass, one aggregate.
    """
    specs = list(cols_bins.items() if isinstance(cols_bins, dict) else cols_bins)
    probs_of = {i: [j / q for j in range(q)] + [1.0] for i, (_, q) in enumerate(specs)}
    all_probs = sorted({p for ps in probs_of.values() for p in ps})
    y = F.col(target).cast("double")
    parts = F.explode(F.array(*[F.struct(F.lit(i).alias("spec"), F.col(c).cast("double").alias("_x"))
                                for i, (c, _) in enumerate(specs)])).alias("s")
    lf = df.select(y.alias("_y"), parts).select("_y", "s.spec", "s._x").where(F.col("_x").isNotNull())
    q = exact_quantiles(lf, ["spec"], "_x", all_probs)
    want = F.create_map(*[x for i, ps in probs_of.items() for x in (F.lit(i), F.array(*[F.lit(p) for p in ps]))])
    edges = (q.where(F.array_contains(want[F.col("spec")], F.col("prob")))
              .groupBy("spec").agg(F.array_sort(F.array_distinct(F.collect_list("quantile"))).alias("edges")))
    n_max = max(q_ for _, q_ in specs) + 1
    j = lf.join(F.broadcast(edges), "spec")   # one row per spec
    j = with_bin_index(j, "_x", "edges", n_max, "_bi", right_closed=True)
    band = F.when(F.col("_x") == F.element_at("edges", 1), 1).otherwise(F.col("_bi")).cast("long")
    b = j.withColumn("band", band).groupBy("spec", "band").agg(
        F.first(F.element_at("edges", F.col("band").cast("int"))).alias("lo"),
        F.first(F.element_at("edges", F.col("band").cast("int") + 1)).alias("hi"),
        F.count(F.lit(1)).alias("n"), F.avg("_y").alias("default_rate"))
    name = F.create_map(*[x for i, (c, _) in enumerate(specs) for x in (F.lit(i), F.lit(c))])
    nq = F.create_map(*[x for i, (_, q_) in enumerate(specs) for x in (F.lit(i), F.lit(q_))])
    return b.select(name[F.col("spec")].alias("feature"), nq[F.col("spec")].cast("long").alias("n_quantiles"),
                    "band", "lo", "hi", "n", "default_rate")


def rate_by_value(df: DataFrame, col: str, target: str = C.TARGET_COL) -> DataFrame:
    """Default rate and volume per value of a column."""
    return df.groupBy(col).agg(F.avg(F.col(target).cast("double")).alias("default_rate"),
                               F.count(F.lit(1)).alias("n"))


def monthly_trend(df: DataFrame, date_col: str = C.DATE_COL, target: str = C.TARGET_COL) -> DataFrame:
    """Month-end resample (E7): draws, defaults, rate, mean draw, mean utilization;
    months without episodes inside the range appear with 0 counts and null means."""
    m = df.withColumn("_m", F.last_day(F.col(date_col)))
    agg = m.groupBy("_m").agg(F.count(F.lit(1)).alias("draws"), F.sum(F.col(target).cast("long")).alias("defaults"),
                              F.avg(F.col(target).cast("double")).alias("default_rate"),
                              F.avg("draw_amount_kes").alias("avg_draw_kes"),
                              F.avg("utilization_rate").alias("avg_utilization"))
    rng = agg.agg(F.min("_m").alias("lo"), F.max("_m").alias("hi"))
    spine = rng.select(F.explode(F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"),
                                            F.expr("INTERVAL 1 MONTH"))).alias("_s")).select(
        F.last_day("_s").alias("_m"))
    return spine.join(agg, "_m", "left").select(
        F.col("_m").alias("month_end"), F.coalesce("draws", F.lit(0)).cast("long").alias("draws"),
        F.coalesce("defaults", F.lit(0)).cast("long").alias("defaults"), "default_rate", "avg_draw_kes",
        "avg_utilization")


def monthly_peak(trend: DataFrame) -> DataFrame:
    """Peak-volume month (earliest on ties) and the ranges of rate and mean draw."""
    return trend.agg(
        F.min_by("month_end", F.struct(-F.col("draws"), F.col("month_end"))).alias("peak_month"),
        F.max("draws").alias("peak_draws"), F.min("default_rate").alias("min_default_rate"),
        F.max("default_rate").alias("max_default_rate"), F.min("avg_draw_kes").alias("min_avg_draw_kes"),
        F.max("avg_draw_kes").alias("max_avg_draw_kes"))


def fixed_bands(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str],
                target: str = C.TARGET_COL, include_lowest: bool = False) -> DataFrame:
    """Counts and default rate per fixed right-closed band (E9, E10); values outside
    (including the lowest edge unless include_lowest) are in no band."""
    x = F.col(col)
    band = None
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = ((x >= lo) if (include_lowest and i == 0) else (x > lo)) & (x <= hi)
        band = F.when(cond, F.lit(lab)) if band is None else band.when(cond, F.lit(lab))
    order = F.create_map(*[v for i, lab in enumerate(labels) for v in (F.lit(lab), F.lit(i))])
    b = df.withColumn("band", band).where(F.col("band").isNotNull())
    return b.groupBy("band").agg(F.count(F.lit(1)).alias("n"),
                                 F.avg(F.col(target).cast("double")).alias("default_rate")).select(
        order[F.col("band")].cast("long").alias("band_order"), "band", "n", "default_rate")


def tenure_bands(df: DataFrame) -> DataFrame:
    return fixed_bands(df, "tenure_months", C.TENURE_BAND_EDGES, C.TENURE_BAND_LABELS)


def prior_clear_bands(df: DataFrame, min_prior: int = 2) -> DataFrame:
    """Episodes with >= 2 prior draws banded by prior clear rate."""
    d = df.where(F.col("prior_overdraw_count") >= min_prior).withColumn(
        "clear_rate_prior", F.col("prior_cleared_within_24h_count")
        / clip(F.col("prior_overdraw_count").cast("double"), lower=1.0))
    return fixed_bands(d, "clear_rate_prior", C.CLEAR_RATE_BAND_EDGES, C.CLEAR_RATE_BAND_LABELS,
                       include_lowest=True)


def histogram(df: DataFrame, col: str, bins: int, group_col: str | None = None,
              upper: float | None = None, density: bool = True) -> DataFrame:
    """Equal-width histogram per group after an optional upper clip.

    Range = [min, max] of the (clipped) values of the group; the last bin is
    closed; density = count / (n * width). One pass for min/max per group, one
    for the counts.
    """
    x = clip(F.col(col).cast("double"), upper=upper) if upper is not None else F.col(col).cast("double")
    g = [group_col] if group_col else []
    d = df.select(*g, x.alias("_x")).where(F.col("_x").isNotNull())
    rng = d.groupBy(*g).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    # one row per group: counted, so that a column of a few values does not shuffle all rows on it
    rng = materialize(rng) if g else rng
    side = counted_side(rng, rng.count(), 4) if g else F.broadcast(rng)
    j = d.join(side, g) if g else d.crossJoin(side)
    width = (F.col("_hi") - F.col("_lo")) / bins
    raw = F.floor((F.col("_x") - F.col("_lo")) / width)
    b = F.when(width == 0, 0).when(F.col("_x") == F.col("_hi"), bins - 1).otherwise(F.least(raw, F.lit(bins - 1)))
    cnt = j.withColumn("bin", b.cast("long")).groupBy(*g, "bin").agg(F.count(F.lit(1)).alias("n"))
    out = cnt.join(side, g) if g else cnt.crossJoin(side)
    w = (F.col("_hi") - F.col("_lo")) / bins
    cols = [*g, "bin", (F.col("_lo") + F.col("bin") * w).alias("bin_lo"),
            (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_hi"), "n"]
    if density:
        cols.append(F.try_divide(F.col("n").cast("double"), F.col("_n") * w).alias("density"))
    return out.select(*cols)


def top_by_volume(df: DataFrame, col: str, k: int = 15, target: str = C.TARGET_COL) -> DataFrame:
    """Volume and default rate per value, top-k by volume (name tie-break), flag above the
    overall rate (E15). The limit is the feature of this report."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("volume"),
                            F.avg(F.col(target).cast("double")).alias("default_rate"))
    overall = df.agg(F.avg(F.col(target).cast("double")).alias("_overall"))
    top = g.orderBy(F.col("volume").desc(), F.col(col).asc()).limit(k)
    return top.crossJoin(F.broadcast(overall)).select(
        col, "volume", "default_rate", (F.col("default_rate") > F.col("_overall")).alias("above_average"))


def channel_summary(df: DataFrame, col: str = "channel", target: str = C.TARGET_COL) -> DataFrame:
    """Volume, default rate and mean draw per channel."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("volume"),
                               F.avg(F.col(target).cast("double")).alias("default_rate"),
                               F.avg("draw_amount_kes").alias("avg_draw"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson matrix in long form.

    Two passes like pandas: column means and null counts (one small aggregate),
    then sums of centred cross-products for every pair in ONE aggregate row.
    Columns without nulls share their means; a pair involving a column with
    nulls falls back to the masked moment form. A constant column gives null.
    Expressions are built as SQL text (a few JVM calls for hundreds of pairs).
    """
    from .quality import pearson_sql, q
    cols = list(cols)
    x = {c: f"CAST(`{c}` AS DOUBLE)" for c in cols}
    stats = df.agg(*[F.expr(f"count_if({x[c]} IS NULL) AS z{i}") for i, c in enumerate(cols)],
                   *[F.expr(f"avg({x[c]}) AS m{i}") for i, c in enumerate(cols)]).first()
    nullable = {c for i, c in enumerate(cols) if stats[f"z{i}"] > 0}
    mean = {c: (f"{float(stats[f'm{i}'])!r}D" if stats[f"m{i}"] is not None else "NULL") for i, c in enumerate(cols)}
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    idx = {pr: i for i, pr in enumerate(pairs)}
    aggs = []
    for i, (a, b) in enumerate(pairs):
        if a in nullable or b in nullable:
            aggs.append(f"{pearson_sql(x[a], x[b])} AS r{i}")
        else:
            aggs.append(f"sum(({x[a]} - {mean[a]}) * ({x[b]} - {mean[b]})) AS s{i}")
    row = df.agg(*[F.expr(a) for a in aggs])
    structs = []
    for i, (a, b) in enumerate(pairs):
        if a in nullable or b in nullable:
            r = f"r{i}"
        else:
            saa, sbb = f"s{idx[(a, a)]}", f"s{idx[(b, b)]}"
            r = f"CASE WHEN {saa} > 0 AND {sbb} > 0 THEN s{i} / sqrt({saa} * {sbb}) END"
        if a == b:
            r = f"CASE WHEN ({r}) IS NOT NULL THEN 1.0D END"
        structs.append(f"named_struct('feature_a', {q(a)}, 'feature_b', {q(b)}, 'r', CAST({r} AS DOUBLE))")
        if a != b:
            structs.append(f"named_struct('feature_a', {q(b)}, 'feature_b', {q(a)}, 'r', CAST({r} AS DOUBLE))")
    return row.selectExpr(f"inline(array({', '.join(structs)}))")


def target_correlation_topk(df: DataFrame, cols: Sequence[str] = MODEL_FEATURES, target: str = C.TARGET_COL,
                            k: int = 5) -> DataFrame:
    """Correlation of each feature with the target; top-k positive and top-k negative."""
    row = df.agg(*[pearson_expr(F.col(c), F.col(target)).alias(c) for c in cols])
    lf = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("r"))
                                        for c in cols])).alias("s")).select("s.*").where(F.col("r").isNotNull())
    w_pos = Window.orderBy(F.col("r").desc(), F.col("feature"))
    w_neg = Window.orderBy(F.col("r").asc(), F.col("feature"))
    # the frame has one row per feature (a handful), so a global window here is safe
    ranked = lf.select("feature", "r", F.row_number().over(w_pos).alias("rank_pos"),
                       F.row_number().over(w_neg).alias("rank_neg"))
    pos = ranked.where(F.col("rank_pos") <= k).select(F.lit("positive").alias("direction"),
                                                      F.col("rank_pos").cast("long").alias("rank"), "feature", "r")
    neg = ranked.where(F.col("rank_neg") <= k).select(F.lit("negative").alias("direction"),
                                                      F.col("rank_neg").cast("long").alias("rank"), "feature", "r")
    return pos.unionByName(neg)


def hash_sample(df: DataFrame, k: int, seed: int = C.RANDOM_STATE, key: str = C.KEY_COL) -> DataFrame:
    """Deterministic sample of k rows (E14): smallest seeded hashes of the key.
    Planned as TakeOrderedAndProject (per-partition top-k, then merge), no full sort."""
    return df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))).orderBy("_h", key).limit(k).drop("_h")
