"""Scored-table metrics.

Input: a scored DataFrame with a 0/1 label and a score column (one row per
episode, any size). Every ranking metric first collapses rows into the
distinct-score table (K4, partial aggregation map-side), then orders that
table with the two-level prefix sum (K5): no global sort of rows and no
single-partition window. Threshold metrics cross the distinct-score table
with the (user-given, small) threshold list.

Definitions follow the reference: predict positive when score >= t;
precision = tp / max(tp+fp, 1); recall = tp / max(tp+fn, 1);
f1 = 2pr / max(p+r, 1e-9); AUC credits ties by half (Mann-Whitney);
average precision is the step sum of (R_n - R_{n-1}) * P_n over distinct
thresholds (not the trapezoid); Brier is mean (p - y)^2.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.prims import (bin_index_fast, exact_quantiles, prefix_sum, quantile_array, round_dp,
                               score_hist)


def _hist(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    known = df.withColumn(score, F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double")))   # K1: NaN is no score
    return score_hist(known, score, label, group_cols).withColumnRenamed(score, "score") \
        .withColumn("neg", F.col("n") - F.col("pos"))


def threshold_frame(df: DataFrame, thresholds) -> DataFrame:
    """A list of thresholds as a small frame; a frame with a `threshold` column passes through."""
    if isinstance(thresholds, DataFrame):
        return thresholds
    return df.sparkSession.createDataFrame([(float(t),) for t in thresholds], "threshold double")


def confusion_at(df: DataFrame, thresholds, score: str = "score",
                 label: str = "label", group_cols: Sequence[str] = (), hist: DataFrame | None = None) -> DataFrame:
    """(group..., threshold[, tags], tn, fp, fn, tp, n) per threshold; score >= t is positive.

    `thresholds` is a list or a small frame with a `threshold` column (extra
    columns are carried as tags); it is broadcast against the distinct-score table.
    """
    h = _hist(df, score, label, group_cols) if hist is None else hist
    ts = threshold_frame(df, thresholds)
    j = h.crossJoin(F.broadcast(ts))
    flag = F.col("score") >= F.col("threshold")
    return j.groupBy(*group_cols, *ts.columns).agg(
        F.sum(F.when(~flag, F.col("neg")).otherwise(0)).cast("long").alias("tn"),
        F.sum(F.when(flag, F.col("neg")).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when(~flag, F.col("pos")).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when(flag, F.col("pos")).otherwise(0)).cast("long").alias("tp"),
        F.sum("n").cast("long").alias("n"))


def threshold_metrics(df: DataFrame, thresholds: Sequence[float], score: str = "score",
                      label: str = "label", group_cols: Sequence[str] = (), hist: DataFrame | None = None) -> DataFrame:
    """Confusion matrix + precision, recall, F1 and flag rate (4 dp) per threshold."""
    c = confusion_at(df, thresholds, score, label, group_cols, hist)
    tags = [x for x in threshold_frame(df, thresholds).columns if x != "threshold"]
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    prec = tp / F.greatest(tp + fp, F.lit(1))
    rec = tp / F.greatest(tp + fn, F.lit(1))
    f1 = 2 * prec * rec / F.greatest(prec + rec, F.lit(1e-9))
    return c.select(*group_cols, *tags, "threshold", "tn", "fp", "fn", "tp",
                    round_dp(prec, 4).alias("precision"), round_dp(rec, 4).alias("recall"),
                    round_dp(f1, 4).alias("f1"),
                    round_dp(F.try_divide(tp + fp, F.col("n")), 4).alias("flag_rate"))


def threshold_sweep(df: DataFrame, thresholds: Sequence[float], score: str = "score",
                    label: str = "label", group_cols: Sequence[str] = ()) -> DataFrame:
    """Flag rate, FPR and FNR per threshold (A13); one pass over the distinct-score table."""
    c = confusion_at(df, thresholds, score, label, group_cols)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(*group_cols, "threshold",
                    F.try_divide((tp + fp).cast("double"), F.col("n")).alias("flag_rate"),
                    F.try_divide(fp.cast("double"), fp + tn).alias("fpr"),
                    F.try_divide(fn.cast("double"), fn + tp).alias("fnr"))


def roc_auc(df: DataFrame, score: str = "score", label: str = "label",
            group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., auc, n_pos, n_neg); auc null when a class is missing."""
    h = _hist(df, score, label, group_cols)
    r = prefix_sum(h, group_cols, "score", ["neg", "pos"])
    return r.groupBy(*group_cols).agg(
        (F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))).alias("_u"),
        F.first("pos_total").alias("n_pos"), F.first("neg_total").alias("n_neg")).select(
        *group_cols,
        F.try_divide(F.col("_u"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("auc"),
        F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg"))


def pr_curve(df: DataFrame, score: str = "score", label: str = "label",
             group_cols: Sequence[str] = ()) -> DataFrame:
    """Per distinct score t (descending): tp, fp (score >= t), precision, recall."""
    h = _hist(df, score, label, group_cols)
    r = prefix_sum(h, group_cols, "score", ["pos", "n"], descending=True)
    tp = F.col("pos_before") + F.col("pos")
    flagged = F.col("n_before") + F.col("n")
    return r.select(*group_cols, F.col("score").alias("threshold"),
                    tp.cast("long").alias("tp"), (flagged - tp).cast("long").alias("fp"),
                    F.col("pos").cast("long").alias("pos_at"),
                    F.col("pos_total").cast("long").alias("n_pos"),
                    (F.col("n_total") - F.col("pos_total")).cast("long").alias("n_neg"),
                    (tp / flagged).alias("precision"),
                    F.try_divide(tp.cast("double"), F.col("pos_total")).alias("recall"))


def average_precision(df: DataFrame, score: str = "score", label: str = "label",
                      group_cols: Sequence[str] = ()) -> DataFrame:
    """Step-wise average precision (A15); null without positives."""
    c = pr_curve(df, score, label, group_cols)
    return c.groupBy(*group_cols).agg(
        F.try_divide(F.sum(F.col("pos_at") * F.col("precision")), F.first("n_pos").cast("double"))
        .alias("average_precision"))


def brier(df: DataFrame, score: str = "score", label: str = "label",
          group_cols: Sequence[str] = ()) -> DataFrame:
    """Brier score, base rate and the no-skill Brier r(1 - r)."""
    y = F.col(label).cast("double")
    d = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    return d.groupBy(*group_cols).agg(
        F.avg(F.pow(F.col(score) - y, 2)).alias("brier"), F.avg(y).alias("base_rate"),
        F.count(F.lit(1)).alias("n")).withColumn(
        "no_skill_brier", F.col("base_rate") * (1 - F.col("base_rate")))


def calibration_table(df: DataFrame, score: str = "score", label: str = "label",
                      n_bins: int = 10, group_cols: Sequence[str] = ()) -> DataFrame:
    """Reliability table (A18): decile edges of the score, unique, right-closed bins with
    the lowest edge included; empty bins omitted; fewer than 2 edges gives no rows."""
    probs = [float(i) / n_bins for i in range(n_bins + 1)]
    d = df.where(F.col(score).isNotNull()).select(*group_cols, F.col(score).alias("_s"),
                                                  F.col(label).cast("double").alias("_y"))
    e = quantile_array(d, group_cols, "_s", probs, alias="_q").select(
        *group_cols, F.array_sort(F.array_distinct("_q")).alias("edges"))
    e = e.where(F.size("edges") >= 2)
    j = d.crossJoin(F.broadcast(e)) if not group_cols else d.join(F.broadcast(e), list(group_cols))
    idx = bin_index_fast("_s", "edges", n_bins + 1, right_closed=True)
    idx = F.when(F.col("_s") == F.element_at("edges", 1), 1).otherwise(idx)
    b = j.withColumn("bin", idx.cast("long")).where((F.col("bin") >= 1) & (F.col("bin") < F.size("edges")))
    return b.groupBy(*group_cols, "bin").agg(
        F.first(F.element_at("edges", F.col("bin").cast("int"))).alias("bin_lo"),
        F.first(F.element_at("edges", F.col("bin").cast("int") + 1)).alias("bin_hi"),
        F.count(F.lit(1)).alias("n"),
        round_dp(F.avg("_s"), 4).alias("mean_predicted"),
        round_dp(F.avg("_y"), 4).alias("actual_default_rate"))


def score_quantiles(df: DataFrame, probs: Sequence[float] = (0.5, 0.9), score: str = "score",
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact linear quantiles of the score (A19), e.g. median and p90."""
    return exact_quantiles(df, group_cols, score, probs).select(
        *group_cols, "prob", F.col("quantile").alias("value"), "n")


def ranking_summary(df: DataFrame | None = None, score: str = "score", label: str = "label",
                    group_cols: Sequence[str] = (), hist: DataFrame | None = None) -> DataFrame:
    """AUC, average precision, Brier, base rate and counts from ONE distinct-score table
    and ONE ascending prefix sum: descending cumulative counts are totals minus the
    ascending "before" counts, and (p - y)^2 sums per distinct score as
    pos (s - 1)^2 + neg s^2."""
    h = _hist(df, score, label, group_cols) if hist is None else hist
    r = prefix_sum(h, group_cols, "score", ["pos", "n"])
    s_, pos, n = F.col("score"), F.col("pos"), F.col("n")
    neg = n - pos
    neg_before = F.col("n_before") - F.col("pos_before")
    tp_incl = F.col("pos_total") - F.col("pos_before")
    flagged_incl = F.col("n_total") - F.col("n_before")
    agg = r.groupBy(*group_cols).agg(
        F.sum(pos * (neg_before + neg / 2.0)).alias("_u"),
        F.sum(pos * (tp_incl / flagged_incl)).alias("_ap"),
        F.sum(pos * F.pow(s_ - 1.0, 2) + neg * F.pow(s_, 2)).alias("_sq"),
        F.first("pos_total").alias("n_pos"), F.first("n_total").alias("n"))
    n_pos, n_all = F.col("n_pos"), F.col("n")
    return agg.select(
        *group_cols,
        F.try_divide(F.col("_u"), n_pos.cast("double") * (n_all - n_pos)).alias("auc"),
        F.try_divide(F.col("_ap"), n_pos.cast("double")).alias("average_precision"),
        (F.col("_sq") / n_all).alias("brier"), (n_pos / n_all).alias("base_rate"),
        n_pos.cast("long").alias("n_pos"), n_all.cast("long").alias("n"))
