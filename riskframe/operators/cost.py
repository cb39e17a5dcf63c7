"""Business-cost thresholds.

The empirical search runs over every distinct score t (predict positive when
score >= t) with the cumulative counts of the two-level prefix sum, so it is
exact and never sorts the rows globally. The argmin is `min(struct(cost,
score))`: the lowest threshold wins ties, as numpy's first-argmin does on an
ascending threshold list. Kept quirk of the reference: where TP = 0 the FP
term is the count of all negatives (its precision-based formula degenerates).
"Approve everyone" is not a candidate.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CostConfig
from ..functions.prims import prefix_sum, round_dp, score_hist


def bayes_optimal_threshold(cfg: CostConfig = CostConfig()) -> float:
    return cfg.cost_fp / (cfg.cost_fp + cfg.cost_fn)


def cost_curve(df: DataFrame, cfg: CostConfig = CostConfig(), score: str = "score",
               label: str = "label", group_cols=()) -> DataFrame:
    """Per distinct score: tp, fp, fn and expected cost c_fp * FP + c_fn * FN."""
    h = score_hist(df, score, label, group_cols).withColumnRenamed(score, "score")
    r = prefix_sum(h, group_cols, "score", ["pos", "n"], descending=True)
    tp = F.col("pos_before") + F.col("pos")
    fp = F.col("n_before") + F.col("n") - tp
    n_pos = F.col("pos_total")
    n_neg = F.col("n_total") - F.col("pos_total")
    fp_term = F.when(tp > 0, fp).otherwise(n_neg)
    fn = n_pos - tp
    cost = F.lit(float(cfg.cost_fp)) * fp_term.cast("double") + F.lit(float(cfg.cost_fn)) * fn.cast("double")
    return r.select(*group_cols, F.col("score").alias("threshold"), tp.cast("long").alias("tp"),
                    fp.cast("long").alias("fp"), fn.cast("long").alias("fn"), cost.alias("cost"),
                    F.col("n_total").cast("long").alias("n_total"))


def min_cost_threshold(df: DataFrame, cfg: CostConfig = CostConfig(), score: str = "score",
                       label: str = "label", group_cols=()) -> DataFrame:
    """(group..., threshold, expected_cost, flag_rate) at the empirical minimum-cost threshold."""
    c = cost_curve(df, cfg, score, label, group_cols)
    best = c.groupBy(*group_cols).agg(
        F.min(F.struct("cost", "threshold", "tp", "fp", "n_total")).alias("b"))
    return best.select(*group_cols, F.col("b.threshold").alias("threshold"),
                       F.col("b.cost").alias("expected_cost"),
                       ((F.col("b.tp") + F.col("b.fp")) / F.col("b.n_total")).alias("flag_rate"))


def cost_threshold_report(df: DataFrame, cfg: CostConfig = CostConfig(), score: str = "score",
                          label: str = "label") -> DataFrame:
    """Bayes vs empirical threshold, flag rate and cost at the empirical one."""
    m = min_cost_threshold(df, cfg, score, label)
    return m.select(
        F.lit(float(cfg.cost_fp)).alias("cost_fp"), F.lit(float(cfg.cost_fn)).alias("cost_fn"),
        F.lit(cfg.description).alias("description"),
        round_dp(F.lit(bayes_optimal_threshold(cfg)), 4).alias("bayes_optimal_threshold"),
        round_dp(F.col("threshold"), 4).alias("empirical_threshold"),
        round_dp(F.col("flag_rate"), 4).alias("flag_rate_at_empirical"),
        round_dp(F.col("expected_cost"), 2).alias("expected_cost_at_empirical"),
        F.col("threshold").alias("empirical_threshold_raw"))
