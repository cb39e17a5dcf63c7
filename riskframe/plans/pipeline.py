"""Composite evaluation and training flows built from the operators."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators import cost, metrics
from ..functions.prims import round_dp
from ..session import materialize

EVAL_METRICS = ["threshold", "tn", "fp", "fn", "tp", "precision", "recall", "f1", "flag_rate"]


def evaluate_scores(scored: DataFrame, configured: float = C.CONFIGURED_THRESHOLD,
                    cfg: C.CostConfig = C.CostConfig(), split_col: str = "split",
                    threshold_split: str = "val", eval_split: str = "oot") -> DataFrame:
    """Long table (operating_point, metric, value) of the evaluation bundle.

    The deployment threshold is the min-cost threshold of the *validation*
    split; metrics are graded on the evaluation split only, so the test labels
    never choose a threshold. AUC, AP and Brier are threshold-free.
    """
    ev = scored.where(F.col(split_col) == eval_split)
    dep = cost.min_cost_threshold(scored.where(F.col(split_col) == threshold_split), cfg)
    spark = scored.sparkSession
    ts = spark.createDataFrame([("configured", float(configured))], "operating_point string, threshold double") \
        .unionByName(dep.select(F.lit("deployment").alias("operating_point"), "threshold"))
    # one distinct-score table of the evaluation split feeds every metric below
    hist = materialize(metrics.score_hist(ev, "score", "label").withColumn("neg", F.col("n") - F.col("pos")))
    tm = metrics.threshold_metrics(ev, ts, hist=hist)
    ops = tm.select("operating_point", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in EVAL_METRICS]))
        .alias("m")).select("operating_point", "m.metric", "m.value")
    summ = metrics.ranking_summary(hist=hist)
    allm = summ.select(F.explode(F.array(
        F.struct(F.lit("auc").alias("metric"), round_dp("auc", 4).alias("value")),
        F.struct(F.lit("pr_auc").alias("metric"), round_dp("average_precision", 4).alias("value")),
        F.struct(F.lit("brier_score").alias("metric"), round_dp("brier", 4).alias("value")),
        F.struct(F.lit("default_rate_actual").alias("metric"), round_dp("base_rate", 4).alias("value")))).alias("m")
    ).select(F.lit("all").alias("operating_point"), "m.metric", round_dp("m.value", 6).alias("value"))
    return allm.unionByName(ops.select("operating_point", "metric", round_dp("value", 6).alias("value")))


def train_pipeline(episodes: DataFrame, cfg: C.TrainingConfig = C.TrainingConfig(),
                   split_col: str = "split", bundle_root: str | None = None, version: str = "gbt-1") -> dict[str, DataFrame]:
    """End-to-end training flow (M7): fit on train, choose trees and calibrate on val,
    choose the min-cost threshold on val (calibrated), grade on OOT only.

    Returns result tables: metrics (long form), fairness audit, model gate
    checks, per-iteration validation loss, importances and the OOT scores.
    Only one scalar (the deployment threshold) is brought to the driver. With
    `bundle_root` the model, calibrator and threshold are saved there as `version`.
    """
    from ..operators import fairness, features, gates, model
    from ..session import materialize
    spark = episodes.sparkSession
    feats = features.build_features(episodes, validate=False, keys=(C.KEY_COL, split_col))
    train = feats.where(F.col(split_col) == "train")
    val = feats.where(F.col(split_col) == "val")
    fitted = model.train_gbt(train, val, cfg.gbt)
    raw = materialize(model.raw_scores(fitted.model, feats))
    cal = model.fit_isotonic(raw.where(F.col(split_col) == "val"))
    scored = model.calibrate(cal, raw).withColumn("label", F.col(C.TARGET_COL))
    dep_row = cost.min_cost_threshold(scored.where(F.col(split_col) == "val"), cfg.cost).first()
    dep = float(dep_row["threshold"]) if dep_row else cfg.threshold
    bundle = model.Bundle(fitted.model, cal, dep, version)
    if bundle_root is not None:
        model.save_bundle(spark, bundle, bundle_root)
    metrics_long = evaluate_scores(scored, cfg.threshold, cfg.cost)
    auc_split = metrics.roc_auc(scored.withColumn("score", F.col("raw_score")), group_cols=[split_col])
    extra = auc_split.select(F.lit("train_val_check").alias("operating_point"),
                             F.concat(F.col(split_col), F.lit("_auc")).alias("metric"),
                             round_dp("auc", 6).alias("value"))
    it = spark.createDataFrame([("train_val_check", "best_iteration", float(fitted.best_iteration)),
                                ("deployment", "bayes_optimal_threshold",
                                 float(round(cfg.cost.cost_fp / (cfg.cost.cost_fp + cfg.cost.cost_fn), 6)))],
                               "operating_point string, metric string, value double")
    oot = scored.join(episodes.select(C.KEY_COL, "tenure_months", "crb_flagged").alias("m"), C.KEY_COL) \
        if "tenure_months" not in scored.columns else scored
    oot = oot.where(F.col(split_col) == "oot")
    fair = fairness.fairness_audit(oot, dep)
    checks = gates.validate_model(scored.withColumn("score", F.col("score")), dep, cfg.validation,
                                  fitted.feature_cols)
    losses = spark.createDataFrame([(i + 1, -float(v)) for i, v in enumerate(fitted.val_losses)],
                                   "iteration int, val_auc double")
    return {"metrics": metrics_long.unionByName(extra).unionByName(it), "fairness": fair,
            "validation": checks, "val_losses": losses,
            "importance": model.feature_importance(fitted.model, fitted.feature_cols),
            "scores": scored, "model": fitted, "calibrator": cal, "threshold": dep, "bundle": bundle}
