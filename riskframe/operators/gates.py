"""Model validation gates and report handling.

AUC for several splits comes from ONE grouped AUC plan (groupBy split inside
the distinct-score table), so the train-vs-OOT gap costs no extra pass.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.prims import CHECK_SCHEMA, check_row, fmt_num, round_dp
from .fairness import fairness_gate, with_gate_groups
from .metrics import roc_auc


class ValidationError(Exception):
    """Raised by `assert_passed` when an error-severity check failed."""


def auc_by_split(scored: DataFrame, score: str = "score", label: str = "label",
                 split_col: str = "split") -> DataFrame:
    return roc_auc(scored, score, label, group_cols=[split_col])


def auc_gate(auc_row: DataFrame, min_auc: float = C.MIN_AUC, seq: int = 100) -> DataFrame:
    """model.auc check from a one-row frame with column `auc` (null AUC fails)."""
    auc = F.col("auc")
    ok = F.coalesce(auc >= min_auc, F.lit(False))
    msg = F.concat(F.lit("AUC="), F.coalesce(fmt_num(round_dp(auc, 4), 4), F.lit("nan")),
                   F.when(ok, F.lit(" >= ")).otherwise(F.lit(" < ")), F.lit(f"min={min_auc}"))
    return auc_row.select(check_row(seq, "model.auc", ok, F.when(ok, "info").otherwise("error"),
                                    round_dp(auc, 4), min_auc, msg).alias("c")).select("c.*")


def auc_gap_gate(train_oot: DataFrame, max_gap: float = C.MAX_TRAIN_OOT_GAP, seq: int = 200) -> DataFrame:
    """model.train_oot_gap from a one-row frame with `train_auc`, `oot_auc` (warning on failure)."""
    gap = F.col("train_auc") - F.col("oot_auc")
    ok = F.coalesce(gap <= max_gap, F.lit(False))
    msg = F.concat(F.lit("Train-OOT AUC gap="), fmt_num(round_dp(gap, 4), 4), F.lit(" (train="),
                   fmt_num(round_dp(F.col("train_auc"), 4), 4), F.lit(", OOT="),
                   fmt_num(round_dp(F.col("oot_auc"), 4), 4), F.lit(")"))
    return train_oot.where(F.col("train_auc").isNotNull()).select(
        check_row(seq, "model.train_oot_gap", ok, F.when(ok, "info").otherwise("warning"),
                  round_dp(gap, 4), max_gap, msg).alias("c")).select("c.*")


def forbidden_feature_checks(spark, feature_cols: Sequence[str],
                             forbidden: Sequence[str] = C.FORBIDDEN_FEATURES, seq: int = 400) -> DataFrame:
    """Forbidden names in the model's feature list: one error each, or one pass row."""
    present = [f for f in forbidden if f in feature_cols]
    if present:
        rows = [(seq + i, f"leakage.forbidden_feature.{f}", False, "error", None, None,
                 f"Forbidden feature '{f}' is present in the model's feature list") for i, f in enumerate(present)]
    elif forbidden:
        rows = [(seq, "leakage.forbidden_features", True, "info", None, None,
                 "No forbidden features present in model feature list")]
    else:
        rows = []
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def validate_model(scored: DataFrame, threshold: float | str, config: C.ModelValidationConfig = C.ModelValidationConfig(),
                   feature_cols: Sequence[str] = C.FEATURE_COLUMNS, score: str = "score", label: str = "label",
                   split_col: str = "split", eval_split: str = "oot", train_split: str | None = "train") -> DataFrame:
    """AUC gate, train-OOT gap, fairness gates and forbidden features as one check table.

    `scored` holds every split; AUCs of the evaluation and training splits come
    from one grouped AUC plan; fairness is evaluated on the evaluation split.
    """
    aucs = auc_by_split(scored.where(F.col(split_col).isin(eval_split, train_split or eval_split)),
                        score, label, split_col)
    pivot = aucs.agg(F.max(F.when(F.col(split_col) == eval_split, F.col("auc"))).alias("oot_auc"),
                     F.max(F.when(F.col(split_col) == train_split, F.col("auc"))).alias("train_auc"))
    checks = auc_gate(pivot.select(F.col("oot_auc").alias("auc")), config.min_auc)
    if train_split:
        checks = checks.unionByName(auc_gap_gate(pivot, config.max_train_oot_gap))
    oot = with_gate_groups(scored.where(F.col(split_col) == eval_split))
    checks = checks.unionByName(fairness_gate(oot, threshold, config.fairness_configs, score, label))
    checks = checks.unionByName(forbidden_feature_checks(scored.sparkSession, feature_cols,
                                                         config.forbidden_feature_names))
    return checks


def report_summary(checks: DataFrame) -> DataFrame:
    """passed / n_checks / n_errors / n_warnings over a check table."""
    failed = ~F.col("passed")
    return checks.agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(failed & (F.col("severity") == "error")).alias("n_errors"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("n_warnings")).withColumn(
        "passed", F.col("n_errors") == 0)


def report_json(checks: DataFrame) -> DataFrame:
    """Checks rendered as JSON text (one line per check), ordered by check_seq."""
    return checks.select("check_seq", F.to_json(F.struct(*[c for c in checks.columns])).alias("json"))


def assert_passed(checks: DataFrame) -> None:
    """Raise ValidationError listing every failed error-severity check (one small job)."""
    errs = checks.where(~F.col("passed") & (F.col("severity") == "error")).orderBy("check_seq").collect()
    if errs:
        lines = [f"  [ERROR] {r['name']}: {r['message']}" for r in errs]
        raise ValidationError(f"Validation failed with {len(errs)} error(s):\n" + "\n".join(lines))
