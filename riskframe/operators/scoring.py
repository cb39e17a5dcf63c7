"""Row-level scoring expressions (P6, P7, P9, P16, M5 linear, S10).

All are plain column expressions: they run inside whole-stage codegen (or the
array higher-order functions for reason codes) and compose with any batch
or streaming plan.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.prims import clip


def decision(score: Column, threshold: Column | float) -> Column:
    """DECLINE when score >= threshold, else APPROVE."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(score >= t, "DECLINE").otherwise("APPROVE")


def limit_tier(score: Column, threshold: Column | float, limit: Column,
               reduced_low: float = C.TIER_REDUCED_LOW, share: float = C.TIER_REDUCED_LIMIT_SHARE) -> Column:
    """Policy tier described by the reference (P16): DECLINE at/above the threshold,
    REDUCED (share of the limit) for scores in [reduced_low, threshold), else APPROVE."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    tier = F.when(score >= t, "DECLINE").when(score >= reduced_low, "REDUCED").otherwise("APPROVE")
    granted = (F.when(tier == "DECLINE", F.lit(0.0)).when(tier == "REDUCED", limit * share)
               .otherwise(limit.cast("double")))
    return F.struct(tier.alias("tier"), granted.alias("granted_limit"))


def proxy_groups(df: DataFrame) -> DataFrame:
    """Fairness proxy flags (P6): thin_file = tenure < 12 (null -> 0), crb = crb_flagged == 1 (null -> 0)."""
    return df.withColumns({
        "thin_file": F.coalesce(F.col("tenure_months") < C.THIN_FILE_TENURE, F.lit(False)).cast("int"),
        "crb_group": F.coalesce(F.col("crb_flagged") == 1, F.lit(False)).cast("int"),
    })


def clip_columns(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """pandas-style clip per column (P9); nulls stay null."""
    return df.withColumns({c: clip(F.col(c).cast("double"), lo, hi) for c, (lo, hi) in bounds.items()})


def linear_contributions(weights: Mapping[str, float], means: Mapping[str, float] | Column | None = None) -> Column:
    """Array of (feature, contribution) with contribution = w_j * (x_j - mean_j).

    For a linear (logit) model with independent features this is the exact
    SHAP value of each feature relative to the mean input.
    """
    items = []
    for f, w in weights.items():
        m = F.lit(0.0) if means is None else (means[f] if isinstance(means, Mapping) else means[f])
        m = m if isinstance(m, Column) else F.lit(float(m))
        items.append(F.struct(F.lit(f).alias("feature"),
                              (F.lit(float(w)) * (F.col(f).cast("double") - m)).alias("shap_value")))
    return F.array(*items)


def top_reasons(contribs: Column, order: Sequence[str], top_n: int = C.REASON_TOP_N) -> Column:
    """Top-n contributions by |value| (T1), ties broken by feature order; each with a
    direction label. Sorting happens inside the row (array_sort with a comparator)."""
    rank = F.create_map(*[x for i, f in enumerate(order) for x in (F.lit(f), F.lit(i))])
    tagged = F.transform(contribs, lambda s: F.struct(s["feature"].alias("feature"),
                                                      s["shap_value"].alias("shap_value"),
                                                      rank[s["feature"]].alias("_o")))

    def cmp(a, b):
        aa, ab = F.abs(a["shap_value"]), F.abs(b["shap_value"])
        return F.when(aa > ab, -1).when(aa < ab, 1).when(a["_o"] < b["_o"], -1).when(a["_o"] > b["_o"], 1).otherwise(0)
    top = F.slice(F.array_sort(tagged, cmp), 1, top_n)
    return F.transform(top, lambda s: F.struct(
        s["feature"].alias("feature"), s["shap_value"].alias("shap_value"),
        F.when(s["shap_value"] > 0, "increases risk").otherwise("decreases risk").alias("direction")))


def audit_record(df: DataFrame, feature_cols: Sequence[str], threshold: Column | float,
                 model_version: str, score: str = "score") -> DataFrame:
    """Decision audit rows (S10): decision, score, threshold, version and all inputs as JSON."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.select(
        *[c for c in (C.KEY_COL,) if c in df.columns],
        decision(F.col(score), t).alias("decision"), F.col(score).alias("pd"), t.alias("threshold"),
        F.lit(model_version).alias("model_version"),
        F.to_json(F.struct(*[F.col(c) for c in feature_cols])).alias("features_json"),
        F.current_timestamp().alias("logged_at"))
