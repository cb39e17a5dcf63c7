"""Serving fallbacks, policy tiers, decisions and linear reason codes."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.operators import model, scoring


def test_decision_and_limit_tier(spark):
    df = spark.createDataFrame([(0.05, 1000.0), (0.12, 1000.0), (0.2, 1000.0), (None, 1000.0)],
                               "score double, lim double")
    r = df.select(scoring.decision(F.col("score"), 0.17).alias("d"),
                  scoring.limit_tier(F.col("score"), 0.17, F.col("lim")).alias("t")).collect()
    assert [x.d for x in r[:3]] == ["APPROVE", "APPROVE", "DECLINE"]
    assert [(x.t.tier, x.t.granted_limit) for x in r[:3]] == [("APPROVE", 1000.0), ("REDUCED", 500.0),
                                                              ("DECLINE", 0.0)]


def test_linear_reason_codes_order_and_direction(spark):
    df = spark.createDataFrame([(1.0, 10.0, 0.0)], "a double, b double, c double")
    contribs = scoring.linear_contributions({"a": 2.0, "b": -0.5, "c": 1.0}, {"a": 0.0, "b": 0.0, "c": 0.0})
    rc = df.select(scoring.top_reasons(contribs, ["a", "b", "c"], 3).alias("rc")).first().rc
    assert [(x.feature, x.shap_value, x.direction) for x in rc] == [
        ("b", -5.0, "decreases risk"), ("a", 2.0, "increases risk"), ("c", 0.0, "decreases risk")]


def test_score_batch_fallbacks(spark):
    rng = np.random.default_rng(0)
    cols = C.RAW_FEATURE_COLUMNS
    rows = []
    for i in range(300):
        vals = [int(rng.integers(0, 5)) if c in C.INT_FEATURES else float(rng.uniform(0.1, 1)) for c in cols]
        vals[cols.index("crb_flagged")] = int(i % 2)
        rows.append(tuple(vals) + (int(i % 3 == 0),))
    schema = ", ".join(f"{c} {'int' if c in C.INT_FEATURES else 'double'}" for c in cols) + ", defaulted_30d int"
    raw = spark.createDataFrame(rows, schema)
    from riskframe.operators.features import derived_rates
    m = model.train_scorecard(derived_rates(raw))
    s = model.score_batch(m, None, raw, None).collect()
    assert all(r.score == r.raw_score and r.threshold_used == C.CONFIGURED_THRESHOLD for r in s)
    assert all(r.decision == ("DECLINE" if r.score >= 0.3 else "APPROVE") for r in s)
