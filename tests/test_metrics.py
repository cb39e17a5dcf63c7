"""Ranking metrics, cost threshold and fairness against brute-force definitions."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.operators import cost, fairness, gates, metrics


def scored(spark, y, p, extra=None):
    rows = [(int(a), float(b)) + (tuple(int(v) for v in e) if extra is not None else ()) for a, b, *e in
            zip(y, p, *(extra or []))]
    schema = "label int, score double" + ("".join(f", g{i} int" for i in range(len(extra))) if extra else "")
    return spark.createDataFrame(rows, schema)


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])


def brute_ap(y, p):
    ts = np.unique(p)[::-1]
    P, ap, prev = y.sum(), 0.0, 0.0
    for t in ts:
        f = p >= t
        tp = (y[f] == 1).sum()
        r = tp / P
        ap += (r - prev) * tp / f.sum()
        prev = r
    return ap


def test_auc_ties_and_golden(spark):
    rng = np.random.default_rng(3)
    p = rng.uniform(size=200)
    y = np.array([0, 1] * 100)
    assert metrics.roc_auc(scored(spark, y, p)).first().auc == pytest.approx(0.4906, abs=1e-4)
    p2 = np.round(rng.uniform(size=300), 1)
    y2 = (rng.uniform(size=300) < p2).astype(int)
    assert metrics.roc_auc(scored(spark, y2, p2)).first().auc == pytest.approx(brute_auc(y2, p2), abs=1e-12)
    perfect = metrics.roc_auc(scored(spark, np.sort(y), np.linspace(0, 1, 200))).first().auc
    assert perfect == pytest.approx(1.0)


def test_single_class_auc_is_null_and_gate_fails(spark):
    a = metrics.roc_auc(scored(spark, np.zeros(10), np.linspace(0, 1, 10)))
    assert a.first().auc is None
    assert not gates.auc_gate(a).first().passed


def test_average_precision_step_sum(spark):
    rng = np.random.default_rng(8)
    p = np.round(rng.uniform(size=400), 2)
    y = (rng.uniform(size=400) < p).astype(int)
    got = metrics.average_precision(scored(spark, y, p)).first().average_precision
    assert got == pytest.approx(brute_ap(y, p), abs=1e-12)


def test_threshold_metrics_and_equal_threshold_is_positive(spark):
    y = np.array([1, 0, 1, 0])
    p = np.array([0.3, 0.3, 0.1, 0.9])
    r = metrics.threshold_metrics(scored(spark, y, p), [0.3]).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (1, 2, 1, 0)
    assert r.flag_rate == 0.75


def test_min_cost_threshold_brute_force(spark):
    rng = np.random.default_rng(11)
    p = np.round(rng.uniform(size=500), 2)
    y = (rng.uniform(size=500) < p * 0.5).astype(int)
    best = None
    for t in np.unique(p):
        f = p >= t
        tp = (y[f] == 1).sum()
        fp = (y[f] == 0).sum() if tp > 0 else (y == 0).sum()
        c = 0.2 * fp + 1.0 * (y.sum() - tp)
        if best is None or c < best[0]:
            best = (c, t)
    r = cost.min_cost_threshold(scored(spark, y, p)).first()
    assert r.threshold == pytest.approx(best[1]) and r.expected_cost == pytest.approx(best[0])
    assert cost.bayes_optimal_threshold() == pytest.approx(1 / 6)


def test_fairness_gate_unfair_and_fair(spark):
    rng = np.random.default_rng(0)
    n = 200
    g = np.array([1] * 100 + [0] * 100)
    p = np.where(g == 1, rng.uniform(0.55, 0.9, n), rng.uniform(0.05, 0.3, n))
    y = rng.integers(0, 2, n)
    df = scored(spark, y, p, [g]).withColumnRenamed("g0", "grp")
    rows = {r.name: r for r in fairness.fairness_gate(df, 0.5, [C.FairnessConfig("grp")]).collect()}
    assert rows["fairness.di.grp"].value == 0.0 and not rows["fairness.di.grp"].passed
    p2 = np.clip(rng.normal(0.15, 0.05, n), 0, 1)
    g2 = np.array([1, 0] * 100)
    df2 = scored(spark, y, p2, [g2]).withColumnRenamed("g0", "grp")
    rows2 = {r.name: r for r in fairness.fairness_gate(df2, 0.5, [C.FairnessConfig("grp")]).collect()}
    assert rows2["fairness.di.grp"].passed
    # a missing side yields no rows
    one = df2.where(F.col("grp") == 1)
    assert fairness.fairness_gate(one, 0.5, [C.FairnessConfig("grp")]).count() == 0


def test_fisher_matches_known_value(spark):
    # 2x2 [[3, 1], [1, 3]]: two-sided Fisher p = 0.4857
    z = spark.createDataFrame([("p", 3, 4, 1, 4)], "proxy string, x_a long, n_a long, x_b long, n_b long")
    assert fairness.fisher_pvalues(z, ["proxy"]).first().p_fisher == pytest.approx(0.485714, abs=1e-5)


def test_forbidden_features(spark):
    bad = gates.forbidden_feature_checks(spark, C.FEATURE_COLUMNS + ["defaulted_30d"]).collect()
    assert [r.name for r in bad] == ["leakage.forbidden_feature.defaulted_30d"]
    ok = gates.forbidden_feature_checks(spark, C.FEATURE_COLUMNS).collect()
    assert ok[0].passed


def test_calibration_table_bins(spark):
    p = np.repeat(np.linspace(0.05, 0.95, 10), 10)
    y = (np.arange(100) % 3 == 0).astype(int)
    t = metrics.calibration_table(scored(spark, y, p)).orderBy("bin").collect()
    assert sum(r.n for r in t) == 100 and len(t) == 10


def test_ranking_summary_matches_individual_metrics(spark):
    rng = np.random.default_rng(21)
    p = np.round(rng.uniform(size=600), 2)
    y = (rng.uniform(size=600) < p).astype(int)
    df = scored(spark, y, p)
    s = metrics.ranking_summary(df).first()
    assert s.auc == pytest.approx(brute_auc(y, p), abs=1e-12)
    assert s.average_precision == pytest.approx(brute_ap(y, p), abs=1e-12)
    assert s.brier == pytest.approx(float(np.mean((p - y) ** 2)), abs=1e-12)
    assert s.base_rate == pytest.approx(y.mean())


def test_nan_scores_are_no_scores(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.2, 0), (float("nan"), 0), (None, 1)], "score double, label int")
    assert metrics.roc_auc(df).collect()[0].auc == 1.0


def test_totals_of_an_ungrouped_table_stay_long(spark):
    """The classes' product passes 2^31 while each total is below it; every ungrouped ranking metric takes it whole."""
    n = 100_000
    s = spark.range(n).select(F.expr("CAST(id % 2 AS INT)").alias("label"), (F.col("id") / n).alias("score"))
    a = metrics.roc_auc(s).first()
    expected = 0.5 + 1 / n              # each positive lies above its own negative as well
    assert a.auc == pytest.approx(expected, abs=1e-12) and (a.n_pos, a.n_neg) == (n // 2, n // 2)
    assert metrics.ranking_summary(s).first().auc == pytest.approx(expected, abs=1e-12)
    assert metrics.prefix_sum(metrics.score_hist(s), [], "score", ["pos"]).schema["pos_total"].dataType.simpleString() == "bigint"
