"""PSI golden values (numpy re-computation of the definition) and report semantics."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import drift


def _psi(spark, ref, cur):
    r = spark.createDataFrame([(float(v),) for v in ref], "x double")
    c = spark.createDataFrame([(float(v),) for v in cur], "x double")
    return drift.psi_table(r, c, ["x"]).first()


def test_psi_shifted_normal(spark):
    rng = np.random.default_rng(1)
    ref, cur = rng.normal(0, 1, 1000), rng.normal(3, 1, 1000)
    assert _psi(spark, ref, cur).psi == pytest.approx(8.6387, abs=1e-4)


def test_psi_stable(spark):
    rng = np.random.default_rng(1)
    ref, cur = rng.normal(0, 1, 1000), rng.normal(0, 1, 500)
    assert _psi(spark, ref, cur).psi == pytest.approx(0.0226, abs=1e-4)


def test_psi_all_out_of_range(spark):
    ref = np.linspace(0, 10, 1000)
    cur = np.linspace(45, 55, 500)
    row = _psi(spark, ref, cur)
    assert row.psi == pytest.approx(11.5128, abs=1e-4)
    assert row.n_out_of_range == 500


def test_psi_constant_and_binary_flag(spark):
    assert _psi(spark, [1.0] * 50, [1.0] * 40).psi == 0.0
    # with < 10 % ones every inner decile is 0: quantile PSI is blind to the flag
    ref = [1.0] * 5 + [0.0] * 95
    cur = [1.0] * 99 + [0.0] * 1
    assert _psi(spark, ref, cur).psi == 0.0
    r = spark.createDataFrame([(v,) for v in ref], "x double")
    c = spark.createDataFrame([(v,) for v in cur], "x double")
    assert drift.category_psi(r, c, ["x"]).first().psi_category > 1.0


def test_psi_empty_side_is_null_and_status_stable(spark):
    r = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    c = spark.createDataFrame([(None,)], "x double")
    rep = drift.drift_report(r, c, ["x"]).first()
    assert rep.psi is None and rep.status == "stable"
    assert drift.drift_checks(r, c, ["x"]).count() == 0


def test_drift_checks_severity(spark):
    rng = np.random.default_rng(0)
    ref = spark.createDataFrame([(float(a), float(b)) for a, b in zip(rng.uniform(0, 10, 500), rng.normal(0, 1, 500))],
                                "a double, b double")
    cur = spark.createDataFrame([(float(a), float(b)) for a, b in zip(rng.uniform(45, 55, 500), rng.normal(0, 1, 500))],
                                "a double, b double")
    rows = {r.name: r for r in drift.drift_checks(ref, cur, ["a", "b"]).collect()}
    assert rows["drift.psi.a"].severity == "error" and not rows["drift.psi.a"].passed
    assert rows["drift.psi.b"].severity == "info" and rows["drift.psi.b"].passed


def test_psi_open_mode_counts_out_of_range(spark):
    ref = np.linspace(0, 10, 1000)
    cur = np.concatenate([np.linspace(0, 10, 500), np.linspace(20, 30, 500)])
    r = spark.createDataFrame([(float(v),) for v in ref], "x double")
    c = spark.createDataFrame([(float(v),) for v in cur], "x double")
    closed = drift.psi_table(r, c, ["x"]).first()
    opened = drift.psi_table(r, c, ["x"], mode="open").first()
    assert closed.n_out_of_range == 500 and closed.psi < 0.01
    assert opened.n_out_of_range == 0 and opened.psi > 0.25


def test_saved_profile_stands_in_for_the_reference(spark):
    from riskframe.session import scratch_path
    from riskframe.sources import io
    rng = np.random.default_rng(5)
    ref = spark.createDataFrame([(float(a), float(b), 1.0) for a, b in zip(rng.normal(0, 1, 700), rng.integers(0, 3, 700))],
                                "a double, b double, gone double")
    rows = [(d, float(rng.normal(s, 1)), float(rng.integers(0, 3)), None) for d, s in (("d1", 0), ("d2", 2), (None, 1)) for _ in range(200)]
    cur = spark.createDataFrame(rows + [("d3", None, 1.0, None)], "day string, a double, b double, other double")
    path = scratch_path(spark, "test-profile")
    io.write_table(drift.reference_profile(ref, ["a", "b", "gone", "none"]), path)
    profile = io.read_profile(spark, path)
    assert profile.count() == 3
    got = drift.psi_from_profile(profile, cur, ["day"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") + plan.count("ExternalRDD") <= 1      # the current rows alone
    found = {(r.day, r.feature): (r.psi, r.n_ref, r.n_cur, r.n_bins, r.n_out_of_range) for r in got.collect()}
    assert len(found) == 4 * 2
    for day in ("d1", "d2", "d3", None):
        part = cur.where(F.col("day").eqNullSafe(F.lit(day)))
        for r in drift.psi_table(ref, part, ["a", "b"]).collect():
            assert found[day, r.feature] == (r.psi, r.n_ref, r.n_cur, r.n_bins, r.n_out_of_range)
    assert found["d3", "a"][0] is None and found["d2", "a"][0] > 0.25
    assert drift.psi_from_profile(profile, cur.limit(0), ["day"]).count() == 0
