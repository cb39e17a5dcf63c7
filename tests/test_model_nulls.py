"""Models are fitted and applied with missing features and labels."""
import numpy as np
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.operators import explain, model
from riskframe.session import scratch_path

COLS = ["a", "b", "empty"]


def frame(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b = float(rng.normal()), float(rng.normal())
        y = int(a + 0.5 * rng.normal() > 0)
        if i % 10 == 0:
            a = None if i % 20 else float("nan")
        rows.append((i, a, b, None, None if i % 50 == 7 else y))
    return spark.createDataFrame(rows, "loan_id long, a double, b double, empty double, y int")


def test_gbt_with_missing_values(spark):
    tr, va = frame(spark), frame(spark, seed=4)
    fitted = model.train_gbt(tr, va, C.GBTParams(max_iter=3, max_depth=2), COLS, "y")
    smallest = tr.where(~F.isnan("a")).agg(F.min("a")).first()[0]
    assert fitted.fills["a"] == smallest - 1 and fitted.fills["empty"] == 0.0
    scored = model.raw_scores(fitted.model, va)
    assert scored.columns == [*va.columns, "raw_score"]
    assert scored.where(F.col("raw_score").between(0, 1)).count() == va.count()
    codes = explain.gbt_reason_codes(va, fitted.model.stages[-1], COLS, "loan_id", 2, fitted.fills).collect()
    assert len(codes) == va.count() and all(r.reason1_shap_value == r.reason1_shap_value for r in codes)


def test_scorecard_with_missing_values_survives_saving(spark):
    df = frame(spark)
    m = model.train_scorecard(df, COLS, "y")
    path = scratch_path(spark, "null-model")
    model.save_model(m, None, path)
    back, cal = model.load_model(path)
    assert cal is None
    a = [r.raw_score for r in model.raw_scores(m, df).orderBy("loan_id").collect()]
    b = [r.raw_score for r in model.raw_scores(back, df).orderBy("loan_id").collect()]
    assert a == b and len(a) == 400 and all(0 < x < 1 for x in a)


def test_registered_model_queries_use_the_package_parameters_and_all_episodes(spark, monkeypatch):
    import dataclasses
    from riskframe import config as C
    from riskframe.plans import catalog_model as M
    asked, fit = [], M.model.train_gbt

    def small(train, val, params=C.GBTParams(), *a, **k):
        asked.append(params)
        return fit(train, val, dataclasses.replace(params, max_iter=2, max_depth=2), *a, **k)

    monkeypatch.setattr(M.model, "train_gbt", small)
    sf = "/root/testdata/sf0.001"
    rows = M.q_reason_codes_gbt(spark, sf).select("loan_id").collect()
    assert sorted(rows) == sorted(M.ep(spark, sf).select("loan_id").collect())
    assert asked == [C.GBTParams()] and M.TRAIN_CFG.gbt == C.GBTParams()
