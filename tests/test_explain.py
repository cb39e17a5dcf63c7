"""TreeSHAP on an MLlib GBT: additivity against the model's probability, brute force on a tiny tree."""
import itertools
import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.operators import explain


def brute_shap(x, tree, m):
    """Exact Shapley values of the path-dependent tree expectation by enumerating subsets."""
    def expect(node, s):
        f = tree["feature"][node]
        if f < 0:
            return tree["value"][node]
        l, r = tree["left"][node], tree["right"][node]
        if f in s:
            return expect(l if x[f] <= tree["threshold"][node] else r, s)
        c = tree["cover"]
        return (c[l] * expect(l, s) + c[r] * expect(r, s)) / c[node]
    phi = np.zeros(m)
    for i in range(m):
        others = [j for j in range(m) if j != i]
        for k in range(m):
            for s in itertools.combinations(others, k):
                wgt = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                phi[i] += wgt * (expect(0, set(s) | {i}) - expect(0, set(s)))
    return phi


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(0)
    n = 800
    x = rng.normal(size=(n, 4))
    y = ((x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + rng.normal(0, 0.5, n)) > 0).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "id long, a double, b double, c double, d double, label double")
    va = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features")
    m = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(va.transform(df))
    return df, va, m


def test_tree_shap_matches_brute_force(fitted):
    df, va, m = fitted
    trees, _ = explain.extract_trees(m)
    xs = np.array([[r.a, r.b, r.c, r.d] for r in df.limit(5).collect()])
    got = explain.tree_shap(xs, trees[0], 4)
    for i in range(len(xs)):
        assert got[i] == pytest.approx(brute_shap(xs[i], trees[0], 4), abs=1e-9)


def test_additivity_against_probability(fitted):
    df, va, m = fitted
    rc = explain.gbt_reason_codes(df, m, ["a", "b", "c", "d"], key="id", top_n=4)
    prob = m.transform(va.transform(df)).select("id", vector_to_array("probability")[1].alias("p"))
    j = rc.join(prob, "id").collect()
    for r in j[:50]:
        total = r.base_value + sum(getattr(r, f"reason{k}_shap_value") for k in range(1, 5))
        assert 1 / (1 + math.exp(-total)) == pytest.approx(r.p, abs=1e-9)


def test_prefix_auc_matches_model_auc(spark, fitted):
    from riskframe.operators import metrics, model
    df, va, m = fitted
    vec = va.transform(df).select("features", "label")
    aucs = model.prefix_auc(m, vec)
    assert len(aucs) == 5
    full = m.transform(vec).select(vector_to_array("probability")[1].alias("score"), F.col("label").cast("int").alias("label"))
    assert aucs[-1] == pytest.approx(metrics.roc_auc(full).first().auc, abs=1e-12)


def random_tree(rng, depth, m):
    rows = []

    def grow(d, cover):
        j = len(rows)
        rows.append([-1, 0.0, -1, -1, rng.normal(), cover])
        if d and rng.random() < 0.9:
            part = cover * rng.uniform(0.05, 0.95)
            rows[j][:2] = int(rng.integers(m)), rng.normal()
            rows[j][2] = grow(d - 1, part)
            rows[j][3] = grow(d - 1, cover - part)
        return j

    grow(depth, 1000.0)
    return {k: np.array(v) for k, v in zip(("feature", "threshold", "left", "right", "value", "cover"), zip(*rows))}


@pytest.mark.parametrize("limit", [8, 2])
def test_rows_look_up_contributions_of_their_pattern(monkeypatch, limit):
    """Any number of rows runs the algorithm over the leaves' patterns only; longer paths recurse over rows."""
    monkeypatch.setattr(explain, "TABLE_FEATURES", limit)
    rng = np.random.default_rng(5)
    trees = [random_tree(rng, d, 5) for d in (0, 1, 2, 4, 6, 6)]
    x = rng.normal(size=(1000, 5))
    x[::9, 2] = np.nan
    lengths, extend = set(), explain._extend
    monkeypatch.setattr(explain, "_extend", lambda path, pz, po, pi: lengths.add(len(po)) or extend(path, pz, po, pi))
    got = explain.ensemble_shap(x, trees, [0.5] * len(trees), 5)
    assert (max(lengths) <= 2 ** limit) == (limit == 8)
    for i in (0, 1, 9, 500):
        want = 2 * sum(0.5 * brute_shap(x[i], t, 5) for t in trees)
        assert got[i] == pytest.approx(want, abs=1e-10)
    rows = 2 * sum(0.5 * explain.tree_shap(x, t, 5) for t in trees)
    assert np.abs(got - rows).max() < 1e-12
