"""Parallel pool-adjacent-violators against one plain pass and against MLlib's fit."""
import numpy as np
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from riskframe.operators import isotonic
from riskframe.session import scratch_path


def plain(scores, labels):
    """Blocks (lo, hi, pos, n) of one pass over all rows."""
    out = []
    for x in sorted(set(scores)):
        ys = [y for s, y in zip(scores, labels) if s == x]
        out.append([x, x, sum(ys), len(ys)])
        while len(out) > 1 and out[-2][2] * out[-1][3] >= out[-1][2] * out[-2][3]:
            b = out.pop()
            out[-1] = [out[-1][0], b[1], out[-1][2] + b[2], out[-1][3] + b[3]]
    return [tuple(b) for b in out]


def frame(spark, scores, labels):
    return spark.createDataFrame([(i, float(s), int(y)) for i, (s, y) in enumerate(zip(scores, labels))],
                                 "id long, raw double, label int")


@pytest.mark.parametrize("shape", ["noise", "rising", "falling", "equal", "steps"])
def test_blocks_are_those_of_one_pass(spark, shape):
    rng = np.random.default_rng(11)
    s = np.round(rng.random(1500), 2 if shape == "steps" else 4)
    rate = {"noise": s ** 2, "rising": s, "falling": 1 - s, "equal": s * 0 + 0.3, "steps": (s > 0.5) * 0.8 + 0.1}[shape]
    y = (rng.random(len(s)) < rate).astype(int)
    want = plain(s.tolist(), y.tolist())
    for ranges in (1, 7, 40):
        got = isotonic.fit_isotonic(frame(spark, s, y), "raw", ranges=ranges, size=3)
        assert [tuple(r)[:4] for r in got.blocks().orderBy("x_lo").collect()] == want
        assert len(got.starts) == -(-len(want) // 3)


def test_scores_equal_mllib_in_and_between_blocks(spark):
    rng = np.random.default_rng(5)
    s = np.round(rng.random(800), 3)
    y = (rng.random(800) < s).astype(int)
    df = frame(spark, s, y)
    ml = IsotonicRegression(featuresCol="raw", labelCol="label").fit(df.withColumn("label", F.col("label").cast("double")))
    new = spark.createDataFrame([(float(x),) for x in np.linspace(-0.2, 1.2, 401)], "raw double")
    want = {r.raw: r.prediction for r in ml.transform(new).collect()}
    for size in (2, isotonic.TILE):
        cal = isotonic.fit_isotonic(df, "raw", size=size)
        got = {r.raw: r.score for r in cal.transform(new, "raw", "score").collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
        path = scratch_path(spark, "test-isotonic")
        cal.save(path)
        back = isotonic.IsotonicTable.load(spark, path)
        assert {r.raw: r.score for r in back.transform(new, "raw", "score").collect()} == pytest.approx(got, abs=1e-15)


def test_nulls_no_rows_and_clashing_names(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, None), (None, 1), (float("nan"), 1), (0.9, 1)], "raw double, label int")
    cal = isotonic.fit_isotonic(df, "raw")
    assert [tuple(r) for r in cal.blocks().collect()] == [(0.1, 0.1, 0, 1, 0.0), (0.9, 0.9, 1, 1, 1.0)]
    odd = spark.createDataFrame([(0.5, "t", 7), (None, "u", 8), (float("nan"), "v", 9), (-1.0, "w", 1)], "raw double, tile string, lo int")
    got = {r.tile: (r.lo, r.score) for r in cal.transform(odd, "raw", "score").collect()}
    assert got == {"t": (7, 0.5), "u": (8, None), "v": (9, None), "w": (1, 0.0)}
    none = isotonic.fit_isotonic(df.where("raw > 5 AND label = 7"), "raw")
    assert none.starts == [] and [r.score for r in none.transform(odd, "raw", "score").collect()] == [None] * 4
