"""p-values as column expressions against the standard library and exact binomials."""
import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from riskframe.operators import fairness


def exact_fisher(xa, na, xb, nb):
    k = xa + xb
    w = {x: math.comb(na, x) * math.comb(nb, k - x) for x in range(max(0, k - nb), min(k, na) + 1)}
    return float(Fraction(sum(v for v in w.values() if v <= w[xa]), sum(w.values())))


def fisher(spark, tables):
    z = spark.createDataFrame([(str(i), "fpr", *t) for i, t in enumerate(tables)],
                              "proxy string, rate string, x_a long, n_a long, x_b long, n_b long")
    got = {int(r.proxy): r.p_fisher for r in fairness.fisher_pvalues(z, ["proxy", "rate"]).collect()}
    return [got.get(i) for i in range(len(tables))]


def test_erfc(spark):
    xs = [0.0, 1e-9, 0.01, 0.5, 1.0, 1.9999, 2.0, 2.5, 4.0, 7.0, 15.0, 26.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").withColumn("y", F.expr(fairness.erfc_sql("x"))).collect()
    for r in got:
        assert r.y == pytest.approx(math.erfc(r.x), rel=1e-11, abs=1e-300)


def test_fisher_equals_exact_sums(spark):
    tables = [(3, 4, 1, 4), (0, 5, 5, 5), (5, 5, 5, 5), (0, 3, 0, 9), (1, 1, 0, 1), (10, 40, 30, 50), (7, 1000, 30, 900),
              (400, 1000, 500, 1000), (2, 17, 300, 4000), (15, 16, 16, 33)]
    for t, p in zip(tables, fisher(spark, tables)):
        assert p == pytest.approx(exact_fisher(*t), rel=1e-9), t


def test_fisher_large_counts_and_empty_sides(spark):
    far, big, empty = fisher(spark, [(10, 100_000, 90_000, 100_000), (500_000_300, 10 ** 9, 500_000_000, 10 ** 9), (0, 0, 3, 9)])
    assert far == 0 and empty is None
    # 10^9 a side: the normal approximation with continuity correction is good to six digits
    z = (300 - 1) / math.sqrt(2 * 10 ** 9 * 0.25)
    assert big == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-5)


def test_table_with_flags(spark):
    z = spark.createDataFrame([("a", "fpr", 3, 40, 20, 50, -3.5), ("b", "fnr", 0, 0, 2, 5, None)],
                              "proxy string, rate string, x_a long, n_a long, x_b long, n_b long, z double")
    a, b = sorted(fairness.ztest_pvalues(z).collect(), key=lambda r: r.proxy)
    assert a.p_z == pytest.approx(math.erfc(3.5 / math.sqrt(2))) and a.passes_bonferroni is True
    assert a.p_fisher == pytest.approx(exact_fisher(3, 40, 20, 50)) and b.p_z is None and b.p_fisher is None and b.passes_bonferroni is None
