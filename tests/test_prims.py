"""K3/K5/K8 primitives against numpy brute force on small fixtures."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions.prims import bin_index, exact_quantiles, prefix_sum, round_dp, score_hist


def test_bin_index_left_and_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (None,)], "x double")
    e = F.array(*[F.lit(v) for v in (0.0, 1.0, 2.0)])
    got = df.select(bin_index(F.col("x"), e, 3).alias("l"), bin_index(F.col("x"), e, 3, True).alias("r")).collect()
    assert [r.l for r in got] == [1, 2, 2, 3, None]
    assert [r.r for r in got] == [0, 1, 2, 2, None]


@pytest.mark.parametrize("path", ["broadcast", "joined"])
@pytest.mark.parametrize("n,distinct", [(1, 1), (7, 3), (500, 500), (2000, 37)])
def test_exact_quantiles_match_numpy(spark, n, distinct, path, monkeypatch):
    import riskframe.functions.prims as P
    if path == "joined":
        monkeypatch.setattr(P, "BROADCAST_ENTRIES", 0)
    rng = np.random.default_rng(n)
    vals = rng.integers(0, distinct, n).astype(float) * 1.37 + rng.normal(0, 1, n).round(0)
    probs = [0.0, 0.1, 0.25, 0.3, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(float(v), "g") for v in vals], "v double, g string")
    got = {r.prob: r.quantile for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("small,accuracy,bracket", [(0, 200, 4_000_000), (100, 200, 4_000_000), (0, 50, 60)])
@pytest.mark.parametrize("kind", ["spread", "heavy ties", "one value", "skewed", "sorted"])
def test_exact_quantiles_by_brackets(spark, monkeypatch, kind, small, accuracy, bracket):
    """Groups beyond SMALL_GROUP go through brackets; brackets beyond BRACKET_ROWS through a finer sketch."""
    import riskframe.functions.prims as P
    for name, v in (("SMALL_GROUP", small), ("SKETCH_ACCURACY", accuracy), ("BRACKET_ROWS", bracket)):
        monkeypatch.setattr(P, name, v)
    rng = np.random.default_rng(11)
    n = 6000
    vals = {"spread": rng.normal(size=n), "heavy ties": rng.integers(0, 4, n) * 1.0, "one value": np.full(n, 2.5),
            "skewed": np.exp(rng.normal(0, 4, n)).round(1), "sorted": np.arange(n) / 7}[kind]
    probs = [i * 0.1 for i in range(10)] + [1.0]
    rows = [(float(v), "ab"[i % 3 == 0]) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "v double, g string").repartition(5, "v")
    for cols in (["g"], []):
        got = exact_quantiles(df, cols, "v", probs).collect()
        assert len(got) == len(probs) * (2 if cols else 1)
        for r in got:
            own = [v for v, g in rows if not cols or g == r.g]
            assert r.quantile == pytest.approx(float(np.quantile(own, r.prob)), rel=1e-12, abs=1e-12) and r.n == len(own)


def test_exact_quantiles_ignore_nulls_and_empty_groups(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "a"), (3.0, "a"), (None, "b")], "v double, g string")
    got = {(r.g, r.prob): r.quantile for r in exact_quantiles(df, ["g"], "v", [0.5]).collect()}
    assert got == {("a", 0.5): 2.0}


def test_prefix_sum_matches_cumsum(spark):
    rng = np.random.default_rng(5)
    scores = rng.permutation(3000).astype(float)
    w = rng.integers(0, 5, 3000)
    df = spark.createDataFrame([(float(s), int(x), "k") for s, x in zip(scores, w)], "s double, w long, k string")
    out = prefix_sum(df, ["k"], "s", ["w"], n_buckets=16).collect()
    small = prefix_sum(df, ["k"], "s", ["w"]).collect()
    order = np.argsort(scores)
    before = dict(zip(scores[order], np.concatenate([[0], np.cumsum(w[order])[:-1]])))
    assert all(r.w_before == before[r.s] for r in out)
    assert all(r.w_before == before[r.s] for r in small)
    assert {r.w_total for r in out} == {int(w.sum())}
    desc = prefix_sum(df, ["k"], "s", ["w"], descending=True, n_buckets=16).collect()
    after = {s: int(w[scores > s].sum()) for s in scores}
    assert all(r.w_before == after[r.s] for r in desc)


def test_round_dp_is_half_up_on_binary_value(spark):
    df = spark.createDataFrame([(0.1953125,), (-1.5,), (2.675,), (None,)], "x double")
    got = [r.y for r in df.select(round_dp("x", 6).alias("y")).collect()]
    assert got[0] == 0.195313 and got[3] is None


def test_score_hist_counts(spark):
    df = spark.createDataFrame([(0.2, 1), (0.2, 0), (0.5, 1), (None, 1)], "score double, label int")
    got = sorted((r.score, r.pos, r.n) for r in score_hist(df).collect())
    assert got == [(0.2, 1, 2), (0.5, 1, 1)]


@pytest.mark.parametrize("n_edges", [5, 64, 65, 300, 4095])
def test_bin_index_large_edge_arrays(spark, n_edges):
    from riskframe.functions.prims import with_bin_index
    rng = np.random.default_rng(n_edges)
    edges = np.sort(rng.integers(0, 500, n_edges)).astype(float)
    xs = np.concatenate([rng.uniform(-10, 510, 300), edges[:20]])
    df = spark.createDataFrame([(float(x),) for x in xs], "x double").withColumn(
        "e", F.array(*[F.lit(float(v)) for v in edges]))
    for rc in (False, True):
        got = [r.b for r in with_bin_index(df, "x", "e", n_edges, "b", rc).collect()]
        want = [int(np.searchsorted(edges, x, side="left" if rc else "right")) for x in xs]
        assert got == want


def test_prefix_sum_adaptive_buckets(spark, monkeypatch):
    import riskframe.functions.prims as P
    monkeypatch.setattr(P, "ROWS_PER_BUCKET", 20)
    rng = np.random.default_rng(6)
    vals = rng.permutation(5000).astype(float)
    df = spark.createDataFrame([(float(v), 1, "k") for v in vals], "s double, w long, k string")
    out = P.prefix_sum(df, ["k"], "s", ["w"]).collect()
    assert all(r.w_before == int(r.s) for r in out)


def test_clean_nan_and_csv_reader(spark, tmp_path):
    from riskframe.functions.prims import clean_nan
    from riskframe.sources import io
    df = spark.createDataFrame([(float("nan"), 1), (2.0, None)], "x double, k int")
    got = clean_nan(df).collect()
    assert got[0].x is None and got[1].x == 2.0 and got[1].k is None
    header = ",".join(f.name for f in io.EPISODE_SCHEMA.fields)
    vals = ["1", "7", "2024-01-05", "A", "B", "C"] + [
        "NaN" if f.name == "utilization_rate" else ("" if f.name == "avg_txn_value_kes" else "1")
        for f in io.EPISODE_SCHEMA.fields[6:]]
    p = tmp_path / "ep.csv"
    p.write_text(header + "\n" + ",".join(vals) + "\n")
    row = io.read_episodes(spark, str(p), fmt="csv").first()
    assert row.utilization_rate is None and row.avg_txn_value_kes is None
    assert str(row.draw_date) == "2024-01-05" and row.tenure_months == 1
