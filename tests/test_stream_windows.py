"""Windows of many features in update mode, late rows, evicted state and the replay horizon."""
import datetime

import pytest
from pyspark.sql import functions as F

from riskframe.operators import drift
from riskframe.session import scratch_path
from riskframe.streaming import stream as S

T0 = datetime.datetime(2024, 1, 1)


def slices(spark, parts, schema):
    """One file per slice, delivered one after the other."""
    path = scratch_path(spark, "test-slices")
    for rows in parts:
        spark.createDataFrame([(T0 + datetime.timedelta(hours=h), *v) for h, *v in rows], "ts timestamp, " + schema) \
             .coalesce(1).write.mode("append").parquet(path)
    return path


def test_windows_equal_batch_and_late_rows_are_dropped(spark):
    nan = float("nan")
    days = [[(24 * d + h, float(h * (d + 1) % 17), None if h == 3 else nan if h == 4 else float(h % (d + 2))) for h in range(24)]
            for d in range(6)]
    late = [(1, 5.0, 5.0), (2, 1.0, 1.0)]                       # of day 0, delivered after day 3
    near = [(24 * 3 + 5, 2.0, 2.0)]                             # of day 3, within the watermark
    path = slices(spark, [days[0], days[1], days[2], days[3], late + near + days[4], days[5]], "a double, b double")
    ref = spark.createDataFrame([(float(i % 17), float(i % 4)) for i in range(200)], "a double, b double")
    profile = drift.reference_profile(ref, ["a", "b", "absent"])
    out, ckpt = S.scratch(spark, "test-windows")
    S.psi_features_stream(S.file_stream(spark, path, 1), profile, out, ckpt, watermark="6 hours")
    got = {(r.window_start, r.feature): (r.psi, r.n_cur) for r in S.psi_of_windows(spark, out, profile).collect()}
    days[3] += near
    assert len(got) == 12
    for d, rows in enumerate(days):
        day = spark.createDataFrame([(x, None if y != y else y) for _, x, y in rows], "a double, b double")
        want = {r.feature: (r.psi, r.n_cur) for r in drift.psi_table(ref, day, ["a", "b"]).collect()}
        for f in "ab":
            assert got[T0 + datetime.timedelta(days=d), f] == want[f]
    # a batch writes what it changed, not every window seen so far
    last = spark.read.parquet(out).where(F.col("batch_id") == F.lit(5)).select("w.start").distinct().collect()
    assert [r.start for r in last] == [T0 + datetime.timedelta(days=5)]


def test_replays_within_the_horizon_go_and_state_is_evicted(spark):
    day = [[(24 * d + h, 100 * d + h) for h in range(10)] for d in range(8)]
    replay = [day[0], day[1] + [(3, 3), (26, 102)], *day[2:]]
    out, ckpt = S.scratch(spark, "test-dedup")
    q = S.dedup_stream(S.file_stream(spark, slices(spark, replay, "id long"), 1), ["id"], out, ckpt, watermark="2 days")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == sorted(i for d in day for _, i in d)
    sizes = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert max(sizes) <= 50 and sizes[-1] <= 50                  # of 80 keys, those of two horizons and the newest day
    assert any("rocksdb" in k.lower() for p in q.recentProgress for s in p.stateOperators for k in (s.customMetrics or {}))


def test_clashing_names_and_no_rows(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(50)], "a double")
    profile = drift.reference_profile(ref, ["a"])
    path = scratch_path(spark, "test-empty")
    spark.createDataFrame([], "ts timestamp, a double, w string, bin int, feature string").write.parquet(path)
    out, ckpt = S.scratch(spark, "test-windows")
    spark.createDataFrame([(T0, 1.0, "x", 3, "y"), (None, 2.0, "x", 3, "y")], "ts timestamp, a double, w string, bin int, feature string") \
         .write.mode("append").parquet(path)
    S.psi_features_stream(S.file_stream(spark, path, 9), profile, out, ckpt)
    r = S.psi_of_windows(spark, out, profile).collect()
    assert len(r) == 1 and (r[0].feature, r[0].n_cur) == ("a", 1) and r[0].psi == pytest.approx(drift.psi_table(
        ref, spark.createDataFrame([(1.0,)], "a double"), ["a"]).first().psi)
