"""Two-level windows against single-window brute force; streaming equals batch."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import drift, history
from riskframe.streaming import stream as S
from riskframe.session import scratch_path


def test_prior_history_two_level_equals_plain_window(spark):
    rng = np.random.default_rng(2)
    n = 3000
    # one hot key owning a third of the rows
    keys = np.where(rng.uniform(size=n) < 0.33, 0, rng.integers(1, 50, n))
    days = rng.integers(0, 400, n)
    rows = [(i, int(k), int(d), int(rng.integers(0, 2))) for i, (k, d) in enumerate(zip(keys, days))]
    df = spark.createDataFrame(rows, "id long, k long, d int, y int")
    plain = history.prior_history(df, "k", ["d", "id"], {"s": "y"}, "cnt")
    two = history.prior_history(df, "k", ["d", "id"], {"s": "y"}, "cnt", bucket=(F.col("d") / 30).cast("int"))
    a = {r.id: (r.cnt, r.s) for r in plain.collect()}
    b = {r.id: (r.cnt, r.s) for r in two.collect()}
    assert a == b


def test_episode_gaps_two_level(spark):
    rows = [(1, 1, "2020-01-01"), (2, 1, "2020-01-20"), (3, 1, "2020-03-05"), (4, 2, "2020-02-01"),
            (5, 1, "2020-03-05")]
    df = spark.createDataFrame(rows, "loan_id long, cust_id long, d string").withColumn("draw_date", F.to_date("d"))
    r = history.episode_gap_check(df, 30, bucket=F.trunc("draw_date", "month")).first()
    assert (r.n_with_prior, r.n_violations, r.min_gap_days, r.n_same_day) == (3, 2, 0, 1)


def test_activity_window_brute_force(spark):
    rng = np.random.default_rng(4)
    n = 400
    ts = np.sort(rng.integers(0, 40 * 86400, n))
    users = np.where(rng.uniform(size=n) < 0.4, 7, rng.integers(0, 5, n))
    types = rng.choice(["a", "b"], n)
    rows = [(i, int(u), int(t), str(ty), float(i % 7)) for i, (u, t, ty) in enumerate(zip(users, ts, types))]
    df = spark.createDataFrame(rows, "event_id long, user_id long, sec long, event_type string, value double") \
        .withColumn("ts", F.timestamp_seconds("sec"))
    out = {r.event_id: r for r in history.activity_window(df, 30 * 86400, types=["a", "b"]).collect()}
    W = 30 * 86400
    for i, (u, t) in enumerate(zip(users, ts)):
        m = (users == u) & (ts < t) & (ts >= t - W)
        assert out[i].n_events_30d == m.sum()
        assert out[i].n_a_30d == (m & (types == "a")).sum()
        assert out[i].value_sum_30d == pytest.approx(sum(float(j % 7) for j in np.nonzero(m)[0]))


def test_activity_window_cancels_exactly_and_counts_any_type(spark):
    day = 86400
    rows = [(1, 1, 0, "refund", 1e17), (2, 1, day, "refund", 1.7), (3, 1, 2 * day, None, float("nan")),
            (4, 1, 2 * day, "x", None), (5, 1, 31 * day, "y", 3.0), (6, 1, 32 * day, "refund", 0.5),
            (7, 1, 90 * day, "x", 2.0), (8, 2, 5 * day, "x", -1.3)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, sec long, event_type string, value double") \
        .withColumn("ts", F.timestamp_seconds("sec"))
    got = {r.event_id: (r.n_events_30d, r.distinct_types_30d, r.value_sum_30d)
           for r in history.activity_window(df).collect()}
    assert got == {1: (0, 0, 0.0), 2: (1, 1, 1e17), 3: (2, 1, 1e17 + 1.7), 4: (2, 1, 1e17 + 1.7),
                   5: (3, 2, 1.7), 6: (3, 2, 3.0), 7: (0, 0, 0.0), 8: (0, 0, 0.0)}


def test_activity_window_many_types_brute_force(spark):
    rng = np.random.default_rng(8)
    n, w = 600, 10 * 86400
    ts = rng.integers(0, 30, n) * 43200          # many ties, and events exactly at a window's edge
    users = np.where(rng.uniform(size=n) < 0.4, 1, rng.integers(0, 4, n))
    types = [f"t{x}" for x in rng.integers(0, 300, n)]
    df = spark.createDataFrame([(i, int(u), int(t), y, 0.1) for i, (u, t, y) in enumerate(zip(users, ts, types))],
                               "event_id long, user_id long, sec long, event_type string, value double") \
        .withColumn("ts", F.timestamp_seconds("sec"))
    got = {r.event_id: r.distinct_types_30d for r in history.activity_window(df, w).collect()}
    for i, (u, t) in enumerate(zip(users, ts)):
        assert got[i] == len({types[j] for j in np.nonzero((users == u) & (ts < t) & (ts >= t - w))[0]})


def test_null_keys_and_times_stay(spark):
    import duckdb
    rng = np.random.default_rng(11)
    n = 400
    keys = [None if x == 0 else int(x) for x in rng.integers(0, 5, n)]
    days = [None if x < 9 else int(x) for x in rng.integers(0, 90, n)]
    rows = [(i, k, d, int(rng.integers(0, 2))) for i, (k, d) in enumerate(zip(keys, days))]
    df = spark.createDataFrame(rows, "loan_id long, cust_id long, d int, y int").withColumn("draw_date", F.date_add(F.lit("2020-01-01"), F.col("d")))
    ep = df.toPandas()      # noqa: F841 (read by DuckDB)
    ep["draw_date"] = ep["draw_date"].astype("datetime64[s]")
    ep["cust_id"] = ep["cust_id"].astype("Int64")
    w = "OVER (PARTITION BY cust_id ORDER BY CAST(draw_date AS DATE), loan_id"
    prev = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    want = duckdb.sql(f"SELECT loan_id, cust_id, COUNT(*) {w} {prev}, COALESCE(SUM(y) {w} {prev}, 0), CAST(LAG(draw_date) {w}) AS DATE) FROM ep").fetchall()
    for bucket in (None, F.col("draw_date"), F.trunc("draw_date", "month"), history.RANGES):
        h = history.prior_history(df, "cust_id", ["draw_date", "loan_id"], {"s": "y"}, "cnt", bucket=bucket)
        g = history.episode_gaps(df, bucket=bucket).select("loan_id", "prev_date")
        got = h.join(g, "loan_id").select("loan_id", "cust_id", "cnt", "s", "prev_date").collect()
        assert sorted(map(tuple, got)) == sorted(want)
    gaps = [(r.draw_date - p[4]).days for r, p in zip(df.orderBy("loan_id").collect(), sorted(want)) if r.draw_date and p[4]]
    r = history.episode_gap_check(df, 2, bucket=F.col("draw_date")).first()
    assert tuple(r) == (len(gaps), sum(x < 2 for x in gaps), min(gaps), gaps.count(0))


def test_one_key_and_one_day_over_all_rows(spark):
    n = 4000
    df = spark.range(n).selectExpr("id AS loan_id", "1L AS cust_id", "date'2020-01-01' AS draw_date", "cast(id % 3 = 0 AS int) AS y")
    ranged = history.in_ranges(df, ["cust_id"], ["draw_date", "loan_id"])
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < n / 2
    assert len([1 for r in ranged.groupBy("_range").agg(F.min("loan_id").alias("a"), F.max("loan_id").alias("b")).collect()
                for i in range(4) if r.a <= i * n // 4 + n // 8 <= r.b]) == 4      # ranges follow the order
    h = history.prior_history(df, "cust_id", ["draw_date", "loan_id"], {"s": "y"}, "cnt", bucket=history.RANGES)
    assert h.columns == [*df.columns, "cnt", "s"]
    assert {(r.loan_id, r.cnt, r.s) for r in h.collect()} == {(i, i, (i + 2) // 3) for i in range(n)}
    assert tuple(history.episode_gap_check(df, 30, bucket=history.RANGES).first()) == (n - 1, n - 1, 0, n - 1)


def test_gaps_after_rows_without_a_date(spark):
    df = spark.range(400).selectExpr("id AS loan_id", "1L AS cust_id", "CASE WHEN id < 150 THEN date'2020-01-01' END AS draw_date")
    got = {r.loan_id: r.prev_date is not None for r in history.episode_gaps(df, bucket=history.RANGES).collect()}
    assert got == {i: 0 < i <= 150 for i in range(400)}


def test_one_user_and_one_day_of_activity(spark):
    n, w = 3000, 1000
    df = spark.range(n).selectExpr("id AS event_id", "1L AS user_id", "timestamp_seconds(id) AS ts",
                                   "concat('t', id % 50) AS event_type", "0.25D AS value")
    for r in history.activity_window(df, w).collect():
        k = min(r.event_id, w)
        assert (r.n_events_30d, r.distinct_types_30d, r.value_sum_30d) == (k, min(k, 50), k * 0.25)


def test_activity_window_values_no_sum_can_hold(spark):
    inf, day = float("inf"), 86400
    vals = {1: [1e-13, 1e-13, 0.0], 2: [inf, 1.0, -inf, 0.0], 3: [1e24, -1e24, 1.0, 2.0], 4: [9e21] * 200 + [0.0],
            5: [-inf, 1e30, 0.0], 6: [1234.1, 1e-20, 0.0]}
    rows = [(u * 1000 + i, u, i, v) for u, vs in vals.items() for i, v in enumerate(vs)] + [(3999, 3, 40 * day, 5.0)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, sec long, value double") \
        .withColumn("ts", F.timestamp_seconds("sec")).withColumn("event_type", F.lit("x"))
    got = {r.event_id: r.value_sum_30d for r in history.activity_window(df).collect()}
    assert got[1002] == 2e-13 and got[4200] == 1.8e24 and got[6002] == 1234.1
    assert got[2001] == inf and got[2002] == inf and np.isnan(got[2003])
    assert got[3000] == 0 and got[3001] is None and got[3003] is None and got[3999] == 0
    assert got[5001] == -inf and got[5002] == -inf


def test_activity_window_keeps_events_without_user_or_time(spark):
    rows = [(1, 1, 0, "a", 1.0), (2, None, 5, "a", 2.0), (3, None, 9, "a", 2.0), (4, 1, None, "a", 4.0),
            (5, None, None, None, None), (6, 1, 10, "b", 8.0)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, sec long, event_type string, value double") \
        .withColumn("ts", F.timestamp_seconds("sec"))
    got = {tuple(r) for r in history.activity_window(df, types=["a"]).collect()}
    none = (0, 0, 0, 0.0)
    assert got == {(1, 1, *none), (2, None, *none), (3, None, *none), (4, 1, *none), (5, None, *none), (6, 1, 1, 1, 1, 1.0)}


def test_psi_stream_equals_batch(spark):
    rng = np.random.default_rng(9)
    n = 600
    secs = np.sort(rng.integers(0, 6 * 86400, n))
    vals = rng.normal(np.where(secs > 3 * 86400, 2.0, 0.0), 1.0)
    ev = spark.createDataFrame([(int(s), float(v)) for s, v in zip(secs, vals)], "sec long, value double") \
        .withColumn("ts", F.timestamp_seconds("sec"))
    path = scratch_path(spark, "test-events")
    ev.repartitionByRange(4, "ts").write.parquet(path)
    ref = ev.where(F.col("sec") < 2 * 86400).select("value")
    edges, props = S.reference_bins(ref, "value")
    out, ckpt = S.scratch(spark, "test-psi")
    S.psi_stream(S.file_stream(spark, path, 1), edges, props, out, ckpt)
    streamed = {r.window_start: r.psi for r in S.psi_from_counts(spark.read.parquet(f"{out}/counts"), props).collect()}
    assert len(streamed) == 6
    for start, psi in streamed.items():
        day = ev.where(F.date_trunc("day", "ts") == F.lit(start)).select("value")
        assert psi == drift.psi_table(ref, day, ["value"]).first().psi
    late = [v for k, v in sorted(streamed.items())][4:]
    assert all(v > 0.25 for v in late)
