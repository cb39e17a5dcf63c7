"""Split properties (no shared borrower, fractions, stratification) and stream sinks."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.operators import splits
from riskframe.session import scratch_path
from riskframe.streaming import stream as S


def test_group_split_keeps_borrowers_together(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(c)) for i, c in enumerate(rng.integers(0, 2000, 20000))]
    df = splits.group_split(spark.createDataFrame(rows, "loan_id long, cust_id long"))
    per = df.groupBy("cust_id").agg(F.countDistinct("split").alias("k"))
    assert per.where("k > 1").count() == 0
    frac = {r.split: r["count"] for r in df.select("cust_id", "split").distinct().groupBy("split").count().collect()}
    tot = sum(frac.values())
    assert frac["train"] / tot == pytest.approx(0.70, abs=0.03)
    assert frac["val"] / tot == pytest.approx(0.15, abs=0.03)


def test_stratified_split_preserves_rate(spark):
    n = 5000
    rows = [(i, 1 if i % 10 == 0 else 0) for i in range(n)]
    df = splits.stratified_split(spark.createDataFrame(rows, "loan_id long, defaulted_30d int"))
    st = {r.split: (r.n, r.rate) for r in splits.split_summary(df).collect()}
    assert sum(v[0] for v in st.values()) == n
    for part, (cnt, rate) in st.items():
        assert rate == pytest.approx(0.1, abs=0.002)
    assert st["train"][0] == pytest.approx(0.7 * n, abs=2)


def test_temporal_split_boundaries(spark):
    df = spark.createDataFrame([("2023-06-30",), ("2023-07-01",), ("2023-12-31",), ("2024-01-01",), (None,)],
                               "d string").withColumn("draw_date", F.to_date("d"))
    got = [r.split for r in splits.temporal_split(df).orderBy(F.col("d").asc_nulls_last()).collect()]
    assert got == ["train", "val", "val", "oot", None]


def test_quarantine_and_dedup_streams(spark):
    rows = [(i, float(i % 5), 0.5 if i % 7 else 1.5) for i in range(200)]
    df = spark.createDataFrame(rows, "loan_id long, draw_amount_kes double, utilization_rate double")
    src_path = scratch_path(spark, "t-req")
    df.repartition(4).write.parquet(src_path)
    out, ckpt = S.scratch(spark, "t-q")
    rules = [C.RequestRule("draw_amount_kes", "gt", 0.0), C.RequestRule("utilization_rate", "le", 1.0)]
    S.quarantine_stream(S.file_stream(spark, src_path, 1), out, ckpt, rules)
    valid = spark.read.parquet(f"{out}/valid").count()
    bad = spark.read.parquet(f"{out}/quarantine").count()
    expect_bad = sum(1 for i in range(200) if i % 5 == 0 or i % 7 == 0)
    assert (valid, bad) == (200 - expect_bad, expect_bad)
    ev = spark.createDataFrame([(i, 1_704_067_200 + i * 60) for i in range(100)], "event_id long, sec long") \
        .withColumn("ts", F.timestamp_seconds("sec"))
    ev_path = scratch_path(spark, "t-ev")
    ev.write.parquet(ev_path)
    ev.write.mode("append").parquet(ev_path)
    out2, ckpt2 = S.scratch(spark, "t-dd")
    S.dedup_stream(S.file_stream(spark, ev_path, 1), ["event_id"], out2, ckpt2)
    assert spark.read.parquet(out2).count() == 100


def test_stratified_split_keeps_rows_without_a_label(spark):
    rows = [(i, None if i % 50 == 0 else int(i % 5 == 0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "loan_id long, defaulted_30d int")
    out = splits.stratified_split(df)
    assert out.columns == ["loan_id", "defaulted_30d", "split"]
    n = {r.defaulted_30d: r["count"] for r in out.groupBy("defaulted_30d").count().collect()}
    assert n == {None: 20, 0: 800, 1: 180}
