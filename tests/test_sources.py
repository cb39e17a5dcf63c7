"""CSV rows that don't parse are kept apart with their text; lines per episode."""
import pytest
from pyspark.sql import types as T

from riskframe.session import scratch_path
from riskframe.sources import io, testview

SCHEMA = T.StructType([T.StructField("loan_id", T.LongType()), T.StructField("draw_date", T.DateType()),
                       T.StructField("x", T.DoubleType()), T.StructField("name", T.StringType())])
LINES = ["1,2024-01-01,0.5,a", "2,2024-01-02,n/a,b", "3,soon,1.0,c", "4,2024-01-04,,", "five,2024-01-05,1,e",
         "6,2024-01-06", "7,2024-01-07,NaN,g", "8,2024-01-08,1.5,\"h,h\"", "9,2024-01-09,1,i,more"]


def _csv(spark, header, lines):
    path = scratch_path(spark, "test-csv")
    spark.createDataFrame([(x,) for x in [header, *lines]], "value string").coalesce(1).write.text(path)
    return path


def test_bad_rows_are_kept_apart(spark):
    path = _csv(spark, "loan_id,draw_date,x,name", LINES)
    good, bad = io.read_episodes_checked(spark, path, SCHEMA)
    assert good.schema == SCHEMA
    assert {(r.loan_id, str(r.draw_date), r.x, r.name) for r in good.collect()} == {
        (1, "2024-01-01", 0.5, "a"), (4, "2024-01-04", None, None), (7, "2024-01-07", None, "g"), (8, "2024-01-08", 1.5, "h,h")}
    assert sorted(r.record for r in bad.collect()) == sorted(LINES[i] for i in (1, 2, 4, 5, 8))
    assert bad.where("source_file like '%test-csv%'").count() == 5
    # a projection does not hide faults of the other columns
    assert good.select("loan_id").count() == 4 and bad.count() == 5


def test_quarantine_counts_and_sinks(spark):
    path, out = _csv(spark, "loan_id,draw_date,x,name", LINES * 2), scratch_path(spark, "test-quarantine")
    row = io.quarantine_csv(spark, path, out, SCHEMA).first()
    assert (row.n_good, row.n_bad, row.bad_share) == (8, 10, 10 / 18)
    assert spark.read.parquet(f"{out}/bad").count() == 10
    empty = io.quarantine_csv(spark, _csv(spark, "loan_id,draw_date,x,name", []), scratch_path(spark, "test-quarantine"), SCHEMA)
    assert tuple(empty.first()) == (0, 0, None)


def test_other_header_raises(spark):
    with pytest.raises(Exception, match="(?i)header"):
        io.read_episodes_checked(spark, _csv(spark, "loan_id,x,draw_date,name", LINES[:1]), SCHEMA)


def test_episode_lines_are_hashed_per_order(spark, tmp_path):
    """No sort-based fallback of collect_set (it spilled more than in proportion); nulls and repeats count as before."""
    import datetime
    day, t = datetime.date(1998, 1, 1), datetime.datetime(1998, 1, 1)
    line = "l_orderkey long, l_suppkey long, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date"
    rows = [(1, 7, 10.0), (1, 7, 20.0), (1, 8, 60.0), (2, None, 5.0), (None, 9, 1.0), (None, 9, 1.0)]
    tables = {
        "lineitem": ([(o, s, p, 0.05, 0.02, "R", "F", day) for o, s, p in rows], line),
        "orders": ([(k, 1, 1000.0, t, "1-URGENT") for k in (1, 2, 3)],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "customer": ([(1, 0, 5.0, "AUTO")], "c_custkey long, c_nationkey long, c_acctbal double, c_mktsegment string"),
        "nation": ([(0, "KENYA")], "n_nationkey long, n_name string")}
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    e = testview.raw_episodes(spark, str(tmp_path))
    assert "ObjectHashAggregate" not in e._jdf.queryExecution().executedPlan().toString()
    got = {r.loan_id: (r.monthly_txn_count, r.avg_txn_value_kes, r.unique_counterparties_30d) for r in e.collect()}
    assert got == {1: (3, 30.0, 2), 2: (1, 5.0, 0), 3: (0, 0.0, 0)}
