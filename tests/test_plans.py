"""Plan properties: no single-partition exchange over row-level data; pruning reaches the scan."""
import re

import pytest

import __spark_entry__ as E
from conftest import SF

QUERIES = ["validate_data_report", "psi_feature", "roc_auc", "evaluate_scores", "fairness_audit",
           "prior_history", "activity_30d", "profile_describe", "rate_by_quantile_band", "calibration_table"]
ALLOWED_BELOW = re.compile(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(key[s]?=\[")


def physical_lines(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("key", QUERIES)
def test_single_partition_only_above_aggregates(spark, key):
    lines = physical_lines(spark, E.queries()[key](spark, SF))
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and "ReusedExchange" not in line:
            child = lines[i + 1]
            # a global aggregate's partial rows, or a bucket/offset table aggregated per key
            assert ALLOWED_BELOW.search(child), f"{key}: SinglePartition over {child.strip()[:120]}"


def test_split_filter_prunes_partitions_and_columns(spark):
    from riskframe.plans.catalog_scores import oot
    df = oot(spark, SF).groupBy().count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "(split#" in plan
    assert "ReadSchema: struct<>" in plan


def test_rewritten_dataset_is_read_again(spark):
    from riskframe.plans.catalog import ep
    from riskframe.session import scratch_path
    sf = scratch_path(spark, "dataset")
    for t in ("lineitem", "orders", "customer", "nation"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{sf}/{t}.parquet")
    n = ep(spark, sf).count()
    assert ep(spark, sf).count() == n > 1000
    spark.read.parquet(f"{SF}/orders.parquet").limit(1000).write.mode("overwrite").parquet(f"{sf}/orders.parquet")
    assert ep(spark, sf).count() == 1000
