"""Driver contract and oracle agreement on the smallest test tables."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
ORACLE_SAMPLE = ["build_features", "validate_raw", "validate_data_report", "roc_auc", "average_precision",
                 "min_cost_threshold", "fairness_audit", "fairness_gate", "calibration_table", "prior_history",
                 "episode_gap_check", "activity_30d", "monthly_trend", "rate_by_quantile_band", "reason_codes",
                 "correlation_matrix", "split_summary", "borrower_overlap", "evaluate_scores"]


def canon(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return canon(v.item())
    return v


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(canon(x) for x in r) for r in df[cols].itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "loan_id" in df.columns and "defaulted_30d" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 80


@pytest.mark.parametrize("key", ORACLE_SAMPLE)
def test_oracle_agreement(spark, con, key):
    s = E.queries()[key](spark, SF).toPandas()
    d = con.execute(E.oracle_sql()[key]).df()
    assert rows(s) == rows(d)
