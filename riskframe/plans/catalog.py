"""Registered queries over the driver tables (episode view) with their DuckDB oracles.

Every query reads the full tables through `sources.testview.episodes`; none
samples or caps rows except where the cap is the feature (top-k, sampling).
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import drift, features, quality
from ..sources import io
from ..sources.testview import episodes, raw_episodes, with_episodes
from . import oracle_sql as O
from ..session import scratch_path, table_files
from .registry import normalize, register

EP_COLS = (["loan_id", "cust_id", "draw_date", "county", "channel", "product_code"]
           + C.RAW_FEATURE_COLUMNS + ["defaulted_30d", "cleared_24h", "split", "score"])
RAW = C.RAW_FEATURE_COLUMNS
FEATS = C.FEATURE_COLUMNS


_EP_TABLES: dict[tuple, tuple[str, str]] = {}


def ep(spark: SparkSession, sf: str, materialized: bool = True) -> DataFrame:
    """Episode table over the driver tables.

    Built once per dataset and written as a Parquet table partitioned by split
    in the shared checkpoint folder; every query then reads that table, so the
    expensive part (lineitem aggregation, joins, history windows) runs once and
    reads keep column pruning and split-partition pruning. A dataset whose files
    changed under the same path is built again.
    """
    if not materialized:
        return episodes(spark, sf)
    return spark.read.parquet(_tables(spark, sf)[0])


def raw_ep(spark: SparkSession, sf: str) -> DataFrame:
    """The written raw-episode table (outcomes, no history counters) behind `ep`."""
    return spark.read.parquet(_tables(spark, sf)[1])


def _tables(spark: SparkSession, sf: str) -> tuple[str, str]:
    sources = tuple(table_files(spark, f"{sf}/{t}.parquet") for t in ("lineitem", "orders", "customer", "nation"))
    key = (spark.sparkContext.applicationId, os.path.abspath(sf), sources)
    paths = _EP_TABLES.get(key)
    if paths is None:
        path = scratch_path(spark, "episodes")
        raw_path = scratch_path(spark, "raw-episodes")
        raw_episodes(spark, sf).write.parquet(raw_path)
        episodes(spark, sf, base=spark.read.parquet(raw_path)).write.partitionBy("split").parquet(path)
        paths = _EP_TABLES[key] = (path, raw_path)
    return paths


def feats(spark: SparkSession, sf: str, split: str | None = None, keys=("loan_id",)) -> DataFrame:
    e = ep(spark, sf)
    if split:
        e = e.where(F.col("split") == split)
    return features.build_features(e, validate=False, keys=keys)


FEAT_CTE = ("feat AS (SELECT loan_id, split, " + ", ".join(RAW) +
            ", CAST(prior_cleared_within_24h_count AS DOUBLE) / CAST(prior_overdraw_count + 1 AS DOUBLE) "
            "AS prior_cleared_rate, CAST(prior_rolled_past_30d_count AS DOUBLE) / "
            "CAST(prior_overdraw_count + 1 AS DOUBLE) AS prior_roll_rate, "
            "CAST(defaulted_30d AS INTEGER) AS defaulted_30d FROM ep)")


def sql_round(cols_types: list[tuple[str, str]]) -> str:
    out = []
    for c, t in cols_types:
        if t == "d":
            out.append(f"RND({c}, 6) AS {c}")
        elif t == "date":
            out.append(f"strftime({c}, '%Y-%m-%d') AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


DOUBLE_FEATS = {c for c in FEATS if c not in C.INT_FEATURES}


def feat_select(prefix: str = "") -> str:
    return sql_round([(prefix + c, "d" if c in DOUBLE_FEATS else "i") for c in FEATS]).replace(
        f"AS {prefix}", "AS ")


# ---------------------------------------------------------------- scans / features
@register("scan_episodes", with_episodes(
    "SELECT " + sql_round([("loan_id", "i"), ("cust_id", "i"), ("draw_date", "date"), ("county", "s"),
                           ("channel", "s"), ("product_code", "s")]
                          + [(c, "d" if c in DOUBLE_FEATS else "i") for c in RAW]
                          + [("defaulted_30d", "i"), ("cleared_24h", "i"), ("split", "s"), ("score", "d")])
    + " FROM ep"))
def q_scan_episodes(spark, sf):
    return normalize(ep(spark, sf).select(*EP_COLS))


@register("build_features", with_episodes(
    f"SELECT loan_id, {feat_select()}, defaulted_30d FROM feat", FEAT_CTE))
def q_build_features(spark, sf):
    return normalize(features.build_features(ep(spark, sf), validate=True))


@register("derived_rates", with_episodes(
    "SELECT loan_id, prior_overdraw_count, prior_cleared_within_24h_count, prior_rolled_past_30d_count, "
    "RND(prior_cleared_rate, 6) AS prior_cleared_rate, RND(prior_roll_rate, 6) AS prior_roll_rate FROM feat",
    FEAT_CTE))
def q_derived_rates(spark, sf):
    d = features.derived_rates(ep(spark, sf))
    return normalize(d.select("loan_id", "prior_overdraw_count", "prior_cleared_within_24h_count",
                              "prior_rolled_past_30d_count", "prior_cleared_rate", "prior_roll_rate"))


@register("episode_metadata", with_episodes(
    "SELECT loan_id, cust_id, strftime(draw_date, '%Y-%m-%d') AS draw_date FROM ep"))
def q_episode_metadata(spark, sf):
    return normalize(features.episode_metadata(ep(spark, sf)))


_raw_cte, _raw_rows = O.validate_raw_sql("ep")


@register("validate_raw", with_episodes(_raw_rows, _raw_cte))
def q_validate_raw(spark, sf):
    return features.validate_raw_checks(ep(spark, sf))


# ---------------------------------------------------------------- quality checks
FEAT_DF_COLS = ["loan_id"] + FEATS + ["defaulted_30d"]


def _checks_sql(builder) -> str:
    agg = O.Agg()
    rows = builder(agg)
    cte, body = O.checks_sql("feat", agg, rows)
    return with_episodes(body, FEAT_CTE + ",\n" + cte)


@register("quality_schema_checks", _checks_sql(lambda a: O.schema_rows(a, FEAT_DF_COLS)))
def q_quality_schema(spark, sf):
    return quality.schema_checks(feats(spark, sf))


@register("quality_range", _checks_sql(
    lambda a: [r for r in O.schema_rows(a, FEAT_DF_COLS) if "'schema.range." in r]))
def q_quality_range(spark, sf):
    return quality.range_checks(feats(spark, sf))


@register("quality_allowed_values", _checks_sql(
    lambda a: [r for r in O.schema_rows(a, FEAT_DF_COLS) if "'schema.allowed_values." in r]))
def q_quality_allowed(spark, sf):
    return quality.allowed_value_checks(feats(spark, sf))


@register("quality_missing", _checks_sql(lambda a: O.missing_rows(a, FEAT_DF_COLS)))
def q_quality_missing(spark, sf):
    return quality.missing_checks(feats(spark, sf))


@register("leakage_correlation", _checks_sql(lambda a: O.leakage_rows(a, RAW)))
def q_leakage(spark, sf):
    return quality.leakage_checks(feats(spark, sf))


@register("target_rate_gate", _checks_sql(lambda a: O.target_rows(a)))
def q_target_rate(spark, sf):
    return quality.target_rate_check(feats(spark, sf))


@register("pit_consistency", _checks_sql(lambda a: O.pit_rows(a)))
def q_pit(spark, sf):
    return quality.pit_checks(feats(spark, sf))


# ---------------------------------------------------------------- drift
_PSI_CTES = O.psi_ctes("feat WHERE split = 'train'", "feat WHERE split = 'oot'", RAW)


@register("psi_feature", with_episodes(
    "SELECT feature, psi, n_ref, n_cur, n_bins, n_out_of_range FROM psi_t", FEAT_CTE + ",\n" + _PSI_CTES))
def q_psi(spark, sf):
    return drift.psi_table(feats(spark, sf, "train"), feats(spark, sf, "oot"), RAW)


_PSI_OPEN_CTES = O.psi_ctes("feat WHERE split = 'train'", "feat WHERE split = 'oot'", RAW, mode="open")


@register("psi_open", with_episodes(
    "SELECT feature, psi, n_ref, n_cur, n_bins, n_out_of_range FROM psi_t", FEAT_CTE + ",\n" + _PSI_OPEN_CTES))
def q_psi_open(spark, sf):
    return drift.psi_table(feats(spark, sf, "train"), feats(spark, sf, "oot"), RAW, mode="open")


@register("drift_report", with_episodes(
    f"SELECT feature, psi, CASE WHEN psi >= {C.PSI_ALERT} THEN 'ALERT' WHEN psi >= {C.PSI_WARN} THEN 'warn' "
    "ELSE 'stable' END AS status, n_ref, n_cur, n_out_of_range FROM psi_t", FEAT_CTE + ",\n" + _PSI_CTES))
def q_drift_report(spark, sf):
    return drift.drift_report(feats(spark, sf, "train"), feats(spark, sf, "oot"), RAW)


def period_psi_sql(period: str, name: str, more: str = "") -> str:
    """PSI of each period of the last split against the first one (edges and reference counts of _PSI_CTES).

    `period` is SQL over the episode row `e`, `name` its column, `more` further select items over `s`."""
    drift_cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in RAW)
    months = (
        f"mw AS (SELECT {period} AS {name}, {drift_cols} FROM ep e WHERE e.split = 'oot'),\n"
        f"ml AS (SELECT {name}, feature, value FROM (UNPIVOT mw ON {', '.join(RAW)} INTO NAME feature VALUE value)),\n"
        f"mb AS (SELECT l.{name}, l.feature, CASE WHEN l.value >= edges[1] AND l.value <= edges[len(edges)] THEN "
        "CASE WHEN l.value = edges[len(edges)] THEN len(edges) - 2 ELSE len(list_filter(edges, lambda e: e <= l.value)) - 1 "
        "END END AS bin FROM ml l JOIN pe ON l.feature = pe.feature),\n"
        f"ms AS (SELECT {name}, feature, COUNT(*) AS n_cur, COUNT(*) FILTER (WHERE bin IS NULL) AS n_oor FROM mb GROUP BY ALL),\n"
        f"mc AS (SELECT {name}, feature, bin, COUNT(*) AS n FROM mb WHERE bin IS NOT NULL GROUP BY ALL),\n"
        f"mf AS (SELECT s.{name}, s.feature, GREATEST(p.ref_n / GREATEST(t.rt, 1), 1e-6) AS rp, "
        "GREATEST(COALESCE(c.n, 0) / GREATEST(s.n_cur - s.n_oor, 1), 1e-6) AS cp FROM ms s JOIN pfull p ON p.feature = s.feature "
        f"JOIN ptot t ON t.feature = s.feature LEFT JOIN mc c ON c.{name} = s.{name} AND c.feature = s.feature AND c.bin = p.bin),\n"
        f"mp AS (SELECT {name}, feature, RND(SUM((cp - rp) * LN(cp / rp)), 4) AS psi FROM mf GROUP BY ALL)")
    return with_episodes(
        f"SELECT s.{name}, {more}s.feature, p.psi, CASE WHEN p.psi >= {C.PSI_ALERT} THEN 'ALERT' WHEN p.psi >= {C.PSI_WARN} "
        "THEN 'warn' ELSE 'stable' END AS status, CAST(e.n_ref AS BIGINT) AS n_ref, s.n_cur, s.n_oor AS n_out_of_range "
        f"FROM ms s JOIN mp p ON p.{name} = s.{name} AND p.feature = s.feature JOIN pe e ON e.feature = s.feature",
        FEAT_CTE + ",\n" + _PSI_CTES + ",\n" + months)


@register("drift_monthly", period_psi_sql("strftime(e.draw_date, '%Y-%m')", "draw_month"))
def q_drift_monthly(spark, sf):
    path = scratch_path(spark, "reference-profile")
    io.write_table(drift.reference_profile(feats(spark, sf, "train"), RAW), path)
    current = io.with_month(ep(spark, sf).where(F.col("split") == "oot").select(C.DATE_COL, *RAW))
    psi = drift.psi_from_profile(io.read_profile(spark, path), current, ["draw_month"])
    return normalize(psi.select("draw_month", "feature", "psi", "status", "n_ref", "n_cur", "n_out_of_range"))


@register("drift_checks", with_episodes(O.drift_check_rows(RAW), FEAT_CTE + ",\n" + _PSI_CTES))
def q_drift_checks(spark, sf):
    return drift.drift_checks(feats(spark, sf, "train"), feats(spark, sf, "oot"), RAW)


def _validate_data_sql() -> str:
    agg = O.Agg()
    rows = (O.schema_rows(agg, FEAT_DF_COLS) + O.missing_rows(agg, FEAT_DF_COLS)
            + O.leakage_rows(agg, RAW) + O.target_rows(agg) + O.pit_rows(agg))
    cte = f"a AS (SELECT {', '.join(agg.items)} FROM feat WHERE split = 'oot')"
    body = "\nUNION ALL\n".join(rows) + "\nUNION ALL\n" + O.drift_check_rows(RAW)
    return with_episodes(body, FEAT_CTE + ",\n" + _PSI_CTES + ",\n" + cte)


@register("validate_data_report", _validate_data_sql())
def q_validate_data(spark, sf):
    return quality.validate_data(feats(spark, sf, "oot"), reference_df=feats(spark, sf, "train"))


CATEGORY_COLS = ["crb_flagged", "prior_rolled_past_30d_count", "agent_cashin_freq_30d"]


def _category_psi_sql() -> str:
    un = lambda name, cond: (f"{name} AS (SELECT feature, value FROM (UNPIVOT (SELECT " + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" for c in CATEGORY_COLS) + f" FROM feat WHERE {cond}) ON "
        + ", ".join(CATEGORY_COLS) + " INTO NAME feature VALUE value) WHERE value IS NOT NULL)")
    return with_episodes(
        "SELECT feature, CASE WHEN MAX(rt) > 0 AND MAX(ct) > 0 THEN RND(SUM((cp - rp) * LN(cp / rp)), 4) END "
        "AS psi_category, COUNT(*) AS n_values FROM (SELECT c.feature, t.rt, t.ct, "
        "GREATEST(c.ref_n / GREATEST(t.rt, 1), 1e-6) AS rp, GREATEST(c.cur_n / GREATEST(t.ct, 1), 1e-6) AS cp "
        "FROM cc c JOIN (SELECT feature, SUM(ref_n) AS rt, SUM(cur_n) AS ct FROM cc GROUP BY feature) t "
        "ON c.feature = t.feature) x GROUP BY feature",
        FEAT_CTE + ",\n" + un("rl", "split = 'train'") + ",\n" + un("cl", "split = 'oot'") + ",\n"
        "cc AS (SELECT feature, value, COUNT(*) FILTER (WHERE side = 0) AS ref_n, COUNT(*) FILTER (WHERE side = 1) "
        "AS cur_n FROM (SELECT *, 0 AS side FROM rl UNION ALL SELECT *, 1 FROM cl) u GROUP BY feature, value)")


@register("psi_category", _category_psi_sql())
def q_psi_category(spark, sf):
    return drift.category_psi(feats(spark, sf, "train"), feats(spark, sf, "oot"), CATEGORY_COLS)


@register("quality_missing_columns", _checks_sql(
    lambda a: [r for r in O.schema_rows(a, FEAT_DF_COLS) if "'schema.missing_columns'" in r]))
def q_quality_missing_columns(spark, sf):
    return quality.schema_checks(feats(spark, sf)).where(F.col("name") == "schema.missing_columns")
