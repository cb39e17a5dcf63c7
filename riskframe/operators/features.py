"""Feature derivation and raw-input validation."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C


class DataValidationError(ValueError):
    """Raised when raw input violates a data-quality invariant."""


def require_columns(df: DataFrame, required: list[str] | None = None) -> None:
    """Required-column check on the schema only (no job); raises immediately."""
    required = required or (C.RAW_FEATURE_COLUMNS + [C.TARGET_COL])
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise DataValidationError(f"Missing required columns: {missing}")


def derived_rates(df: DataFrame) -> DataFrame:
    """prior_cleared_rate / prior_roll_rate = count / (prior_overdraw_count + 1).

    try_divide keeps a corrupt count of -1 from raising under ANSI (null instead).
    """
    denom = (F.col("prior_overdraw_count") + 1).cast("double")
    return df.withColumns({
        "prior_cleared_rate": F.try_divide(F.col("prior_cleared_within_24h_count").cast("double"), denom),
        "prior_roll_rate": F.try_divide(F.col("prior_rolled_past_30d_count").cast("double"), denom),
    })


def validate_raw_checks(df: DataFrame) -> DataFrame:
    """All raw invariants as check rows, computed in one aggregation.

    Rows: null target count; null fraction per raw feature (fails when > 1 %);
    utilization outside [0, 1]; draw amount <= 0; crb_flagged outside {0, 1}
    (null counts as outside); default rate outside the closed [0.005, 0.5].
    """
    from .quality import fmt, q, rnd, row_sql
    require_columns(df)
    t = f"`{C.TARGET_COL}`"
    aggs = [f"count_if({t} IS NULL) AS null_target"]
    aggs += [f"avg(CAST(`{c}` IS NULL AS DOUBLE)) AS nf_{i}" for i, c in enumerate(C.RAW_FEATURE_COLUMNS)]
    aggs += ["count_if(utilization_rate < 0 OR utilization_rate > 1) AS util_out",
             "count_if(draw_amount_kes <= 0) AS draw_nonpos",
             "count_if(NOT coalesce(crb_flagged IN (0, 1), false)) AS crb_bad",
             f"avg(CAST({t} AS DOUBLE)) AS default_rate"]
    row = df.agg(*[F.expr(a) for a in aggs])
    rows = [row_sql(1, q("raw.null_target"), "null_target = 0", q("error"), "null_target", "0.0D",
                    "concat(CAST(null_target AS STRING), ' rows have a null target')")]
    for i, c in enumerate(C.RAW_FEATURE_COLUMNS):
        rows.append(row_sql(10 + i, q(f"raw.null_fraction.{c}"), f"coalesce(nf_{i} <= {C.NULL_THRESHOLD!r}D, true)",
                            q("error"), rnd(f"nf_{i}", 6), f"{C.NULL_THRESHOLD!r}D",
                            f"concat({q(c + ': null fraction ')}, {fmt(rnd(f'nf_{i}', 6), 6)})"))
    ok_rate = f"coalesce(default_rate BETWEEN {C.DEFAULT_RATE_MIN!r}D AND {C.DEFAULT_RATE_MAX!r}D, false)"
    rows += [
        row_sql(40, q("raw.utilization_bounds"), "util_out = 0", q("error"), "util_out", "0.0D",
                "concat(CAST(util_out AS STRING), ' utilization_rate values out of [0, 1]')"),
        row_sql(41, q("raw.draw_positive"), "draw_nonpos = 0", q("error"), "draw_nonpos", "0.0D",
                "concat(CAST(draw_nonpos AS STRING), ' non-positive draw_amount_kes')"),
        row_sql(42, q("raw.crb_allowed"), "crb_bad = 0", q("error"), "crb_bad", "0.0D",
                "concat(CAST(crb_bad AS STRING), ' crb_flagged values outside {0, 1}')"),
        row_sql(43, q("raw.default_rate"), ok_rate, q("error"), rnd("default_rate", 6), f"{C.DEFAULT_RATE_MAX!r}D",
                f"concat('default rate ', coalesce({fmt(rnd('default_rate', 4), 4)}, 'nan'))"),
    ]
    return row.selectExpr(f"inline(array({', '.join(rows)}))")


def validate_raw(df: DataFrame) -> None:
    """Eager gate: raises DataValidationError listing every failed invariant (one job)."""
    failed = validate_raw_checks(df).where(~F.col("passed")).orderBy("check_seq").collect()
    if failed:
        raise DataValidationError("Data validation failed:\n- " + "\n- ".join(
            f"{r['name']}: {r['message']}" for r in failed))


def build_features(df: DataFrame, validate: bool = True, keys: tuple[str, ...] = (C.KEY_COL,)) -> DataFrame:
    """Validate, derive rates, project keys + 20 features + integer target.

    The key column is carried instead of relying on row position.
    """
    if validate:
        validate_raw(df)
    d = derived_rates(df)
    key_cols = [k for k in keys if k in df.columns]
    return d.select(*key_cols, *C.FEATURE_COLUMNS, F.col(C.TARGET_COL).cast("int").alias(C.TARGET_COL))


def episode_metadata(df: DataFrame) -> DataFrame:
    """Metadata projection (loan_id, cust_id[, draw_date]) kept keyed by loan_id."""
    if C.GROUP_ID_COL not in df.columns:
        return df.select(C.KEY_COL)
    cols = [C.KEY_COL, C.GROUP_ID_COL] + ([C.DATE_COL] if C.DATE_COL in df.columns else [])
    return df.select(*cols)


def feature_catalog(spark) -> DataFrame:
    """Feature schema description (column, role, ordinal) as a small DataFrame."""
    rows = ([(c, "raw_feature", i) for i, c in enumerate(C.RAW_FEATURE_COLUMNS)]
            + [(c, "derived_feature", i) for i, c in enumerate(C.DERIVED_FEATURE_COLUMNS)]
            + [(C.TARGET_COL, "target", 0)]
            + [(c, "fairness_proxy", i) for i, c in enumerate(C.FAIRNESS_PROXY_COLUMNS)])
    return spark.createDataFrame(rows, "column string, role string, ordinal int")
