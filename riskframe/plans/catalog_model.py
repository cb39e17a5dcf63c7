"""Registered queries: scoring expressions, sources/sinks, model training and serving."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions.prims import score_hist
from ..operators import cost, gates, model, quality, scoring
from ..session import scratch_path
from ..sources import io
from ..sources.testview import with_episodes
from .catalog import DOUBLE_FEATS, FEAT_CTE, RAW, ep, feat_select, feats, sql_round
from .catalog import _validate_data_sql

_VALIDATE_DATA_SQL = _validate_data_sql()
from .catalog_scores import DEP, SC, scored
from .pipeline import train_pipeline
from .registry import normalize, register

GBT_QUERY = C.GBTParams()      # the package's parameters; rounds are stopped by the validation score
TRAIN_CFG = C.TrainingConfig(gbt=GBT_QUERY)
SCORECARD = {"monthly_txn_count": -0.12, "utilization_rate": 1.5, "crb_flagged": 0.4}


# ---------------------------------------------------------------- expressions
@register("decision_rule", with_episodes(
    "SELECT loan_id, RND(score, 6) AS score, CASE WHEN score >= 0.3 THEN 'DECLINE' ELSE 'APPROVE' END AS decision "
    "FROM ep"))
def q_decision_rule(spark, sf):
    e = ep(spark, sf)
    return normalize(e.select("loan_id", "score", scoring.decision(F.col("score"), 0.3).alias("decision")))


@register("limit_tiering", with_episodes(
    "SELECT loan_id, CASE WHEN score >= t THEN 'DECLINE' WHEN score >= 0.1 THEN 'REDUCED' ELSE 'APPROVE' END AS tier, "
    "RND(CASE WHEN score >= t THEN 0.0 WHEN score >= 0.1 THEN assigned_limit_kes * 0.5 ELSE assigned_limit_kes END, 6) "
    "AS granted_limit FROM (SELECT o.*, d.threshold AS t FROM ep o CROSS JOIN dep d) x",
    SC + ",\n" + DEP))
def q_limit_tiering(spark, sf):
    e = ep(spark, sf)
    s = scored(spark, sf)
    from .catalog_scores import deployment_threshold
    d = e.crossJoin(F.broadcast(deployment_threshold(s)))
    t = scoring.limit_tier(F.col("score"), F.col("_t"), F.col("assigned_limit_kes"))
    return normalize(d.select("loan_id", t.alias("t")).select("loan_id", "t.tier", "t.granted_limit"))


@register("proxy_groups", with_episodes(
    "SELECT loan_id, CAST(COALESCE(tenure_months < 12, FALSE) AS INTEGER) AS thin_file, "
    "CAST(COALESCE(crb_flagged = 1, FALSE) AS INTEGER) AS crb_group FROM ep"))
def q_proxy_groups(spark, sf):
    return scoring.proxy_groups(ep(spark, sf)).select("loan_id", "thin_file", "crb_group")


@register("clip_ratio", with_episodes(
    "SELECT loan_id, RND(LEAST(overdraw_to_inflow_ratio, 25.0), 6) AS overdraw_to_inflow_ratio, "
    "RND(GREATEST(CAST(prior_overdraw_count AS DOUBLE), 1.0), 6) AS prior_overdraw_count, "
    "RND(LEAST(send_receive_ratio, 20.0), 6) AS send_receive_ratio FROM ep"))
def q_clip_ratio(spark, sf):
    e = ep(spark, sf).select("loan_id", "overdraw_to_inflow_ratio", "prior_overdraw_count", "send_receive_ratio")
    return normalize(scoring.clip_columns(e, {"overdraw_to_inflow_ratio": (None, 25.0),
                                              "prior_overdraw_count": (1.0, None),
                                              "send_receive_ratio": (None, 20.0)}))


def _quarantine_sql() -> str:
    tags = []
    for r in C.REQUEST_RULES:
        bad = {"ge": f"{r.name} < {r.bound}", "gt": f"{r.name} <= {r.bound}", "le": f"{r.name} > {r.bound}"}[r.op]
        tags.append(f"CASE WHEN {r.name} IS NULL OR {bad} THEN '{r.name}:{r.op}:{r.bound}' END")
    arr = f"list_filter([{', '.join(tags)}], lambda x: x IS NOT NULL)"
    return with_episodes(f"SELECT loan_id, array_to_string({arr}, ',') AS violations, len({arr}) = 0 AS valid FROM ep")


@register("request_quarantine", _quarantine_sql())
def q_request_quarantine(spark, sf):
    q = quality.quarantine(ep(spark, sf))
    return q.select("loan_id", F.array_join("violations", ",").alias("violations"), "valid")


def _reasons_sql() -> str:
    order = list(SCORECARD)
    contribs = " UNION ALL ".join(
        f"SELECT loan_id, '{f}' AS feature, {i} AS o, {w!r}::DOUBLE * (CAST({f} AS DOUBLE) - m_{i}) AS v "
        f"FROM base" for i, (f, w) in enumerate(SCORECARD.items()))
    means = ", ".join(f"AVG(CAST({f} AS DOUBLE)) AS m_{i}" for i, f in enumerate(order))
    cols = []
    for k in range(1, C.REASON_TOP_N + 1):
        cols += [f"MAX(feature) FILTER (WHERE rk = {k}) AS reason{k}_feature",
                 f"RND(MAX(v) FILTER (WHERE rk = {k}), 6) AS reason{k}_shap_value",
                 f"MAX(CASE WHEN v > 0 THEN 'increases risk' ELSE 'decreases risk' END) FILTER (WHERE rk = {k}) "
                 f"AS reason{k}_direction"]
    return with_episodes(
        "SELECT r.loan_id, ANY_VALUE(b.decision) AS decision, RND(ANY_VALUE(b.score), 6) AS pd, " + ", ".join(cols)
        + f" FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY loan_id ORDER BY ABS(v) DESC, o) AS rk FROM ({contribs}) c) r "
        "JOIN base b ON r.loan_id = b.loan_id GROUP BY r.loan_id",
        SC + ",\n" + DEP + f",\nmu AS (SELECT {means} FROM ep WHERE split = 'train'),\n"
        "base AS (SELECT e.*, mu.*, CASE WHEN e.score >= d.threshold THEN 'DECLINE' ELSE 'APPROVE' END AS decision "
        "FROM ep e CROSS JOIN mu CROSS JOIN dep d)")


@register("reason_codes", _reasons_sql())
def q_reason_codes(spark, sf):
    e = ep(spark, sf)
    s = scored(spark, sf)
    from .catalog_scores import deployment_threshold
    means = e.where(F.col("split") == "train").agg(*[F.avg(F.col(f).cast("double")).alias(f"_m_{f}")
                                                     for f in SCORECARD])
    d = e.crossJoin(F.broadcast(means)).crossJoin(F.broadcast(deployment_threshold(s)))
    contribs = scoring.linear_contributions(SCORECARD, {f: F.col(f"_m_{f}") for f in SCORECARD})
    r = d.select("loan_id", scoring.decision(F.col("score"), F.col("_t")).alias("decision"),
                 F.col("score").alias("pd"), scoring.top_reasons(contribs, list(SCORECARD)).alias("rc"))
    flat = [x for k in range(C.REASON_TOP_N) for x in (
        F.col("rc")[k]["feature"].alias(f"reason{k + 1}_feature"),
        F.col("rc")[k]["shap_value"].alias(f"reason{k + 1}_shap_value"),
        F.col("rc")[k]["direction"].alias(f"reason{k + 1}_direction"))]
    return normalize(r.select("loan_id", "decision", "pd", *flat))


@register("score_audit_log")
def q_score_audit(spark, sf):
    from .catalog_scores import deployment_threshold
    s = scored(spark, sf)
    s = s.crossJoin(F.broadcast(deployment_threshold(s))).select("loan_id", "score", "_t")
    e = ep(spark, sf).select("loan_id", *C.RAW_FEATURE_COLUMNS)
    j = s.join(e, "loan_id")
    return scoring.audit_record(j, C.RAW_FEATURE_COLUMNS, F.col("_t"), "scorecard-fixed-1")


# ---------------------------------------------------------------- sources / sinks
CSV_COLS = [f.name for f in io.EPISODE_SCHEMA.fields]


@register("scan_csv", with_episodes(
    "SELECT " + sql_round([("loan_id", "i"), ("cust_id", "i"), ("draw_date", "date"), ("county", "s"),
                           ("channel", "s"), ("product_code", "s")]
                          + [(c, "d" if c in DOUBLE_FEATS else "i") for c in RAW] + [("defaulted_30d", "i")])
    + " FROM ep"))
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "episodes-csv")
    io.write_table(ep(spark, sf).select(*CSV_COLS), path, fmt="csv")
    return normalize(io.read_episodes(spark, path, fmt="csv"))


#: Rows that the written CSV spoils: a number that is none, a date that is none.
_SPOILED_NUMBER, _SPOILED_DATE = "crb_flagged = 1", "county = 'BRAZIL'"


@register("scan_csv_quarantine", with_episodes(
    f"SELECT loan_id, NOT ({_SPOILED_NUMBER} OR {_SPOILED_DATE}) AS good, CASE WHEN NOT ({_SPOILED_NUMBER} OR {_SPOILED_DATE}) "
    f"THEN strftime(draw_date, '%Y-%m-%d') END AS draw_date, CASE WHEN NOT ({_SPOILED_NUMBER} OR {_SPOILED_DATE}) "
    "THEN RND(utilization_rate, 6) END AS utilization_rate FROM ep"))
def q_scan_csv_quarantine(spark, sf):
    """Episodes through a CSV with spoiled rows: good ones come back typed, bad ones as their lines."""
    path, out = scratch_path(spark, "episodes-csv"), scratch_path(spark, "csv-quarantine")
    spoiled = ep(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in CSV_COLS]).withColumns({
        "utilization_rate": F.when(F.expr(_SPOILED_NUMBER), "n/a").otherwise(F.col("utilization_rate")),
        "draw_date": F.when(F.expr(_SPOILED_DATE), "soon").otherwise(F.col("draw_date"))})
    io.write_table(spoiled, path, fmt="csv")
    io.quarantine_csv(spark, path, out)
    good = spark.read.parquet(f"{out}/good").select("loan_id", F.lit(True).alias("good"), "draw_date", "utilization_rate")
    bad = spark.read.parquet(f"{out}/bad").select(F.split_part("record", F.lit(","), F.lit(1)).cast("long").alias("loan_id"),
                                                  F.lit(False).alias("good"))
    return normalize(good.unionByName(bad, allowMissingColumns=True))


@register("sink_features_roundtrip", with_episodes(
    f"SELECT loan_id, {feat_select()}, defaulted_30d, split FROM feat", FEAT_CTE))
def q_sink_roundtrip(spark, sf):
    path = scratch_path(spark, "features")
    io.write_table(feats(spark, sf, keys=("loan_id", "split")), path, partition_by=["split"])
    back = spark.read.parquet(path)
    return normalize(back.select("loan_id", *C.FEATURE_COLUMNS, C.TARGET_COL, "split"))


@register("scan_features", with_episodes(
    f"SELECT loan_id, {feat_select()}, defaulted_30d FROM feat WHERE split = 'oot'", FEAT_CTE))
def q_scan_features(spark, sf):
    path = scratch_path(spark, "features")
    io.write_table(feats(spark, sf, keys=("loan_id", "split")), path, partition_by=["split"])
    # the split filter prunes partitions; the projection prunes columns at the scan
    return normalize(io.read_features(spark, path + "/split=oot"))


@register("report_json", _VALIDATE_DATA_SQL)
def q_report_json(spark, sf):
    checks = quality.validate_data(feats(spark, sf, "oot"), reference_df=feats(spark, sf, "train"))
    path = scratch_path(spark, "report")
    gates.report_json(checks).select("json").write.mode("overwrite").text(path)
    back = spark.read.text(path)
    return back.select(F.from_json("value", "check_seq int, name string, passed boolean, severity string, "
                                   "value double, `limit` double, message string").alias("c")).select("c.*")


# ---------------------------------------------------------------- model
def _train(spark, sf):
    e = ep(spark, sf)
    return train_pipeline(e, TRAIN_CFG)


@register("train_pipeline")
def q_train_pipeline(spark, sf):
    return _train(spark, sf)["metrics"]


@register("train_gbt")
def q_train_gbt(spark, sf):
    f_tr, f_va = feats(spark, sf, "train"), feats(spark, sf, "val")
    fitted = model.train_gbt(f_tr, f_va, GBT_QUERY)
    rows = [(i + 1, -float(v), i + 1 == fitted.best_iteration) for i, v in enumerate(fitted.val_losses)]
    return spark.createDataFrame(rows, "iteration int, val_auc double, chosen boolean")


@register("train_scorecard")
def q_train_scorecard(spark, sf):
    m = model.train_scorecard(feats(spark, sf, "train"))
    coefs = model.coefficients(m, C.FEATURE_COLUMNS)
    return spark.createDataFrame(list(coefs.items()), "feature string, coefficient double")


@register("isotonic_calibrate")
def q_isotonic(spark, sf):
    m = model.train_scorecard(feats(spark, sf, "train"))
    val = model.raw_scores(m, feats(spark, sf, "val"))
    cal = model.fit_isotonic(val)
    return model.calibrate(cal, model.raw_scores(m, feats(spark, sf))).select("loan_id", "raw_score", "score", C.TARGET_COL)


#: Max-min form of the isotonic fit: the largest, over starts, of the smallest mean up to any end.
ISOTONIC_SQL = with_episodes(
    "SELECT RND(h.score, 6) AS score, h.pos, h.n, RND(f.fitted, 6) AS fitted FROM ih h JOIN ifit f ON f.i = h.i",
    "ih AS (SELECT score, pos, n, ROW_NUMBER() OVER (ORDER BY score) AS i, SUM(pos) OVER (ORDER BY score) AS cp, "
    "SUM(n) OVER (ORDER BY score) AS cn FROM (SELECT score, CAST(SUM(defaulted_30d) AS BIGINT) AS pos, COUNT(*) AS n "
    "FROM ep WHERE score IS NOT NULL AND defaulted_30d IS NOT NULL GROUP BY score) g),\n"
    "im AS (SELECT a.i AS a, b.i AS i, CAST(b.cp - a.cp + a.pos AS DOUBLE) / CAST(b.cn - a.cn + a.n AS DOUBLE) AS m "
    "FROM ih a JOIN ih b ON b.i >= a.i),\n"
    "imin AS (SELECT i, MIN(m) OVER (PARTITION BY a ORDER BY i DESC) AS m FROM im),\n"
    "ifit AS (SELECT i, MAX(m) AS fitted FROM imin GROUP BY i)")


@register("isotonic_fit", ISOTONIC_SQL)
def q_isotonic_fit(spark, sf):
    d = ep(spark, sf).select("score", C.TARGET_COL)
    hist = score_hist(d, "score", C.TARGET_COL)
    return normalize(model.fit_isotonic(d, "score").transform(hist, "score", "fitted").select("score", "pos", "n", "fitted"))


@register("score_batch")
def q_score_batch(spark, sf):
    m = model.train_scorecard(feats(spark, sf, "train"))
    val = model.raw_scores(m, feats(spark, sf, "val"))
    cal = model.fit_isotonic(val)
    raw = ep(spark, sf).select("loan_id", *C.RAW_FEATURE_COLUMNS)
    return model.score_batch(m, cal, raw, 0.3).select("loan_id", "raw_score", "score", "decision", "threshold_used")


@register("feature_importance_topk")
def q_importance(spark, sf):
    fitted = model.train_gbt(feats(spark, sf, "train"), feats(spark, sf, "val"), GBT_QUERY)
    return model.feature_importance(fitted.model, fitted.feature_cols, 15)


def scorecard_bundle(spark, sf, version: str) -> model.Bundle:
    """Scorecard of the first split, calibrated on the second, which also chooses the threshold."""
    m = model.train_scorecard(feats(spark, sf, "train"))
    raw = model.raw_scores(m, feats(spark, sf, "val"))
    cal = model.fit_isotonic(raw)
    val = model.calibrate(cal, raw).withColumn("label", F.col(C.TARGET_COL))
    best = cost.min_cost_threshold(val).first()
    return model.Bundle(m, cal, float(best["threshold"]) if best else None, version)


@register("model_roundtrip")
def q_model_roundtrip(spark, sf):
    root = scratch_path(spark, "models")
    model.save_bundle(spark, scorecard_bundle(spark, sf, "scorecard-1"), root)
    raw = ep(spark, sf).select("loan_id", *C.RAW_FEATURE_COLUMNS)
    return model.score_bundle(model.load_bundle(spark, root), raw).select(
        "loan_id", "score", "decision", "threshold_used", "model_version")


@register("reason_codes_gbt")
def q_reason_codes_gbt(spark, sf):
    from ..operators.explain import gbt_reason_codes
    fitted = model.train_gbt(feats(spark, sf, "train"), feats(spark, sf, "val"), GBT_QUERY)
    gbt = fitted.model.stages[-1]
    return gbt_reason_codes(feats(spark, sf), gbt, fitted.feature_cols, fills=fitted.fills)
