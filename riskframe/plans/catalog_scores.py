"""Registered scored-table queries: metrics, cost thresholds, fairness, gates.

Scores are the fixed scorecard of the episode view, so every definition is
checkable against DuckDB. Thresholds are chosen on the validation split and
graded on the OOT split, as in the reference protocol.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import cost, fairness, gates, metrics
from ..sources.testview import with_episodes
from .catalog import ep
from .registry import normalize, register

SWEEP = [0.05, 0.08, 0.10, 0.13, 0.20, 0.25, 0.30, 0.40, 0.50, 0.60]
OPS = [0.30, 0.50, 0.60]


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return ep(spark, sf).select("loan_id", "split", F.col("defaulted_30d").alias("label"), "score",
                                "tenure_months", "crb_flagged")


def oot(spark, sf):
    return scored(spark, sf).where(F.col("split") == "oot")


def deployment_threshold(s: DataFrame) -> DataFrame:
    """One row: the min-cost threshold chosen on the validation split."""
    return cost.min_cost_threshold(s.where(F.col("split") == "val")).select(
        F.col("threshold").alias("_t"))


def with_deployment(s: DataFrame) -> DataFrame:
    """OOT rows with the deployment threshold attached (1-row broadcast)."""
    return s.where(F.col("split") == "oot").crossJoin(F.broadcast(deployment_threshold(s)))


SC = ("sc AS (SELECT loan_id, split, defaulted_30d AS label, score, tenure_months, crb_flagged FROM ep),\n"
      "oot AS (SELECT * FROM sc WHERE split = 'oot')")


def hist_cte(name: str, src: str) -> str:
    return (f"{name} AS (SELECT score, CAST(SUM(label) AS BIGINT) AS pos, COUNT(*) AS n, "
            f"COUNT(*) - CAST(SUM(label) AS BIGINT) AS neg FROM {src} GROUP BY score)")


DEP = (hist_cte("vh", "sc WHERE split = 'val'") + ",\n"
       "vc AS (SELECT score, pos, n, SUM(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp, "
       "SUM(n) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS flagged, SUM(pos) OVER () AS tot_pos, "
       "SUM(n) OVER () AS tot_n FROM vh),\n"
       "vk AS (SELECT score AS threshold, "
       f"{C.COST_FP!r}::DOUBLE * CAST(CASE WHEN tp > 0 THEN flagged - tp ELSE tot_n - tot_pos END AS DOUBLE) + "
       f"{C.COST_FN!r}::DOUBLE * CAST(tot_pos - tp AS DOUBLE) AS cost, CAST(flagged AS DOUBLE) / CAST(tot_n AS DOUBLE) "
       "AS flag_rate FROM vc),\n"
       "dep AS (SELECT threshold, cost, flag_rate FROM vk ORDER BY cost, threshold LIMIT 1)")


def values_cte(name: str, vals: list[float]) -> str:
    rows = ", ".join(f"({v!r}::DOUBLE)" for v in vals)
    return f"{name} AS (SELECT * FROM (VALUES {rows}) t(threshold))"


def cm_cte(name: str, src: str, ts: str) -> str:
    return (f"{name} AS (SELECT t.threshold, "
            "COUNT(*) FILTER (WHERE s.score < t.threshold AND s.label = 0) AS tn, "
            "COUNT(*) FILTER (WHERE s.score >= t.threshold AND s.label = 0) AS fp, "
            "COUNT(*) FILTER (WHERE s.score < t.threshold AND s.label = 1) AS fn, "
            "COUNT(*) FILTER (WHERE s.score >= t.threshold AND s.label = 1) AS tp, COUNT(*) AS n "
            f"FROM {src} s CROSS JOIN {ts} t GROUP BY t.threshold)")


TM_SELECT = ("threshold, tn, fp, fn, tp, RND(tp / GREATEST(tp + fp, 1), 4) AS precision, "
             "RND(tp / GREATEST(tp + fn, 1), 4) AS recall, "
             "RND(2 * (tp / GREATEST(tp + fp, 1)) * (tp / GREATEST(tp + fn, 1)) / "
             "GREATEST(tp / GREATEST(tp + fp, 1) + tp / GREATEST(tp + fn, 1), 1e-9), 4) AS f1, "
             "RND((tp + fp) / n, 4) AS flag_rate")


# ---------------------------------------------------------------- A12, A13
@register("threshold_metrics", with_episodes(
    f"SELECT {TM_SELECT} FROM cm", SC + ",\n" + values_cte("ts", OPS) + ",\n" + cm_cte("cm", "oot", "ts")))
def q_threshold_metrics(spark, sf):
    return normalize(metrics.threshold_metrics(oot(spark, sf), OPS))


@register("threshold_sweep", with_episodes(
    "SELECT threshold, RND(CAST(tp + fp AS DOUBLE) / n, 6) AS flag_rate, RND(CAST(fp AS DOUBLE) / (fp + tn), 6) "
    "AS fpr, RND(CAST(fn AS DOUBLE) / (fn + tp), 6) AS fnr FROM cm",
    SC + ",\n" + values_cte("ts", SWEEP) + ",\n" + cm_cte("cm", "oot", "ts")))
def q_threshold_sweep(spark, sf):
    return normalize(metrics.threshold_sweep(oot(spark, sf), SWEEP))


# ---------------------------------------------------------------- A14-A16, W4
AUC_SQL = ("ac AS (SELECT *, COALESCE(SUM(neg) OVER (PARTITION BY split ORDER BY score ROWS BETWEEN UNBOUNDED "
           "PRECEDING AND 1 PRECEDING), 0) AS neg_before FROM sh),\n"
           "auc_t AS (SELECT split, SUM(pos * (neg_before + neg / 2.0)) / CAST(SUM(pos) * SUM(neg) AS DOUBLE) AS auc, "
           "CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg FROM ac GROUP BY split)")
SPLIT_HIST = ("sh AS (SELECT split, score, CAST(SUM(label) AS BIGINT) AS pos, COUNT(*) AS n, "
              "COUNT(*) - CAST(SUM(label) AS BIGINT) AS neg FROM sc GROUP BY split, score)")


@register("roc_auc", with_episodes(
    "SELECT split, RND(auc, 6) AS auc, n_pos, n_neg FROM auc_t", SC + ",\n" + SPLIT_HIST + ",\n" + AUC_SQL))
def q_roc_auc(spark, sf):
    return normalize(metrics.roc_auc(scored(spark, sf), group_cols=["split"]))


PR_SQL = ("pc AS (SELECT split, score, pos, n, SUM(pos) OVER (PARTITION BY split ORDER BY score DESC ROWS UNBOUNDED "
          "PRECEDING) AS tp, SUM(n) OVER (PARTITION BY split ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS flagged, "
          "SUM(pos) OVER (PARTITION BY split) AS tot_pos, SUM(n) OVER (PARTITION BY split) AS tot_n FROM sh)")


@register("average_precision", with_episodes(
    "SELECT split, RND(SUM(pos * (CAST(tp AS DOUBLE) / flagged)) / CAST(SUM(pos) AS DOUBLE), 6) AS average_precision "
    "FROM pc GROUP BY split", SC + ",\n" + SPLIT_HIST + ",\n" + PR_SQL))
def q_average_precision(spark, sf):
    return normalize(metrics.average_precision(scored(spark, sf), group_cols=["split"]))


@register("pr_curve", with_episodes(
    "SELECT split, RND(score, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(flagged - tp AS BIGINT) AS fp, pos AS pos_at, "
    "CAST(tot_pos AS BIGINT) AS n_pos, CAST(tot_n - tot_pos AS BIGINT) AS n_neg, RND(CAST(tp AS DOUBLE) / flagged, 6) AS precision, "
    "RND(CAST(tp AS DOUBLE) / tot_pos, 6) AS recall FROM pc", SC + ",\n" + SPLIT_HIST + ",\n" + PR_SQL))
def q_pr_curve(spark, sf):
    return normalize(metrics.pr_curve(scored(spark, sf), group_cols=["split"]))


@register("brier_score", with_episodes(
    "SELECT split, RND(AVG(POW(score - label, 2)), 6) AS brier, RND(AVG(CAST(label AS DOUBLE)), 6) AS base_rate, "
    "COUNT(*) AS n, RND(AVG(CAST(label AS DOUBLE)) * (1 - AVG(CAST(label AS DOUBLE))), 6) AS no_skill_brier "
    "FROM sc GROUP BY split", SC))
def q_brier(spark, sf):
    return normalize(metrics.brier(scored(spark, sf), group_cols=["split"]))


# ---------------------------------------------------------------- A18, A19
CAL_PROBS = ", ".join(f"{float(i) / 10!r}::DOUBLE" for i in range(11))


@register("calibration_table", with_episodes(
    "SELECT bin, RND(edges[bin], 6) AS bin_lo, RND(edges[bin + 1], 6) AS bin_hi, COUNT(*) AS n, "
    "RND(AVG(score), 4) AS mean_predicted, RND(AVG(CAST(label AS DOUBLE)), 4) AS actual_default_rate "
    "FROM (SELECT o.score, o.label, e.edges, CAST(CASE WHEN o.score = e.edges[1] THEN 1 ELSE "
    "len(list_filter(e.edges, lambda x: x < o.score)) END AS BIGINT) AS bin FROM oot o CROSS JOIN ce e) b "
    "WHERE bin >= 1 AND bin < len(edges) GROUP BY bin, edges",
    SC + f",\ncq AS (SELECT list_sort(list_distinct(quantile_cont(score, [{CAL_PROBS}]))) AS edges FROM oot),\n"
    "ce AS (SELECT edges FROM cq WHERE len(edges) >= 2)"))
def q_calibration(spark, sf):
    return normalize(metrics.calibration_table(oot(spark, sf)))


@register("score_quantiles", with_episodes(
    "SELECT split, UNNEST([0.5::DOUBLE, 0.9::DOUBLE]) AS prob, UNNEST(qs) AS value, n FROM (SELECT split, "
    "quantile_cont(score, [0.5::DOUBLE, 0.9::DOUBLE]) AS qs, COUNT(*) AS n FROM sc GROUP BY split) t", SC))
def q_score_quantiles(spark, sf):
    return normalize(metrics.score_quantiles(scored(spark, sf), (0.5, 0.9), group_cols=["split"]))


# ---------------------------------------------------------------- A20-A22
@register("min_cost_threshold", with_episodes(
    "SELECT RND(threshold, 6) AS threshold, RND(cost, 6) AS expected_cost, RND(flag_rate, 6) AS flag_rate FROM dep",
    SC + ",\n" + DEP))
def q_min_cost(spark, sf):
    return normalize(cost.min_cost_threshold(scored(spark, sf).where(F.col("split") == "val")))


@register("cost_threshold_report", with_episodes(
    f"SELECT {C.COST_FP!r}::DOUBLE AS cost_fp, {C.COST_FN!r}::DOUBLE AS cost_fn, '' AS description, "
    f"RND({C.COST_FP!r}::DOUBLE / ({C.COST_FP!r}::DOUBLE + {C.COST_FN!r}::DOUBLE), 4) AS bayes_optimal_threshold, "
    "RND(threshold, 4) AS empirical_threshold, RND(flag_rate, 4) AS flag_rate_at_empirical, "
    "RND(cost, 2) AS expected_cost_at_empirical, RND(threshold, 6) AS empirical_threshold_raw FROM dep",
    SC + ",\n" + DEP))
def q_cost_report(spark, sf):
    return normalize(cost.cost_threshold_report(scored(spark, sf).where(F.col("split") == "val")))


# ---------------------------------------------------------------- A17
EVAL_METRICS = ["threshold", "tn", "fp", "fn", "tp", "precision", "recall", "f1", "flag_rate"]
EVAL_CTES = (SC + ",\n" + SPLIT_HIST + ",\n" + AUC_SQL + ",\n" + PR_SQL + ",\n" + DEP + ",\n"
             "ts2 AS (SELECT 'configured' AS operating_point, 0.3::DOUBLE AS threshold UNION ALL "
             "SELECT 'deployment', threshold FROM dep),\n"
             "cm2 AS (SELECT t.operating_point, t.threshold, "
             "COUNT(*) FILTER (WHERE s.score < t.threshold AND s.label = 0) AS tn, "
             "COUNT(*) FILTER (WHERE s.score >= t.threshold AND s.label = 0) AS fp, "
             "COUNT(*) FILTER (WHERE s.score < t.threshold AND s.label = 1) AS fn, "
             "COUNT(*) FILTER (WHERE s.score >= t.threshold AND s.label = 1) AS tp, COUNT(*) AS n "
             "FROM oot s CROSS JOIN ts2 t GROUP BY t.operating_point, t.threshold),\n"
             f"em AS (SELECT operating_point, {TM_SELECT} FROM cm2)")
EVAL_BODY = ("SELECT 'all' AS operating_point, 'auc' AS metric, RND(RND(auc, 4), 6) AS value FROM auc_t "
             "WHERE split = 'oot' UNION ALL SELECT 'all', 'pr_auc', RND(RND(SUM(pos * (CAST(tp AS DOUBLE) / "
             "flagged)) / CAST(SUM(pos) AS DOUBLE), 4), 6) FROM pc WHERE split = 'oot' "
             "UNION ALL SELECT 'all', 'brier_score', RND(RND(AVG(POW(score - label, 2)), 4), 6) FROM oot "
             "UNION ALL SELECT 'all', 'default_rate_actual', RND(RND(AVG(CAST(label AS DOUBLE)), 4), 6) FROM oot "
             + " ".join(f"UNION ALL SELECT operating_point, '{m}', RND(CAST({m} AS DOUBLE), 6) FROM em"
                        for m in EVAL_METRICS))


@register("evaluate_scores", with_episodes(EVAL_BODY, EVAL_CTES))
def q_evaluate(spark, sf):
    from ..plans.pipeline import evaluate_scores
    return evaluate_scores(scored(spark, sf))


# ---------------------------------------------------------------- A23, A24, A30, A31
def _side_sql(pred: str, tag: str) -> list[str]:
    return [f"COUNT(*) FILTER (WHERE {pred}) AS {tag}_n",
            f"COUNT(*) FILTER (WHERE {pred} AND score < t AND label = 0) AS {tag}_tn",
            f"COUNT(*) FILTER (WHERE {pred} AND score >= t AND label = 0) AS {tag}_fp",
            f"COUNT(*) FILTER (WHERE {pred} AND score < t AND label = 1) AS {tag}_fn",
            f"COUNT(*) FILTER (WHERE {pred} AND score >= t AND label = 1) AS {tag}_tp"]


AUDIT_SIDES = {
    "tenure_proxy": ("COALESCE(tenure_months < 12, FALSE)", "thin_file", "established"),
    "crb_flag_proxy": ("COALESCE(crb_flagged = 1, FALSE)", "crb_flagged", "crb_clean"),
}
GC = ("gc AS (SELECT " + ", ".join(
    x for name, (p, _, _) in AUDIT_SIDES.items()
    for x in _side_sql(p, f"{name}_a") + _side_sql(f"NOT {p}", f"{name}_b"))
    + " FROM (SELECT o.*, d.threshold AS t FROM oot o CROSS JOIN dep d) x)")


def _audit_sql() -> str:
    parts = []
    for name, (_, a, b) in AUDIT_SIDES.items():
        def side(tag):
            return (f"RND(CAST({name}_{tag}_tn + {name}_{tag}_fn AS DOUBLE) / NULLIF({name}_{tag}_n, 0), 4)",
                    f"RND({name}_{tag}_fp / GREATEST({name}_{tag}_fp + {name}_{tag}_tn, 1), 4)",
                    f"RND({name}_{tag}_fn / GREATEST({name}_{tag}_fn + {name}_{tag}_tp, 1), 4)")
        aa, afpr, afnr = side("a")
        ba, bfpr, bfnr = side("b")
        di = f"({aa} / GREATEST({ba}, 1e-6))"
        parts.append(
            f"SELECT '{name}' AS proxy, '{a}' AS group_a, '{b}' AS group_b, {name}_a_n AS a_n, "
            f"{name}_a_tn AS a_n_true_negative, {name}_a_tp AS a_n_true_positive, {aa} AS a_approval_rate, "
            f"{afpr} AS a_fpr, {afnr} AS a_fnr, {name}_b_n AS b_n, {name}_b_tn AS b_n_true_negative, "
            f"{name}_b_tp AS b_n_true_positive, {ba} AS b_approval_rate, {bfpr} AS b_fpr, {bfnr} AS b_fnr, "
            f"RND({di}, 4) AS disparate_impact_ratio, RND({afpr} / GREATEST({bfpr}, 1e-6), 4) AS fpr_ratio, "
            f"RND({afnr} / GREATEST({bfnr}, 1e-6), 4) AS fnr_ratio, {di} < {C.DI_LOWER_BOUND} AS fails_four_fifths_rule "
            "FROM gc")
    return "\nUNION ALL\n".join(parts)


@register("fairness_audit", with_episodes(_audit_sql(), SC + ",\n" + DEP + ",\n" + GC))
def q_fairness_audit(spark, sf):
    d = with_deployment(scored(spark, sf))
    return normalize(fairness.fairness_audit(d, "_t"))


def _ztest_sql(exact: bool = False) -> str:
    parts = []
    rounded = (lambda e: e) if exact else (lambda e: f"RND({e}, 6)")
    for name in AUDIT_SIDES:
        for rate, (num, oth) in (("fpr", ("fp", "tn")), ("fnr", ("fn", "tp"))):
            xa, oa, xb, ob = (f"{name}_a_{num}", f"{name}_a_{oth}", f"{name}_b_{num}", f"{name}_b_{oth}")
            na, nb = f"({xa} + {oa})", f"({xb} + {ob})"
            pa, pb = f"(CAST({xa} AS DOUBLE) / NULLIF({na}, 0))", f"(CAST({xb} AS DOUBLE) / NULLIF({nb}, 0))"
            pool = f"(CAST({xa} + {xb} AS DOUBLE) / NULLIF({na} + {nb}, 0))"
            se = f"SQRT({pool} * (1 - {pool}) * (1.0 / NULLIF({na}, 0) + 1.0 / NULLIF({nb}, 0)))"
            parts.append(
                f"SELECT '{name}' AS proxy, '{rate}' AS rate, {xa} AS x_a, {na} AS n_a, {xb} AS x_b, {nb} AS n_b, "
                f"{rounded(pa)} AS rate_a, {rounded(pb)} AS rate_b, "
                f"{rounded(f'CASE WHEN {se} > 0 THEN ({pa} - {pb}) / {se} END')} AS z FROM gc")
    return "\nUNION ALL\n".join(parts)


@register("fairness_ztest", with_episodes(_ztest_sql(), SC + ",\n" + DEP + ",\n" + GC))
def q_fairness_ztest(spark, sf):
    d = with_deployment(scored(spark, sf))
    return normalize(fairness.ztest_table(d, "_t"))


def _pvalues_sql() -> str:
    """erfc from the series over half-integer gammas, Fisher's sum from log-gammas over every table with the margins."""
    def ways(n, x):
        return f"(LGAMMA({n} + 1) - LGAMMA({x} + 1) - LGAMMA({n} - {x} + 1))"
    weight = f"{ways('n_a', 'x')} + {ways('n_b', '(x_a + x_b - x)')} - {ways('(n_a + n_b)', '(x_a + x_b)')}"
    ctes = (
        "zt AS (SELECT proxy, rate, x_a, n_a, x_b, n_b, rate_a, rate_b, z FROM (" + _ztest_sql(exact=True) + ") r),\n"
        "ft AS (SELECT *, UNNEST(range(GREATEST(0, x_a + x_b - n_b), LEAST(x_a + x_b, n_a) + 1)) AS x FROM zt WHERE n_a > 0 AND n_b > 0),\n"
        f"fw AS (SELECT proxy, rate, x, x_a, EXP({weight}) AS w FROM ft),\n"
        "fs AS (SELECT proxy, rate, MAX(w) FILTER (WHERE x = x_a) AS seen FROM fw GROUP BY ALL),\n"
        "fp AS (SELECT w.proxy, w.rate, LEAST(1.0::DOUBLE, SUM(w) FILTER (WHERE w.w <= s.seen * (1 + 1e-7)) / SUM(w)) AS p_fisher "
        "FROM fw w JOIN fs s ON s.proxy = w.proxy AND s.rate = w.rate GROUP BY ALL),\n"
        "pz AS (SELECT proxy, rate, CASE WHEN z = 0 THEN 1.0::DOUBLE WHEN ABS(z) > 12 THEN 0.0::DOUBLE ELSE 1 - list_sum(list_transform("
        "range(0, 400), lambda j: EXP((2 * j + 1) * LN(ABS(z) / SQRT(2.0)) - LGAMMA(j + 1.5) - z * z / 2))) END AS p_z FROM zt)")
    return with_episodes(
        "SELECT t.proxy, t.rate, t.x_a, t.n_a, t.x_b, t.n_b, RND(t.rate_a, 6) AS rate_a, RND(t.rate_b, 6) AS rate_b, RND(t.z, 6) AS z, "
        f"RND(p.p_z, 6) AS p_z, RND(f.p_fisher, 6) AS p_fisher, p.p_z < {0.05 / 4!r}::DOUBLE AS passes_bonferroni "
        "FROM zt t JOIN pz p ON p.proxy = t.proxy AND p.rate = t.rate LEFT JOIN fp f ON f.proxy = t.proxy AND f.rate = t.rate",
        SC + ",\n" + DEP + ",\n" + GC + ",\n" + ctes)


@register("fairness_pvalues", _pvalues_sql())
def q_fairness_pvalues(spark, sf):
    d = with_deployment(scored(spark, sf))
    return normalize(fairness.ztest_pvalues(fairness.ztest_table(d, "_t")))


@register("approved_pool_rate", with_episodes(
    "SELECT COUNT(*) FILTER (WHERE score < t) AS n_approved, "
    "COUNT(*) FILTER (WHERE score < t AND label = 1) AS n_defaults_approved, "
    "RND(CAST(COUNT(*) FILTER (WHERE score < t AND label = 1) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE score < t), 0), 6) "
    "AS approved_default_rate FROM (SELECT o.*, d.threshold AS t FROM oot o CROSS JOIN dep d) x",
    SC + ",\n" + DEP))
def q_approved_pool(spark, sf):
    d = with_deployment(scored(spark, sf))
    return normalize(fairness.approved_pool_rate(d, F.col("_t")))


def _gate_sql() -> str:
    aggs = []
    for i, (col, a, b) in enumerate((("thin_file", 1, 0), ("crb_flagged", 1, 0))):
        expr = "CAST(COALESCE(tenure_months < 12, FALSE) AS INTEGER)" if col == "thin_file" else col
        aggs += _side_sql(f"{expr} = {a}", f"g{i}_a") + _side_sql(f"{expr} = {b}", f"g{i}_b")
    gg = ("gg AS (SELECT " + ", ".join(aggs)
          + " FROM (SELECT o.*, d.threshold AS t FROM oot o CROSS JOIN dep d) x)")
    rows = []
    for i, col in enumerate(("thin_file", "crb_flagged")):
        def r(tag):
            n, tn, fp, fn, tp = (f"g{i}_{tag}_{k}" for k in ("n", "tn", "fp", "fn", "tp"))
            return n, f"({tn} + {fn}) / GREATEST({n}, 1)", f"{fp} / GREATEST({fp} + {tn}, 1)", \
                f"{fn} / GREATEST({fn} + {tp}, 1)"
        an, aa, afpr, afnr = r("a")
        bn, ba, bfpr, bfnr = r("b")
        di, fr, nr = (f"({aa} / GREATEST({ba}, 1e-9))", f"({afpr} / GREATEST({bfpr}, 1e-9))",
                      f"({afnr} / GREATEST({bfnr}, 1e-9))")
        base = 300 + 10 * i
        w = f" FROM gg WHERE {an} > 0 AND {bn} > 0"

        def f4(e):
            return f"printf('%.4f', RND({e}, 4))"
        rows.append(
            f"SELECT CAST({base + 1} AS INTEGER) AS check_seq, 'fairness.di.{col}' AS name, {di} >= 0.8 AS passed, "
            f"CASE WHEN {di} >= 0.8 THEN 'info' ELSE 'error' END AS severity, RND({di}, 4) AS value, "
            f"0.8::DOUBLE AS \"limit\", 'DI(1/0)=' || {f4(di)} || CASE WHEN {di} >= 0.8 THEN ' >= ' ELSE ' < ' END "
            f"|| '0.8' AS message" + w)
        for k, (nm, v, pa, pb) in enumerate((("fpr_ratio", fr, afpr, bfpr), ("fnr_ratio", nr, afnr, bfnr))):
            lab = "FPR" if nm == "fpr_ratio" else "FNR"
            rows.append(
                f"SELECT CAST({base + 2 + k} AS INTEGER), 'fairness.{nm}.{col}', {v} <= 2.0, "
                f"CASE WHEN {v} <= 2.0 THEN 'info' ELSE 'warning' END, RND({v}, 4), 2.0::DOUBLE, "
                f"'{lab} ratio(1/0)=' || {f4(v)} || ' (a=' || {f4(pa)} || ', b=' || {f4(pb)} || ')'" + w)
    return gg, "\nUNION ALL\n".join(rows)


_GG, _GATE_ROWS = _gate_sql()


@register("fairness_gate", with_episodes(_GATE_ROWS, SC + ",\n" + DEP + ",\n" + _GG))
def q_fairness_gate(spark, sf):
    d = fairness.with_gate_groups(with_deployment(scored(spark, sf)))
    return normalize(fairness.fairness_gate(d, "_t"))


@register("auc_gate", with_episodes(
    "SELECT CAST(100 AS INTEGER) AS check_seq, 'model.auc' AS name, COALESCE(auc >= 0.65, FALSE) AS passed, "
    "CASE WHEN COALESCE(auc >= 0.65, FALSE) THEN 'info' ELSE 'error' END AS severity, RND(auc, 4) AS value, "
    "0.65::DOUBLE AS \"limit\", 'AUC=' || COALESCE(printf('%.4f', RND(auc, 4)), 'nan') || CASE WHEN "
    "COALESCE(auc >= 0.65, FALSE) THEN ' >= ' ELSE ' < ' END || 'min=0.65' AS message FROM auc_t WHERE split = 'oot'",
    SC + ",\n" + SPLIT_HIST + ",\n" + AUC_SQL))
def q_auc_gate(spark, sf):
    a = metrics.roc_auc(oot(spark, sf))
    return normalize(gates.auc_gate(a))


GAP_ROW = ("SELECT CAST(200 AS INTEGER) AS check_seq, 'model.train_oot_gap' AS name, "
           "COALESCE(tr.auc - o.auc <= 0.15, FALSE) AS passed, CASE WHEN COALESCE(tr.auc - o.auc <= 0.15, FALSE) "
           "THEN 'info' ELSE 'warning' END AS severity, RND(tr.auc - o.auc, 4) AS value, 0.15::DOUBLE AS \"limit\", "
           "'Train-OOT AUC gap=' || printf('%.4f', RND(tr.auc - o.auc, 4)) || ' (train=' || "
           "printf('%.4f', RND(tr.auc, 4)) || ', OOT=' || printf('%.4f', RND(o.auc, 4)) || ')' AS message "
           "FROM auc_t tr, auc_t o WHERE tr.split = 'train' AND o.split = 'oot'")


@register("auc_gap_gate", with_episodes(GAP_ROW, SC + ",\n" + SPLIT_HIST + ",\n" + AUC_SQL))
def q_auc_gap_gate(spark, sf):
    a = metrics.roc_auc(scored(spark, sf), group_cols=["split"])
    p = a.agg(F.max(F.when(F.col("split") == "oot", F.col("auc"))).alias("oot_auc"),
              F.max(F.when(F.col("split") == "train", F.col("auc"))).alias("train_auc"))
    return normalize(gates.auc_gap_gate(p))


_FORBID = ("SELECT CAST(400 AS INTEGER) AS check_seq, 'leakage.forbidden_features' AS name, TRUE AS passed, "
           "'info' AS severity, NULL::DOUBLE AS value, NULL::DOUBLE AS \"limit\", "
           "'No forbidden features present in model feature list' AS message")


@register("validate_model_report", with_episodes(
    "SELECT check_seq, name, passed, severity, value, \"limit\", message FROM ("
    "SELECT CAST(100 AS INTEGER) AS check_seq, 'model.auc' AS name, COALESCE(auc >= 0.65, FALSE) AS passed, "
    "CASE WHEN COALESCE(auc >= 0.65, FALSE) THEN 'info' ELSE 'error' END AS severity, RND(auc, 4) AS value, "
    "0.65::DOUBLE AS \"limit\", 'AUC=' || COALESCE(printf('%.4f', RND(auc, 4)), 'nan') || CASE WHEN "
    "COALESCE(auc >= 0.65, FALSE) THEN ' >= ' ELSE ' < ' END || 'min=0.65' AS message FROM auc_t WHERE split = 'oot' "
    f"UNION ALL {GAP_ROW} UNION ALL {_GATE_ROWS} UNION ALL {_FORBID})",
    SC + ",\n" + SPLIT_HIST + ",\n" + AUC_SQL + ",\n" + DEP + ",\n" + _GG))
def q_validate_model(spark, sf):
    s = scored(spark, sf)
    d = with_deployment(s)
    rest = s.where(F.col("split") != "oot").withColumn("_t", F.lit(None).cast("double"))
    full = d.unionByName(rest)
    return normalize(gates.validate_model(full, "_t"))


VM_BODY = ("SELECT CAST(100 AS INTEGER) AS check_seq, 'model.auc' AS name, COALESCE(auc >= 0.65, FALSE) AS passed, "
           "CASE WHEN COALESCE(auc >= 0.65, FALSE) THEN 'info' ELSE 'error' END AS severity, RND(auc, 4) AS value, "
           "0.65::DOUBLE AS \"limit\", 'AUC=' || COALESCE(printf('%.4f', RND(auc, 4)), 'nan') || CASE WHEN "
           "COALESCE(auc >= 0.65, FALSE) THEN ' >= ' ELSE ' < ' END || 'min=0.65' AS message FROM auc_t "
           f"WHERE split = 'oot' UNION ALL {GAP_ROW} UNION ALL {_GATE_ROWS} UNION ALL {_FORBID}")


@register("report_summary", with_episodes(
    "SELECT COUNT(*) AS n_checks, COUNT(*) FILTER (WHERE NOT passed AND severity = 'error') AS n_errors, "
    "COUNT(*) FILTER (WHERE NOT passed AND severity = 'warning') AS n_warnings, "
    f"COUNT(*) FILTER (WHERE NOT passed AND severity = 'error') = 0 AS passed FROM ({VM_BODY}) c",
    SC + ",\n" + SPLIT_HIST + ",\n" + AUC_SQL + ",\n" + DEP + ",\n" + _GG))
def q_report_summary(spark, sf):
    return q_validate_model(spark, sf).transform(gates.report_summary)
