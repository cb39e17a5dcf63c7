"""Registered queries: splits, history windows and exploratory profiles."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import features, history, profile, splits
from ..sources.testview import TEST_OOT_CUTOFF, TEST_VAL_CUTOFF, expand_rnd, table, with_episodes
from .catalog import EP_COLS, FEAT_CTE, RAW, ep, feat_select, raw_ep
from .registry import normalize, register

TEST_SPLIT = C.SplitConfig(val_cutoff=TEST_VAL_CUTOFF, oot_cutoff=TEST_OOT_CUTOFF)
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


# ---------------------------------------------------------------- splits
@register("split_temporal", with_episodes(
    "SELECT loan_id, strftime(draw_date, '%Y-%m-%d') AS draw_date, CASE WHEN draw_date < DATE '1999-01-01' THEN "
    "'train' WHEN draw_date < DATE '2000-04-01' THEN 'val' WHEN draw_date IS NOT NULL THEN 'oot' END AS split FROM ep"))
def q_split_temporal(spark, sf):
    e = ep(spark, sf).select("loan_id", "draw_date")
    return normalize(splits.temporal_split(e, TEST_SPLIT))


@register("split_group")
def q_split_group(spark, sf):
    return splits.group_split(ep(spark, sf).select("loan_id", "cust_id"), "cust_id")


@register("split_stratified")
def q_split_stratified(spark, sf):
    return splits.stratified_split(ep(spark, sf).select("loan_id", "defaulted_30d"))


@register("split_auto")
def q_split_auto(spark, sf):
    df, mode = splits.auto_split(ep(spark, sf).select("loan_id", "cust_id", "draw_date", "defaulted_30d"), TEST_SPLIT)
    return df.withColumn("split_mode", F.lit(mode))


@register("split_summary", with_episodes(
    "SELECT split, COUNT(*) AS n, CAST(SUM(defaulted_30d) AS BIGINT) AS n_pos, "
    "RND(AVG(CAST(defaulted_30d AS DOUBLE)), 6) AS rate FROM ep GROUP BY split"))
def q_split_summary(spark, sf):
    e = splits.temporal_split(ep(spark, sf).drop("split"), TEST_SPLIT)
    return normalize(splits.split_summary(e))


@register("join_features_metadata", with_episodes(
    f"SELECT f.loan_id, {feat_select('f.')}, f.defaulted_30d, e.cust_id, strftime(e.draw_date, '%Y-%m-%d') "
    "AS draw_date FROM feat f JOIN ep e ON f.loan_id = e.loan_id", FEAT_CTE))
def q_join_features_metadata(spark, sf):
    e = ep(spark, sf)
    f = features.build_features(e, validate=False)
    m = features.episode_metadata(e)
    return normalize(splits.join_features_metadata(f, m))


@register("borrower_overlap", with_episodes(
    "SELECT CAST(COUNT(*) FILTER (WHERE in_a) AS BIGINT) AS n_overlap, CAST(COUNT(*) AS BIGINT) AS n_borrowers, "
    "RND(COUNT(*) FILTER (WHERE in_a) / GREATEST(COUNT(*), 1) * 100, 6) AS pct_overlap FROM ("
    "SELECT DISTINCT cust_id, cust_id IN (SELECT cust_id FROM ep WHERE split = 'train') AS in_a "
    "FROM ep WHERE split = 'oot') t"))
def q_borrower_overlap(spark, sf):
    return normalize(splits.borrower_overlap(ep(spark, sf)))


# ---------------------------------------------------------------- history
@register("prior_history", with_episodes(
    "SELECT loan_id, cust_id, prior_overdraw_count, prior_cleared_within_24h_count, prior_rolled_past_30d_count "
    "FROM ep"))
def q_prior_history(spark, sf):
    h = history.prior_history(raw_ep(spark, sf), key="cust_id", order_cols=["draw_date", "loan_id"],
                              outcomes={"prior_cleared_within_24h_count": "cleared_24h",
                                        "prior_rolled_past_30d_count": "defaulted_30d"},
                              count_name="prior_overdraw_count", bucket=history.RANGES)
    return h.select("loan_id", "cust_id", "prior_overdraw_count",
                    F.col("prior_cleared_within_24h_count").cast("int").alias("prior_cleared_within_24h_count"),
                    F.col("prior_rolled_past_30d_count").cast("int").alias("prior_rolled_past_30d_count"))


@register("episode_gap_check", with_episodes(
    "SELECT CAST(COUNT(gap) AS BIGINT) AS n_with_prior, CAST(COUNT(*) FILTER (WHERE gap < 30) AS BIGINT) AS "
    "n_violations, CAST(MIN(gap) AS BIGINT) AS min_gap_days, CAST(COUNT(*) FILTER (WHERE gap = 0) AS BIGINT) AS "
    "n_same_day FROM (SELECT date_diff('day', LAG(draw_date) OVER (PARTITION BY cust_id ORDER BY draw_date, loan_id), "
    "draw_date) AS gap FROM ep) t"))
def q_episode_gap_check(spark, sf):
    return history.episode_gap_check(ep(spark, sf), 30, bucket=history.RANGES)


def _activity_sql() -> str:
    types = ", ".join(f"CAST(COUNT(p.event_id) FILTER (WHERE p.event_type = '{t}') AS BIGINT) AS n_{t}_30d"
                      for t in EVENT_TYPES)
    return ("SELECT e.event_id, e.user_id, CAST(COUNT(p.event_id) AS BIGINT) AS n_events_30d, " + types
            + f", COUNT(DISTINCT p.event_type) AS distinct_types_30d, RND(COALESCE(SUM(p.value), 0.0), 6) AS "
            "value_sum_30d FROM events e LEFT JOIN events p ON p.user_id = e.user_id AND p.ts < e.ts AND "
            "p.ts >= e.ts - INTERVAL 30 DAY GROUP BY e.event_id, e.user_id")


@register("activity_30d", expand_rnd(_activity_sql()))
def q_activity_30d(spark, sf):
    return normalize(history.activity_window(table(spark, sf, "events"), types=EVENT_TYPES))


# ---------------------------------------------------------------- profiles
TYPE_COUNTS = {"int": 13, "double": 10, "string": 4, "date": 1, "other": 0}  # of the EP_COLS projection


@register("profile_overview", with_episodes(
    "SELECT COUNT(*) AS n_rows, COUNT(DISTINCT cust_id) AS n_borrowers, strftime(MIN(draw_date), '%Y-%m-%d') AS "
    "first_date, strftime(MAX(draw_date), '%Y-%m-%d') AS last_date, "
    + ", ".join(f"CAST({v} AS BIGINT) AS n_{k}_columns" for k, v in TYPE_COUNTS.items()) + " FROM ep"))
def q_profile_overview(spark, sf):
    return normalize(profile.overview(ep(spark, sf).select(*EP_COLS)))


@register("profile_nulls", with_episodes(
    "SELECT \"column\", n_null FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null FROM ep" for c in EP_COLS)
    + ") t WHERE n_null > 0"))
def q_profile_nulls(spark, sf):
    return profile.null_counts(ep(spark, sf).select(*EP_COLS))


def _unpivot(src: str, cols: list[str]) -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return (f"(SELECT feature, value FROM (UNPIVOT (SELECT {casts} FROM {src}) ON {', '.join(cols)} "
            "INTO NAME feature VALUE value) WHERE value IS NOT NULL)")


@register("profile_describe", with_episodes(
    "SELECT feature, RND(AVG(value), 3) AS mean, RND(STDDEV_SAMP(value), 3) AS std, RND(MIN(value), 3) AS min, "
    "RND(quantile_cont(value, 0.5), 3) AS median, RND(MAX(value), 3) AS max FROM " + _unpivot("ep", RAW)
    + " u GROUP BY feature"))
def q_profile_describe(spark, sf):
    return normalize(profile.describe(ep(spark, sf)))


@register("class_balance", with_episodes(
    "SELECT defaulted_30d, n, RND(n / SUM(n) OVER (), 6) AS share, RND(MAX(n) FILTER (WHERE defaulted_30d = 0) "
    "OVER () / MAX(n) FILTER (WHERE defaulted_30d = 1) OVER (), 6) AS imbalance_ratio FROM (SELECT defaulted_30d, "
    "COUNT(*) AS n FROM ep GROUP BY defaulted_30d) t"))
def q_class_balance(spark, sf):
    return normalize(profile.class_balance(ep(spark, sf)))


BANDS = [("utilization_rate", 4), ("overdraw_to_inflow_ratio", 10), ("send_receive_ratio", 10)]


def _band_sql() -> str:
    parts = []
    for col, q in BANDS:
        probs = ", ".join(f"{p!r}::DOUBLE" for p in [i / q for i in range(q)] + [1.0])
        parts.append(
            f"SELECT '{col}' AS feature, CAST({q} AS BIGINT) AS n_quantiles, band, RND(edges[band], 6) AS lo, "
            f"RND(edges[band + 1], 6) AS hi, COUNT(*) AS n, RND(AVG(CAST(defaulted_30d AS DOUBLE)), 6) AS default_rate "
            f"FROM (SELECT x.defaulted_30d, e.edges, CAST(CASE WHEN x.{col} = e.edges[1] THEN 1 ELSE "
            f"len(list_filter(e.edges, lambda v: v < x.{col})) END AS BIGINT) AS band FROM ep x CROSS JOIN "
            f"(SELECT list_sort(list_distinct(quantile_cont(CAST({col} AS DOUBLE), [{probs}]))) AS edges FROM ep "
            f"WHERE {col} IS NOT NULL) e WHERE x.{col} IS NOT NULL) b GROUP BY band, edges")
    return " UNION ALL ".join(parts)


@register("rate_by_quantile_band", with_episodes(_band_sql()))
def q_rate_by_band(spark, sf):
    return normalize(profile.rate_by_quantile_band(ep(spark, sf), BANDS))


@register("rate_by_flag", with_episodes(
    "SELECT crb_flagged, RND(AVG(CAST(defaulted_30d AS DOUBLE)), 6) AS default_rate, COUNT(*) AS n FROM ep "
    "GROUP BY crb_flagged"))
def q_rate_by_flag(spark, sf):
    return normalize(profile.rate_by_value(ep(spark, sf), "crb_flagged"))


@register("rate_by_prior_rolls", with_episodes(
    "SELECT prior_rolled_past_30d_count, RND(AVG(CAST(defaulted_30d AS DOUBLE)), 6) AS default_rate, COUNT(*) AS n "
    "FROM ep GROUP BY prior_rolled_past_30d_count"))
def q_rate_by_prior_rolls(spark, sf):
    return normalize(profile.rate_by_value(ep(spark, sf), "prior_rolled_past_30d_count"))


MONTHLY = ("mt AS (SELECT last_day(s) AS month_end, COALESCE(a.draws, 0) AS draws, COALESCE(a.defaults, 0) AS defaults, "
           "a.default_rate, a.avg_draw_kes, a.avg_utilization FROM (SELECT UNNEST(generate_series(date_trunc('month', "
           "MIN(draw_date)), date_trunc('month', MAX(draw_date)), INTERVAL 1 MONTH)) AS s FROM ep) sp LEFT JOIN "
           "(SELECT last_day(draw_date) AS m, COUNT(*) AS draws, CAST(SUM(defaulted_30d) AS BIGINT) AS defaults, "
           "AVG(CAST(defaulted_30d AS DOUBLE)) AS default_rate, AVG(draw_amount_kes) AS avg_draw_kes, "
           "AVG(utilization_rate) AS avg_utilization FROM ep GROUP BY 1) a ON last_day(sp.s) = a.m)")


@register("monthly_trend", with_episodes(
    "SELECT strftime(month_end, '%Y-%m-%d') AS month_end, CAST(draws AS BIGINT) AS draws, CAST(defaults AS BIGINT) "
    "AS defaults, RND(default_rate, 6) AS default_rate, RND(avg_draw_kes, 6) AS avg_draw_kes, "
    "RND(avg_utilization, 6) AS avg_utilization FROM mt", MONTHLY))
def q_monthly_trend(spark, sf):
    return normalize(profile.monthly_trend(ep(spark, sf)))


@register("monthly_peak", with_episodes(
    "SELECT (SELECT strftime(month_end, '%Y-%m-%d') FROM mt ORDER BY draws DESC, month_end LIMIT 1) AS peak_month, "
    "CAST(MAX(draws) AS BIGINT) AS peak_draws, RND(MIN(default_rate), 6) AS min_default_rate, "
    "RND(MAX(default_rate), 6) AS max_default_rate, RND(MIN(avg_draw_kes), 6) AS min_avg_draw_kes, "
    "RND(MAX(avg_draw_kes), 6) AS max_avg_draw_kes FROM mt", MONTHLY))
def q_monthly_peak(spark, sf):
    return normalize(profile.monthly_peak(profile.monthly_trend(ep(spark, sf))))


def _fixed_band_sql(col: str, edges, labels, src: str, include_lowest: bool) -> str:
    cases = []
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        left = f"{col} >= {lo}" if (include_lowest and i == 0) else f"{col} > {lo}"
        cases.append(f"WHEN {left} AND {col} <= {hi} THEN '{lab}'")
    order = " ".join(f"WHEN '{lab}' THEN {i}" for i, lab in enumerate(labels))
    return (f"SELECT CAST(CASE band {order} END AS BIGINT) AS band_order, band, COUNT(*) AS n, "
            f"RND(AVG(CAST(defaulted_30d AS DOUBLE)), 6) AS default_rate FROM (SELECT *, CASE {' '.join(cases)} END "
            f"AS band FROM {src}) t WHERE band IS NOT NULL GROUP BY band")


@register("tenure_bands", with_episodes(_fixed_band_sql("tenure_months", C.TENURE_BAND_EDGES,
                                                        C.TENURE_BAND_LABELS, "ep", False)))
def q_tenure_bands(spark, sf):
    return normalize(profile.tenure_bands(ep(spark, sf)))


@register("prior_clear_bands", with_episodes(_fixed_band_sql(
    "clear_rate_prior", C.CLEAR_RATE_BAND_EDGES, C.CLEAR_RATE_BAND_LABELS,
    "(SELECT *, prior_cleared_within_24h_count / GREATEST(CAST(prior_overdraw_count AS DOUBLE), 1.0) AS "
    "clear_rate_prior FROM ep WHERE prior_overdraw_count >= 2)", True)))
def q_prior_clear_bands(spark, sf):
    return normalize(profile.prior_clear_bands(ep(spark, sf)))


@register("histogram_by_group", with_episodes(
    "SELECT defaulted_30d, bin, RND(lo + bin * w, 6) AS bin_lo, RND(lo + (bin + 1) * w, 6) AS bin_hi, n, "
    "RND(n / (cnt * w), 6) AS density FROM (SELECT defaulted_30d, bin, COUNT(*) AS n, ANY_VALUE(lo) AS lo, "
    "ANY_VALUE(w) AS w, ANY_VALUE(cnt) AS cnt FROM (SELECT d.defaulted_30d, r.lo, r.cnt, (r.hi - r.lo) / 50 AS w, "
    "CAST(CASE WHEN (r.hi - r.lo) / 50 = 0 THEN 0 WHEN d.x = r.hi THEN 49 ELSE LEAST(FLOOR((d.x - r.lo) / "
    "((r.hi - r.lo) / 50)), 49) END AS BIGINT) AS bin FROM (SELECT defaulted_30d, LEAST(overdraw_to_inflow_ratio, "
    "25.0::DOUBLE) AS x FROM ep WHERE overdraw_to_inflow_ratio IS NOT NULL) d JOIN (SELECT defaulted_30d, "
    "MIN(LEAST(overdraw_to_inflow_ratio, 25.0::DOUBLE)) AS lo, MAX(LEAST(overdraw_to_inflow_ratio, 25.0::DOUBLE)) "
    "AS hi, COUNT(*) AS cnt FROM ep WHERE overdraw_to_inflow_ratio IS NOT NULL GROUP BY defaulted_30d) r "
    "ON d.defaulted_30d = r.defaulted_30d) b GROUP BY defaulted_30d, bin) t"))
def q_histogram(spark, sf):
    return normalize(profile.histogram(ep(spark, sf), "overdraw_to_inflow_ratio", 50, "defaulted_30d", upper=25.0))


@register("county_topk", with_episodes(
    "SELECT county, volume, RND(default_rate, 6) AS default_rate, default_rate > overall AS above_average FROM ("
    "SELECT county, COUNT(*) AS volume, AVG(CAST(defaulted_30d AS DOUBLE)) AS default_rate FROM ep GROUP BY county "
    "ORDER BY volume DESC, county LIMIT 15) t CROSS JOIN (SELECT AVG(CAST(defaulted_30d AS DOUBLE)) AS overall "
    "FROM ep) o"))
def q_county_topk(spark, sf):
    return normalize(profile.top_by_volume(ep(spark, sf), "county", 15))


@register("channel_summary", with_episodes(
    "SELECT channel, COUNT(*) AS volume, RND(AVG(CAST(defaulted_30d AS DOUBLE)), 6) AS default_rate, "
    "RND(AVG(draw_amount_kes), 6) AS avg_draw FROM ep GROUP BY channel"))
def q_channel_summary(spark, sf):
    return normalize(profile.channel_summary(ep(spark, sf)))


CORR_COLS = RAW + ["defaulted_30d"]


def _pearson_sql(a: str, b: str) -> str:
    x = f"CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
    y = f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
    return (f"CASE WHEN STDDEV_POP({x}) * STDDEV_POP({y}) = 0 THEN NULL ELSE COVAR_POP({x}, {y}) / "
            f"(STDDEV_POP({x}) * STDDEV_POP({y})) END")


def _corr_sql() -> str:
    pairs = [(a, b) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i:]]
    agg = ", ".join(f"{_pearson_sql(a, b)} AS r{i}" for i, (a, b) in enumerate(pairs))
    rows = []
    for i, (a, b) in enumerate(pairs):
        r = f"CASE WHEN r{i} IS NOT NULL THEN 1.0 END" if a == b else f"RND(r{i}, 6)"
        rows.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r} AS r FROM cm")
        if a != b:
            rows.append(f"SELECT '{b}', '{a}', {r} FROM cm")
    return with_episodes(" UNION ALL ".join(rows), f"cm AS (SELECT {agg} FROM ep)")


@register("correlation_matrix", _corr_sql())
def q_correlation_matrix(spark, sf):
    return normalize(profile.correlation_matrix(ep(spark, sf), CORR_COLS))


def _target_corr_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, {_pearson_sql(c, 'defaulted_30d')} AS r FROM ep" for c in RAW)
    return with_episodes(
        "SELECT direction, CAST(rank AS BIGINT) AS rank, feature, RND(r, 6) AS r FROM ("
        "SELECT 'positive' AS direction, ROW_NUMBER() OVER (ORDER BY r DESC, feature) AS rank, feature, r FROM tc "
        "UNION ALL SELECT 'negative', ROW_NUMBER() OVER (ORDER BY r ASC, feature), feature, r FROM tc) t "
        "WHERE rank <= 5", f"tc AS (SELECT * FROM ({rows}) x WHERE r IS NOT NULL)")


@register("target_correlation_topk", _target_corr_sql())
def q_target_corr(spark, sf):
    return normalize(profile.target_correlation_topk(ep(spark, sf)))


@register("hash_sample_k")
def q_hash_sample(spark, sf):
    return profile.hash_sample(ep(spark, sf).select("loan_id", "cust_id", "score", "defaulted_30d"), 200)
