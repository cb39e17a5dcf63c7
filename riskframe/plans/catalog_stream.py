"""Registered streaming queries. Each drives a Structured Streaming job over files
derived from the driver tables (availableNow trigger, checkpoint in the shared
folder) and returns the sink read back as a batch DataFrame."""
from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from .. import config as C
from ..operators import drift, model
from ..session import scratch_path
from ..sources import io
from ..sources.testview import expand_rnd, fixed_score, table, with_episodes
from ..streaming import stream as S
from .catalog import ep, feats, period_psi_sql
from .catalog_model import scorecard_bundle
from .catalog_scores import DEP, SC, deployment_threshold, scored
from .registry import normalize, register

REF_END = "2024-01-08"  # reference window = first 7 days of the events month
REQ_COLS = ["loan_id", "draw_date"] + C.RAW_FEATURE_COLUMNS


def _request_files(spark, sf: str, n_files: int = 8) -> str:
    """Episodes (raw request fields) as several time-ordered files: the request log."""
    path = scratch_path(spark, "requests")
    ep(spark, sf).select(*REQ_COLS).repartitionByRange(n_files, "draw_date", "loan_id").write.parquet(path)
    return path


def _event_files(spark, sf: str, n_files: int = 8, copies: int = 1) -> str:
    path = scratch_path(spark, "events")
    ev = table(spark, sf, "events")
    for _ in range(copies):
        ev.repartitionByRange(n_files, "ts").write.mode("append").parquet(path)
    return path


def _quarantine_sql() -> str:
    tags = []
    for r in C.REQUEST_RULES:
        bad = {"ge": f"{r.name} < {r.bound}", "gt": f"{r.name} <= {r.bound}", "le": f"{r.name} > {r.bound}"}[r.op]
        tags.append(f"CASE WHEN {r.name} IS NULL OR {bad} THEN '{r.name}:{r.op}:{r.bound}' END")
    arr = f"list_filter([{', '.join(tags)}], lambda x: x IS NOT NULL)"
    return with_episodes(f"SELECT loan_id, array_to_string({arr}, ',') AS violations, len({arr}) = 0 AS valid, "
                         f"CASE WHEN len({arr}) = 0 THEN 'valid' ELSE 'quarantine' END AS sink FROM ep")


@register("stream_quarantine", _quarantine_sql())
def q_stream_quarantine(spark, sf):
    src = S.file_stream(spark, _request_files(spark, sf), max_files=2)
    out, ckpt = S.scratch(spark, "quarantine")
    S.quarantine_stream(src, out, ckpt)
    valid = spark.read.parquet(f"{out}/valid").withColumn("sink", F.lit("valid"))
    bad = spark.read.parquet(f"{out}/quarantine").withColumn("sink", F.lit("quarantine"))
    return valid.unionByName(bad, allowMissingColumns=True).select("loan_id", "violations", "valid", "sink")


@register("stream_score", with_episodes(
    "SELECT loan_id, RND(score, 6) AS pd, CASE WHEN score >= d.threshold THEN 'DECLINE' ELSE 'APPROVE' END AS decision, "
    "RND(d.threshold, 6) AS threshold, 'scorecard-fixed-1' AS model_version FROM ep CROSS JOIN dep d",
    SC + ",\n" + DEP))
def q_stream_score(spark, sf):
    t_row = deployment_threshold(scored(spark, sf)).first()
    t = float(t_row["_t"]) if t_row else C.CONFIGURED_THRESHOLD
    src = S.file_stream(spark, _request_files(spark, sf), max_files=2)
    out, ckpt = S.scratch(spark, "scores")
    S.score_stream(src, lambda d: d.withColumn("score", fixed_score()), t, out, ckpt, "scorecard-fixed-1")
    return normalize(spark.read.parquet(out).select("loan_id", "pd", "decision", "threshold", "model_version"))


@register("stream_score_model")
def q_stream_score_model(spark, sf):
    root = scratch_path(spark, "models")
    model.save_bundle(spark, scorecard_bundle(spark, sf, "scorecard-1"), root)
    src = S.file_stream(spark, _request_files(spark, sf), max_files=2)
    out, ckpt = S.scratch(spark, "model-scores")
    S.score_stream_bundle(src, model.load_bundle(spark, root), out, ckpt)
    return normalize(spark.read.parquet(out).select("loan_id", "raw_score", "pd", "decision", "threshold", "model_version"))


def _psi_stream_query(spark, sf, window: str, slide: str | None):
    ref = table(spark, sf, "events").where(F.col("ts") < F.lit(REF_END).cast("timestamp_ntz")) \
        .select(F.col("value").cast("double").alias("value"))
    edges, props = S.reference_bins(ref, "value")
    src = S.file_stream(spark, _event_files(spark, sf), max_files=4).withColumn("ts", F.col("ts").cast("timestamp"))
    out, ckpt = S.scratch(spark, "psi")
    S.psi_stream(src, edges, props, out, ckpt, "value", window, slide)
    return S.psi_from_counts(spark.read.parquet(f"{out}/counts"), props)


#: Span of one delivered slice of the request log, and so how late a row of it may be.
SLICE_DAYS = 60


def _request_slices(spark, src, time_col: str, days: int = SLICE_DAYS) -> str:
    """A request log as it is delivered: one slice of days after the other, each in files of its own."""
    path = scratch_path(spark, "request-slices")
    ends = src.agg(F.min(time_col).alias("a"), F.max(time_col).alias("b")).first()
    at = ends.a
    while at is not None and at <= ends.b:
        nxt = at + datetime.timedelta(days=days)
        src.where((F.col(time_col) >= F.lit(at)) & (F.col(time_col) < F.lit(nxt))).write.mode("append").parquet(path)
        at = nxt
    return path


def _psi_features_sql() -> str:
    """PSI of every 30-day window of the last split against the first one (windows start at multiples of 30 days from 1970)."""
    start = "TIMESTAMP '1970-01-01' + to_days(CAST(30 * FLOOR(date_diff('day', DATE '1970-01-01', {d}) / 30) AS INTEGER))"
    return period_psi_sql(
        f"strftime({start.format(d='CAST(e.draw_date AS DATE)')}, '%Y-%m-%d %H:%M:%S')", "window_start",
        "strftime(CAST(s.window_start AS TIMESTAMP) + INTERVAL 30 DAY, '%Y-%m-%d %H:%M:%S') AS window_end, ")


@register("stream_psi_features", _psi_features_sql())
def q_stream_psi_features(spark, sf):
    path = scratch_path(spark, "reference-profile")
    io.write_table(drift.reference_profile(feats(spark, sf, "train"), C.RAW_FEATURE_COLUMNS), path)
    profile = io.read_profile(spark, path)
    log = ep(spark, sf).where(F.col("split") == "oot").select(F.col("draw_date").cast("timestamp").alias("ts"), *C.RAW_FEATURE_COLUMNS)
    out, ckpt = S.scratch(spark, "psi-features")
    S.psi_features_stream(S.file_stream(spark, _request_slices(spark, log, "ts"), max_files=4), profile, out, ckpt,
                          window="30 days", watermark=f"{SLICE_DAYS} days")
    return normalize(S.psi_of_windows(spark, out, profile).select(
        "window_start", "window_end", "feature", "psi", "status", "n_ref", "n_cur", "n_out_of_range"))


def _psi_sql(win_days: int) -> str:
    step = 1.0 / C.PSI_BINS
    probs = ", ".join(f"{p!r}::DOUBLE" for p in [i * step for i in range(C.PSI_BINS)] + [1.0])
    starts = ("date_trunc('day', ts)" if win_days == 1 else
              f"UNNEST([date_trunc('day', ts) - to_days(k) FOR k IN range({win_days})])")
    return expand_rnd(
        "WITH ref AS (SELECT CAST(value AS DOUBLE) AS value FROM events WHERE ts < TIMESTAMP '" + REF_END + "' "
        "AND value IS NOT NULL),\n"
        f"pq AS (SELECT quantile_cont(value, [{probs}]) AS qs FROM ref),\n"
        "pe AS (SELECT list_sort(list_distinct(list_concat([qs[1] - 1e-6], qs[2:len(qs) - 1], "
        "[qs[len(qs)] + 1e-6]))) AS edges FROM pq),\n"
        "rbin AS (SELECT CASE WHEN r.value >= edges[1] AND r.value <= edges[len(edges)] THEN CASE WHEN "
        "r.value = edges[len(edges)] THEN len(edges) - 2 ELSE len(list_filter(edges, lambda e: e <= r.value)) - 1 END "
        "END AS bin FROM ref r CROSS JOIN pe),\n"
        "bins AS (SELECT UNNEST(range(0, len(edges) - 1)) AS bin FROM pe),\n"
        "rp AS (SELECT b.bin, GREATEST(COALESCE(c.n, 0) / GREATEST((SELECT COUNT(*) FROM rbin WHERE bin IS NOT NULL), 1), "
        "1e-6) AS rp FROM bins b LEFT JOIN (SELECT bin, COUNT(*) AS n FROM rbin WHERE bin IS NOT NULL GROUP BY bin) c "
        "ON b.bin = c.bin),\n"
        f"cur AS (SELECT {starts} AS window_start, CAST(value AS DOUBLE) AS value FROM events WHERE value IS NOT NULL),\n"
        "cb AS (SELECT window_start, CASE WHEN c.value >= edges[1] AND c.value <= edges[len(edges)] THEN CASE WHEN "
        "c.value = edges[len(edges)] THEN len(edges) - 2 ELSE len(list_filter(edges, lambda e: e <= c.value)) - 1 END "
        "END AS bin FROM cur c CROSS JOIN pe),\n"
        "wins AS (SELECT window_start, COUNT(*) AS n_cur, COUNT(*) FILTER (WHERE bin IS NULL) AS n_out_of_range "
        "FROM cb GROUP BY window_start),\n"
        "full_ AS (SELECT w.window_start, r.bin, r.rp, COALESCE(c.n, 0) AS cur_n FROM wins w CROSS JOIN rp r LEFT JOIN "
        "(SELECT window_start, bin, COUNT(*) AS n FROM cb WHERE bin IS NOT NULL GROUP BY ALL) c ON "
        "c.window_start = w.window_start AND c.bin = r.bin),\n"
        "ct AS (SELECT window_start, SUM(cur_n) AS ct FROM full_ GROUP BY window_start),\n"
        "psi AS (SELECT f.window_start, RND(SUM((GREATEST(f.cur_n / GREATEST(t.ct, 1), 1e-6) - f.rp) * "
        "LN(GREATEST(f.cur_n / GREATEST(t.ct, 1), 1e-6) / f.rp)), 4) AS psi FROM full_ f JOIN ct t ON "
        "f.window_start = t.window_start GROUP BY f.window_start)\n"
        "SELECT strftime(p.window_start, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(p.window_start + "
        f"INTERVAL {win_days} DAY, '%Y-%m-%d %H:%M:%S') AS window_end, RND(p.psi, 6) AS psi, w.n_cur, w.n_out_of_range, "
        "CASE WHEN p.psi >= 0.25 THEN 'ALERT' WHEN p.psi >= 0.1 THEN 'warn' ELSE 'stable' END AS status "
        "FROM psi p JOIN wins w ON p.window_start = w.window_start")


@register("stream_psi_daily", _psi_sql(1))
def q_stream_psi_daily(spark, sf):
    return normalize(_psi_stream_query(spark, sf, "1 day", None))


@register("stream_psi_sliding", _psi_sql(7))
def q_stream_psi_sliding(spark, sf):
    return normalize(_psi_stream_query(spark, sf, "7 days", "1 day"))


@register("stream_psi_alerts", "SELECT * FROM (" + _psi_sql(1) + ") a WHERE status = 'ALERT'")
def q_stream_psi_alerts(spark, sf):
    return normalize(S.alerts(_psi_stream_query(spark, sf, "1 day", None)))


@register("stream_dedup", expand_rnd("SELECT event_id, user_id, event_type, RND(value, 6) AS value FROM events"))
def q_stream_dedup(spark, sf):
    src = S.file_stream(spark, _event_files(spark, sf, copies=2), max_files=4).withColumn(
        "ts", F.col("ts").cast("timestamp"))
    out, ckpt = S.scratch(spark, "dedup")
    S.dedup_stream(src, ["event_id"], out, ckpt)
    return normalize(spark.read.parquet(out).select("event_id", "user_id", "event_type", "value"))
