"""Structured Streaming jobs (ST1-ST6).

* quarantine_stream: per-row request rules; valid rows and quarantined rows go
  to two sinks from one `foreachBatch`, written under `batch_id=<n>` with
  overwrite, so a replayed micro-batch rewrites the same files (idempotent).
* score_stream: stateless scoring + decision + audit columns, append sink.
* psi_stream: event-time windows (tumbling or sliding) of binned values with a
  watermark; state is windows x bins only. The PSI of every window against a
  fixed reference is computed from the window counts in `foreachBatch`.
* psi_features_stream: the same for many features against a saved reference
  profile, in update mode with state that the watermark evicts.
* dedup_stream: replayed requests dropped with `dropDuplicatesWithinWatermark`.

Every job checkpoints in the shared checkpoint folder, so a restarted driver
or lost executor resumes from the last committed offsets.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.prims import bin_index_fast, round_dp
from ..operators import quality
from ..operators.drift import bin_counts, drift_status, psi_edges, psi_of_counts
from ..operators.model import Bundle, score_bundle
from ..session import materialize, scratch_path


def events_stream(spark: SparkSession, sf_dir: str, max_files: int = 1) -> DataFrame:
    """Stream the events table of a folder; timestamps cast to TIMESTAMP for watermarks."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    s = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
         .option("maxFilesPerTrigger", max_files).parquet(sf_dir))
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def file_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def run_available(writer):
    """Start with the availableNow trigger and wait, as long as it takes, for the backlog to drain."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def quarantine_stream(src: DataFrame, out: str, ckpt: str,
                      rules=C.REQUEST_RULES) -> None:
    """ST1: tag requests, write valid and quarantined rows to their own sinks per batch."""
    tagged = quality.quarantine(src, rules)

    def sink(batch: DataFrame, batch_id: int) -> None:
        b = batch.withColumn("violations", F.array_join("violations", ","))
        b.where("valid").write.mode("overwrite").parquet(f"{out}/valid/batch_id={batch_id}")
        b.where(~F.col("valid")).write.mode("overwrite").parquet(f"{out}/quarantine/batch_id={batch_id}")
    run_available(tagged.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt))


def score_stream(src: DataFrame, score_fn: Callable[[DataFrame], DataFrame], threshold: float,
                 out: str, ckpt: str, model_version: str = "v1") -> None:
    """ST2: stateless scoring with decision and audit columns, appended to Parquet."""
    scored = score_fn(src)
    audit = scored.select(
        "loan_id", F.col("score").alias("pd"),
        F.when(F.col("score") >= threshold, "DECLINE").otherwise("APPROVE").alias("decision"),
        F.lit(float(threshold)).alias("threshold"), F.lit(model_version).alias("model_version"),
        F.to_json(F.struct(*[F.col(c) for c in C.RAW_FEATURE_COLUMNS if c in src.columns])).alias("features_json"))
    run_available(audit.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
                  .outputMode("append"))


def score_stream_bundle(src: DataFrame, bundle: Bundle, out: str, ckpt: str) -> None:
    """ST2 with a saved model: score, decision, threshold and version come from the bundle.

    The checkpoint belongs to one version: score the backlog of another version
    with a checkpoint of its own.
    """
    scored = score_bundle(bundle, src)
    audit = scored.select(
        "loan_id", "raw_score", F.col("score").alias("pd"), "decision", F.col("threshold_used").alias("threshold"),
        "model_version", F.to_json(F.struct(*[F.col(c) for c in C.RAW_FEATURE_COLUMNS if c in src.columns])).alias("features_json"))
    run_available(audit.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
                  .outputMode("append"))


def reference_bins(reference: DataFrame, value_col: str, bins: int = C.PSI_BINS) -> tuple[DataFrame, DataFrame]:
    """Edges (one row) and reference proportions per bin from a batch reference window."""
    e = materialize(psi_edges(reference.select(F.col(value_col).alias("value")), ["value"], bins).select("edges"))
    k = F.size("edges") - 1
    x = F.col(value_col)
    hi = F.element_at("edges", -1)
    idx = F.when(x == hi, k - 1).otherwise(bin_index_fast(f"`{value_col}`", "edges", bins + 1) - 1)
    inside = (x >= F.element_at("edges", 1)) & (x <= hi)
    r = reference.where(x.isNotNull()).crossJoin(F.broadcast(e)).select(F.when(inside, idx).alias("bin"))
    all_bins = e.select(F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin"))
    cnt = r.where(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("ref_n"))
    full = all_bins.join(cnt, "bin", "left").fillna(0, ["ref_n"])
    tot = full.agg(F.sum("ref_n").alias("rt"))
    props = full.crossJoin(tot).select(
        "bin", F.greatest(F.col("ref_n") / F.greatest("rt", F.lit(1)), F.lit(C.PSI_FLOOR)).alias("rp"))
    # both are bins-sized; materialized so micro-batches never recompute the reference
    return e, materialize(props)


def psi_stream(src: DataFrame, edges: DataFrame, ref_props: DataFrame, out: str, ckpt: str,
               value_col: str = "value", window: str = "1 day", slide: str | None = None,
               watermark: str = "1 hour", bins: int = C.PSI_BINS, state_partitions: int = 4) -> None:
    """ST3/ST4: windowed bin counts with a watermark; PSI per window vs the reference.

    Complete output mode makes every trigger deliver the full (windows x bins)
    result; each trigger overwrites the `counts` snapshot (idempotent on replay),
    so the final snapshot equals the batch computation. The state is bounded by
    windows x bins, not by rows. `psi_from_counts` turns a snapshot into PSI rows.
    """
    x = F.col(value_col)
    k = F.size("edges") - 1
    hi = F.element_at("edges", -1)
    idx = F.when(x == hi, k - 1).otherwise(bin_index_fast(f"`{value_col}`", "edges", bins + 1) - 1)
    inside = (x >= F.element_at("edges", 1)) & (x <= hi)
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    binned = (src.withWatermark("ts", watermark).where(x.isNotNull()).crossJoin(F.broadcast(edges))
              .withColumn("bin", F.when(inside, idx)))
    counts = binned.groupBy(w.alias("w"), "bin").agg(F.count(F.lit(1)).alias("cur_n"))
    # The state is windows x bins and rows are pre-aggregated before the state
    # shuffle, so a few state partitions suffice at any input rate; the number is
    # fixed into the checkpoint when the query first starts.
    spark = src.sparkSession
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        run_available(counts.writeStream.outputMode("complete")
                      .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/counts"))
                      .option("checkpointLocation", ckpt))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)


def psi_from_counts(counts: DataFrame, ref_props: DataFrame) -> DataFrame:
    """PSI per window from (w, bin, cur_n) window counts and reference proportions.

    The inputs are windows x bins and bins rows -- small tables whatever the stream rate.
    """
    c = counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "bin", "cur_n")
    wins = c.select("window_start", "window_end").distinct()
    n_all = c.groupBy("window_start", "window_end").agg(
        F.sum("cur_n").alias("n_cur"), F.sum(F.when(F.col("bin").isNull(), F.col("cur_n")).otherwise(0))
        .alias("n_out_of_range"))
    full = wins.crossJoin(F.broadcast(ref_props)).join(
        c.where(F.col("bin").isNotNull()), ["window_start", "window_end", "bin"], "left").fillna(0, ["cur_n"])
    tot = full.groupBy("window_start", "window_end").agg(F.sum("cur_n").alias("ct"))
    t = full.join(tot, ["window_start", "window_end"]).withColumn(
        "cp", F.greatest(F.col("cur_n") / F.greatest("ct", F.lit(1)), F.lit(C.PSI_FLOOR)))
    psi = t.groupBy("window_start", "window_end").agg(
        round_dp(F.sum((F.col("cp") - F.col("rp")) * F.log(F.col("cp") / F.col("rp"))), 4).alias("psi"))
    return psi.join(n_all, ["window_start", "window_end"]).withColumn("status", drift_status(F.col("psi")))


def psi_features_stream(src: DataFrame, profile: DataFrame, out: str, ckpt: str, time_col: str = "ts", window: str = "1 day",
                        slide: str | None = None, watermark: str = "1 hour", state_partitions: int = 4) -> None:
    """ST3/ST4 over many features: windowed bin counts against a saved reference profile, in update mode.

    Rows are unpivoted on the stream, binned by the profile's edges and counted per
    (window, feature, bin). A micro-batch writes the counts it changed to a folder
    of its own (`batch_id=<n>`, overwritten on replay), so what is written grows with
    the input and not with the windows seen so far. A window leaves the state once
    the watermark passes its end; rows that arrive later are dropped. `window_counts`
    reads the last count of every window back. Nulls and NaN are not counted (a window
    holding nothing else has n_cur 0); rows without a time belong to no window.
    """
    sizes = {r.feature: r.k for r in profile.select("feature", F.size("edges").alias("k")).collect()}
    cols = [c for c in sizes if c in src.columns]
    w = F.window(time_col, window, slide) if slide else F.window(time_col, window)
    clean = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(c) for c in cols]
    windows = src.withWatermark(time_col, watermark).select(w.alias("w"), *clean)
    counts = bin_counts(windows, profile, cols, max([2, *sizes.values()]), ["w"])
    spark = src.sparkSession
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        run_available(counts.writeStream.outputMode("update")
                      .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch_id={i}"))
                      .option("checkpointLocation", ckpt))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)


def window_counts(spark: SparkSession, out: str) -> DataFrame:
    """(w, feature, bin, n): the last count of every bin of every window; counts only grow, so it is the largest."""
    schema = "w struct<start: timestamp, end: timestamp>, feature string, bin int, n bigint, batch_id bigint"
    return spark.read.schema(schema).parquet(out).groupBy("w", "feature", "bin").agg(F.max("n").alias("n"))


def psi_of_windows(spark: SparkSession, out: str, profile: DataFrame) -> DataFrame:
    """One row per window and feature of a `psi_features_stream` sink."""
    counts = window_counts(spark, out).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                                              "feature", "bin", "n")
    return psi_of_counts(profile, counts, ["window_start", "window_end"])


def alerts(psi_rows: DataFrame) -> DataFrame:
    """ST6: windows whose PSI reaches the alert threshold."""
    return psi_rows.where(F.col("status") == "ALERT")


#: State store that keeps keys on local disk with changelogs in the checkpoint, not in the executors' heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def dedup_stream(src: DataFrame, keys: list[str], out: str, ckpt: str, watermark: str = "31 days"):
    """ST5: drop replayed events by key within the watermark; append the survivors.

    The replay horizon is `watermark`: a copy that arrives while the watermark is
    within that time of the first one is dropped. The watermark itself trails the
    newest row by the horizon, so the state holds the keys of two horizons and no
    more. It lies in RocksDB, whose memory does not grow with it. Rows older than the
    watermark are dropped.
    """
    d = src.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(keys)
    spark, conf = src.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    prev = spark.conf.get(conf)
    spark.conf.set(conf, ROCKSDB)
    try:
        return run_available(d.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
                             .outputMode("append"))
    finally:
        spark.conf.set(conf, prev)


def scratch(spark: SparkSession, name: str) -> tuple[str, str]:
    base = scratch_path(spark, name)
    return f"{base}/out", f"{base}/checkpoint"
