"""Train / validation / test splits and borrower overlap.

All splits are a computed `split` column: no row is moved, filters on the
column push down to Parquet when the table is written partitioned by it.
Random splits are deterministic hashes of a key and a seed, so they are
stable under retries, executor loss and re-runs without any shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.prims import prefix_sum

SCALE = 1_000_000


def temporal_split(df: DataFrame, cfg: C.SplitConfig = C.SplitConfig(), date_col: str = C.DATE_COL) -> DataFrame:
    """train < val_cutoff <= val < oot_cutoff <= oot; a null date is in no split."""
    d = F.col(date_col)
    s = (F.when(d < F.lit(cfg.val_cutoff).cast("date"), "train")
          .when(d < F.lit(cfg.oot_cutoff).cast("date"), "val")
          .when(d.isNotNull(), "oot"))
    return df.withColumn("split", s)


def unit_hash(key: Column, seed: int) -> Column:
    """Deterministic uniform value in [0, 1) from a key and a seed."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(SCALE)).cast("double") / SCALE


def group_split(df: DataFrame, group_col: str = C.GROUP_ID_COL, cfg: C.SplitConfig = C.SplitConfig()) -> DataFrame:
    """Group-aware random split: every row of a group lands in the same part.

    Fractions hold over groups (not rows), as with a group shuffle split.
    """
    tr, va, _ = cfg.fractions
    u = unit_hash(F.col(group_col), cfg.seed)
    return df.withColumn("split", F.when(u < tr, "train").when(u < tr + va, "val").otherwise("oot"))


def stratified_split(df: DataFrame, label: str = C.TARGET_COL, key: str = C.KEY_COL,
                     cfg: C.SplitConfig = C.SplitConfig()) -> DataFrame:
    """Exact stratified split (X3): inside each class, rows are ranked by a seeded hash
    with the two-level prefix sum and cut at the class's fraction boundaries, so
    every class keeps its rate in each part without a global sort."""
    tr, va, _ = cfg.fractions
    # rows without a label are a class of their own: they are split like the others, none is lost
    h = (df.withColumn("_h", F.xxhash64(F.col(key), F.lit(cfg.seed)))
         .withColumn("_class", F.coalesce(F.col(label).cast("string"), F.lit("null"))))
    counts = h.groupBy("_class", "_h").agg(F.count(F.lit(1)).alias("_c"))
    ranked = prefix_sum(counts, ["_class"], "_h", ["_c"])
    j = h.join(ranked.select("_class", "_h", "_c_before", "_c_total"), ["_class", "_h"])
    n = F.col("_c_total")
    # sizes as in a two-step split: temp = ceil(n * (val + test)), test = ceil(temp * test share)
    n_temp = F.ceil(n * (va + cfg.fractions[2]))
    n_train = n - n_temp
    n_test = F.ceil(n_temp * (cfg.fractions[2] / (va + cfg.fractions[2])))
    n_val = n_temp - n_test
    r = F.col("_c_before")
    s = F.when(r < n_train, "train").when(r < n_train + n_val, "val").otherwise("oot")
    return j.withColumn("split", s).select(*df.columns, "split")


def auto_split(df: DataFrame, cfg: C.SplitConfig = C.SplitConfig()) -> tuple[DataFrame, str]:
    """Temporal if a draw date exists, else group-aware, else stratified."""
    if C.DATE_COL in df.columns:
        return temporal_split(df, cfg), "temporal-OOT"
    if C.GROUP_ID_COL in df.columns:
        return group_split(df, C.GROUP_ID_COL, cfg), "group-aware-random"
    return stratified_split(df, cfg=cfg), "stratified-random"


def split_summary(df: DataFrame, label: str = C.TARGET_COL) -> DataFrame:
    """Rows, positives and rate per split."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                   F.sum(F.col(label).cast("long")).alias("n_pos"),
                                   F.avg(F.col(label).cast("double")).alias("rate"))


def join_features_metadata(features: DataFrame, metadata: DataFrame, key: str = C.KEY_COL) -> DataFrame:
    """Key join replacing positional alignment (J1); Catalyst picks the strategy."""
    return features.join(metadata, key)


def borrower_overlap(df: DataFrame, group_col: str = C.GROUP_ID_COL, a: str = "train", b: str = "oot") -> DataFrame:
    """Distinct borrowers of split b that also appear in split a, and their share."""
    ga = df.where(F.col("split") == a).select(group_col).distinct()
    gb = df.where(F.col("split") == b).select(group_col).distinct()
    both = gb.join(ga, group_col, "left_semi")
    nb = gb.agg(F.count(F.lit(1)).alias("n_b"))
    nboth = both.agg(F.count(F.lit(1)).alias("n_overlap"))
    return nb.crossJoin(nboth).select(
        F.col("n_overlap").cast("long").alias("n_overlap"), F.col("n_b").cast("long").alias("n_borrowers"),
        (F.col("n_overlap") / F.greatest(F.col("n_b"), F.lit(1)) * 100).alias("pct_overlap"))
