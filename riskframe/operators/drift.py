"""Population Stability Index and drift reports.

All features are handled by one plan: both sides are unpivoted to
(feature, value), the reference's exact deciles come from K8 (a table of
features x 11 edges, broadcast), each value is binned by binary search, and
one groupBy(feature, bin) counts both sides at once. Every bin of every
feature is generated from the edge table and left-joined, so empty bins count 0.

Reference semantics kept: nulls dropped; edges = linear quantiles of the
reference at linspace(0, 1, bins+1), outer edges padded by 1e-6, duplicates
removed; bins are left-closed with the last one closed; current values
outside the edges are dropped from both numerator and denominator;
proportions floored at 1e-6; PSI rounded to 4 dp; an empty side gives null.
`n_out_of_range` is reported beside PSI because that drop hides real drift.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.prims import round_dp, bin_index_fast, check_row, fmt_num, long_form, quantile_array
from ..session import materialize
from .quality import SEQ_DRIFT


def psi_probs(bins: int = C.PSI_BINS) -> list[float]:
    """numpy.linspace(0, 1, bins + 1) exactly (step * i, last point pinned to 1)."""
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def psi_edges(reference: DataFrame, cols: Sequence[str], bins: int = C.PSI_BINS, mode: str = "quantile") -> DataFrame:
    """(feature, edges array<double>, n_ref) from the reference's exact quantiles.

    mode "quantile": outer edges padded by 1e-6 (reference semantics, values outside
    are dropped); mode "open": outer edges at -inf / +inf so every value is binned.
    """
    ref = long_form(reference, [], cols).where(F.col("value").isNotNull())
    q = quantile_array(ref, ["feature"], "value", psi_probs(bins), alias="_q")
    last = F.size("_q")
    if mode == "open":
        lo, hi = F.lit(float("-inf")), F.lit(float("inf"))
    else:
        lo, hi = F.element_at("_q", 1) - C.PSI_EDGE_PAD, F.element_at("_q", -1) + C.PSI_EDGE_PAD
    padded = F.concat(F.array(lo), F.slice("_q", 2, last - 2), F.array(hi))
    return q.select("feature", F.array_sort(F.array_distinct(padded)).alias("edges"), F.col("n").alias("n_ref"))


def psi_table(reference: DataFrame, current: DataFrame, cols: Sequence[str],
              bins: int = C.PSI_BINS, mode: str = "quantile") -> DataFrame:
    """Per feature: psi (4 dp, null if a side is empty), n_ref, n_cur, n_bins, n_out_of_range."""
    cols = [c for c in cols if c in reference.columns and c in current.columns]
    # features x bins edge table, read by four branches below: materialize it once
    edges = materialize(psi_edges(reference, cols, bins, mode))
    ref = long_form(reference, [], cols).where(F.col("value").isNotNull()).withColumn("_side", F.lit(0))
    cur = long_form(current, [], cols).where(F.col("value").isNotNull()).withColumn("_side", F.lit(1))
    both = ref.unionByName(cur).join(F.broadcast(edges.select("feature", "edges")), "feature")
    k = F.size("edges") - 1
    hi = F.element_at("edges", -1)
    idx = bin_index_fast("value", "edges", bins + 1) - 1
    idx = F.when(F.col("value") == hi, k - 1).otherwise(idx)
    inside = (F.col("value") >= F.element_at("edges", 1)) & (F.col("value") <= hi)
    binned = both.select("feature", "_side", F.when(inside, idx).alias("bin"))
    # one pass over both sides: features x (bins and out of range) rows, which also hold the sizes
    counts = materialize(binned.groupBy("feature", "bin").agg(
        F.count_if(F.col("_side") == 0).alias("ref_n"), F.count_if(F.col("_side") == 1).alias("cur_n")))
    sizes = counts.groupBy("feature").agg(
        F.sum("cur_n").alias("n_cur_all"),
        F.sum(F.when(F.col("bin").isNull(), F.col("cur_n")).otherwise(0)).alias("n_out_of_range"))
    all_bins = edges.select("feature", F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin"))
    full = (all_bins.join(counts.where(F.col("bin").isNotNull()), ["feature", "bin"], "left")
                    .fillna(0, ["ref_n", "cur_n"]))
    tot = full.groupBy("feature").agg(F.sum("ref_n").alias("ref_tot"), F.sum("cur_n").alias("cur_tot"),
                                      F.count(F.lit(1)).alias("n_bins"))
    term = full.join(tot, "feature").select(
        "feature",
        F.greatest(F.col("ref_n") / F.greatest(F.col("ref_tot"), F.lit(1)), F.lit(C.PSI_FLOOR)).alias("rp"),
        F.greatest(F.col("cur_n") / F.greatest(F.col("cur_tot"), F.lit(1)), F.lit(C.PSI_FLOOR)).alias("cp"))
    psi = term.groupBy("feature").agg(
        F.sum((F.col("cp") - F.col("rp")) * F.log(F.col("cp") / F.col("rp"))).alias("psi_raw"))
    feats = edges.select("feature", "n_ref")
    out = (feats.join(psi, "feature", "left").join(tot, "feature", "left")
                .join(sizes, "feature", "left"))
    return out.select(
        "feature",
        F.when(F.col("n_cur_all") > 0, round_dp("psi_raw", 4)).alias("psi"),
        F.col("n_ref").cast("long").alias("n_ref"),
        F.coalesce(F.col("n_cur_all"), F.lit(0)).cast("long").alias("n_cur"),
        F.col("n_bins").cast("long").alias("n_bins"),
        F.coalesce(F.col("n_out_of_range"), F.lit(0)).cast("long").alias("n_out_of_range"))


def bin_counts(df: DataFrame, edges: DataFrame, cols: Sequence[str], max_edges: int, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., feature, bin, n): values per bin; bin null counts those outside the edges, nulls count 0."""
    rows = long_form(df, keys, cols).join(F.broadcast(edges.select("feature", "edges")), "feature")
    hi = F.element_at("edges", -1)
    idx = F.when(F.col("value") == hi, F.size("edges") - 2).otherwise(bin_index_fast("value", "edges", max_edges) - 1)
    inside = (F.col("value") >= F.element_at("edges", 1)) & (F.col("value") <= hi)
    return rows.select(*keys, "feature", "value", F.when(inside, idx).alias("bin")) \
               .groupBy(*keys, "feature", "bin").agg(F.count("value").alias("n"))


def reference_profile(reference: DataFrame, cols: Sequence[str], bins: int = C.PSI_BINS,
                      mode: str = "quantile") -> DataFrame:
    """What drift needs of a reference: (feature, edges, n_ref, ref_n), one row per feature.

    `ref_n` holds the values per bin. Saved once (`sources.io.write_table`), it
    stands in for the reference in every later `psi_from_profile`. A feature
    without values has no row.
    """
    cols = [c for c in cols if c in reference.columns]
    edges = materialize(psi_edges(reference, cols, bins, mode))
    counts = bin_counts(reference, edges, cols, bins + 1).where(F.col("bin").isNotNull())
    held = counts.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("held"))
    every = F.sequence(F.lit(0), F.size("edges") - 2)
    return edges.join(held, "feature", "left").select(
        "feature", "edges", F.col("n_ref").cast("long").alias("n_ref"),
        F.transform(every, lambda b: F.coalesce(F.col("held")[b], F.lit(0).cast("long"))).alias("ref_n"))


def psi_from_profile(profile: DataFrame, current: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """`psi_table` against a saved reference profile, per period (or whatever `keys` are) of `current`.

    One scan of `current`, none of the reference. Features that `current` lacks are
    skipped; a period whose values of a feature are all null has a null psi; null
    keys are a period of their own; an empty `current` gives no rows.
    """
    sizes = {r.feature: r.k for r in profile.select("feature", F.size("edges").alias("k")).collect()}
    cols = [c for c in sizes if c in current.columns]
    return psi_of_counts(profile, bin_counts(current, profile, cols, max([2, *sizes.values()]), keys), keys)


def psi_of_counts(profile: DataFrame, counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """PSI per (keys, feature) of counted bins (keys..., feature, bin, n) against a reference profile."""
    per = counts.groupBy(*keys, "feature").agg(
        F.sum("n").alias("n_cur"), F.sum(F.when(F.col("bin").isNull(), F.col("n")).otherwise(0)).alias("n_out"),
        F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "n")))).alias("held"))
    j = per.join(F.broadcast(profile), "feature")
    every = F.sequence(F.lit(0), F.size("ref_n") - 1)
    cur_n = F.transform(every, lambda b: F.coalesce(F.col("held")[b], F.lit(0).cast("long")))
    in_ref = F.aggregate("ref_n", F.lit(0).cast("long"), lambda a, x: a + x)

    def share(n, total):
        return F.greatest(n / F.greatest(total, F.lit(1)), F.lit(C.PSI_FLOOR))
    j = j.withColumn("cur_n", cur_n).withColumn("rt", in_ref).withColumn("ct", F.col("n_cur") - F.col("n_out"))
    terms = F.zip_with("cur_n", "ref_n", lambda c, r: (share(c, F.col("ct")) - share(r, F.col("rt")))
                       * F.log(share(c, F.col("ct")) / share(r, F.col("rt"))))
    psi = F.when(F.col("n_cur") > 0, round_dp(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), 4))
    return j.select(*keys, "feature", psi.alias("psi"), "n_ref", "n_cur",
                    F.size("ref_n").cast("long").alias("n_bins"), F.col("n_out").alias("n_out_of_range")) \
            .withColumn("status", drift_status(F.col("psi")))


def category_psi(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PSI with one bin per distinct value (for low-cardinality flags the quantile form is blind to)."""
    ref = long_form(reference, [], cols).where(F.col("value").isNotNull()).withColumn("_side", F.lit(0))
    cur = long_form(current, [], cols).where(F.col("value").isNotNull()).withColumn("_side", F.lit(1))
    counts = ref.unionByName(cur).groupBy("feature", "value").agg(
        F.count_if(F.col("_side") == 0).alias("ref_n"), F.count_if(F.col("_side") == 1).alias("cur_n"))
    tot = counts.groupBy("feature").agg(F.sum("ref_n").alias("rt"), F.sum("cur_n").alias("ct"))
    t = counts.join(tot, "feature").select(
        "feature", "rt", "ct",
        F.greatest(F.col("ref_n") / F.greatest("rt", F.lit(1)), F.lit(C.PSI_FLOOR)).alias("rp"),
        F.greatest(F.col("cur_n") / F.greatest("ct", F.lit(1)), F.lit(C.PSI_FLOOR)).alias("cp"))
    return t.groupBy("feature").agg(
        F.when((F.first("rt") > 0) & (F.first("ct") > 0),
               round_dp(F.sum((F.col("cp") - F.col("rp")) * F.log(F.col("cp") / F.col("rp"))), 4))
        .alias("psi_category"),
        F.count(F.lit(1)).cast("long").alias("n_values"))


def drift_status(psi_col, warn: float = C.PSI_WARN, alert: float = C.PSI_ALERT):
    """ALERT / warn / stable; a null (NaN) PSI is 'stable', as in the reference."""
    return F.when(psi_col >= alert, "ALERT").when(psi_col >= warn, "warn").otherwise("stable")


def drift_report(reference: DataFrame, current: DataFrame, cols: Sequence[str],
                 warn: float = C.PSI_WARN, alert: float = C.PSI_ALERT) -> DataFrame:
    """Per feature PSI + status; features missing on either side are skipped."""
    t = psi_table(reference, current, cols)
    return t.select("feature", "psi", drift_status(F.col("psi"), warn, alert).alias("status"),
                    "n_ref", "n_cur", "n_out_of_range")


def drift_checks(reference: DataFrame, current: DataFrame, cols: Sequence[str],
                 warn: float = C.PSI_WARN, alert: float = C.PSI_ALERT) -> DataFrame:
    """Drift as check rows: >= alert error, >= warn warning, else info; null PSI omitted (A10)."""
    order = {c: i for i, c in enumerate(cols)}
    t = psi_table(reference, current, cols).where(F.col("psi").isNotNull())
    seq_map = F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(SEQ_DRIFT + 1 + i))])
    psi = F.col("psi")
    is_alert, is_warn = psi >= alert, psi >= warn
    txt = fmt_num(psi, 4)
    msg = (F.when(is_alert, F.concat(F.col("feature"), F.lit(": PSI="), txt,
                                     F.lit(f" exceeds ALERT threshold {alert}")))
            .when(is_warn, F.concat(F.col("feature"), F.lit(": PSI="), txt,
                                    F.lit(f" exceeds WARN threshold {warn}")))
            .otherwise(F.concat(F.col("feature"), F.lit(": PSI="), txt, F.lit(" (stable)"))))
    row = check_row(seq_map[F.col("feature")], F.concat(F.lit("drift.psi."), F.col("feature")),
                    ~is_warn, F.when(is_alert, "error").when(is_warn, "warning").otherwise("info"),
                    psi, F.when(is_alert, F.lit(alert)).when(is_warn, F.lit(warn)), msg)
    return t.select(row.alias("c")).select("c.*")
