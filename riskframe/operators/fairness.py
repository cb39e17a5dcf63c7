"""Fairness audit and gate.

Both definitions are computed from ONE aggregation of conditional counts per
(proxy, side); nothing is materialised per group. A23 (audit) rounds the
group rates to 4 dp before forming ratios with a 1e-6 floor, A24 (gate)
uses unrounded rates with a 1e-9 floor, as the reference does; both are kept.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C

# Proxy definitions of the audit: name -> (protected side predicate, side names).
# A null proxy value falls on the reference side ("established" / "clean").
AUDIT_PROXIES = {
    "tenure_proxy": (f"coalesce(tenure_months < {C.THIN_FILE_TENURE}, false)", ("thin_file", "established")),
    "crb_flag_proxy": ("coalesce(crb_flagged = 1, false)", ("crb_flagged", "crb_clean")),
}


def threshold_sql(threshold) -> str:
    """A float threshold as a literal, or the name of a column holding it."""
    if isinstance(threshold, Column):
        raise TypeError("pass the threshold as a float or as the name of its column")
    if isinstance(threshold, str):
        return f"`{threshold}`"
    return f"{float(threshold)!r}D"


def _counts_sql(t: str, score: str, label: str, side: str, tag: str) -> list[str]:
    pred, y = f"(`{score}` >= {t})", f"`{label}`"
    return [f"count_if({side}) AS {tag}_n",
            f"count_if({side} AND NOT {pred} AND {y} = 0) AS {tag}_tn",
            f"count_if({side} AND {pred} AND {y} = 0) AS {tag}_fp",
            f"count_if({side} AND NOT {pred} AND {y} = 1) AS {tag}_fn",
            f"count_if({side} AND {pred} AND {y} = 1) AS {tag}_tp"]


def group_counts(df: DataFrame, threshold, score: str = "score", label: str = "label") -> DataFrame:
    """One row: n/tn/fp/fn/tp for both sides of every audit proxy (single scan)."""
    t = threshold_sql(threshold)
    aggs = []
    for name, (side, _) in AUDIT_PROXIES.items():
        aggs += _counts_sql(t, score, label, side, f"{name}_a") + _counts_sql(t, score, label, f"NOT {side}", f"{name}_b")
    return df.agg(*[F.expr(a) for a in aggs])


def fairness_audit(df: DataFrame, threshold, score: str = "score", label: str = "label") -> DataFrame:
    """Per proxy: both sides' n, tn, tp, approval, FPR, FNR (4 dp) and ratio columns."""
    from .quality import q, rnd
    row = group_counts(df, threshold, score, label)
    structs = []
    for name, (_, (a_name, b_name)) in AUDIT_PROXIES.items():
        def side(tag):
            n, tn, fp, fn, tp = (f"{name}_{tag}_{k}" for k in ("n", "tn", "fp", "fn", "tp"))
            return (n, tn, tp, rnd(f"try_divide(CAST({tn} + {fn} AS DOUBLE), {n})", 4),
                    rnd(f"{fp} / greatest({fp} + {tn}, 1)", 4), rnd(f"{fn} / greatest({fn} + {tp}, 1)", 4))
        an, atn, atp, aa, afpr, afnr = side("a")
        bn, btn, btp, ba, bfpr, bfnr = side("b")
        di = f"({aa} / greatest({ba}, 1e-6D))"
        structs.append(
            f"named_struct('proxy', {q(name)}, 'group_a', {q(a_name)}, 'group_b', {q(b_name)}, "
            f"'a_n', CAST({an} AS BIGINT), 'a_n_true_negative', CAST({atn} AS BIGINT), "
            f"'a_n_true_positive', CAST({atp} AS BIGINT), 'a_approval_rate', {aa}, 'a_fpr', {afpr}, 'a_fnr', {afnr}, "
            f"'b_n', CAST({bn} AS BIGINT), 'b_n_true_negative', CAST({btn} AS BIGINT), "
            f"'b_n_true_positive', CAST({btp} AS BIGINT), 'b_approval_rate', {ba}, 'b_fpr', {bfpr}, 'b_fnr', {bfnr}, "
            f"'disparate_impact_ratio', {rnd(di, 4)}, 'fpr_ratio', {rnd(f'{afpr} / greatest({bfpr}, 1e-6D)', 4)}, "
            f"'fnr_ratio', {rnd(f'{afnr} / greatest({bfnr}, 1e-6D)', 4)}, "
            f"'fails_four_fifths_rule', {di} < {C.DI_LOWER_BOUND!r}D)")
    return row.selectExpr(f"inline(array({', '.join(structs)}))")


def fairness_gate(df: DataFrame, threshold,
                  configs: Sequence[C.FairnessConfig] = C.ModelValidationConfig().fairness_configs,
                  score: str = "score", label: str = "label", seq0: int = 300) -> DataFrame:
    """Gate checks per config (A24): DI >= bound (error), FPR/FNR ratios <= max (warnings).

    Unrounded rates; floor 1e-9. A config whose group column is absent, or one of
    whose sides is empty, yields no rows. Group membership is plain equality, so a
    null group value is on neither side.
    """
    from ..functions.prims import CHECK_SCHEMA
    from .quality import fmt, q, rnd, row_sql
    usable = [fc for fc in configs if fc.group_col in df.columns]
    if not usable:
        return df.sparkSession.createDataFrame([], CHECK_SCHEMA)
    t = threshold_sql(threshold)
    aggs = []
    for i, fc in enumerate(usable):
        g = f"`{fc.group_col}`"
        aggs += (_counts_sql(t, score, label, f"coalesce({g} = {fc.group_a_label!r}, false)", f"g{i}_a")
                 + _counts_sql(t, score, label, f"coalesce({g} = {fc.group_b_label!r}, false)", f"g{i}_b"))
    row = df.agg(*[F.expr(a) for a in aggs])
    cands = []
    for i, fc in enumerate(usable):
        def rates(tag):
            n, tn, fp, fn, tp = (f"g{i}_{tag}_{k}" for k in ("n", "tn", "fp", "fn", "tp"))
            return (n, f"(({tn} + {fn}) / greatest({n}, 1))", f"({fp} / greatest({fp} + {tn}, 1))",
                    f"({fn} / greatest({fn} + {tp}, 1))")
        an, aa, afpr, afnr = rates("a")
        bn, ba, bfpr, bfnr = rates("b")
        keep = f"({an} > 0 AND {bn} > 0)"
        lab = f"{fc.group_a_label}/{fc.group_b_label}"
        di = f"({aa} / greatest({ba}, 1e-9D))"
        fr = f"({afpr} / greatest({bfpr}, 1e-9D))"
        nr = f"({afnr} / greatest({bfnr}, 1e-9D))"
        di_ok, fr_ok, nr_ok = (f"{di} >= {fc.di_lower_bound!r}D", f"{fr} <= {fc.max_fpr_ratio!r}D",
                               f"{nr} <= {fc.max_fnr_ratio!r}D")
        base = seq0 + 10 * i

        def f4(e):
            return fmt(rnd(e, 4), 4)
        cands += [
            f"named_struct('k', {keep}, 'r', " + row_sql(
                base + 1, q(f"fairness.di.{fc.group_col}"), di_ok, f"CASE WHEN {di_ok} THEN 'info' ELSE 'error' END",
                rnd(di, 4), f"{fc.di_lower_bound!r}D",
                f"concat({q(f'DI({lab})=')}, {f4(di)}, CASE WHEN {di_ok} THEN ' >= ' ELSE ' < ' END, "
                f"{q(str(fc.di_lower_bound))})") + ")",
            f"named_struct('k', {keep}, 'r', " + row_sql(
                base + 2, q(f"fairness.fpr_ratio.{fc.group_col}"), fr_ok,
                f"CASE WHEN {fr_ok} THEN 'info' ELSE 'warning' END", rnd(fr, 4), f"{fc.max_fpr_ratio!r}D",
                f"concat({q(f'FPR ratio({lab})=')}, {f4(fr)}, ' (a=', {f4(afpr)}, ', b=', {f4(bfpr)}, ')')") + ")",
            f"named_struct('k', {keep}, 'r', " + row_sql(
                base + 3, q(f"fairness.fnr_ratio.{fc.group_col}"), nr_ok,
                f"CASE WHEN {nr_ok} THEN 'info' ELSE 'warning' END", rnd(nr, 4), f"{fc.max_fnr_ratio!r}D",
                f"concat({q(f'FNR ratio({lab})=')}, {f4(nr)}, ' (a=', {f4(afnr)}, ', b=', {f4(bfnr)}, ')')") + ")",
        ]
    return row.selectExpr(f"explode(filter(array({', '.join(cands)}), s -> s.k)) AS s").select("s.r.*")


def with_gate_groups(df: DataFrame) -> DataFrame:
    """Add the gate's group columns: thin_file = int(tenure < 12) (null tenure -> 0)."""
    return df.withColumn("thin_file", F.coalesce(F.col("tenure_months") < C.THIN_FILE_TENURE,
                                                 F.lit(False)).cast("int"))


def ztest_table(df: DataFrame, threshold: float | str, score: str = "score",
                label: str = "label") -> DataFrame:
    """Two-proportion z (pooled) of FPR and FNR between the sides of each proxy.

    Returns one row per (proxy, rate) with the counts and z; p-values are added by
    `ztest_pvalues`.
    """
    row = group_counts(df, threshold, score, label)
    out = []
    for name in AUDIT_PROXIES:
        for rate, (num, other) in (("fpr", ("fp", "tn")), ("fnr", ("fn", "tp"))):
            xa, oa = F.col(f"{name}_a_{num}"), F.col(f"{name}_a_{other}")
            xb, ob = F.col(f"{name}_b_{num}"), F.col(f"{name}_b_{other}")
            na, nb = xa + oa, xb + ob
            pa, pb = F.try_divide(xa.cast("double"), na), F.try_divide(xb.cast("double"), nb)
            pool = F.try_divide((xa + xb).cast("double"), na + nb)
            se = F.sqrt(pool * (1 - pool) * (F.try_divide(F.lit(1.0), na) + F.try_divide(F.lit(1.0), nb)))
            z = F.when(se > 0, (pa - pb) / se)
            out.append(F.struct(F.lit(name).alias("proxy"), F.lit(rate).alias("rate"),
                                xa.cast("long").alias("x_a"), na.cast("long").alias("n_a"),
                                xb.cast("long").alias("x_b"), nb.cast("long").alias("n_b"),
                                pa.alias("rate_a"), pb.alias("rate_b"), z.alias("z")))
    return row.select(F.explode(F.array(*out)).alias("s")).select("s.*")


#: Half width of the tables that Fisher's sum visits around the mode: so many standard deviations and tables more.
#: Beyond it a table weighs less than 1e-300.
FISHER_SDS, FISHER_MORE = 40, 800
#: Tables that one row unfolds into before they are summed.
FISHER_BLOCK = 65_536


def erfc_sql(x: str) -> str:
    """SQL text of erfc(x) for x >= 0: the all-positive series of erf below 2, from there its continued fraction."""
    series = (f"aggregate(sequence(1, 60), struct({x} AS t, {x} AS s), (a, j) -> struct(a.t * 2 * {x} * {x} / (2 * j + 1) AS t, "
              f"a.s + a.t * 2 * {x} * {x} / (2 * j + 1) AS s), a -> a.s)")
    fraction = f"aggregate(sequence(150, 1, -1), 0D, (a, j) -> j / 2D / ({x} + a))"
    return (f"CASE WHEN {x} < 2 THEN 1 - 2 / sqrt(pi()) * exp(-{x} * {x}) * {series} "
            f"ELSE exp(-{x} * {x}) / (sqrt(pi()) * ({x} + {fraction})) END")


def _stirling_error(n: str) -> str:
    """log n! minus Stirling's formula: from log-gamma's recursion below 16, its asymptotic series above."""
    exact = f"(aggregate(sequence(1, 15), 0D, (a, j) -> a + CASE WHEN j <= {n} THEN ln(j) ELSE 0D END) - ({n} + 0.5) * ln({n}) + {n} " \
            "- 0.5 * ln(2 * pi()))"
    series = f"((1 / 12D - (1 / 360D - (1 / 1260D - 1 / 1680D / {n} / {n}) / {n} / {n}) / {n} / {n}) / {n})"
    return f"CASE WHEN {n} <= 0 THEN 0D WHEN {n} < 16 THEN {exact} ELSE {series} END"


def _deviance(x: str, m: str) -> str:
    """x ln(x / m) + m - x without the digits that cancel where x is near m."""
    v = f"(({x} - {m}) / ({x} + {m}))"
    odd = " + ".join(f"pow({v}, {2 * j + 1}) / {2 * j + 1}" for j in range(1, 9))
    near = f"(({x} - {m}) * {v} + 2 * {x} * ({odd}))"
    return f"CASE WHEN {x} <= 0 THEN {m} WHEN abs({x} - {m}) < 0.1 * ({x} + {m}) THEN {near} ELSE {x} * ln({x} / {m}) + {m} - {x} END"


def _log_binomial(x: str, n: str, p: str, q: str) -> str:
    """ln P(x of n) in saddle-point form: as exact for 10^12 as for 10."""
    y = f"({n} - {x})"
    mid = (f"({_stirling_error(n)}) - ({_stirling_error(x)}) - ({_stirling_error(y)}) - ({_deviance(x, f'({n} * {p})')}) "
           f"- ({_deviance(y, f'({n} * {q})')}) - 0.5 * ln(2 * pi() * {x} * ({y} / {n}))")
    return f"CASE WHEN {n} <= 0 THEN 0D WHEN {x} <= 0 THEN {n} * ln({q}) WHEN {y} <= 0 THEN {n} * ln({p}) ELSE {mid} END"


def _log_table(x: str) -> str:
    """ln of the weight of the 2x2 table with x in the first cell (columns na, nb, k): its three binomials at rate k / (na + nb)."""
    return f"({_log_binomial(x, 'na', 'p', 'q')}) + ({_log_binomial(f'(k - {x})', 'nb', 'p', 'q')})"


def fisher_pvalues(z: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, p_fisher): two-sided Fisher exact p of [[x_a, n_a - x_a], [x_b, n_b - x_b]], all in column expressions.

    The p sums the weights of all tables with these margins that weigh no more
    than the given one. Tables lie within FISHER_SDS standard deviations of the
    mode, unfold in blocks of FISHER_BLOCK and are summed in parallel. Sides
    without rows have a null p; margins with a single table have p = 1.
    """
    d = z.where("n_a > 0 AND n_b > 0").selectExpr(
        *keys, "cast(x_a AS double) AS xa", "cast(n_a AS double) AS na", "cast(n_b AS double) AS nb", "cast(x_a + x_b AS double) AS k")
    d = d.selectExpr("*", "k / (na + nb) AS p", "(na + nb - k) / (na + nb) AS q").selectExpr(
        "*", "sqrt(na * p * q * nb / greatest(na + nb - 1, 1D)) AS sd", "na * p AS mode")
    wide = f"({FISHER_SDS} * sd + {FISHER_MORE})"
    d = d.selectExpr("*", f"cast(greatest(0D, k - nb, floor(mode - {wide})) AS long) AS lo",
                     f"cast(least(k, na, ceil(mode + {wide})) AS long) AS hi").withColumn(
        "seen", F.expr(f"CASE WHEN p > 0 AND q > 0 THEN {_log_table('xa')} ELSE 0D END"))
    blocks = d.selectExpr("*", f"explode(sequence(lo, hi, {FISHER_BLOCK}L)) AS b")
    spread = int(z.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tables = blocks.repartition(spread, *keys, "b").selectExpr("*", f"explode(sequence(b, least(hi, b + {FISHER_BLOCK - 1}))) AS t") \
        .withColumn("x", F.col("t").cast("double"))
    tables = tables.withColumn("w", F.expr(f"CASE WHEN p > 0 AND q > 0 THEN {_log_table('x')} ELSE 0D END"))
    top = F.exp(F.col("w"))
    return tables.groupBy(*keys).agg(F.sum(F.when(F.col("w") <= F.col("seen") + 1e-7, top)).alias("s"), F.sum(top).alias("a")).select(
        *keys, F.least(F.lit(1.0), F.coalesce(F.try_divide("s", "a"), F.lit(0.0))).alias("p_fisher"))


def ztest_pvalues(z: DataFrame, tests: int = 4, alpha: float = 0.05) -> DataFrame:
    """Add two-sided z-test and Fisher exact p-values and the Bonferroni flag, as column expressions."""
    keys = ["proxy", "rate"]
    p_z = F.expr(erfc_sql("(abs(z) / sqrt(2D))"))
    cols = [F.col(c) for c in z.columns]
    return (z.join(F.broadcast(fisher_pvalues(z, keys)), keys, "left")
            .select(*cols, p_z.alias("p_z"), "p_fisher").withColumn("passes_bonferroni", F.col("p_z") < alpha / tests))


def approved_pool_rate(df: DataFrame, threshold: float | Column, score: str = "score",
                       label: str = "label") -> DataFrame:
    """Default rate among approved episodes FN / (FN + TN)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    appr = F.col(score) < t
    return df.agg(F.count_if(appr).alias("n_approved"),
                  F.count_if(appr & (F.col(label) == 1)).alias("n_defaults_approved")).select(
        "n_approved", "n_defaults_approved",
        F.try_divide(F.col("n_defaults_approved").cast("double"), F.col("n_approved")).alias("approved_default_rate"))
