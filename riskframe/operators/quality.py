"""Declarative data-quality checks.

A rule set is compiled into ONE aggregation over the input: every range,
allowed-value, missing-rate, leakage-moment, target-rate and point-in-time
counter is a column of a single-row aggregate, and the check rows are
exploded from that row. A full validation therefore scans the data once,
plus the two scans drift needs (reference quantiles, binned counts).

Null semantics follow pandas on the reference side: a null is never a range
violation, is always an allowed-value violation, and is skipped by means.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.prims import checks_frame

# Stage offsets keep check_seq ordered like the reference's report:
# schema -> missing -> drift -> leakage -> target -> point-in-time.
SEQ_SCHEMA, SEQ_MISSING, SEQ_DRIFT, SEQ_LEAK, SEQ_TARGET, SEQ_PIT = 1000, 2000, 3000, 4000, 5000, 6000
PIT_COLS = ("prior_overdraw_count", "prior_cleared_within_24h_count", "prior_rolled_past_30d_count")


def _num_text(x: float) -> str:
    """Bound text as Python prints it (0.0, 240.0, inf, -inf)."""
    return repr(float(x)) if math.isfinite(x) else ("inf" if x > 0 else "-inf")


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.NumericType)


def q(text: str) -> str:
    """Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rnd(e: str, dp: int) -> str:
    """SQL text of `prims.round_dp` (round half up on the binary value)."""
    k = f"{float(10 ** dp)!r}D"
    return f"(CASE WHEN abs({e}) < 1e12D THEN floor(({e}) * {k} + 0.5D) / {k} ELSE round({e}, {dp}) END)"


def fmt(e: str, dp: int) -> str:
    return f"format_string('%.{dp}f', {e})"


def row_sql(seq, name: str, passed: str, sev: str, value: str, limit: str, msg: str) -> str:
    """SQL text of one check-row struct (schema of prims.CHECK_SCHEMA)."""
    return (f"named_struct('check_seq', CAST({seq} AS INT), 'name', CAST({name} AS STRING), "
            f"'passed', CAST({passed} AS BOOLEAN), 'severity', CAST({sev} AS STRING), "
            f"'value', CAST({value} AS DOUBLE), 'limit', CAST({limit} AS DOUBLE), 'message', CAST({msg} AS STRING))")


def lit_num(x) -> str:
    return "NULL" if x is None else f"{float(x)!r}D"


# ------------------------------------------------------------------ plans
class _Plan:
    """Aggregates and candidate check rows of a rule set, kept as Spark SQL text.

    Text keeps the plan construction to a couple of JVM calls however many
    rules there are; the aggregate is still one pass over the data.
    """

    def __init__(self):
        self.aggs: list[str] = []
        self.cands: list[str] = []

    def agg(self, expr: str) -> str:
        name = f"a{len(self.aggs)}"
        self.aggs.append(f"{expr} AS {name}")
        return name

    def add(self, keep: str, row: str) -> None:
        self.cands.append(f"named_struct('_keep', {keep}, '_row', {row})")


def col_ref(c: str) -> str:
    return f"`{c}`"


def _schema_checks(p: _Plan, df: DataFrame, rules: Sequence[C.ColumnRule]) -> None:
    expected = {r.name for r in rules}
    missing = sorted(expected - set(df.columns))
    if missing:
        p.add("true", row_sql(SEQ_SCHEMA, q("schema.missing_columns"), "false", q("error"),
                              lit_num(len(missing)), "0.0D", q(f"Missing required columns: {missing}")))
    else:
        p.add("true", row_sql(SEQ_SCHEMA, q("schema.missing_columns"), "true", q("info"), "0.0D", "0.0D",
                              q("All required columns present")))
    seq = SEQ_SCHEMA
    for r in rules:
        if r.name not in df.columns:
            continue
        c = col_ref(r.name)
        if r.min_val is not None or r.max_val is not None:
            seq += 1
            lo = r.min_val if r.min_val is not None else -math.inf
            hi = r.max_val if r.max_val is not None else math.inf
            conds = ([f"{c} < {lo!r}D"] if math.isfinite(lo) else []) + ([f"{c} > {hi!r}D"] if math.isfinite(hi) else [])
            n = p.agg(f"count_if({' OR '.join(conds) or 'false'})")
            bounds = f"[{_num_text(lo)}, {_num_text(hi)}]"
            msg = (f"CASE WHEN {n} = 0 THEN {q(r.name + ': all values in ' + bounds)} ELSE "
                   f"concat({q(r.name + ': ')}, CAST({n} AS STRING), {q(' value(s) outside ' + bounds)}) END")
            p.add("true", row_sql(seq, q(f"schema.range.{r.name}"), f"{n} = 0",
                                  f"CASE WHEN {n} = 0 THEN 'info' ELSE 'error' END", n, "NULL", msg))
        if r.allowed_values is not None:
            seq += 1
            vals = ", ".join(repr(v) for v in r.allowed_values)
            n = p.agg(f"count_if(NOT coalesce({c} IN ({vals}), false))")
            allowed = "[" + ", ".join(str(v) for v in r.allowed_values) + "]"
            msg = (f"CASE WHEN {n} = 0 THEN {q(r.name + ': all values in allowed set')} ELSE "
                   f"concat({q(r.name + ': ')}, CAST({n} AS STRING), {q(' value(s) not in allowed set ' + allowed)}) END")
            p.add("true", row_sql(seq, q(f"schema.allowed_values.{r.name}"), f"{n} = 0",
                                  f"CASE WHEN {n} = 0 THEN 'info' ELSE 'error' END", n, "NULL", msg))


def _missing_checks(p: _Plan, df: DataFrame, rules: Sequence[C.ColumnRule]) -> None:
    by_name = {r.name: r for r in rules}
    fails = []
    seq = SEQ_MISSING
    for c in df.columns:
        if c not in by_name:
            continue
        seq += 1
        lim = by_name[c].max_missing_rate
        rate = p.agg(f"avg(CAST({col_ref(c)} IS NULL AS DOUBLE))")
        bad = f"coalesce({rate} > {lim!r}D, false)"
        fails.append(bad)
        sev = f"CASE WHEN {rate} > {C.MISSING_ERROR_RATE!r}D THEN 'error' ELSE 'warning' END"
        msg = f"concat({q(c + ': missing rate ')}, {fmt(rnd(rate, 6), 6)}, {q(f' exceeds allowed {lim}')})"
        p.add(bad, row_sql(seq, q(f"missing.{c}"), "false", sev, rnd(rate, 6), lit_num(lim), msg))
    none_failed = " AND ".join(f"NOT {b}" for b in fails) or "true"
    p.add(none_failed, row_sql(SEQ_MISSING + 999, q("missing.all_columns"), "true", q("info"), "NULL", "NULL",
                               q("All columns within expected missingness bounds")))


def leakage_columns(df: DataFrame, rules: Sequence[C.ColumnRule], target: str) -> list[str]:
    return [r.name for r in rules if r.name in df.columns and r.name != target and _is_numeric(df, r.name)]


def pearson_expr(x: Column, y: Column) -> Column:
    """Pairwise-complete Pearson r from population moments; null when a variance is 0.

    `corr` is avoided on purpose: under ANSI mode it raises on a constant column.
    """
    xm = F.when(y.isNotNull(), x.cast("double"))
    ym = F.when(x.isNotNull(), y.cast("double"))
    return F.try_divide(F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym))


def pearson_sql(x: str, y: str) -> str:
    """SQL text of `pearson_expr`."""
    xm = f"CASE WHEN {y} IS NOT NULL THEN CAST({x} AS DOUBLE) END"
    ym = f"CASE WHEN {x} IS NOT NULL THEN CAST({y} AS DOUBLE) END"
    return f"try_divide(covar_pop({xm}, {ym}), stddev_pop({xm}) * stddev_pop({ym}))"


def _leakage_checks(p: _Plan, df: DataFrame, rules, target: str, thr: float) -> None:
    cols = leakage_columns(df, rules, target)
    leaks = []
    for i, c in enumerate(cols):
        seq = SEQ_LEAK + 1 + i
        r = p.agg(pearson_sql(col_ref(c), col_ref(target)))
        leaked = f"coalesce(abs({r}) >= {thr!r}D, false)"
        leaks.append(leaked)
        msg = (f"concat({q(c + ': |Pearson r|=')}, {fmt(rnd(f'abs({r})', 4), 4)}, "
               f"{q(f' with target - possible feature leakage (threshold {thr})')})")
        p.add(leaked, row_sql(seq, q(f"leakage.correlation.{c}"), "false", q("error"), rnd(r, 4), lit_num(thr), msg))
    none = " AND ".join(f"NOT {b}" for b in leaks) or "true"
    p.add(none, row_sql(SEQ_LEAK, q("leakage.correlation"), "true", q("info"), "NULL", lit_num(thr),
                        q(f"No features correlated with target above {thr}")))


def _target_checks(p: _Plan, target: str) -> None:
    rate = p.agg(f"avg(CAST({col_ref(target)} AS DOUBLE))")
    ok = f"coalesce({rate} BETWEEN {C.DEFAULT_RATE_MIN!r}D AND {C.DEFAULT_RATE_MAX!r}D, false)"
    txt = f"coalesce({fmt(rnd(rate, 4), 4)}, 'nan')"
    msg = (f"CASE WHEN {ok} THEN concat('Default rate ', {txt}, ' within plausible range') "
           f"ELSE concat('Default rate ', {txt}, ' outside plausible range [0.005, 0.50]') END")
    p.add("true", row_sql(SEQ_TARGET, q("target.rate"), ok, f"CASE WHEN {ok} THEN 'info' ELSE 'error' END",
                          rnd(rate, 4), "NULL", msg))


PIT_SPECS = [
    ("pit.prior_count_negative", "{t} < 0", "prior_overdraw_count < 0"),
    ("pit.cleared_exceeds_total", "{c} > {t}", "prior_cleared_within_24h_count > prior_overdraw_count"),
    ("pit.rolled_exceeds_total", "{r} > {t}", "prior_rolled_past_30d_count > prior_overdraw_count"),
    ("pit.outcomes_exceed_total", "{c} + {r} > {t}", "cleared + rolled > prior_overdraw_count (non-overlapping subsets)"),
]


def pit_counters() -> list[tuple[str, Column, str]]:
    t, c, r = PIT_COLS
    return [(name, F.expr(pred.format(t=t, c=c, r=r)), desc) for name, pred, desc in PIT_SPECS]


def _pit_checks(p: _Plan, df: DataFrame) -> None:
    if not set(PIT_COLS).issubset(df.columns):
        return
    t, c, r = PIT_COLS
    for i, (name, pred, desc) in enumerate(PIT_SPECS):
        seq = SEQ_PIT + 1 + i
        n = p.agg(f"count_if({pred.format(t=t, c=c, r=r)})")
        msg = (f"CASE WHEN {n} = 0 THEN {q('PIT check passed: no ' + desc + ' violations')} ELSE "
               f"concat('Point-in-time violation: ', CAST({n} AS STRING), {q(' row(s) have ' + desc)}) END")
        p.add("true", row_sql(seq, q(name), f"{n} = 0", f"CASE WHEN {n} = 0 THEN 'info' ELSE 'error' END",
                              n, "0.0D", msg))


def _run(df: DataFrame, p: _Plan) -> DataFrame:
    if not p.cands:
        return checks_frame(df, [])
    row = df.agg(*[F.expr(a) for a in p.aggs]) if p.aggs else df.sparkSession.range(1)
    return row.selectExpr(f"explode(filter(array({', '.join(p.cands)}), s -> s._keep)) AS s").select("s._row.*")


# ------------------------------------------------------------- public API
def schema_checks(df: DataFrame, rules: Sequence[C.ColumnRule] = C.FEATURE_RULES) -> DataFrame:
    """Missing columns + range (P4) + allowed-values (P5) checks; one scan."""
    p = _Plan()
    _schema_checks(p, df, rules)
    return _run(df, p)


def range_checks(df: DataFrame, rules: Sequence[C.ColumnRule] = C.FEATURE_RULES) -> DataFrame:
    return schema_checks(df, rules).where(F.col("name").startswith("schema.range."))


def allowed_value_checks(df: DataFrame, rules: Sequence[C.ColumnRule] = C.FEATURE_RULES) -> DataFrame:
    return schema_checks(df, rules).where(F.col("name").startswith("schema.allowed_values."))


def missing_checks(df: DataFrame, rules: Sequence[C.ColumnRule] = C.FEATURE_RULES) -> DataFrame:
    p = _Plan()
    _missing_checks(p, df, rules)
    return _run(df, p)


def leakage_checks(df: DataFrame, rules: Sequence[C.ColumnRule] = C.FEATURE_RULES,
                   target: str = C.TARGET_COL, threshold: float = C.LEAKAGE_CORR) -> DataFrame:
    p = _Plan()
    _leakage_checks(p, df, rules, target, threshold)
    return _run(df, p)


def target_rate_check(df: DataFrame, target: str = C.TARGET_COL) -> DataFrame:
    p = _Plan()
    _target_checks(p, target)
    return _run(df, p)


def pit_checks(df: DataFrame) -> DataFrame:
    p = _Plan()
    _pit_checks(p, df)
    return _run(df, p)


def validate_data(df: DataFrame, rules: Sequence[C.ColumnRule] = C.FEATURE_RULES,
                  reference_df: DataFrame | None = None, target: str = C.TARGET_COL,
                  psi_warn: float = C.PSI_WARN, psi_alert: float = C.PSI_ALERT,
                  leakage_threshold: float = C.LEAKAGE_CORR) -> DataFrame:
    """Full data validation report as check rows.

    schema, missing, leakage, target and PIT counters come from one aggregate
    over `df`; drift (when a reference is given) adds the PSI plan.
    """
    p = _Plan()
    _schema_checks(p, df, rules)
    _missing_checks(p, df, rules)
    if target in df.columns:
        _leakage_checks(p, df, rules, target, leakage_threshold)
        _target_checks(p, target)
    _pit_checks(p, df)
    out = _run(df, p)
    if reference_df is not None:
        from .drift import drift_checks
        cols = [r.name for r in rules if r.name in df.columns and r.name in reference_df.columns
                and _is_numeric(df, r.name) and r.name != target]
        out = out.unionByName(drift_checks(reference_df, df, cols, psi_warn, psi_alert))
    return out


# --------------------------------------------------------- request quarantine
def request_violations(df: DataFrame, rules: Sequence[C.RequestRule] = C.REQUEST_RULES) -> Column:
    """Array of violated rule names per row (missing field counts as a violation)."""
    out = []
    for r in rules:
        c = F.col(r.name)
        if r.op == "ge":
            bad = c < r.bound
        elif r.op == "gt":
            bad = c <= r.bound
        elif r.op == "le":
            bad = c > r.bound
        else:
            raise ValueError(r.op)
        tag = f"{r.name}:{r.op}:{r.bound}"
        out.append(F.when(c.isNull() | bad, F.lit(tag)))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def quarantine(df: DataFrame, rules: Sequence[C.RequestRule] = C.REQUEST_RULES) -> DataFrame:
    """Tag every request with its violations; `valid` = no violation."""
    v = request_violations(df, rules)
    return df.withColumn("violations", v).withColumn("valid", F.size("violations") == 0)
