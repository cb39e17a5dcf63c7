"""DuckDB oracle SQL generators for the check tables.

Written independently of the Spark operators: they take the same rule
configuration and express each counter as plain SQL over the `ep`-based
CTEs, so a bug in the Spark compilation of a rule shows up as a mismatch.
"""
from __future__ import annotations

import math

from .. import config as C

PIT = ("prior_overdraw_count", "prior_cleared_within_24h_count", "prior_rolled_past_30d_count")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def num_text(x: float) -> str:
    return repr(float(x)) if math.isfinite(x) else ("inf" if x > 0 else "-inf")


def dbl(x) -> str:
    return "NULL::DOUBLE" if x is None else f"CAST({float(x)!r} AS DOUBLE)"


def row(seq, name, passed, sev, value, limit, msg) -> str:
    return (f"SELECT CAST({seq} AS INTEGER) AS check_seq, {name} AS name, {passed} AS passed, "
            f"{sev} AS severity, CAST({value} AS DOUBLE) AS value, CAST({limit} AS DOUBLE) AS \"limit\", "
            f"{msg} AS message FROM a")


def f6(expr: str) -> str:
    return f"printf('%.6f', RND({expr}, 6))"


def f4(expr: str) -> str:
    return f"printf('%.4f', RND({expr}, 4))"


def validate_raw_sql(src: str) -> tuple[str, str]:
    """(agg CTE body, union of check rows) for the raw invariants."""
    aggs = ["COUNT(*) FILTER (WHERE defaulted_30d IS NULL) AS null_target"]
    for i, c in enumerate(C.RAW_FEATURE_COLUMNS):
        aggs.append(f"AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS nf_{i}")
    aggs += ["COUNT(*) FILTER (WHERE utilization_rate < 0 OR utilization_rate > 1) AS util_out",
             "COUNT(*) FILTER (WHERE draw_amount_kes <= 0) AS draw_nonpos",
             "COUNT(*) FILTER (WHERE NOT COALESCE(crb_flagged IN (0, 1), FALSE)) AS crb_bad",
             "AVG(CAST(defaulted_30d AS DOUBLE)) AS default_rate"]
    cte = f"a AS (SELECT {', '.join(aggs)} FROM {src})"
    rows = [row(1, q("raw.null_target"), "null_target = 0", q("error"), "null_target", "0.0",
                "CAST(null_target AS VARCHAR) || ' rows have a null target'")]
    for i, c in enumerate(C.RAW_FEATURE_COLUMNS):
        rows.append(row(10 + i, q(f"raw.null_fraction.{c}"), f"COALESCE(nf_{i} <= {C.NULL_THRESHOLD}, TRUE)",
                        q("error"), f"RND(nf_{i}, 6)", dbl(C.NULL_THRESHOLD),
                        f"{q(c + ': null fraction ')} || {f6(f'nf_{i}')}"))
    rows += [
        row(40, q("raw.utilization_bounds"), "util_out = 0", q("error"), "util_out", "0.0",
            "CAST(util_out AS VARCHAR) || ' utilization_rate values out of [0, 1]'"),
        row(41, q("raw.draw_positive"), "draw_nonpos = 0", q("error"), "draw_nonpos", "0.0",
            "CAST(draw_nonpos AS VARCHAR) || ' non-positive draw_amount_kes'"),
        row(42, q("raw.crb_allowed"), "crb_bad = 0", q("error"), "crb_bad", "0.0",
            "CAST(crb_bad AS VARCHAR) || ' crb_flagged values outside {0, 1}'"),
        row(43, q("raw.default_rate"),
            f"COALESCE(default_rate BETWEEN {C.DEFAULT_RATE_MIN} AND {C.DEFAULT_RATE_MAX}, FALSE)", q("error"),
            "RND(default_rate, 6)", dbl(C.DEFAULT_RATE_MAX),
            f"'default rate ' || COALESCE({f4('default_rate')}, 'nan')"),
    ]
    return cte, "\nUNION ALL\n".join(rows)


class Agg:
    def __init__(self):
        self.items: list[str] = []

    def add(self, expr: str) -> str:
        name = f"a{len(self.items)}"
        self.items.append(f"{expr} AS {name}")
        return name


def schema_rows(agg: Agg, columns: list[str], rules=C.FEATURE_RULES) -> list[str]:
    rows = []
    expected = {r.name for r in rules}
    missing = sorted(expected - set(columns))
    if missing:
        rows.append(row(1000, q("schema.missing_columns"), "FALSE", q("error"), float(len(missing)), "0.0",
                        q(f"Missing required columns: {missing}")))
    else:
        rows.append(row(1000, q("schema.missing_columns"), "TRUE", q("info"), "0.0", "0.0",
                        q("All required columns present")))
    seq = 1000
    for r in rules:
        if r.name not in columns:
            continue
        if r.min_val is not None or r.max_val is not None:
            seq += 1
            lo = r.min_val if r.min_val is not None else -math.inf
            hi = r.max_val if r.max_val is not None else math.inf
            conds = []
            if math.isfinite(lo):
                conds.append(f"{r.name} < {lo!r}")
            if math.isfinite(hi):
                conds.append(f"{r.name} > {hi!r}")
            n = agg.add(f"COUNT(*) FILTER (WHERE {' OR '.join(conds) or 'FALSE'})")
            b = f"[{num_text(lo)}, {num_text(hi)}]"
            rows.append(row(seq, q(f"schema.range.{r.name}"), f"{n} = 0",
                            f"CASE WHEN {n} = 0 THEN 'info' ELSE 'error' END", n, "NULL",
                            f"CASE WHEN {n} = 0 THEN {q(r.name + ': all values in ' + b)} ELSE "
                            f"{q(r.name + ': ')} || CAST({n} AS VARCHAR) || {q(' value(s) outside ' + b)} END"))
        if r.allowed_values is not None:
            seq += 1
            vals = ", ".join(str(v) for v in r.allowed_values)
            n = agg.add(f"COUNT(*) FILTER (WHERE NOT COALESCE({r.name} IN ({vals}), FALSE))")
            rows.append(row(seq, q(f"schema.allowed_values.{r.name}"), f"{n} = 0",
                            f"CASE WHEN {n} = 0 THEN 'info' ELSE 'error' END", n, "NULL",
                            f"CASE WHEN {n} = 0 THEN {q(r.name + ': all values in allowed set')} ELSE "
                            f"{q(r.name + ': ')} || CAST({n} AS VARCHAR) || "
                            f"{q(' value(s) not in allowed set [' + vals + ']')} END"))
    return rows


def missing_rows(agg: Agg, columns: list[str], rules=C.FEATURE_RULES) -> list[str]:
    by = {r.name: r for r in rules}
    rows, fails = [], []
    seq = 2000
    for c in columns:
        if c not in by:
            continue
        seq += 1
        lim = by[c].max_missing_rate
        m = agg.add(f"AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE")
        fails.append(f"COALESCE({m} > {lim!r}, FALSE)")
        rows.append(row(seq, q(f"missing.{c}"), "FALSE",
                        f"CASE WHEN {m} > {C.MISSING_ERROR_RATE} THEN 'error' ELSE 'warning' END",
                        f"RND({m}, 6)", dbl(lim),
                        f"{q(c + ': missing rate ')} || {f6(m)} || {q(f' exceeds allowed {lim}')}")
                    + f" WHERE COALESCE({m} > {lim!r}, FALSE)")
    none = " AND ".join(f"NOT {f}" for f in fails) or "TRUE"
    rows.append(row(2999, q("missing.all_columns"), "TRUE", q("info"), "NULL", "NULL",
                    q("All columns within expected missingness bounds")) + f" WHERE {none}")
    return rows


def leakage_rows(agg: Agg, numeric_cols: list[str], target: str = C.TARGET_COL,
                 thr: float = C.LEAKAGE_CORR) -> list[str]:
    rows, leaks = [], []
    for i, c in enumerate(numeric_cols):
        x = f"CASE WHEN {target} IS NOT NULL THEN CAST({c} AS DOUBLE) END"
        y = f"CASE WHEN {c} IS NOT NULL THEN CAST({target} AS DOUBLE) END"
        r = agg.add(f"CASE WHEN STDDEV_POP({x}) * STDDEV_POP({y}) = 0 THEN NULL ELSE "
                    f"COVAR_POP({x}, {y}) / (STDDEV_POP({x}) * STDDEV_POP({y})) END")
        leaked = f"COALESCE(ABS({r}) >= {thr}, FALSE)"
        leaks.append(leaked)
        rows.append(row(4001 + i, q(f"leakage.correlation.{c}"), "FALSE", q("error"), f"RND({r}, 4)", dbl(thr),
                        f"{q(c + ': |Pearson r|=')} || {f4(f'ABS({r})')} || "
                        f"{q(f' with target - possible feature leakage (threshold {thr})')}")
                    + f" WHERE {leaked}")
    none = " AND ".join(f"NOT {x}" for x in leaks) or "TRUE"
    rows.append(row(4000, q("leakage.correlation"), "TRUE", q("info"), "NULL", dbl(thr),
                    q(f"No features correlated with target above {thr}")) + f" WHERE {none}")
    return rows


def target_rows(agg: Agg, target: str = C.TARGET_COL) -> list[str]:
    r = agg.add(f"AVG(CAST({target} AS DOUBLE))")
    ok = f"COALESCE({r} BETWEEN {C.DEFAULT_RATE_MIN} AND {C.DEFAULT_RATE_MAX}, FALSE)"
    txt = f"COALESCE({f4(r)}, 'nan')"
    return [row(5000, q("target.rate"), ok, f"CASE WHEN {ok} THEN 'info' ELSE 'error' END", f"RND({r}, 4)",
                "NULL", f"CASE WHEN {ok} THEN 'Default rate ' || {txt} || ' within plausible range' "
                        f"ELSE 'Default rate ' || {txt} || ' outside plausible range [0.005, 0.50]' END")]


def pit_rows(agg: Agg) -> list[str]:
    tot, clr, rol = PIT
    specs = [("pit.prior_count_negative", f"{tot} < 0", "prior_overdraw_count < 0"),
             ("pit.cleared_exceeds_total", f"{clr} > {tot}", "prior_cleared_within_24h_count > prior_overdraw_count"),
             ("pit.rolled_exceeds_total", f"{rol} > {tot}", "prior_rolled_past_30d_count > prior_overdraw_count"),
             ("pit.outcomes_exceed_total", f"{clr} + {rol} > {tot}",
              "cleared + rolled > prior_overdraw_count (non-overlapping subsets)")]
    rows = []
    for i, (name, pred, desc) in enumerate(specs):
        n = agg.add(f"COUNT(*) FILTER (WHERE {pred})")
        rows.append(row(6001 + i, q(name), f"{n} = 0", f"CASE WHEN {n} = 0 THEN 'info' ELSE 'error' END", n, "0.0",
                        f"CASE WHEN {n} = 0 THEN {q('PIT check passed: no ' + desc + ' violations')} ELSE "
                        f"'Point-in-time violation: ' || CAST({n} AS VARCHAR) || {q(' row(s) have ' + desc)} END"))
    return rows


def checks_sql(src: str, agg: Agg, rows: list[str]) -> tuple[str, str]:
    cte = f"a AS (SELECT {', '.join(agg.items) or '1 AS one'} FROM {src})"
    return cte, "\nUNION ALL\n".join(rows)


# ------------------------------------------------------------------ PSI
def unpivot_sql(name: str, src: str, cols: list[str]) -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return (f"{name}_w AS (SELECT {casts} FROM {src}),\n"
            f"{name} AS (SELECT feature, value FROM (UNPIVOT {name}_w ON {', '.join(cols)} "
            f"INTO NAME feature VALUE value) WHERE value IS NOT NULL)")


def psi_ctes(ref_src: str, cur_src: str, cols: list[str], bins: int = C.PSI_BINS, mode: str = "quantile") -> str:
    step = 1.0 / bins
    probs = [i * step for i in range(bins)] + [1.0]
    plist = ", ".join(f"{p!r}::DOUBLE" for p in probs)
    return ",\n".join([
        unpivot_sql("ref_l", ref_src, cols),
        unpivot_sql("cur_l", cur_src, cols),
        f"pq AS (SELECT feature, quantile_cont(value, [{plist}]) AS qs, COUNT(*) AS n_ref FROM ref_l GROUP BY feature)",
        ("pe AS (SELECT feature, n_ref, list_sort(list_distinct(list_concat([qs[1] - 1e-6], qs[2:len(qs) - 1], "
         "[qs[len(qs)] + 1e-6]))) AS edges FROM pq)") if mode != "open" else
        ("pe AS (SELECT feature, n_ref, list_sort(list_distinct(list_concat(['-inf'::DOUBLE], qs[2:len(qs) - 1], "
         "['inf'::DOUBLE]))) AS edges FROM pq)"),
        "pb AS (SELECT l.feature, l.side, CASE WHEN l.value >= edges[1] AND l.value <= edges[len(edges)] THEN "
        "CASE WHEN l.value = edges[len(edges)] THEN len(edges) - 2 "
        "ELSE len(list_filter(edges, lambda e: e <= l.value)) - 1 END END AS bin "
        "FROM (SELECT feature, value, 0 AS side FROM ref_l UNION ALL SELECT feature, value, 1 AS side FROM cur_l) l "
        "JOIN pe ON l.feature = pe.feature)",
        "pbins AS (SELECT feature, UNNEST(range(0, len(edges) - 1)) AS bin FROM pe)",
        "pcnt AS (SELECT feature, bin, COUNT(*) FILTER (WHERE side = 0) AS ref_n, "
        "COUNT(*) FILTER (WHERE side = 1) AS cur_n FROM pb WHERE bin IS NOT NULL GROUP BY feature, bin)",
        "pfull AS (SELECT b.feature, b.bin, COALESCE(c.ref_n, 0) AS ref_n, COALESCE(c.cur_n, 0) AS cur_n "
        "FROM pbins b LEFT JOIN pcnt c ON b.feature = c.feature AND b.bin = c.bin)",
        "ptot AS (SELECT feature, SUM(ref_n) AS rt, SUM(cur_n) AS ct, COUNT(*) AS n_bins FROM pfull GROUP BY feature)",
        "pterm AS (SELECT f.feature, GREATEST(f.ref_n / GREATEST(t.rt, 1), 1e-6) AS rp, "
        "GREATEST(f.cur_n / GREATEST(t.ct, 1), 1e-6) AS cp FROM pfull f JOIN ptot t ON f.feature = t.feature)",
        "ppsi AS (SELECT feature, SUM((cp - rp) * LN(cp / rp)) AS psi_raw FROM pterm GROUP BY feature)",
        "psz AS (SELECT feature, COUNT(*) FILTER (WHERE side = 1) AS n_cur_all, "
        "COUNT(*) FILTER (WHERE side = 1 AND bin IS NULL) AS n_oor FROM pb GROUP BY feature)",
        "psi_t AS (SELECT e.feature, CASE WHEN s.n_cur_all > 0 THEN RND(p.psi_raw, 4) END AS psi, "
        "CAST(e.n_ref AS BIGINT) AS n_ref, CAST(COALESCE(s.n_cur_all, 0) AS BIGINT) AS n_cur, "
        "CAST(t.n_bins AS BIGINT) AS n_bins, CAST(COALESCE(s.n_oor, 0) AS BIGINT) AS n_out_of_range "
        "FROM pe e LEFT JOIN ppsi p ON e.feature = p.feature LEFT JOIN ptot t ON e.feature = t.feature "
        "LEFT JOIN psz s ON e.feature = s.feature)",
    ])


def drift_check_rows(cols: list[str], warn: float = C.PSI_WARN, alert: float = C.PSI_ALERT) -> str:
    seq = "CASE feature " + " ".join(f"WHEN {q(c)} THEN {3001 + i}" for i, c in enumerate(cols)) + " END"
    txt = "printf('%.4f', psi)"
    return (f"SELECT CAST({seq} AS INTEGER) AS check_seq, 'drift.psi.' || feature AS name, psi < {warn} AS passed, "
            f"CASE WHEN psi >= {alert} THEN 'error' WHEN psi >= {warn} THEN 'warning' ELSE 'info' END AS severity, "
            f"CAST(psi AS DOUBLE) AS value, CAST(CASE WHEN psi >= {alert} THEN {alert} WHEN psi >= {warn} THEN {warn} END "
            f"AS DOUBLE) AS \"limit\", CASE WHEN psi >= {alert} THEN feature || ': PSI=' || {txt} || "
            f"' exceeds ALERT threshold {alert}' WHEN psi >= {warn} THEN feature || ': PSI=' || {txt} || "
            f"' exceeds WARN threshold {warn}' ELSE feature || ': PSI=' || {txt} || ' (stable)' END AS message "
            f"FROM psi_t WHERE psi IS NOT NULL")
