"""Reason codes for tree ensembles: path-dependent TreeSHAP (M5, trees).

The published path-dependent algorithm (Lundberg, Erion & Lee, 2018) recurses
over a tree carrying the unique path of features with their "zero" fractions
(cover ratios) and "one" fractions (does x follow the branch). The recursion
depends on a row only through the one fractions, so it is run once per tree
with those fractions as numpy vectors over a whole Arrow batch: both children
are visited for every row, the hot child receiving the row's one fraction and
the cold child zero. A leaf's contributions depend on a row only through which
features of its path are met, so the algorithm is run once per task over all such
patterns and rows look theirs up (`leaf_tables`). Cost per batch: O(trees x leaves x
depth) vector ops; paths of many features recurse over the rows (depth^2 instead).

Trees are read once from the fitted MLlib model (feature, threshold, children,
node value, training cover) and broadcast; rows are explained in
`mapInPandas`, so the work is spread over the cluster with the data.
MLlib GBT probabilities are 1 / (1 + exp(-2 * margin)); contributions are
reported in that log-odds space (2 * sum of weighted tree SHAP values), as a
booster's SHAP values are.
"""
from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..session import scratch_path


def extract_trees(gbt_model) -> tuple[list[dict], list[float]]:
    """Node arrays of an MLlib GBT classification model (model-sized), read from its saved node table.

    One save and one read, whatever the number of nodes. Node ids are numbered
    in pre-order within a tree, the root first; leaves have feature -1.
    """
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "trees")
    gbt_model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", F.col("nodeData.id").alias("id"), F.col("nodeData.prediction").alias("value"), F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"), F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("cut"), F.col("nodeData.impurityStats")[0].alias("cover")).collect()
    by_tree: dict[int, list] = {}
    for r in sorted(nodes, key=lambda r: (r.treeID, r.id)):
        by_tree.setdefault(r.treeID, []).append(r)
    trees = []
    for t in sorted(by_tree):
        rows = by_tree[t]
        inner = [r.left >= 0 for r in rows]
        trees.append({
            "feature": np.array([r.feature if i else -1 for r, i in zip(rows, inner)]),
            "threshold": np.array([r.cut[0] if i else 0.0 for r, i in zip(rows, inner)]),
            "left": np.array([r.left if i else -1 for r, i in zip(rows, inner)]),
            "right": np.array([r.right if i else -1 for r, i in zip(rows, inner)]),
            "value": np.array([float(r.value) for r in rows]), "cover": np.array([float(r.cover) for r in rows])})
    return trees, [float(w) for w in gbt_model.treeWeights]


def tree_values(x: np.ndarray, tree: dict) -> np.ndarray:
    """Prediction of one regression tree for every row, level by level; leaves lead to themselves."""
    leaf, own = tree["feature"] < 0, np.arange(len(tree["feature"]))
    feature = np.where(leaf, 0, tree["feature"])
    left, right = np.where(leaf, own, tree["left"]), np.where(leaf, own, tree["right"])
    cells, first = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
    at = np.zeros(len(x), dtype=np.int64)
    while True:
        after = np.where(cells[first + feature[at]] <= tree["threshold"][at], left[at], right[at])
        if np.array_equal(after, at):
            return tree["value"][at]
        at = after


def _extend(path, pz, po, pi):
    """EXTEND: append (feature pi, zero fraction pz, one fractions po) and update weights."""
    d, z, o, w = path
    l = len(d)
    d, z, o, w = d + [pi], z + [pz], o + [po], [x.copy() for x in w] + [np.ones_like(po) if l == 0 else np.zeros_like(po)]
    for i in range(l - 1, -1, -1):
        w[i + 1] = w[i + 1] + po * w[i] * (i + 1) / (l + 1)
        w[i] = pz * w[i] * (l - i) / (l + 1)
    return d, z, o, w


def _unwind(path, k):
    """UNWIND: remove element k of the path, undoing its weight contribution."""
    d, z, o, w = path
    l = len(d) - 1
    n = w[l].copy()
    ok, zk = o[k], z[k]
    nz = ok != 0
    safe_o = np.where(nz, ok, 1.0)
    w = [x.copy() for x in w[:l]]
    for j in range(l - 1, -1, -1):
        t = w[j]
        w_nz = n * (l + 1) / ((j + 1) * safe_o)
        n_nz = t - w_nz * zk * (l - j) / (l + 1)
        w_z = (t * (l + 1)) / (zk * (l - j)) if zk * (l - j) != 0 else np.zeros_like(t)
        w[j] = np.where(nz, w_nz, w_z)
        n = np.where(nz, n_nz, n)
    d = d[:k] + d[k + 1:]
    z = z[:k] + z[k + 1:]
    o = o[:k] + o[k + 1:]
    return d, z, o, w


def _unwound_sum(path, k) -> np.ndarray:
    return sum(_unwind(path, k)[3])


def tree_shap(x: np.ndarray, tree: dict, n_features: int) -> np.ndarray:
    """SHAP values (rows x features) of one regression tree, path-dependent, vectorised over rows."""
    n = x.shape[0]
    phi = np.zeros((n, n_features))
    feat, thr, left, right, val, cover = (tree[k] for k in ("feature", "threshold", "left", "right", "value", "cover"))
    ones = np.ones(n)

    def recurse(j, path, pz, po, pi):
        path = _extend(path, pz, po, pi)
        if feat[j] < 0:
            d, z, o, _ = path
            for i in range(1, len(d)):
                w = _unwound_sum(path, i)
                phi[:, d[i]] += w * (o[i] - z[i]) * val[j]
            return
        f = feat[j]
        go_left = (x[:, f] <= thr[j]).astype(float)
        iz, io = 1.0, ones
        d = path[0]
        if f in d[1:]:
            k = d.index(f, 1)
            iz, io = path[1][k], path[2][k]
            path = _unwind(path, k)
        rj = cover[j] if cover[j] > 0 else 1.0
        recurse(left[j], path, iz * cover[left[j]] / rj, io * go_left, f)
        recurse(right[j], path, iz * cover[right[j]] / rj, io * (1.0 - go_left), f)

    recurse(0, ([], [], [], []), 1.0, ones, -1)
    return phi


#: Distinct features on a path up to which a leaf's contributions are tabulated (2 ** that many columns a leaf).
TABLE_FEATURES = 8


def leaf_tables(tree: dict) -> list[tuple[list, list, np.ndarray]] | None:
    """Per leaf: its path's features, their conditions as (node, left?), and a table of contributions.

    A row meets or misses the conditions of each feature on a leaf's path, and the
    leaf adds to its SHAP values by that pattern alone: column p of the table holds
    the contributions of rows that meet the features of p's bits. One run of the
    algorithm over all patterns then serves every row. None if a path has more than
    `TABLE_FEATURES` features.
    """
    feat, left, right, val, cover = (tree[k] for k in ("feature", "left", "right", "value", "cover"))
    out = []

    def walk(j, path):
        if feat[j] < 0:
            if not path or len(path) > TABLE_FEATURES:
                return not path
            bits = np.arange(2 ** len(path))
            o = [((bits >> i) & 1).astype(float) for i in range(len(path))]
            p = _extend(([], [], [], []), 1.0, np.ones(len(bits)), -1)
            for (f, z, _), one in zip(path, o):
                p = _extend(p, z, one, f)
            out.append(([f for f, _, _ in path], [c for _, _, c in path], np.stack(
                [_unwound_sum(p, i + 1) * (one - z) * val[j] for i, ((_, z, _), one) in enumerate(zip(path, o))])))
            return True
        f, rj = feat[j], cover[j] if cover[j] > 0 else 1.0
        _, iz, met = next((e for e in path if e[0] == f), (f, 1.0, []))
        rest = [e for e in path if e[0] != f]
        return all([walk(child, [*rest, (f, iz * cover[child] / rj, [*met, (j, child == left[j])])])
                    for child in (left[j], right[j])])

    return out if walk(0, []) else None


def tabled_shap(x: np.ndarray, tree: dict, tables: list, n_features: int) -> np.ndarray:
    """`tree_shap` by the tree's `leaf_tables`: one lookup per row, leaf and feature of its path."""
    phi = np.zeros((n_features, len(x)))
    left = {j: x[:, tree["feature"][j]] <= tree["threshold"][j] for j in np.flatnonzero(tree["feature"] >= 0)}
    for feats, conditions, table in tables:
        pattern = np.zeros(len(x), dtype=np.int64)
        for i, met in enumerate(conditions):
            hit = np.logical_and.reduce([left[j] if is_left else ~left[j] for j, is_left in met])
            pattern |= hit.astype(np.int64) << i
        for f, row in zip(feats, table):
            phi[f] += row[pattern]
    return phi.T


def expected_value(tree: dict) -> float:
    """Cover-weighted mean leaf value of a tree (the SHAP base value)."""
    leaves = tree["feature"] < 0
    return float((tree["value"][leaves] * tree["cover"][leaves]).sum() / tree["cover"][0])


def ensemble_shap(x: np.ndarray, trees: list[dict], weights: list[float], n_features: int,
                  tables: list | None = None) -> np.ndarray:
    """SHAP values in log-odds; `tables` are the trees' `leaf_tables`, kept by callers with many batches."""
    phi = np.zeros((x.shape[0], n_features))
    for t, w, leaves in zip(trees, weights, [leaf_tables(t) for t in trees] if tables is None else tables):
        phi += w * (tree_shap(x, t, n_features) if leaves is None else tabled_shap(x, t, leaves, n_features))
    return 2.0 * phi


def gbt_reason_codes(df: DataFrame, gbt_model, feature_cols: Sequence[str], key: str = C.KEY_COL,
                     top_n: int = C.REASON_TOP_N, fills: Mapping[str, float] | None = None) -> DataFrame:
    """Top-n TreeSHAP contributions per row (ties by feature order) plus the base value.

    `fills` are the model's stand-ins for missing values (`FittedModel.fills`).

    Output: key, base_value, and reason{k}_feature / reason{k}_shap_value / reason{k}_direction.
    """
    feature_cols = list(feature_cols)
    trees, weights = extract_trees(gbt_model)
    base = 2.0 * sum(w * expected_value(t) for t, w in zip(trees, weights))
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast((trees, weights))
    m = len(feature_cols)

    def fn(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tr, ws = bc.value
        tables = [leaf_tables(t) for t in tr]
        for pdf in it:
            x = pdf[feature_cols].to_numpy(dtype=float, na_value=np.nan)
            phi = ensemble_shap(x, tr, ws, m, tables)
            order = np.lexsort((np.tile(np.arange(m), (len(pdf), 1)), -np.abs(phi)), axis=1)[:, :top_n]
            out = {key: pdf[key].to_numpy(), "base_value": np.full(len(pdf), base)}
            for k in range(top_n):
                idx = order[:, k]
                v = phi[np.arange(len(pdf)), idx]
                out[f"reason{k + 1}_feature"] = np.array(feature_cols, dtype=object)[idx]
                out[f"reason{k + 1}_shap_value"] = v
                out[f"reason{k + 1}_direction"] = np.where(v > 0, "increases risk", "decreases risk")
            yield pd.DataFrame(out)

    key_type = df.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, base_value double, " + ", ".join(
        f"reason{k + 1}_feature string, reason{k + 1}_shap_value double, reason{k + 1}_direction string"
        for k in range(top_n))
    def filled(c: str):
        x = F.nanvl(df[c].cast("double"), F.lit(None).cast("double"))
        return F.coalesce(x, F.lit(float(fills[c]))) if fills else x
    return df.select(key, *[filled(c).alias(c) for c in feature_cols]).mapInPandas(fn, schema)
