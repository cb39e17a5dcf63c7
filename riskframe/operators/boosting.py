"""Boosted trees that can go on from where they stopped (M1, many rows).

MLlib's `GBTClassifier` returns an ensemble and forgets the rest: more rounds mean
a fit from the start, and every level of a tree reads boxed rows. `Boosting` grows the
same trees from the same draws and keeps what the next round needs:

* MLlib's own code checks the rows and chooses the bins (`findSplits`). Rows are
  binned once, into chunks of bytes that are dealt evenly.
* A round draws its rows per partition as MLlib does (XORShift seeded by seed, round
  and partition, computed in lanes) and features per node (reservoir of the same
  generator). A level is one job: tasks add up count, sum and squares per node, feature
  and bin, and the driver holds these sums alone, whatever the number of rows.
* Splits follow `RandomForest.binsToBestSplit` for the variance: gains, limits, order
  of ties, leaves, merged equal leaves. The model is built from MLlib's node classes.
  (MLlib grows a level in parts when its sums exceed `maxMemoryInMB`, 256 by default,
  and then draws features anew; here a level is always one part.)

Sums of one chunk are added in MLlib's order; those of several are added in the order
of chunks, where MLlib takes those of partitions as they arrive, so its last bits vary
and these do not.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame

from ..session import materialize

#: Steps of a generator's lane; lanes run side by side.
LANE = 256
#: Rows that a task holds at a time: whole lanes.
CHUNK = 1 << 16
#: Rows that a task walks through at most, as far as chunks can be dealt evenly.
TASK_ROWS = 1 << 22
#: Rounds after which margins are added up anew from the binned rows, so that lineage stays short.
REBASE = 25
#: Bytes as they are: packing and unpacking them each pass costs as much as the sums.
KEPT = StorageLevel.MEMORY_AND_DISK_DESER
#: Tasks whose sums the driver adds itself; those of more are added on the cluster first.
DIRECT_TASKS = 64
MASK32, MASK64 = (1 << 32) - 1, (1 << 64) - 1
#: `Utils.EPSILON`: a child of less impurity is a leaf.
EPSILON = 2.0 ** -52


# ---------------------------------------------------------------- draws
def _bytes_hash(data: bytes, seed: int) -> int:
    """MurmurHash3 of whole words, as `scala.util.hashing` computes it."""
    h = seed
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & MASK32
        k = (k << 15 | k >> 17) & MASK32
        h ^= k * 0x1B873593 & MASK32
        h = (h << 13 | h >> 19) & MASK32
        h = h * 5 + 0xE6546B64 & MASK32
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & MASK32
    h = (h ^ h >> 13) * 0xC2B2AE35 & MASK32
    return h ^ h >> 16


def _hashed(seed: int) -> int:
    """First state of Spark's `XORShiftRandom`."""
    data = (seed & MASK64).to_bytes(8, "big")
    low = _bytes_hash(data, 0x3C074A61)
    return _bytes_hash(data, low) << 32 | low


def _step(s: np.ndarray) -> np.ndarray:
    s = s ^ (s << np.uint64(21))
    s ^= s >> np.uint64(35)
    s ^= s << np.uint64(4)
    return s


def _applied(columns: np.ndarray, states: np.ndarray) -> np.ndarray:
    """A linear map over bits, given by the images of the 64 bits, on every state."""
    out = np.zeros_like(states)
    for b in range(64):
        out ^= columns[b] * (states >> np.uint64(b) & np.uint64(1))
    return out


@lru_cache
def _jump(k: int) -> np.ndarray:
    """The map of 2^k lanes."""
    if k:
        return _applied(_jump(k - 1), _jump(k - 1))
    jump = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for _ in range(LANE):
        jump = _step(jump)
    return jump


def uniforms(seed: int, n: int, skip: int = 0) -> np.ndarray:
    """n values of `new XORShiftRandom(seed).nextDouble()` after the first `skip`, of whole lanes; two states each."""
    lanes = max(1, -(-2 * n // LANE))
    starts = np.array([_hashed(seed)], np.uint64)
    for k in range((2 * skip // LANE).bit_length()):
        if 2 * skip // LANE >> k & 1:
            starts = _applied(_jump(k), starts)
    for k in range((lanes - 1).bit_length()):
        starts = np.concatenate([starts, _applied(_jump(k), starts)])
    s, states = starts[:lanes], np.empty((LANE, lanes), np.uint64)
    for i in range(LANE):
        s = states[i] = _step(s)
    first, second = states.T.reshape(-1, 2)[:n].T
    high = (first & np.uint64((1 << 26) - 1)) << np.uint64(27)
    return (high + (second & np.uint64((1 << 27) - 1))).astype(np.float64) * 2.0 ** -53


class JavaRandom:
    """`nextLong` of `java.util.Random`."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def _next32(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & (1 << 48) - 1
        v = self.state >> 16
        return v - (1 << 32) if v >> 31 else v

    def next_long(self) -> int:
        return ((self._next32() << 32) + self._next32()) & MASK64


def feature_subset(n: int, k: int, seed: int) -> list[int]:
    """`SamplingUtils.reservoirSampleAndCount` of k out of range(n)."""
    out = list(range(min(n, k)))
    for item, u in zip(range(k, n), uniforms(seed, max(0, n - k))):
        at = int(u * (item + 1))
        if at < k:
            out[at] = item
    return out


# ---------------------------------------------------------------- tasks
def _binned(thresholds: list[np.ndarray], kind: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition as chunks: its number, the first row, the rows' bins (a line of bytes per feature), labels of -1 and 1."""
    part, start = TaskContext.get().partitionId(), 0
    x, y = np.empty((len(thresholds), 0), kind), np.empty(0, np.int8)

    def row(n):
        values = [part, start, x[:, :n].tobytes(), y[:n].tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                                          ["part", "start", "x", "y"])

    for b in batches:
        raw = b.column("x").flatten().to_numpy().reshape(b.num_rows, -1)
        x = np.concatenate([x, *([np.stack([np.searchsorted(t, raw[:, f]).astype(kind) for f, t in enumerate(thresholds)])]
                                 if b.num_rows else [])], axis=1)
        y = np.concatenate([y, (b.column("y").to_numpy() * 2 - 1).astype(np.int8)])
        while len(y) >= CHUNK:
            yield row(CHUNK)
            x, y, start = x[:, CHUNK:], y[CHUNK:], start + CHUNK
    if len(y):
        yield row(len(y))


def _at(x: np.ndarray, tree: dict, depth: int) -> np.ndarray:
    """The node of every row after `depth` levels; a leaf's own cut keeps its rows."""
    n = x.shape[1]
    at, flat, rows = np.zeros(n, np.int64), x.ravel(), np.arange(n)
    for _ in range(depth):
        at = tree["left"][at] + (flat[tree["feature"][at] * n + rows] > tree["cut"][at])
    return at


def _start(kind: str, trees: list[tuple[dict, float]], row) -> tuple:
    y = np.frombuffer(row.y, np.int8)
    x = np.frombuffer(row.x, kind).reshape(-1, len(y))
    margin = np.zeros(len(y))
    for tree, weight in trees:
        margin = margin + tree["value"][_at(x, tree, tree["depth"])] * weight
    return (row.part, row.start), x, y, margin, None


def _drawn(seed: int, rate: float, grown: tuple[dict, float] | None, state: tuple) -> tuple:
    """A chunk with the margins of one more tree and the rows of the next round."""
    (part, start), x, y, margin, _ = state
    if grown is not None:
        tree, weight = grown
        margin = margin + tree["value"][_at(x, tree, tree["depth"])] * weight
    keep = None if rate == 1.0 else np.packbits(uniforms(seed + part + 1, len(y), start) < rate)
    return (part, start), x, y, margin, keep


def _sums(tree: dict, depth: int, slot: np.ndarray, n_slots: int, features: list[int], bins: int, first: bool,
          states: Iterable[tuple]) -> Iterator[np.ndarray]:
    """Count, sum and sum of squares of the residuals per feature, node and bin."""
    total = np.zeros((3, len(features), n_slots * bins))
    for _, x, y, margin, keep in states:
        if keep is not None:
            rows = np.flatnonzero(np.unpackbits(keep, count=len(y)))
            x, y, margin = np.take(x, rows, axis=1), y[rows], margin[rows]
        s = slot[_at(x, tree, depth)]
        if (s < 0).any():
            rows = np.flatnonzero(s >= 0)
            x, y, margin, s = np.take(x, rows, axis=1), y[rows], margin[rows], s[rows]
        label = y.astype(np.float64)
        r = label if first else 4.0 * label / (1.0 + np.exp(2.0 * label * margin))
        squares = r * r
        s = s * bins
        for i, f in enumerate(features):
            cell = s + x[f]
            total[0, i] += np.bincount(cell, minlength=n_slots * bins)
            total[1, i] += np.bincount(cell, r, n_slots * bins)
            total[2, i] += np.bincount(cell, squares, n_slots * bins)
    yield total.reshape(3, len(features), n_slots, bins)


# ---------------------------------------------------------------- driver
def _impurity(n, s, q):
    """Variance of n values with sum s and sum of squares q; 0 of none."""
    n, s, q = np.asarray(n, float), np.asarray(s, float), np.asarray(q, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n == 0, 0.0, (q - s * s / n) / n)


def _scala_object(package, name: str):
    return getattr(getattr(package, f"{name}$"), "MODULE$")


class Boosting:
    """An ensemble of `gbt`'s parameters on `tr` (features, label) that grows round by round."""

    def __init__(self, gbt: GBTClassifier, tr: DataFrame):
        self.gbt = gbt
        self.trees: list[dict] = []
        self.sc = tr.sparkSession.sparkContext
        jvm = self.sc._jvm
        gbt._transfer_params_to_java()
        java = gbt._java_obj
        instances = _scala_object(jvm.org.apache.spark.ml.util, "DatasetUtils").extractInstances(
            java, tr._jdf, jvm.scala.Option.apply(2))
        algo = _scala_object(jvm.org.apache.spark.mllib.tree.configuration, "Algo")
        strategy = java.getOldBoostingStrategy(jvm.PythonUtils.toScalaMap({}), algo.Classification()).treeStrategy().copy()
        strategy.setAlgo(algo.Regression())
        strategy.setImpurity(_scala_object(jvm.org.apache.spark.mllib.tree.impurity, "Variance"))
        impl = jvm.org.apache.spark.ml.tree.impl
        meta = _scala_object(impl, "DecisionTreeMetadata").buildMetadata(instances, strategy, 1, gbt.getFeatureSubsetStrategy())
        self.thresholds = [np.array([s.threshold() for s in line])
                           for line in _scala_object(impl, "RandomForest").findSplits(instances, meta, gbt.getSeed())]
        self.n_features, self.per_node = meta.numFeatures(), meta.numFeaturesPerNode()
        self.min_rows, self.min_gain = max(meta.minInstancesPerNode(), meta.minWeightPerNode()), meta.minInfoGain()
        self.bins = max(len(t) for t in self.thresholds) + 1
        self.kind = "uint8" if self.bins <= 256 else "uint16" if self.bins <= 65_536 else "int32"
        chunks = tr.select(vector_to_array("features").alias("x"), tr["label"].cast("double").alias("y")).mapInArrow(
            partial(_binned, self.thresholds, self.kind), "part int, start long, x binary, y binary")
        # dealt evenly and in a fixed order, so that sums are added in the same order each time
        tasks = max(self.sc.defaultParallelism, -(-meta.numExamples() // TASK_ROWS))
        self.chunks = materialize(chunks.repartitionByRange(tasks, "part", "start").sortWithinPartitions("part", "start")).rdd
        self.state: RDD | None = None

    @property
    def weights(self) -> list[float]:
        return [1.0 if i == 0 else self.gbt.getStepSize() for i in range(len(self.trees))]

    def grow(self, rounds: int) -> Boosting:
        """Goes on until the ensemble has `rounds` trees."""
        while len(self.trees) < rounds:
            self._round()
        return self

    def _round(self) -> None:
        m, before = len(self.trees), self.state
        draw = partial(_drawn, self.gbt.getSeed() + m, self.gbt.getSubsamplingRate())
        if m % REBASE == 0 or before is None:
            state = self.chunks.map(partial(_start, self.kind, list(zip(self._compact(), self.weights)))).map(partial(draw, None))
        else:
            state = before.map(partial(draw, (self._compact()[-1], self.weights[-1])))
        self.state = state.persist(KEPT)
        self.trees.append(self._tree(m))
        if before is not None:
            before.unpersist()

    def _compact(self) -> list[dict]:
        return [{k: t[k] for k in ("feature", "cut", "left", "value", "depth")} for t in self.trees]

    def _summed(self, sums) -> np.ndarray:
        partials = self.state.mapPartitions(sums)
        if partials.getNumPartitions() <= DIRECT_TASKS:
            total = None
            for p in partials.collect():
                total = p if total is None else total + p
            return total
        return partials.treeReduce(np.add)

    def _tree(self, m: int) -> dict:
        """The tree of round m, level by level as `RandomForest.runBagged` queues its nodes."""
        rng = JavaRandom(self.gbt.getSeed() + m)
        # node: stats (count, sum, squares), impurity, feature, cut, left child, gain; children are neighbours
        nodes = [{"stats": None, "impurity": None, "feature": -1}]
        queue = [0]
        for depth in range(max(1, self.gbt.getMaxDepth())):
            if not queue:
                break
            subsets = [feature_subset(self.n_features, self.per_node, rng.next_long()) if self.per_node < self.n_features
                       else list(range(self.n_features)) for _ in queue]
            used = sorted({f for s in subsets for f in s})
            slot = np.full(len(nodes), -1)
            slot[queue] = np.arange(len(queue))
            total = self._summed(partial(_sums, self._arrays(nodes, depth), depth, slot, len(queue), used, self.bins, m == 0))
            found, queue = queue, []
            for at, best in zip(found, self._splits([nodes[at] for at in found], subsets, used, total)):
                if best is None or best["gain"] <= 0 or self.gbt.getMaxDepth() == 0:
                    nodes[at]["unsplit"] = best is None
                    continue
                left, pair = len(nodes), best.pop("children")
                nodes[at] |= best | {"left": left}
                for child, stats in zip((left, left + 1), pair):
                    nodes.append({"stats": stats, "impurity": float(_impurity(*stats)), "feature": -1})
                    if depth + 1 < self.gbt.getMaxDepth() and abs(nodes[child]["impurity"]) >= EPSILON:
                        queue.insert(0, child)
        return self._arrays(nodes, self.gbt.getMaxDepth()) | {"nodes": nodes}

    def _splits(self, nodes: list[dict], subsets: list[list[int]], used: list[int], total: np.ndarray) -> Iterator[dict | None]:
        """The best split of every node, or none; the first of equal gains in the order of features drawn and bins."""
        n_splits = np.array([len(self.thresholds[f]) for f in used])
        left = np.cumsum(total, axis=3)
        right = left[..., -1:] - left
        line = {f: i for i, f in enumerate(used)}
        for k, node in enumerate(nodes):
            if node["stats"] is None:       # the root has no parent to tell its totals
                i = next((line[f] for f in subsets[k] if n_splits[line[f]]), line[subsets[k][0]])
                node["stats"] = left[:, i, k, 0] + right[:, i, k, 0]
                node["impurity"] = float(_impurity(*node["stats"]))
        impurity = np.array([n["impurity"] for n in nodes])[None, :, None]
        both = left[0] + right[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = impurity - left[0] / both * _impurity(*left) - right[0] / both * _impurity(*right)
        valid = (left[0] >= self.min_rows) & (right[0] >= self.min_rows) & (gain >= self.min_gain)
        gain = np.where(valid & (np.arange(self.bins) < n_splits[:, None, None]), gain, -np.inf)
        cut = gain.argmax(axis=2)
        top = np.take_along_axis(gain, cut[..., None], axis=2)[..., 0]
        for k, subset in enumerate(subsets):
            f = subset[int(np.argmax([top[line[f], k] for f in subset]))]
            i, c = line[f], int(cut[line[f], k])
            yield None if np.isinf(top[i, k]) else {"gain": float(top[i, k]), "feature": f, "cut": c,
                                                    "children": (left[:, i, k, c], right[:, i, k, c])}

    def _arrays(self, nodes: list[dict], depth: int) -> dict:
        """Node arrays for the tasks: leaves lead to themselves."""
        inner = [n["feature"] >= 0 for n in nodes]
        return {"feature": np.array([n["feature"] if i else 0 for n, i in zip(nodes, inner)]),
                "cut": np.array([n["cut"] if i else self.bins for n, i in zip(nodes, inner)]),
                "left": np.array([n["left"] if i else k for k, (n, i) in enumerate(zip(nodes, inner))]),
                "value": np.array([n["stats"][1] / n["stats"][0] if n["stats"] is not None and n["stats"][0] else 0.0 for n in nodes]),
                "depth": depth}

    # ------------------------------------------------------------ the ensemble for others
    def extracted(self, n_trees: int) -> tuple[list[dict], list[float]]:
        """The first trees in the form of `explain.extract_trees`, without a model."""
        out = []
        for t in self.trees[:n_trees]:
            inner = np.array([n["feature"] >= 0 for n in t["nodes"]])
            out.append({"feature": np.where(inner, t["feature"], -1),
                        "threshold": np.array([self.thresholds[n["feature"]][n["cut"]] if i else 0.0 for n, i in zip(t["nodes"], inner)]),
                        "left": np.where(inner, t["left"], -1), "right": np.where(inner, t["left"] + 1, -1),
                        "value": t["value"], "cover": np.array([n["stats"][0] for n in t["nodes"]])})
        return out, self.weights[:n_trees]

    def _java_tree(self, t: dict):
        ml = self.sc._jvm.org.apache.spark.ml
        nodes = t["nodes"]
        stats = _py2java(self.sc, DenseVector(np.concatenate([[*n["stats"], n["stats"][0]] for n in nodes]))).toArray()
        calculators = self.sc._jvm.org.apache.spark.mllib.tree.impurity.VarianceAggregator()
        built: list = [None] * len(nodes)
        for k in range(len(nodes) - 1, -1, -1):        # children come after their parent
            n, value = nodes[k], float(t["value"][k])
            calculator = calculators.getCalculator(stats, 4 * k)
            if n["feature"] >= 0:
                (a, pa_), (b, pb) = built[n["left"]], built[n["left"] + 1]
                if pa_ is not None and pa_ == pb:       # both are leaves and say the same
                    built[k] = (ml.tree.LeafNode(pa_, n["impurity"], calculator), pa_)
                    continue
                cut = ml.tree.ContinuousSplit(n["feature"], float(self.thresholds[n["feature"]][n["cut"]]))
                built[k] = (ml.tree.InternalNode(value, n["impurity"], n["gain"], a, b, cut, calculator), None)
            else:
                built[k] = (ml.tree.LeafNode(value, -1.0 if n.get("unsplit") else n["impurity"], calculator), value)
        return ml.regression.DecisionTreeRegressionModel(built[0][0], self.n_features)

    def model(self, n_trees: int) -> GBTClassificationModel:
        """The first trees as the model a fit with so many rounds gives."""
        gateway, ml = self.sc._gateway, self.sc._jvm.org.apache.spark.ml
        head = gateway.new_array(ml.regression.DecisionTreeRegressionModel, n_trees)
        w = gateway.new_array(gateway.jvm.double, n_trees)
        for i, (t, weight) in enumerate(zip(self.trees[:n_trees], self.weights)):
            head[i], w[i] = self._java_tree(t), weight
        java = ml.classification.GBTClassificationModel(self.gbt.uid, head, w, self.n_features, 2)
        return self.gbt._copyValues(GBTClassificationModel(java))

    def close(self) -> None:
        if self.state is not None:
            self.state.unpersist()
            self.state = None
