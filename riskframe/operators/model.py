"""Model training, calibration and batch scoring on Spark MLlib (M1-M4, M6).

* GBT (M1): MLlib's boosted trees replace the reference's leaf-wise booster
  (parameter map in SURVEY 4.3). MLlib has no patience, so rounds are fitted in
  blocks of growing length until the best validation AUC lies `patience` rounds
  back; the ensemble is then cut after its best round (same seed -> same trees).
  On many rows the trees are grown by `operators.boosting`, which goes on from
  the last block where MLlib starts anew.
* Isotonic calibration (M3) pools adjacent violators in parallel over the
  validation split's distinct-score table (`operators.isotonic`).
* Scoring (M4) is `transform` + `vector_to_array`; it runs unchanged on
  streaming DataFrames.
"""
from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.prims import counted_side, score_hist
from ..session import materialize, path_exists
from . import isotonic
from .boosting import Boosting
from .isotonic import IsotonicTable


def assembler(feature_cols: Sequence[str] = C.FEATURE_COLUMNS) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"_x_{c}" for c in feature_cols], outputCol="features")


def _prep(df: DataFrame, feature_cols, label: str) -> DataFrame:
    """Feature columns as doubles (NaN is null) and the label; rows without a label teach nothing and go."""
    return df.where(F.col(label).isNotNull()).select(
        *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in feature_cols],
        F.col(label).cast("double").alias("label"))


def missing_fills(prepared: DataFrame, feature_cols: Sequence[str], below: bool) -> dict[str, float]:
    """What stands for a missing value, learned from the training rows in one aggregate.

    below=True: one less than the smallest value, so a tree can send missing values
    their own way; False: the mean, which is neutral in a linear score. A feature
    without any value is filled with 0.
    """
    fn = F.min if below else F.avg
    row = prepared.agg(*[fn(c).alias(c) for c in feature_cols]).first()
    return {c: 0.0 if row[c] is None else float(row[c]) - (1.0 if below else 0.0) for c in feature_cols}


def filler(fills: dict[str, float]) -> SQLTransformer:
    """Pipeline stage (saved with the model) that adds the filled inputs of the assembler."""
    cols = ", ".join(f"COALESCE(NANVL(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), CAST('{v!r}' AS DOUBLE)) AS `_x_{c}`"
                     for c, v in fills.items())
    return SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__")


#: Training rows per partition while trees are grown.
ROWS_PER_PARTITION = 50_000
#: From so many training rows on, the first block of rounds gets no fit of its own.
LONG_START_ROWS = 500_000
#: From so many training rows on, trees are grown by `Boosting`, block after block without a start from scratch.
GROWN_ROWS = 1_000_000


@dataclass
class FittedModel:
    model: PipelineModel
    best_iteration: int
    val_losses: list[float]  # per prefix: -AUC (select_by="auc") or log-loss
    feature_cols: list[str]
    fills: dict[str, float]


#: Cells per prefix of the margin grid; they only bound what is resolved row by row.
MARGIN_CELLS = 16_384


def _margins(vectors: DataFrame, ensemble: tuple[list[dict], list[float]], out: str, emit) -> DataFrame:
    """Runs `emit(margins, labels)` on Arrow batches; margins has a column per tree prefix, as running sums of one pass."""
    from .explain import tree_values
    shared = vectors.sparkSession.sparkContext.broadcast(ensemble)      # model-sized

    def rows(batches):
        trees, weights = shared.value
        for b in batches:
            if b.num_rows:
                x = b.column("x").flatten().to_numpy().reshape(b.num_rows, -1)
                terms = np.stack([w * tree_values(x, t) for t, w in zip(trees, weights)], axis=1)
                yield from emit(np.cumsum(terms, axis=1), b.column("y").to_numpy())

    return vectors.select(vector_to_array("features").alias("x"), F.col("label").cast("long").alias("y")).mapInArrow(rows, out)


def _grid_cell(margins: np.ndarray, low: np.ndarray, width: np.ndarray, n_cells: int) -> np.ndarray:
    return np.clip(((margins - low) / width).astype(np.int64), 0, n_cells - 1)


def _grid(vectors: DataFrame, ensemble: tuple[list[dict], list[float]], low: np.ndarray, width: np.ndarray,
          n_cells: int) -> DataFrame:
    """Positives and negatives per prefix and cell, added up by each task over all its rows, tree by tree."""
    from .explain import tree_values
    shared = vectors.sparkSession.sparkContext.broadcast(ensemble)      # model-sized

    def cells(batches):
        trees, weights = shared.value
        pos, neg = np.zeros((2, len(trees), n_cells), np.int32)
        for b in batches:
            if b.num_rows:
                x, y = b.column("x").flatten().to_numpy().reshape(b.num_rows, -1), b.column("y").to_numpy()
                margins = np.zeros(b.num_rows)
                for k, (t, w) in enumerate(zip(trees, weights)):
                    margins = margins + w * tree_values(x, t)
                    at = _grid_cell(margins, low[k], width[k], n_cells)
                    np.add.at(pos[k], at, y.astype(np.int32))
                    np.add.at(neg[k], at, (1 - y).astype(np.int32))
        for k in range(len(trees)):
            at = np.flatnonzero(pos[k] + neg[k])
            yield pa.RecordBatch.from_arrays([pa.array(at + k * n_cells), pa.array(pos[k][at].astype(np.int64)),
                                              pa.array(neg[k][at].astype(np.int64))], ["cell", "pos", "neg"])

    return vectors.select(vector_to_array("features").alias("x"), F.col("label").cast("long").alias("y")).mapInArrow(
        cells, "cell long, pos long, neg long")


def prefix_auc(gbt_model, val_vectors: DataFrame, only_best: bool = False, n_cells: int = MARGIN_CELLS) -> list[float]:
    """Validation AUC of every tree prefix (1..n) of a fitted model (see `ensemble_auc`)."""
    from .explain import extract_trees
    return ensemble_auc(extract_trees(gbt_model), val_vectors, only_best, n_cells)


def ensemble_auc(ensemble: tuple[list[dict], list[float]], val_vectors: DataFrame, only_best: bool = False,
                 n_cells: int = MARGIN_CELLS) -> list[float]:
    """Validation AUC of every prefix (1..n) of (trees, weights), as `explain.extract_trees` gives them.

    Pass 1 adds up positives and negatives per prefix and cell of a grid over the
    prefix's possible margins (its leaves bound them): `n_cells` rows per prefix and
    task at most, added up where the rows are. Pairs of different cells are then ordered; pairs inside a cell
    leave the AUC between two bounds. Pass 2 sends the rows of cells that hold both
    classes, for prefixes whose bounds are apart, and ranks them inside their cell.
    With `only_best`, pass 2 takes only prefixes that may be the best by their
    bounds: those and the maximum are exact, others are the middle of their bounds.
    Missing a class, every AUC is NaN.
    """
    trees, weights = ensemble
    low = np.cumsum([min(w * v for v in t["value"][t["feature"] < 0]) for t, w in zip(trees, weights)])
    high = np.cumsum([max(w * v for v in t["value"][t["feature"] < 0]) for t, w in zip(trees, weights)])
    width = np.maximum(high - low, 1e-300) / n_cells
    n = len(trees)

    grid = materialize(_grid(val_vectors, ensemble, low, width, n_cells)
                       .groupBy("cell").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
                       .withColumn("k", F.expr(f"CAST(cell div {n_cells} AS INT)")))
    w = Window.partitionBy("k").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)     # n_cells rows at most
    sums = (grid.withColumn("before", F.coalesce(F.sum("neg").over(w), F.lit(0)))
            .groupBy("k").agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
                              F.sum(F.col("pos").cast("double") * F.col("before")).alias("u"),
                              F.sum(F.col("pos").cast("double") * F.col("neg")).alias("open")).collect())
    by_k = {r.k: r for r in sums}
    if len(by_k) < n or any(r.n_pos == 0 or r.n_neg == 0 for r in sums):
        return [float("nan")] * n
    u = np.array([by_k[k].u for k in range(n)])
    gap = np.array([by_k[k].open for k in range(n)])
    pairs = float(by_k[0].n_pos) * float(by_k[0].n_neg)
    wanted = np.flatnonzero((gap > 0) & (u + gap >= u.max() if only_best else True))
    inside = gap / 2
    if len(wanted):
        mixed = grid.where((F.col("pos") > 0) & (F.col("neg") > 0) & F.col("k").isin([int(k) for k in wanted])).select("cell")

        def rows(m, y):
            at = _grid_cell(m[:, wanted], low[wanted], width[wanted], n_cells) + wanted * n_cells
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.ravel()), pa.array(m[:, wanted].ravel()), pa.array(np.repeat(y, len(wanted)))], ["cell", "m", "y"])

        met = (_margins(val_vectors, ensemble, "cell long, m double, y long", rows)
               .join(counted_side(mixed, len(wanted) * n_cells), "cell", "left_semi")
               .groupBy("cell", "m").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")))
        wc = Window.partitionBy("cell").orderBy("m").rowsBetween(Window.unboundedPreceding, -1)
        exact = (met.withColumn("before", F.coalesce(F.sum("neg").over(wc), F.lit(0)))
                 .groupBy(F.expr(f"CAST(cell div {n_cells} AS INT)").alias("k"))
                 .agg(F.sum(F.col("pos") * (F.col("before") + F.col("neg") / 2.0)).alias("u")).collect())
        for r in exact:
            inside[r.k] = r.u
    return [float(a) for a in (u + inside) / pairs]


def truncated(gbt_model, n_trees: int):
    """The first `n_trees` of a fitted ensemble as a model of its own: what a fit with so many rounds gives."""
    trees, weights = gbt_model._java_obj.trees(), list(gbt_model.treeWeights)
    if n_trees >= len(weights):
        return gbt_model
    sc = SparkSession.getActiveSession().sparkContext
    gateway, ml = sc._gateway, sc._jvm.org.apache.spark.ml
    head = gateway.new_array(ml.regression.DecisionTreeRegressionModel, n_trees)
    for i in range(n_trees):
        head[i] = trees[i]
    w = gateway.new_array(gateway.jvm.double, n_trees)
    for i in range(n_trees):
        w[i] = float(weights[i])
    java = ml.classification.GBTClassificationModel(gbt_model.uid, head, w, gbt_model.numFeatures, gbt_model.numClasses)
    return gbt_model._copyValues(GBTClassificationModel(java))


def rounds_in_blocks(max_iter: int, patience: int) -> Iterator[int]:
    """Rounds to fit in turn: the patience and a fifth more, then twice as many, up to `max_iter`."""
    n = patience + max(1, patience // 5)
    while n < max_iter:
        yield n
        n *= 2
    yield max_iter


class Refits:
    """An ensemble that grows by MLlib fits from the start, in blocks; the counterpart of `Boosting` for few rows.

    Fewer than `first` rounds get no fit of their own: they are the head of the fit of
    `first` rounds, which is the same ensemble. So `first` and the blocks change what is
    fitted, never what is returned.
    """

    def __init__(self, gbt: GBTClassifier, tr: DataFrame, blocks: Sequence[int], first: int = 0):
        self.gbt, self.tr, self.blocks, self.first, self.whole = gbt, tr, blocks, first, None

    def grow(self, rounds: int) -> Refits:
        if self.whole is None or len(self.whole.treeWeights) < rounds:
            block = next(n for n in self.blocks if n >= max(rounds, self.first))
            self.whole = self.gbt.copy().setMaxIter(block).fit(self.tr)
        return self

    def extracted(self, n_trees: int) -> tuple[list[dict], list[float]]:
        from .explain import extract_trees
        return extract_trees(self.model(n_trees))

    def model(self, n_trees: int) -> GBTClassificationModel:
        return truncated(self.whole, n_trees)

    def close(self) -> None:
        pass


def _boost(ensemble: Refits | Boosting, va: DataFrame, params: C.GBTParams, select_by: str) -> tuple[list[float], int]:
    """(losses up to the stop, best round) of an ensemble that grows until its best round lies `patience` rounds back.

    It is judged where it might stop at the earliest: `patience` rounds after the best
    one so far. A better round among the new ones moves that point by the patience at
    least, so the stop is that of a look after every round, with few looks.
    """
    rounds = min(params.max_iter, 1 + params.patience)
    while True:
        ensemble.grow(rounds)
        losses = [-a for a in ensemble_auc(ensemble.extracted(rounds), va, only_best=True)] if select_by == "auc" \
            else list(ensemble.model(rounds).evaluateEachIteration(va))
        best = int(np.argmin([np.inf if np.isnan(x) else x for x in losses])) + 1
        if rounds >= min(params.max_iter, best + params.patience):
            return losses, best
        rounds = min(params.max_iter, best + params.patience)


def train_gbt(train: DataFrame, val: DataFrame, params: C.GBTParams = C.GBTParams(),
              feature_cols: Sequence[str] = C.FEATURE_COLUMNS, label: str = C.TARGET_COL,
              select_by: str = "auc") -> FittedModel:
    """Fit boosted trees on train with patience on validation, and keep the best prefix.

    The budget is `params.max_iter` rounds; boosting stops once the best round lies
    `params.patience` rounds back, as after a look at every round: rounds that a block
    holds beyond that stop are not looked at. MLlib cannot go on from a fitted ensemble,
    so rounds are fitted in blocks of growing length, each from the start under the
    same seed (its first trees are those of the block before): at most twice the
    rounds of the last block in all. The result is the last ensemble cut after its
    best round, which needs no further fit.

    The first block ends boosting only if the best round is one of its first few
    (a fifth of the patience); from `LONG_START_ROWS` training rows on, where a round
    costs by its rows, the second block is fitted at once and the first is judged on
    its head (`Refits`), with the same result. From `GROWN_ROWS` on no round is fitted
    twice: `Boosting` grows the same trees and goes on from the block before.

    select_by="auc" (the reference's first early-stopping metric): the prefix with
    the highest validation AUC, earliest on ties; "logloss": the prefix with the
    lowest validation log-loss (`evaluateEachIteration`). Without both classes in
    the validation rows nothing can be chosen, and the first round is kept.
    """
    feature_cols = list(feature_cols)
    prepared = materialize(_prep(train, feature_cols, label))
    fills = missing_fills(prepared, feature_cols, below=True)
    inputs = PipelineModel(stages=[filler(fills), assembler(feature_cols)])
    # every round is a handful of jobs over all partitions: few rows need few of them
    n_rows = prepared.count()
    parts = max(1, -(-n_rows // ROWS_PER_PARTITION))
    tr = inputs.transform(prepared.coalesce(parts)).select("features", "label")
    va = materialize(inputs.transform(_prep(val, feature_cols, label)).select("features", "label"))
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=params.max_iter,
                        stepSize=params.step_size, maxDepth=params.max_depth,
                        minInstancesPerNode=params.min_instances_per_node,
                        featureSubsetStrategy=params.feature_subset, subsamplingRate=params.subsampling_rate,
                        maxBins=params.max_bins, seed=params.seed)
    blocks = [*rounds_in_blocks(params.max_iter, params.patience)]
    ensemble = Boosting(gbt, tr) if n_rows >= GROWN_ROWS else \
        Refits(gbt, tr, blocks, blocks[:2][-1] if n_rows >= LONG_START_ROWS else 0)
    try:
        losses, best = _boost(ensemble, va, params, select_by)
        pm = PipelineModel(stages=[*inputs.stages, ensemble.model(best)])
    finally:
        ensemble.close()
    return FittedModel(pm, best, losses, feature_cols, fills)


def train_scorecard(train: DataFrame, feature_cols: Sequence[str] = C.FEATURE_COLUMNS,
                    label: str = C.TARGET_COL, reg: float = 0.0) -> PipelineModel:
    """Logistic-regression scorecard (M2); its score is a pure column expression of the inputs."""
    feature_cols = list(feature_cols)
    lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=100, regParam=reg)
    prepared = _prep(train, feature_cols, label)
    fills = missing_fills(prepared, feature_cols, below=False)
    return Pipeline(stages=[filler(fills), assembler(feature_cols), lr]).fit(prepared)


def coefficients(model: PipelineModel, feature_cols: Sequence[str]) -> dict[str, float]:
    lr = model.stages[-1]
    return dict(zip(feature_cols, [float(x) for x in lr.coefficients.toArray()])) | {"_intercept": float(lr.intercept)}


def raw_scores(model: PipelineModel, df: DataFrame, out: str = "raw_score") -> DataFrame:
    """Positive-class probability of the model as a double column (keeps all input columns)."""
    keep = df.columns
    t = model.transform(df.select(*keep))
    return t.select(*keep, vector_to_array(F.col("probability"))[1].alias(out))


def fit_isotonic(scored_val: DataFrame, raw: str = "raw_score", label: str = C.TARGET_COL) -> IsotonicTable:
    """Isotonic calibrator of the validation scores (see `operators.isotonic`), clipping outside."""
    return isotonic.fit_isotonic(scored_val, raw, label)


def calibrate(calibrator: IsotonicTable, df: DataFrame, raw: str = "raw_score", out: str = "score") -> DataFrame:
    return calibrator.transform(df, raw, out)


def score_batch(model: PipelineModel, calibrator: IsotonicTable | None, df: DataFrame,
                threshold: float | None) -> DataFrame:
    """Derive -> predict -> calibrate -> decide (M4). Missing calibrator: raw score;
    missing threshold: the configured 0.30 fallback of the reference service."""
    from .features import derived_rates
    from .scoring import decision
    d = derived_rates(df) if "prior_cleared_rate" not in df.columns else df
    r = raw_scores(model, d)
    s = calibrate(calibrator, r) if calibrator is not None else r.withColumn("score", F.col("raw_score"))
    t = C.CONFIGURED_THRESHOLD if threshold is None else threshold
    return s.withColumn("decision", decision(F.col("score"), t)).withColumn("threshold_used", F.lit(float(t)))


def feature_importance(model: PipelineModel, feature_cols: Sequence[str], k: int = 15) -> DataFrame:
    """Top-k split-gain importances of the tree model (M6), as a small DataFrame."""
    from pyspark.sql import SparkSession
    imp = model.stages[-1].featureImportances.toArray()
    spark = SparkSession.getActiveSession()
    rows = [(f, float(v)) for f, v in zip(feature_cols, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)


def save_model(model: PipelineModel, calibrator: IsotonicTable | None, path: str) -> None:
    """MLlib persistence of the pipeline, and the calibrator's tiles as Parquet."""
    model.write().overwrite().save(f"{path}/model")
    if calibrator is not None:
        calibrator.save(f"{path}/calibrator")


def load_model(path: str) -> tuple[PipelineModel, IsotonicTable | None]:
    m = PipelineModel.load(f"{path}/model")
    spark = SparkSession.getActiveSession()
    cal = IsotonicTable.load(spark, f"{path}/calibrator") if path_exists(spark, f"{path}/calibrator") else None
    return m, cal


@dataclass(frozen=True)
class Bundle:
    """What a scoring job needs: the model, its calibrator (or none), its own threshold and its version."""
    model: PipelineModel
    calibrator: IsotonicTable | None
    threshold: float | None
    version: str


MANIFEST_SCHEMA = "version string, number long, threshold double, calibrated boolean"


def _manifests(spark: SparkSession, root: str) -> list:
    if not path_exists(spark, root):
        return []
    return spark.read.schema(MANIFEST_SCHEMA).option("pathGlobFilter", "manifest.json") \
        .option("recursiveFileLookup", True).json(root).orderBy("number", "version").collect()


def save_bundle(spark: SparkSession, bundle: Bundle, root: str) -> str:
    """Write a bundle below `root` and return its folder.

    The manifest comes last and by a rename, so readers see a version whole or not
    at all; a save that was cut short leaves no manifest and may be repeated. A
    version that has a manifest is not overwritten (ValueError).
    """
    known = _manifests(spark, root)
    if bundle.version in {m.version for m in known}:
        raise ValueError(f"version {bundle.version!r} is already saved")
    path = f"{root}/{bundle.version}"
    save_model(bundle.model, bundle.calibrator, path)
    number = 1 + max((m.number for m in known), default=0)
    text = json.dumps({"version": bundle.version, "number": number, "threshold": bundle.threshold,
                       "calibrated": bundle.calibrator is not None})
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    draft, final = hadoop(f"{path}/_manifest.draft"), hadoop(f"{path}/manifest.json")
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(draft, True)
    out.write(text.encode())
    out.close()
    if not fs.rename(draft, final):
        raise OSError(f"could not write {final.toString()}")
    return path


def load_bundle(spark: SparkSession, root: str, version: str | None = None) -> Bundle:
    """A saved bundle, the last one saved by default; LookupError where there is none."""
    found = [m for m in _manifests(spark, root) if version is None or m.version == version]
    if not found:
        raise LookupError(f"no bundle {version or ''} in {root}")
    m = found[-1]
    path = f"{root}/{m.version}"
    calibrator = IsotonicTable.load(spark, f"{path}/calibrator") if m.calibrated else None
    return Bundle(PipelineModel.load(f"{path}/model"), calibrator, m.threshold, m.version)


def score_bundle(bundle: Bundle, df: DataFrame) -> DataFrame:
    """`score_batch` with the bundle's own parts and threshold, and its version as a column.

    Works on batch and streaming frames alike. Only a bundle saved without a
    threshold takes the configured one.
    """
    return score_batch(bundle.model, bundle.calibrator, df, bundle.threshold) \
        .withColumn("model_version", F.lit(bundle.version))
