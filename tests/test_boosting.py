"""Boosting with patience: when it stops, what it keeps, and the AUC of every prefix."""
import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.operators import model

COLS = ["a", "b", "c"]


def frame(spark, n, seed, noise):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, noise, n) > 0).astype(int)
    return spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))],
                                 "loan_id long, a double, b double, c double, y int").repartition(3)


def auc(scores, labels):
    pos, neg = scores[labels == 1], scores[labels == 0]
    return ((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / (len(pos) * len(neg))


def test_stops_patience_rounds_after_the_best(spark, monkeypatch):
    fitted_rounds, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df, *a: fitted_rounds.append(self.getMaxIter()) or fit(self, df, *a))
    tr, va = frame(spark, 600, 1, 2.0), frame(spark, 400, 2, 2.0)
    p = C.GBTParams(max_iter=1000, patience=5, max_depth=3, step_size=0.3, min_instances_per_node=5)
    got = model.train_gbt(tr, va, p, COLS, "y")
    assert fitted_rounds[-1] < 1000 and fitted_rounds == list(model.rounds_in_blocks(1000, 5))[:len(fitted_rounds)]
    assert len(got.val_losses) == got.best_iteration + 5
    kept = got.model.stages[-1]
    assert len(kept.treeWeights) == got.best_iteration and kept.numFeatures == 3
    # the same as a fit of just so many rounds, and better than every round looked at
    whole = fit(GBTClassifier(featuresCol="features", labelCol="label", maxIter=got.best_iteration, stepSize=0.3, maxDepth=3,
                              minInstancesPerNode=5, featureSubsetStrategy=p.feature_subset, subsamplingRate=p.subsampling_rate,
                              maxBins=p.max_bins, seed=p.seed),
                got.model.stages[1].transform(got.model.stages[0].transform(
                    tr.coalesce(1).withColumn("label", F.col("y").cast("double")))).select("features", "label"))
    assert whole.toDebugString.split("\n")[1:] == kept.toDebugString.split("\n")[1:]
    rows = model.raw_scores(got.model, va).select("raw_score", "y").collect()
    best = auc(np.array([r.raw_score for r in rows]), np.array([r.y for r in rows]))
    assert -min(got.val_losses) == pytest.approx(best, abs=1e-9)


def test_budget_ends_the_fit(spark):
    tr, va = frame(spark, 300, 3, 0.1), frame(spark, 200, 4, 0.1)
    got = model.train_gbt(tr, va, C.GBTParams(max_iter=4, patience=50, max_depth=2), COLS, "y")
    assert len(got.val_losses) == 4 and 1 <= got.best_iteration <= 4
    one_class = va.withColumn("y", F.lit(0))
    got = model.train_gbt(tr, one_class, C.GBTParams(max_iter=3, patience=50, max_depth=2), COLS, "y")
    assert got.best_iteration == 1 and all(np.isnan(got.val_losses))
    assert list(model.rounds_in_blocks(1000, 50)) == [60, 120, 240, 480, 960, 1000]


@pytest.mark.parametrize("cells", [16_384, 4])
def test_prefix_auc_is_exact_whatever_the_grid(spark, cells):
    """A coarse grid only sends more rows to the second pass."""
    df = frame(spark, 500, 5, 1.0)
    vec = VectorAssembler(inputCols=COLS, outputCol="features").transform(df).select("features", F.col("y").cast("double").alias("label"))
    m = GBTClassifier(maxIter=6, maxDepth=3, seed=1).fit(vec)
    want = []
    for k in range(1, 7):
        rows = model.truncated(m, k).transform(vec).select(vector_to_array("probability")[1].alias("p"), "label").collect()
        want.append(auc(np.array([r.p for r in rows]), np.array([r.label for r in rows])))
    assert model.prefix_auc(m, vec, n_cells=cells) == pytest.approx(want, abs=1e-12)
    best = model.prefix_auc(m, vec, only_best=True, n_cells=cells)
    assert max(best) == pytest.approx(max(want), abs=1e-12) and int(np.argmax(best)) == int(np.argmax(want))


def test_truncated_models_are_saved(spark, tmp_path):
    tr, va = frame(spark, 300, 6, 1.0), frame(spark, 200, 7, 1.0)
    got = model.train_gbt(tr, va, C.GBTParams(max_iter=6, patience=2, max_depth=2, step_size=0.5), COLS, "y")
    model.save_model(got.model, None, str(tmp_path / "m"))
    back, _ = model.load_model(str(tmp_path / "m"))
    a, b = ([r.raw_score for r in model.raw_scores(m, va).orderBy("loan_id").collect()] for m in (got.model, back))
    assert a == b


def test_many_rows_skip_the_first_fit_and_get_the_same_model(spark, monkeypatch):
    fitted_rounds, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df, *a: fitted_rounds.append(self.getMaxIter()) or fit(self, df, *a))
    tr, va = frame(spark, 600, 1, 2.0), frame(spark, 400, 2, 2.0)
    p = C.GBTParams(max_iter=1000, patience=5, max_depth=2, step_size=0.1, min_instances_per_node=5)
    few = model.train_gbt(tr, va, p, COLS, "y")
    assert fitted_rounds[:2] == [6, 12]
    plain = fitted_rounds.copy()
    fitted_rounds.clear()
    monkeypatch.setattr(model, "LONG_START_ROWS", 600)
    many = model.train_gbt(tr, va, p, COLS, "y")
    assert fitted_rounds == plain[1:]
    assert (many.best_iteration, many.val_losses) == (few.best_iteration, few.val_losses)
    assert many.model.stages[-1].toDebugString.split("\n")[1:] == few.model.stages[-1].toDebugString.split("\n")[1:]
    # a first block that already ends boosting is judged as if it had been fitted alone
    stop = C.GBTParams(max_iter=1000, patience=5, max_depth=2, min_instances_per_node=5)
    one_class = va.withColumn("y", F.lit(0))
    fitted_rounds.clear()
    got = model.train_gbt(tr, one_class, stop, COLS, "y")
    assert fitted_rounds == [12] and got.best_iteration == 1 and len(got.val_losses) == 6


def test_draws_are_those_of_spark(spark):
    from riskframe.operators import boosting
    jvm = spark.sparkContext._jvm
    for seed in (0, 42, -7, 1 << 40):
        r = jvm.org.apache.spark.util.random.XORShiftRandom(seed)
        assert boosting.uniforms(seed, 300).tolist() == [r.nextDouble() for _ in range(300)]
    assert np.array_equal(boosting.uniforms(5, 400_000)[3 * boosting.CHUNK:], boosting.uniforms(5, 400_000 - 3 * boosting.CHUNK, 3 * boosting.CHUNK))
    r, own = jvm.java.util.Random(9), boosting.JavaRandom(9)
    assert [r.nextLong() % (1 << 64) for _ in range(20)] == [own.next_long() for _ in range(20)]


@pytest.mark.parametrize("parts,depth,rate,direct", [(1, 5, 0.8, 64), (3, 3, 0.8, 1), (2, 4, 1.0, 64), (1, 0, 0.8, 64)])
def test_grown_trees_are_those_of_a_fit(spark, monkeypatch, parts, depth, rate, direct):
    """Grown in two steps and over a rebase, several chunks and constant, repeated and missing values included."""
    from riskframe.operators import boosting
    from riskframe.operators.explain import extract_trees
    monkeypatch.setattr(boosting, "REBASE", 4)
    monkeypatch.setattr(boosting, "DIRECT_TASKS", direct)
    df = frame(spark, 900, 8, 1.0).coalesce(parts).withColumn("same", F.lit(2.0)).withColumn("few", F.floor("b") * 1.0)
    cols = [*COLS, "same", "few"]
    vec = VectorAssembler(inputCols=cols, outputCol="features").transform(df).select("features", F.col("y").cast("double").alias("label"))
    gbt = GBTClassifier(maxIter=7, maxDepth=depth, stepSize=0.2, minInstancesPerNode=5, featureSubsetStrategy="0.7", subsamplingRate=rate,
                        maxBins=32, seed=11)
    want, grown = gbt.fit(vec), boosting.Boosting(gbt, vec)
    got = grown.grow(3).grow(7).model(7)
    for forms in (extract_trees(got), grown.extracted(7)):
        assert forms[1] == list(want.treeWeights)
    for a, b in zip(extract_trees(got)[0], extract_trees(want)[0]):
        assert a["feature"].tolist() == b["feature"].tolist() and a["cover"].tolist() == b["cover"].tolist()
        assert a["threshold"].tolist() == b["threshold"].tolist()
        assert a["value"] == pytest.approx(b["value"], rel=1e-9, abs=1e-12)
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), abs=1e-9)
    assert model.ensemble_auc(grown.extracted(7), vec) == pytest.approx(model.prefix_auc(want, vec), abs=1e-9)
    assert model.ensemble_auc(grown.extracted(4), vec) == pytest.approx(model.prefix_auc(model.truncated(want, 4), vec), abs=1e-9)
    grown.close()


def test_chunks_and_uneven_partitions(spark, monkeypatch):
    """Partitions of several chunks draw the rows MLlib draws, and no rows are lost."""
    from riskframe.operators import boosting
    from riskframe.operators.explain import extract_trees
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2 * boosting.CHUNK + 777, 1))
    df = spark.createDataFrame([(float(a), float(a + b > 0)) for a, b in zip(x[:, 0], rng.normal(size=len(x)))], "a double, label double", 2)
    vec = VectorAssembler(inputCols=["a"], outputCol="features").transform(df.coalesce(1)).select("features", "label").cache()
    gbt = GBTClassifier(maxIter=2, maxDepth=2, subsamplingRate=0.8, seed=4)
    got, want = extract_trees(boosting.Boosting(gbt, vec).grow(2).model(2))[0], extract_trees(gbt.fit(vec))[0]
    for a, b in zip(got, want):
        assert a["threshold"].tolist() == b["threshold"].tolist() and a["cover"].tolist() == b["cover"].tolist()
        assert a["value"] == pytest.approx(b["value"], rel=1e-9)


def test_many_rows_are_grown_without_a_fit_and_give_the_same_model(spark, monkeypatch):
    tr, va = frame(spark, 600, 1, 2.0), frame(spark, 400, 2, 2.0)
    p = C.GBTParams(max_iter=1000, patience=5, max_depth=2, step_size=0.1, min_instances_per_node=5)
    few = model.train_gbt(tr, va, p, COLS, "y")
    monkeypatch.setattr(model, "GROWN_ROWS", 600)
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df, *a: pytest.fail("fitted from the start"))
    many = model.train_gbt(tr, va, p, COLS, "y")
    assert many.best_iteration == few.best_iteration and many.val_losses == pytest.approx(few.val_losses, abs=1e-9)
    a, b = ([r.raw_score for r in model.raw_scores(m.model, va).orderBy("loan_id").collect()] for m in (many, few))
    assert a == pytest.approx(b, abs=1e-9)
    one_class = va.withColumn("y", F.lit(0))
    got = model.train_gbt(tr, one_class, p, COLS, "y")
    assert got.best_iteration == 1 and all(np.isnan(got.val_losses))
    by_loss = model.train_gbt(tr, va, C.GBTParams(max_iter=8, patience=5, max_depth=2), COLS, "y", select_by="logloss")
    assert len(by_loss.val_losses) <= 8 and by_loss.best_iteration >= 1


def test_stop_is_that_of_a_look_after_every_round(monkeypatch):
    """A later round that is better, but past the stop, is not taken, whatever the rounds of a block."""
    rng = np.random.default_rng(0)

    class Ensemble:
        grown = 0

        def grow(self, rounds):
            self.grown = max(self.grown, rounds)

        def extracted(self, n):
            return n

    for _ in range(300):
        p = C.GBTParams(max_iter=int(rng.integers(1, 60)), patience=int(rng.integers(1, 12)))
        aucs = np.where(rng.random(60) < 0.1, np.nan, np.round(rng.random(60), 1) + np.arange(60) * rng.choice([0, 0.02]))
        best, stop = 0, p.max_iter
        for i in range(p.max_iter):
            if np.isnan(aucs[best]) and not np.isnan(aucs[i]) or aucs[i] > aucs[best]:
                best = i
            if i + 1 >= best + 1 + p.patience:
                stop = i + 1
                break
        if np.isnan(aucs[0]):
            continue        # without a first AUC there are none at all
        monkeypatch.setattr(model, "ensemble_auc", lambda n, va, only_best: list(aucs[:n]))
        e = Ensemble()
        losses, got = model._boost(e, None, p, "auc")
        assert (len(losses), got, e.grown) == (stop, best + 1, stop)
