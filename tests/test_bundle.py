"""Saved model versions: whole or absent, each with its own threshold, the same in batch and on a stream."""
import pytest
from pyspark.sql import functions as F

from conftest import SF
from riskframe import config as C
from riskframe.operators import model
from riskframe.plans.catalog import ep
from riskframe.plans.catalog_model import scorecard_bundle
from riskframe.session import path_exists, scratch_path
from riskframe.streaming import stream as S


@pytest.fixture(scope="module")
def fitted(spark):
    return scorecard_bundle(spark, SF, "first")


def test_versions_keep_their_threshold(spark, fitted):
    root = scratch_path(spark, "test-models")
    with pytest.raises(LookupError):
        model.load_bundle(spark, root)
    model.save_bundle(spark, fitted, root)
    model.save_bundle(spark, model.Bundle(fitted.model, None, 0.77, "a-later-one"), root)
    last, first = model.load_bundle(spark, root), model.load_bundle(spark, root, "first")
    assert (last.version, last.threshold, last.calibrator) == ("a-later-one", 0.77, None)
    assert (first.version, first.threshold) == ("first", fitted.threshold) and first.threshold is not None
    with pytest.raises(ValueError):
        model.save_bundle(spark, fitted, root)
    with pytest.raises(LookupError):
        model.load_bundle(spark, root, "other")
    raw = ep(spark, SF).select("loan_id", *C.RAW_FEATURE_COLUMNS)
    assert {(r.threshold_used, r.model_version) for r in model.score_bundle(last, raw).select(
        "threshold_used", "model_version").distinct().collect()} == {(0.77, "a-later-one")}


def test_a_save_cut_short_is_no_version(spark, fitted):
    root = scratch_path(spark, "test-models")
    model.save_model(fitted.model, fitted.calibrator, f"{root}/first")      # all but the manifest
    with pytest.raises(LookupError):
        model.load_bundle(spark, root)
    path = model.save_bundle(spark, fitted, root)
    assert path_exists(spark, f"{path}/manifest.json") and not path_exists(spark, f"{path}/_manifest.draft")
    assert model.load_bundle(spark, root).version == "first"


def test_stream_equals_batch(spark, fitted):
    root = scratch_path(spark, "test-models")
    model.save_bundle(spark, fitted, root)
    raw = ep(spark, SF).select("loan_id", *C.RAW_FEATURE_COLUMNS)
    path = scratch_path(spark, "test-requests")
    raw.repartition(3, "loan_id").write.parquet(path)
    out, ckpt = S.scratch(spark, "test-scores")
    S.score_stream_bundle(S.file_stream(spark, path, 1), model.load_bundle(spark, root), out, ckpt)
    cols = ["loan_id", "raw_score", "pd", "decision", "threshold", "model_version"]
    streamed = spark.read.parquet(out).select(*cols)
    batch = model.score_bundle(fitted, raw).select("loan_id", "raw_score", F.col("score").alias("pd"), "decision",
                                                   F.col("threshold_used").alias("threshold"), "model_version")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert {r.decision for r in streamed.collect()} == {"APPROVE", "DECLINE"}
