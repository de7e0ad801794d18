"""Batched trainer against the library's SGD trainers; scoring plans agree."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators import score as SC
from tagloom.operators import train as TR
from tagloom.sources import testdata as td

from conftest import SF_SMALL

DIMS = 64
FEATS = [f"e{i}" for i in range(DIMS)]


def _examples(spark):
    emb = td.embedding_tracks(spark, SF_SMALL, DIMS)
    parts = [
        emb.select(F.lit(f"label_{k}").alias("tag"), "track_id",
                   F.array_contains("tags", f"label_{k}").cast("double").alias("y"), *FEATS)
        for k in (0, 5)
    ]
    return parts[0].unionByName(parts[1])


@pytest.mark.parametrize("loss", ["hinge", "logistic"])
def test_matches_library_sgd(spark, loss):
    from pyspark.mllib.classification import LogisticRegressionWithSGD, SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint

    ex = _examples(spark)
    iters = 100
    model = TR.train_linear_all_tags(ex, FEATS, loss=loss, iterations=iters, split=None).collect()
    assert len(model) == 2
    for r in model:
        sub = ex.filter(F.col("tag") == r.tag).select("y", *FEATS).collect()
        rdd = spark.sparkContext.parallelize([LabeledPoint(x[0], list(x[1:])) for x in sub], 3)
        trainer = SVMWithSGD if loss == "hinge" else LogisticRegressionWithSGD
        ref = trainer.train(rdd, iterations=iters, step=1.0, regParam=0.01, intercept=True)
        ours = np.array(list(r.weights) + [r.intercept])
        theirs = np.array(list(ref.weights) + [ref.intercept])
        assert r.iterations <= iters and np.abs(ours - theirs).max() < 1e-9


def test_score_all_tags_matches_join_plan(spark):
    ex = _examples(spark)
    w = SC.class_mean_weights(ex, FEATS)
    tracks = td.embedding_tracks(spark, SF_SMALL, DIMS)
    allm = {(r.track_id, r.tag): (r.margin, r.rank) for r in SC.score_all_tags(tracks, w, FEATS).collect()}
    joined = SC.with_margin(ex, w, FEATS).collect()
    for r in joined[:200]:
        assert abs(allm[(r.track_id, r.tag)][0] - r.margin) < 1e-9
    ranks = {}
    for (tid, tag), (m, k) in allm.items():
        ranks.setdefault(tid, []).append((k, -m))
    for lst in ranks.values():
        lst.sort()
        assert [k for k, _ in lst] == [1, 2]
        assert lst[0][1] <= lst[1][1]
    top1 = SC.score_all_tags(tracks, w, FEATS, top_k=1)
    assert top1.count() == tracks.count()


def test_one_tag_pipeline_round_trip(spark, tmp_path):
    from pyspark.ml import PipelineModel

    ex = _examples(spark).filter(F.col("tag") == "label_0")
    pm = TR.train_one_tag(ex, FEATS, model="logistic", iterations=20)
    pm.write().overwrite().save(str(tmp_path / "m"))
    a = TR.margins_from_pipeline(pm, ex).select("track_id", "margin").orderBy("track_id").collect()
    b = TR.margins_from_pipeline(PipelineModel.load(str(tmp_path / "m")), ex).select("track_id", "margin").orderBy("track_id").collect()
    assert a == b


@pytest.mark.parametrize("model", ["logistic", "svm"])
def test_fitted_pipeline_after_an_observation(spark, model):
    """A session in which anything was observed can't be sent to tasks."""
    from pyspark.sql import Observation

    seen = Observation()
    assert spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).count() == 3 and seen.get["n"] == 3
    ex = _examples(spark).filter(F.col("tag") == "label_0")
    pm = TR.train_one_tag(ex, FEATS, model=model, iterations=20)
    rows = TR.margins_from_pipeline(pm, ex).select("margin", "prediction").collect()
    assert len(rows) == ex.count() and all((r.margin > 0) == (r.prediction == 1.0) for r in rows)
    assert pm.stages[-1].hasSummary


def test_lbfgs_matches_library(spark):
    """Against pyspark.ml's logistic regression, with a penalty so that a separable tag has a solution."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    feats = FEATS[:8]
    ex = _examples(spark)
    model = {r.tag: r for r in TR.train_lbfgs_all_tags(ex, feats, reg=0.01, split=None, iterations=200).collect()}
    for tag, r in model.items():
        rows = VectorAssembler(inputCols=feats, outputCol="x").transform(ex.filter(F.col("tag") == tag))
        lr = LogisticRegression(featuresCol="x", labelCol="y", regParam=0.01, standardization=False, tol=1e-12, maxIter=500)
        ref = lr.fit(rows)
        ours, theirs = np.array([*r.weights, r.intercept]), np.array([*ref.coefficients, ref.intercept])
        assert r.converged and np.abs(ours - theirs).max() < 1e-4


def test_portions_of_tags_change_nothing(spark, monkeypatch):
    ex = _examples(spark)
    told = lambda df: sorted(tuple(r)[:6] for r in df.drop("batch_seconds").collect())
    whole = [told(f(ex, FEATS, iterations=5, split=None)) for f in (TR.train_linear_all_tags, TR.train_lbfgs_all_tags)]
    monkeypatch.setattr(TR, "NUMBERS_A_TASK", 1)  # no tag fits a task
    monkeypatch.setattr(TR, "WEIGHTS_AT_ONCE", 1)  # one tag at a time
    parts = [told(f(ex, FEATS, iterations=5, split=None)) for f in (TR.train_linear_all_tags, TR.train_lbfgs_all_tags)]
    for a, b in zip(whole, parts):
        assert [r[0] for r in a] == [r[0] for r in b]
        assert np.allclose([r[1] for r in a], [r[1] for r in b], atol=1e-12)


def test_large_and_small_tags_together(spark, monkeypatch):
    """Tags that fit a task and tags that don't are trained alike in one call."""
    ex = _examples(spark)
    ex = ex.filter((F.col("tag") == "label_0") | (F.col("track_id").cast("int") % 3 == 0))
    told = lambda: {r.tag: r for r in TR.train_linear_all_tags(ex, FEATS, iterations=20, split=None).collect()}
    whole = told()
    monkeypatch.setattr(TR, "NUMBERS_A_TASK", 300 * (DIMS + 1))  # label_0 has 500 rows
    parts = told()
    assert set(whole) == set(parts) == {"label_0", "label_5"}
    for tag, r in whole.items():
        assert np.allclose(r.weights, parts[tag].weights, atol=1e-12) and r.iterations == parts[tag].iterations


def test_no_examples(spark):
    none = _examples(spark).limit(0)
    assert TR.train_linear_all_tags(none, FEATS, split=None).collect() == []
    assert TR.train_lbfgs_all_tags(none, FEATS, split=None).collect() == []


def test_scoring_in_parts_ranks_alike(spark, monkeypatch):
    """Weights in several parts, small pieces of rows and ties give the same ranking."""
    feats = ["a", "b"]
    tracks = spark.createDataFrame([(str(i), float(i % 5), float(i % 3)) for i in range(40)], "track_id string, a double, b double")
    w = spark.createDataFrame(
        [(f"t{i:02d}", float(i % 4), float(i % 2), 0.0) for i in range(30)], "tag string, w_a double, w_b double, bias double"
    )
    run = lambda k: sorted(tuple(r) for r in SC.score_all_tags(tracks, w, feats, top_k=k).collect())
    whole = {k: run(k) for k in (None, 1, 3, 30)}
    want = []
    for i in range(40):
        best = sorted((-(i % 5) * (j % 4) - (i % 3) * (j % 2), f"t{j:02d}") for j in range(30))
        want += [(str(i), tag, float(-m), r + 1) for r, (m, tag) in enumerate(best)]
    assert whole[None] == sorted(want) and whole[3] == sorted(x for x in want if x[3] <= 3)
    monkeypatch.setattr(SC, "WEIGHTS_AT_ONCE", 21)
    monkeypatch.setattr(SC, "MARGINS_AT_ONCE", 50)
    assert {k: run(k) for k in whole} == whole
