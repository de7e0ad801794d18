"""Curve areas against the library evaluator, ties, skew; confusion report."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tagloom.operators import metrics as M


def _data(spark, n=600, seed=3, ties=False):
    rnd = random.Random(seed)
    rows = []
    for tag in ("a", "b", "c"):
        for i in range(n if tag != "c" else n // 10):
            y = 1.0 if rnd.random() < (0.3 if tag == "a" else 0.6) else 0.0
            s = rnd.gauss(y * 1.2, 1.0)
            if ties:
                s = round(s, 1)
            rows.append((tag, y, s))
    return spark.createDataFrame(rows, "tag string, y double, score double")


@pytest.mark.parametrize("ties", [False, True])
def test_curve_areas_match_evaluator(spark, ties):
    df = _data(spark, ties=ties)
    got = {r.tag: r for r in M.curve_areas(df).collect()}
    for tag in ("a", "b", "c"):
        sub = df.filter(F.col("tag") == tag).select(F.col("score").alias("rawPrediction"), F.col("y").alias("label"))
        roc = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(sub)
        pr = BinaryClassificationEvaluator(metricName="areaUnderPR", numBins=0).evaluate(sub)
        assert abs(got[tag].auroc - roc) < 1e-9, tag
        assert abs(got[tag].auprc - pr) < 1e-9, tag


def test_buckets_do_not_change_result(spark):
    df = _data(spark, ties=True)
    a = {r.tag: (r.auroc, r.auprc) for r in M.curve_areas(df).collect()}
    b = {r.tag: (r.auroc, r.auprc) for r in M.curve_areas(df, points_per_bucket=3).collect()}
    for t in a:
        assert abs(a[t][0] - b[t][0]) < 1e-12 and abs(a[t][1] - b[t][1]) < 1e-12


def test_label_scores_give_balanced_accuracy(spark):
    rows = [("t", 1.0, 1.0)] * 30 + [("t", 1.0, 0.0)] * 10 + [("t", 0.0, 1.0)] * 15 + [("t", 0.0, 0.0)] * 45
    df = spark.createDataFrame(rows, "tag string, y double, score double")
    r = M.curve_areas(df).first()
    tpr, tnr = 30 / 40, 45 / 60
    assert abs(r.auroc - (tpr + tnr) / 2) < 1e-12
    p, rec, prev = 30 / 45, 30 / 40, 40 / 100
    assert abs(r.auprc - (p * rec + (1 - rec) * (p + prev) / 2)) < 1e-12


def test_confusion_report(spark):
    rows = [("t", 1.0, 1.0)] * 3 + [("t", 1.0, 0.0)] * 1 + [("t", 0.0, 0.0)] * 4 + [("t", 0.0, 1.0)] * 2
    df = spark.createDataFrame(rows, "tag string, y double, prediction double")
    r = M.confusion_report(df).first()
    assert (r.n, r.n0, r.n1) == (10, 6, 4)
    assert r.recall1 == 0.75 and r.precision1 == 0.6 and r.recall0 == 4 / 6 and r.precision0 == 0.8
    assert r.accuracy == 0.7 and abs(r.test_error - 0.3) < 1e-12 and r.positive_rate == 0.4
    assert r.mean_prediction == 0.5


def test_hot_tag_and_repartition(spark):
    """One tag holds far more rows than the others; buckets and partitioning do not change results."""
    rnd = random.Random(11)
    rows = [("hot", float(rnd.random() < 0.4), rnd.gauss(0, 1)) for _ in range(3000)]
    rows += [(t, float(rnd.random() < 0.5), rnd.gauss(0, 1)) for t in ("a", "b") for _ in range(100)]
    df = spark.createDataFrame(rows, "tag string, y double, score double")
    base = {r.tag: (r.auroc, r.auprc, r.n_pos, r.n_neg) for r in M.curve_areas(df).collect()}
    for points, parts in ((200, 3), (10, 11)):
        areas = M.curve_areas(df.repartition(parts), points_per_bucket=points)
        got = {r.tag: (r.auroc, r.auprc, r.n_pos, r.n_neg) for r in areas.collect()}
        for t in base:
            assert got[t][2:] == base[t][2:]
            assert abs(got[t][0] - base[t][0]) < 1e-12 and abs(got[t][1] - base[t][1]) < 1e-12


def test_large_counts_do_not_overflow(spark):
    """Three billion rows of each class: the products leave the range of a long."""
    n = 3_000_000_000
    pts = spark.createDataFrame([("t", 2.0, n // 3, 0), ("t", 1.0, 2 * n // 3, n // 2), ("t", 0.0, 0, n // 2)],
                                "tag string, s double, tp long, fp long")
    r = M.areas_of_points(pts).first()
    assert (r.n_pos, r.n_neg) == (n, n)
    assert abs(r.auroc - (1 - 0.5 * 0.5 * 2 / 3)) < 1e-12


def test_hot_tag_takes_many_buckets(spark):
    """One tag with 20,000 points is cut into hundreds of ranges, the result unchanged."""
    pts = spark.range(20_000).select(
        F.lit("hot").alias("tag"), F.col("id").cast("double").alias("s"),
        (F.col("id") % 3).alias("tp"), (1 + F.col("id") % 2).alias("fp"),
    )
    one, many = (M.areas_of_points(pts, points_per_bucket=n).first() for n in (10**9, 50))
    assert abs(one.auroc - many.auroc) < 1e-12 and abs(one.auprc - many.auprc) < 1e-12
    plan = M.areas_of_points(pts, points_per_bucket=50)
    assert "_bucket" in plan._jdf.queryExecution().toString()
