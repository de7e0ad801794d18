"""Summary statistics, report lines; binary-file and CSV sources."""

import json

import pytest
from pyspark.sql import functions as F

from tagloom.operators import summary as SU
from tagloom.sources import binary as B
from tagloom.sources import sinks as K


def test_summary_quartiles_and_rounding(spark):
    counts = spark.createDataFrame([("a", 10), ("b", 20), ("c", 30), ("d", 40), ("e", 5)], "tag string, n bigint")
    metrics = spark.createDataFrame(
        [("a", 0.5, 0.6, 1.0), ("b", 0.6, 0.7, 2.0), ("c", 0.7, 0.8, 3.0), ("d", 0.8, 0.9, 4.0), ("x", 0.9, 0.9, 1.0)],
        "tag string, auroc double, auprc double, train_seconds double",
    )
    s = SU.summarize_models(counts, metrics, min_count=10)
    assert sorted(r.tag for r in s.collect()) == ["a", "b", "c", "d"]
    q = {r.metric: r for r in SU.summary_quartiles(s).collect()}
    assert abs(q["auroc"].q1 - 0.575) < 1e-12 and abs(q["auroc"].median - 0.65) < 1e-12
    assert abs(q["auroc"].mean - 0.65) < 1e-12 and q["auroc"].max == 0.8
    m = SU.metric_means(s).first()
    assert m.n_tags == 4 and abs(m.mean_auprc - 0.75) < 1e-12
    r = SU.summary_rounded(spark.createDataFrame([("a", 1, 0.5264948976103123, 0.675)], "tag string, song_count int, auroc double, auprc double"))
    row = r.first()
    assert row.auroc == 0.53 and row.auprc == 0.68


def test_report_lines(spark):
    ranked = spark.createDataFrame([("t1", "rock", 1.25, 1)], "track_id string, tag string, margin double, rank int")
    line = SU.prediction_report_lines(ranked).first().line
    assert line == "rock" + " " * 24 + " | 1.25"


def test_report_prints_margins_in_full(spark):
    ranked = spark.createDataFrame([("t1", "rock", 0.123456789012345, 1)], "track_id string, tag string, margin double, rank int")
    assert SU.prediction_report_lines(ranked).first().line.endswith("| 0.123456789012345")


def test_binary_files(spark, tmp_path):
    root = tmp_path / "files" / "A" / "B"
    root.mkdir(parents=True)
    with open(root / "x.json", "w") as f:
        f.write(json.dumps({"track_id": "TRABC1", "tags": ["rock"], "features": [1, 2]}) + "\n")
        f.write(json.dumps({"track_id": "TRABC2", "tags": [], "features": [3, 4]}) + "\n")
    (root / "skip.txt").write_text("not a track file")
    got = B.read_track_files(spark, str(tmp_path / "files"), B.json_lines_decoder, "*.json", ["f0", "f1"])
    rows = {r.track_id: r for r in got.collect()}
    assert set(rows) == {"TRABC1", "TRABC2"}
    assert rows["TRABC1"].f1 == 2.0 and rows["TRABC1"].letter == "A" and rows["TRABC2"].tags == []


def test_summary_csv(spark, tmp_path):
    s = spark.createDataFrame([("rock, pop", 5, 0.5, 0.6, 1.0)], "tag string, song_count bigint, auroc double, auprc double, train_seconds double")
    K.write_summary_csv(s, str(tmp_path / "csv"))
    back = K.read_summary_csv(spark, str(tmp_path / "csv")).first()
    assert back.tag == "rock, pop" and back.song_count == 5 and back.auroc == 0.5
    header = [p for p in (tmp_path / "csv").iterdir() if p.name.endswith(".csv")][0].read_text().splitlines()[0]
    assert header == "Tag,Song Count,AUROC,AUPRC,Time to Train"


def test_exact_quantiles(spark):
    """Odd and even sizes, ties, one value, nulls, many ranges, a column in several tasks."""
    import random
    import statistics

    random.seed(4)
    groups = {"a": [random.gauss(0, 1) for _ in range(501)], "b": [random.randint(0, 3) * 1.0 for _ in range(400)], "c": [2.5], "d": [1.0, 2.0]}
    rows = [(g, v) for g, x in groups.items() for v in x] + [("a", None), ("e", None)]
    df = spark.createDataFrame(rows, "metric string, v double").repartition(5)
    got = {r.metric: r for r in SU.exact_quantiles(df, (0.0, 0.25, 0.5, 0.9, 1.0)).collect()}
    assert set(got) == set(groups)
    for g, x in groups.items():
        x = sorted(x)
        for k, q in enumerate((0.0, 0.25, 0.5, 0.9, 1.0)):
            at = q * (len(x) - 1)
            lo, hi = x[int(at)], x[min(int(at) + 1, len(x) - 1)]
            assert abs(got[g][f"q{k}"] - (lo + (hi - lo) * (at - int(at)))) < 1e-12
        assert got[g].q2 == statistics.median(x)


def test_exact_quantiles_of_many_rows(spark):
    """Ten million values in no order, each number once."""
    n = 10_000_000
    df = spark.range(n).selectExpr("'m' AS metric", f"CAST(id * 7919 % {n} AS DOUBLE) AS v")
    r = SU.exact_quantiles(df, (0.25, 0.5, 0.9)).first()
    assert [r.q0, r.q1, r.q2] == pytest.approx([q * (n - 1) for q in (0.25, 0.5, 0.9)], abs=1e-6)
