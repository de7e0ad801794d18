"""Jobs over stored results: nothing is lost by a re-run; scoring from storage."""

import pytest
from pyspark.sql import functions as F

from tagloom import config
from tagloom.operators import scaling
from tagloom.operators import tags as T
from tagloom.plans import jobs as J
from tagloom.sources import results as R
from tagloom.sources import sinks as K

FEATS = ["a", "b"]


def _tracks(spark):
    """Tags that look like numbers, of three frequencies."""
    return spark.range(120).select(
        F.col("id").cast("string").alias("track_id"),
        F.filter(
            F.array(F.lit("007"), F.when(F.col("id") % 2 == 0, "1990"), F.when(F.col("id") % 5 == 0, "1e3")),
            lambda t: t.isNotNull(),
        ).alias("tags"),
        (F.col("id") % 7).cast("double").alias("a"),
        (F.col("id") % 2 * 3 + F.col("id") % 3).cast("double").alias("b"),
    )


def test_runs_add_and_keep(spark, tmp_path):
    tracks, out = _tracks(spark), str(tmp_path / "models")
    counts = T.tag_counts(tracks)
    run = lambda n: J.train_job(spark, tracks, counts, FEATS, out, min_count=n, mode="exact", iterations=3)
    weights = lambda: {r.tag: (r.run, r.weights, r.mean) for r in K.read_results(spark, f"{out}/weights").collect()}
    run(50)
    first = weights()
    assert set(first) == {"007", "1990"}
    run(50)
    assert weights() == first
    run(20)
    assert set(weights()) == {"007", "1990", "1e3"} and {t: weights()[t] for t in first} == first
    assert {r.tag for r in K.read_results(spark, f"{out}/metrics").collect()} == set(weights())
    assert spark.read.parquet(f"{out}/run_times").count() == 3
    J.train_job(spark, tracks, counts, FEATS, out, min_count=50, mode="exact", iterations=4, skip_trained=False)
    again = weights()
    assert again["1e3"] == weights()["1e3"] and again["007"][0] > first["007"][0]


def test_weights_without_metrics_are_trained_again(spark, tmp_path):
    """A run that ended before its metrics were written is made up for."""
    tracks, out = _tracks(spark), str(tmp_path / "models")
    counts = T.tag_counts(tracks)
    J.train_job(spark, tracks, counts, FEATS, out, min_count=50, mode="exact", iterations=3)
    config.remove_path(spark, f"{out}/metrics")
    J.train_job(spark, tracks, counts, FEATS, out, min_count=50, mode="exact", iterations=3)
    assert {r.tag for r in K.read_results(spark, f"{out}/metrics").collect()} == {"007", "1990"}


def _one_row_a_tag(spark, out, tags):
    for name in ("weights", "metrics"):
        assert sorted(r.tag for r in K.read_results(spark, f"{out}/{name}").collect()) == sorted(tags)
    runs = [{r.tag: r.run for r in K.read_results(spark, f"{out}/{name}").collect()} for name in ("weights", "metrics")]
    assert runs[0] == runs[1]


def test_a_run_that_dies_between_its_tables_leaves_nothing(spark, tmp_path, monkeypatch):
    tracks, out = _tracks(spark), str(tmp_path / "models")
    counts = T.tag_counts(tracks)
    train = lambda n: J.train_job(spark, tracks, counts, FEATS, out, min_count=n, mode="exact", iterations=3)
    write = R.Run.write

    def dies(self, name, table):
        if name == "metrics":
            raise RuntimeError("lost")
        write(self, name, table)

    for n, tags in ((50, ["007", "1990"]), (20, ["007", "1990", "1e3"])):  # the first run of all, and a later one
        monkeypatch.setattr(R.Run, "write", dies)
        with pytest.raises(RuntimeError, match="lost"):
            train(n)
        monkeypatch.setattr(R.Run, "write", write)
        train(n)
        _one_row_a_tag(spark, out, tags)
    assert len(J.predict_job(spark, tracks.limit(1), out, FEATS).collect()) == 3
    assert [e.rows for e in R.committed(spark, out)] == [{"weights": 2, "metrics": 2}, {"weights": 1, "metrics": 1}]
    # What the dead runs left is removed only when it has not changed for a while.
    assert R.remove_uncommitted(spark, out, ["weights", "metrics"], 3600) == []
    assert len(R.remove_uncommitted(spark, out, ["weights", "metrics"], -1)) == 2
    _one_row_a_tag(spark, out, ["007", "1990", "1e3"])


def test_a_run_that_dies_before_its_entry_is_not_seen(spark, tmp_path, monkeypatch):
    tracks, out = _tracks(spark), str(tmp_path / "models")
    counts = T.tag_counts(tracks)
    monkeypatch.setattr(R.Run, "commit", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        J.train_job(spark, tracks, counts, FEATS, out, min_count=50, mode="exact", iterations=3)
    with pytest.raises(FileNotFoundError):
        K.read_results(spark, f"{out}/weights")


def test_two_runs_at_once(spark, tmp_path):
    """Both train the same tags; one of them counts, for both tables."""
    from concurrent.futures import ThreadPoolExecutor

    tracks, out = _tracks(spark), str(tmp_path / "models")
    counts = T.tag_counts(tracks)
    train = lambda n: J.train_job(spark, tracks, counts, FEATS, out, min_count=50, mode="exact", iterations=n)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(train, (3, 4)))
    _one_row_a_tag(spark, out, ["007", "1990"])
    # Runs that start before either has ended have one number; the ids decide.
    out = str(tmp_path / "other")
    a, b = R.Run(spark, out, 1), R.Run(spark, out, 1)
    assert a.number == b.number
    for run, w in ((a, 1.0), (b, 2.0)):
        for name in ("weights", "metrics"):
            rows = spark.createDataFrame([("007", w)], "tag string, w double")
            run.write(name, rows)
    b.commit()
    a.commit()
    want = 1.0 if a.id > b.id else 2.0
    for name in ("weights", "metrics"):
        (row,) = R.read_tag(spark, out, name, "007").collect()
        assert row.run == a.number and row.w == want


def test_one_tag_is_read_from_one_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "TAGS_A_BUCKET", 10)
    out = str(tmp_path / "models")
    rows = spark.range(400).select(F.concat(F.lit("tag "), F.col("id").cast("string")).alias("tag"), F.col("id").alias("w"))
    run = R.Run(spark, out, 400)
    run.write("weights", rows)
    run.commit()
    assert run.buckets == 40 and K.read_results(spark, f"{out}/weights").count() == 400
    for i in (0, 7, 399):
        one = R.read_tag(spark, out, "weights", f"tag {i}")
        assert [r.w for r in one.collect()] == [i]
        assert len(one.inputFiles()) == 1
        assert "PushedFilters: [IsNotNull(tag), EqualTo(tag,tag " in one._jdf.queryExecution().toString()
    assert R.read_tag(spark, out, "weights", "absent").collect() == []


def test_unreadable_metrics_are_an_error(spark, tmp_path):
    tracks, out = _tracks(spark), tmp_path / "models"
    for name in ("weights", "metrics"):
        (out / name).mkdir(parents=True)
        (out / name / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark raises; nothing is overwritten
        J.train_job(spark, tracks, T.tag_counts(tracks), FEATS, str(out), min_count=50, mode="exact", iterations=3)
    assert (out / "metrics" / "part-0.parquet").read_text() == "not parquet"


def test_predict_scores_raw_features(spark, tmp_path):
    tracks, out = _tracks(spark), str(tmp_path / "models")
    J.train_job(spark, tracks, T.tag_counts(tracks), FEATS, out, min_count=20, mode="exact", iterations=20)
    got = {(r.track_id, r.tag): r.margin for r in J.predict_job(spark, tracks, out, FEATS).collect()}
    scaled = {r.track_id: (r.a, r.b) for r in scaling.standard_scale(tracks, FEATS).collect()}
    for r in K.read_results(spark, f"{out}/weights").collect():
        for k, x in scaled.items():
            want = r.weights[0] * x[0] + r.weights[1] * x[1] + r.intercept
            assert abs(got[k, r.tag] - want) < 1e-9


def test_text_to_models(spark, tmp_path):
    """Legacy text lines -> typed store -> trained models, the lines' rejects apart."""
    from tagloom.sources import legacy_text as LT

    lines = LT.format_track_lines(_tracks(spark).withColumn("track_id", F.concat(F.lit("TRX"), "track_id")), FEATS)
    bad = spark.createDataFrame([("not a line",)], "value string")
    lines.select("value").unionByName(bad).write.text(str(tmp_path / "text"))
    rejects = J.ingest_text_job(spark, str(tmp_path / "text"), str(tmp_path / "store"), FEATS)
    assert rejects.count() == 1
    store = K.read_track_store(spark, str(tmp_path / "store"))
    assert store.count() == 120
    counts = J.tag_count_job(spark, store, str(tmp_path / "counts"))
    metrics = J.train_job(spark, store, counts, FEATS, str(tmp_path / "models"), min_count=50, mode="exact", iterations=3)
    assert {r.tag for r in metrics.collect()} == {"007", "1990"}


def test_files_to_store(spark, tmp_path):
    t = _tracks(spark).select("track_id", "tags", F.array("a", "b").alias("features"), F.lit("x").alias("letter"))
    t.write.partitionBy("letter").json(str(tmp_path / "files"))
    J.ingest_files_job(spark, str(tmp_path / "files"), str(tmp_path / "store"), glob="*.json", feature_names=FEATS)
    assert K.read_track_store(spark, str(tmp_path / "store")).count() == 120


def test_broken_files_and_lines_are_told(spark, tmp_path):
    """A broken file is a row, not the end; a large file is read by several tasks."""
    from tagloom.sources import binary as B

    root = tmp_path / "files"
    root.mkdir()
    good = '{"track_id": "TRX%d", "tags": ["a"], "features": [1.0, %d]}\n'
    (root / "one.json").write_text("".join(good % (i, i) for i in range(5)))
    (root / "two.json").write_text(good % (7, 7) + "not json\n")
    (root / "three.json").write_bytes(b"\xff\xfe")
    (root / "none.json").write_text("")
    rejected = J.ingest_files_job(spark, str(root), str(tmp_path / "store"), glob="*.json", feature_names=FEATS, run_times=str(tmp_path / "times"))
    assert sorted(r.source_file.rsplit("/", 1)[1] for r in rejected.collect()) == ["three.json", "two.json"]
    assert K.read_track_store(spark, str(tmp_path / "store")).count() == 5
    log = spark.read.parquet(str(tmp_path / "times")).first()
    assert (log.job, log.rows_read, log.rows_rejected) == ("ingest_files", 7, 2)
    # As records: only the broken lines are rejected.
    lines = B.read_track_lines(spark, str(root), "*.json", FEATS)
    assert B.tracks_only(lines).count() == 6 and B.rejects(lines).count() == 2
    # One file of several splits, every record once.
    big = tmp_path / "big"
    big.mkdir()
    (big / "all.json").write_text("".join(good % (i, i) for i in range(20_000)) + '{"track_id": null}\n{"tags": 3}\n\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        lines = B.read_track_lines(spark, str(big), "*.json", FEATS)
        assert lines.rdd.getNumPartitions() >= 4
        assert lines.filter("error IS NULL").agg(F.countDistinct("track_id"), F.sum("b")).first() == (20_000, 19_999 * 10_000.0)
        assert B.rejects(lines).count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_observed_counts_of_text(spark, tmp_path):
    from tagloom.sources import legacy_text as LT

    lines = LT.format_track_lines(_tracks(spark).withColumn("track_id", F.concat(F.lit("TRX"), "track_id")), FEATS)
    bad = spark.createDataFrame([("not a line",), ("",)], "value string")
    lines.select("value").unionByName(bad).write.text(str(tmp_path / "text"))
    J.ingest_text_job(spark, str(tmp_path / "text"), str(tmp_path / "store"), FEATS, str(tmp_path / "times"))
    log = spark.read.parquet(str(tmp_path / "times")).first()
    assert (log.rows_read, log.rows_rejected) == (122, 2)


def test_preview(spark, caplog):
    import logging

    df = spark.range(100)
    with caplog.at_level(logging.INFO, logger="tagloom"):
        assert T.preview(df, 4) == [] and not caplog.records
        rows = T.preview(df, 4, enabled=True, label="ids")
        assert len(rows) == 4 and all(0 <= r.id < 100 for r in rows) and "ids: " in caplog.text
        assert len(T.preview(df.limit(2), 4, enabled=True)) == 2


def test_scaler_fitted_on_train_only(spark):
    df = spark.createDataFrame([(1.0, "train"), (3.0, "train"), (100.0, "test")], "a double, split string")
    got = [r.a for r in scaling.standard_scale(df, ["a"], fit_on="train").collect()]
    assert abs(got[0] + got[1]) < 1e-12 and got[2] > 50
    with pytest.raises(ValueError):
        scaling.standard_scale(df, ["a"], fit_on="both")


def test_scratch_is_kept_per_key_and_cleared(spark):
    from pathlib import Path

    calls = spark.range(5)
    a = config.materialize(calls, "kept", key=("k",))
    b = config.materialize(calls, "kept", key=("k",))
    assert a.inputFiles() == b.inputFiles()
    root = config.scratch_root(spark).removeprefix("file:")
    assert Path(root).exists()
    config.clear_scratch(spark)
    assert not Path(root).exists()
    assert config.materialize(calls, "kept", key=("k",)).count() == 5
