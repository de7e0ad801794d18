import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tagloom.llm import quality

MID = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_folds(spark):
    docs, labels = (spark.read.parquet(f"{MID}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    marks = {r.doc_id: r.quality for r in labels.collect()}
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(got[i].predicted, q) for i, q in marks.items() if got[i].held_out]
    assert np.mean([p == q for p, q in held]) >= 0.95
    assert all(p == 1 for p, q in held if q == 1)  # good documents stay
    # Labels of held-out rows have no part in the scores.
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.classify(docs, turned).collect()}
    assert all(again[i] == r.score for i, r in got.items())


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (7, 0), (9, 1), (9, 1), (10, None), (None, 1)], "doc_id long, quality int")
    got = quality.classify(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.classify(empty, labels).count() == 0
    assert {r.score for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.count() <= odd.count()
    assert quality.keep_good(empty, labels).count() == 0


def test_features_do_not_depend_on_neighbours():
    texts = ["One two. Three\nfour | five", "", "###!! A A A", "été 語 12"]
    whole = quality.text_features(pa.array(texts))
    assert whole.shape == (4, len(quality.FEATURES)) and np.isfinite(whole).all()
    for i, t in enumerate(texts):
        assert np.allclose(quality.text_features(pa.array([t])), whole[i])


def test_pairs_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (4000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)  # no single feature tells
    model = quality.fit(x[:3000], y[:3000])
    assert (0, 1) in {(i, j) for i, j, _ in model.pairs}
    assert np.mean((model.score(x[3000:]) > 0.5) == y[3000:]) > 0.9
