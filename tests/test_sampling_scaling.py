"""Hash sampling and splitting properties; scaling."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.operators import sampling as S
from tagloom.operators import scaling


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=0.1, max_value=5.0), min_size=2, max_size=4), st.integers(0, 1000))
def test_split_index_disjoint_and_covering(spark, weights, seed):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    parts = df.select("k", S.split_index("k", weights, seed).alias("p"))
    counts = {r.p: r["count"] for r in parts.groupBy("p").count().collect()}
    assert sum(counts.values()) == 500
    assert set(counts) <= set(range(len(weights)))


def test_split_independent_of_partitioning(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("track_id"))
    a = {r.track_id: r.split for r in S.split_train_test(df).collect()}
    b = {r.track_id: r.split for r in S.split_train_test(df.repartition(7)).collect()}
    assert a == b
    share = sum(1 for v in a.values() if v == "train") / len(a)
    assert 0.6 < share < 0.8


def test_rebalance_keeps_positives(spark):
    df = spark.range(1000).select(
        F.lit("t").alias("tag"), F.col("id").cast("string").alias("track_id"),
        F.when(F.col("id") < 100, 1.0).otherwise(0.0).alias("y"),
    )
    fr = spark.createDataFrame([("t", 100 / 900)], "tag string, fraction double")
    out = S.rebalance(df, fr)
    assert out.filter("y = 1").count() == 100
    n0 = out.filter("y = 0").count()
    assert 60 < n0 < 140
    again = S.rebalance(df.repartition(5), fr)
    assert sorted(r.track_id for r in again.collect()) == sorted(r.track_id for r in out.collect())


def test_negative_fraction_clamped(spark):
    df = spark.createDataFrame([(10, 100), (80, 100), (100, 100), (0, 100)], "p long, n long")
    got = [r[0] for r in df.select(S.negative_fraction(F.col("p"), F.col("n"))).collect()]
    assert got == [10 / 90, 1.0, 1.0, 0.0]
    prior = [r[0] for r in df.select(S.negative_fraction(F.col("p"), F.col("n"), "prior")).collect()]
    assert prior == [0.1, 0.8, 1.0, 0.0]


def test_sample_one_is_deterministic(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("track_id"))
    a = S.sample_one(df).first().track_id
    b = S.sample_one(df.repartition(3)).first().track_id
    assert a == b


def test_standard_scale(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (6.0, 5.0)], "a double, b double")
    out = scaling.standard_scale(df, ["a", "b"])
    st_ = out.agg(F.avg("a"), F.stddev_samp("a"), F.max(F.abs("b"))).first()
    assert abs(st_[0]) < 1e-12 and abs(st_[1] - 1.0) < 1e-12
    assert st_[2] == 0.0  # zero variance -> 0.0
