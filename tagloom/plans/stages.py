"""Shared stages of the catalogue, on the stand-in tables, with DuckDB twins.

Each Spark stage function has a SQL CTE string next to it that computes the
same thing in DuckDB over the same parquet files; the catalogue composes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.config import materialize
from tagloom.functions.hashing import unit_hash_sql
from tagloom.operators import labels as L
from tagloom.operators import scaling, score, tags
from tagloom.operators.metrics import CURVE_AREAS_SQL
from tagloom.sources import testdata as td

# Fixed parameters of the catalogue queries.
SHARE_DEN = 40          # popular: carried by at least 1/40 of all tracks
SEED = 42
TRAIN_FRACTION = 0.7
ARTIST_TAGSTRING = "urgent"
FEATS = td.PART_FEATURES


# ---------------------------------------------------------------------------
# Spark stages
# ---------------------------------------------------------------------------


def tracks(spark: SparkSession, sf: str) -> DataFrame:
    return td.part_tracks(spark, sf)


def counts(spark: SparkSession, sf: str) -> DataFrame:
    return tags.tag_counts(tracks(spark, sf))


def n_tracks(spark: SparkSession, sf: str) -> int:
    return td.read_table(spark, sf, "part").count()


def popular(spark: SparkSession, sf: str, share_den: int = SHARE_DEN) -> DataFrame:
    return tags.popular_tags_by_share(counts(spark, sf), n_tracks(spark, sf), share_den)


def stored_tracks(spark: SparkSession, sf: str) -> DataFrame:
    """The tracks of ``sf``, written once per application."""
    return materialize(tracks(spark, sf), "tracks", key=(sf,))


def scaled(spark: SparkSession, sf: str) -> DataFrame:
    return scaling.standard_scale(stored_tracks(spark, sf), FEATS)


def examples(spark: SparkSession, sf: str, mode: str = "substring", ratio: str = "balanced") -> DataFrame:
    """The examples of ``sf``, written once per application and kind: several
    queries read them, and each query reads them more than once."""
    made = L.labelled_examples(
        scaled(spark, sf), popular(spark, sf), FEATS, mode=mode, seed=SEED, ratio=ratio, train_fraction=TRAIN_FRACTION
    )
    return materialize(made, "examples", key=(sf, mode, ratio))


def weights(ex: DataFrame) -> DataFrame:
    return score.class_mean_weights(ex.filter(F.col("split") == "train"), FEATS)


def test_predictions(spark: SparkSession, sf: str) -> DataFrame:
    ex = examples(spark, sf)
    w = weights(ex)
    test = ex.filter(F.col("split") == "test")
    return score.with_prediction(score.with_margin(test, w, FEATS), "svm")


# ---------------------------------------------------------------------------
# DuckDB twins (CTE fragments)
# ---------------------------------------------------------------------------

SQL_TRACKS = td.PART_TRACKS_SQL

SQL_COUNTS = f"""
counts AS (
  SELECT tag, CAST(count(*) AS BIGINT) AS n
  FROM (SELECT unnest(tags) AS tag FROM tracks) WHERE tag IS NOT NULL GROUP BY tag),
ntracks AS (SELECT count(*) AS n_tracks FROM tracks),
popular AS (SELECT tag, n FROM counts WHERE n * {SHARE_DEN} >= (SELECT n_tracks FROM ntracks))"""


def sql_scaled() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in FEATS)
    cols = ", ".join(
        f"CASE WHEN coalesce(s_{c}, 0) = 0 THEN CAST(0 AS DOUBLE) ELSE ({c} - m_{c}) / s_{c} END AS {c}"
        for c in FEATS
    )
    return f"""
stats AS (SELECT {stats} FROM tracks),
scaled AS (SELECT track_id, tags, letter, {cols} FROM tracks CROSS JOIN stats)"""


def sql_pos(mode: str = "substring") -> str:
    cond = {
        "exact": "e.t = p.tag",
        "substring": "contains(e.t, p.tag)",
        "substring_ci": "contains(lower(e.t), lower(p.tag))",
    }[mode]
    return f"""
elems AS (SELECT DISTINCT track_id, t FROM (SELECT track_id, unnest(tags) AS t FROM tracks) WHERE t IS NOT NULL),
pos AS (SELECT DISTINCT p.tag, e.track_id FROM elems e JOIN popular p ON {cond})"""


def sql_frac(ratio: str = "balanced") -> str:
    if ratio == "balanced":
        frac = ("CASE WHEN n_total - n_positive <= 0 THEN CAST(1 AS DOUBLE) "
                "ELSE n_positive / (n_total - n_positive) END")
    else:
        frac = "CASE WHEN n_total <= 0 THEN CAST(1 AS DOUBLE) ELSE n_positive / n_total END"
    return f"""
ntotal AS (SELECT CAST(count(*) AS BIGINT) AS n_total FROM tracks),
npos AS (SELECT tag, CAST(count(*) AS BIGINT) AS n_positive FROM pos GROUP BY tag),
cc AS (SELECT p.tag, n_total, CAST(coalesce(npos.n_positive, 0) AS BIGINT) AS n_positive
       FROM popular p LEFT JOIN npos ON npos.tag = p.tag CROSS JOIN ntotal),
frac AS (SELECT tag, n_total, n_positive, CAST(n_positive AS DOUBLE) / n_total AS positive_rate,
                least({frac}, CAST(1 AS DOUBLE)) AS fraction FROM cc)"""


def sql_examples(src: str = "scaled") -> str:
    u = unit_hash_sql("d.track_id", salt="sample", seed=SEED)
    v = unit_hash_sql("d.track_id", salt="split", seed=SEED)
    feats = ", ".join(f"d.{c}" for c in FEATS)
    return f"""
drawn AS (SELECT d.*, {u} AS u, {v} AS v FROM {src} d),
examples AS (
  SELECT f.tag, d.track_id, CAST(CASE WHEN pos.track_id IS NULL THEN 0 ELSE 1 END AS DOUBLE) AS y,
         CASE WHEN d.v < {TRAIN_FRACTION} THEN 'train' ELSE 'test' END AS split, {feats}
  FROM drawn d CROSS JOIN frac f LEFT JOIN pos ON pos.tag = f.tag AND pos.track_id = d.track_id
  WHERE pos.track_id IS NOT NULL OR d.u < f.fraction)"""


def sql_weights() -> str:
    m = ", ".join(
        f"avg(CASE WHEN y = 1 THEN {c} END) AS m1_{c}, avg(CASE WHEN y <> 1 THEN {c} END) AS m0_{c}" for c in FEATS
    )
    w = ", ".join(f"coalesce(m1_{c}, 0) - coalesce(m0_{c}, 0) AS w_{c}" for c in FEATS)
    bias = " + ".join(
        f"(coalesce(m1_{c}, 0) - coalesce(m0_{c}, 0)) * ((coalesce(m1_{c}, 0) + coalesce(m0_{c}, 0)) / 2)"
        for c in FEATS
    )
    return f"""
cmeans AS (SELECT tag, {m} FROM examples WHERE split = 'train' GROUP BY tag),
weights AS (SELECT tag, {w}, -({bias}) AS bias FROM cmeans)"""


def sql_dot(w_alias: str, x_alias: str) -> str:
    return " + ".join(f"{w_alias}.w_{c} * {x_alias}.{c}" for c in FEATS)


def sql_test_pred() -> str:
    dot = sql_dot("w", "e")
    return f"""
test_pred AS (
  SELECT e.tag, e.track_id, e.y, ({dot}) + w.bias AS margin,
         CAST(CASE WHEN ({dot}) + w.bias > 0 THEN 1 ELSE 0 END AS DOUBLE) AS prediction
  FROM examples e JOIN weights w ON w.tag = e.tag WHERE e.split = 'test')"""


def sql_sgd(
    loss: str, step: float = 1.0, reg: float = 0.01, tol: float = 0.001, iterations: int = 100, feats=None,
    intercept: bool = True,
) -> str:
    """CTE ``model`` (tag, t, w, done): batched SGD as a recursion over ``train_x``
    (tag, y, x), x ending in 1.0 for the intercept (0.0 without one). Same rule,
    start and stop test as the trainer."""
    feats = FEATS if feats is None else feats
    d = len(feats) + 1
    start = "[" + ", ".join(["CAST(0 AS DOUBLE)"] * (d - 1) + [f"CAST({int(intercept)} AS DOUBLE)"]) + "]"
    if loss == "hinge":
        mult = "CASE WHEN (2 * y - 1) * m < 1 THEN -(2 * y - 1) ELSE 0 END"
    else:
        mult = "1 / (1 + exp(-m)) - y"
    sums = ", ".join(f"sum(mult * x[{i + 1}])" for i in range(d))
    eta = f"({step} / sqrt(t + 1))"
    move = f"list_transform(range(1, {d} + 1), lambda i: w[i] * (1 - {eta} * {reg}) - {eta} * g[i] / n)"
    norm = "sqrt(list_dot_product({0}, {0}))"
    moved = f"list_transform(range(1, {d} + 1), lambda i: after[i] - w[i])"
    return f"""
model_steps AS (
  SELECT DISTINCT tag, 0 AS t, {start} AS w, false AS done FROM train_x
  UNION ALL
  SELECT tag, t + 1, after, t >= 1 AND {norm.format(moved)} < {tol} * greatest({norm.format("after")}, 1)
  FROM (SELECT *, {move} AS after
        FROM (SELECT tag, any_value(t) AS t, any_value(w) AS w, count(*) AS n, [{sums}] AS g
              FROM (SELECT tag, t, w, x, {mult} AS mult
                    FROM (SELECT s.tag, s.t, s.w, e.x, e.y, list_dot_product(s.w, e.x) AS m
                          FROM model_steps s JOIN train_x e ON e.tag = s.tag WHERE NOT s.done AND s.t < {iterations}))
              GROUP BY tag))),
model AS (SELECT tag, max(t) AS t, arg_max(w, t) AS w, arg_max(done, t) AS done FROM model_steps GROUP BY tag)"""


def sql_x(alias: str = "e", feats=None, intercept: bool = True) -> str:
    cols = ", ".join(f"{alias}.{c}" for c in (FEATS if feats is None else feats))
    return f"[{cols}, CAST({int(intercept)} AS DOUBLE)]"


def sql_model_predictions(kind: str, feats=None) -> str:
    """CTE ``test_pred`` by ``model`` over the test examples."""
    hit = "m > 0" if kind == "hinge" else "1 / (1 + exp(-m)) > 0.5"
    return f"""
test_pred AS (
  SELECT tag, track_id, y, m AS margin, CAST(CASE WHEN {hit} THEN 1 ELSE 0 END AS DOUBLE) AS prediction
  FROM (SELECT e.tag, e.track_id, e.y, list_dot_product(w.w, {sql_x(feats=feats)}) AS m
        FROM examples e JOIN model w ON w.tag = e.tag WHERE e.split = 'test'))"""


def sql_trained(loss: str, **options) -> str:
    """The trainer query: hold-out areas of every tag's model on 0/1 predictions."""
    return sql_trained_over(loss, sql_examples_chain(), **options)


def sql_trained_over(loss: str, chain: list[str], feats=None, **options) -> str:
    x = sql_x(feats=feats, intercept=options.get("intercept", True))
    train = f"\ntrain_x AS (SELECT e.tag, e.y, {x} AS x FROM examples e WHERE e.split = 'train')"
    scored = "\nscored AS (SELECT tag, y, prediction AS score FROM test_pred)"
    sgd = sql_sgd(loss, feats=feats, **options)
    parts = [*chain, train, sgd, sql_model_predictions(loss, feats), scored, CURVE_AREAS_SQL]
    return (
        with_ctes(*parts).replace("WITH ", "WITH RECURSIVE ", 1)
        + "SELECT a.tag, n_pos, n_neg, round(auroc, 6) AS auroc, round(auprc, 6) AS auprc, "
        "CAST(m.t AS INTEGER) AS iterations, m.done AS converged FROM areas a JOIN model m ON m.tag = a.tag"
    )


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"


# The CTE chain up to the examples table, substring labels, balanced ratio.
def sql_examples_chain(mode: str = "substring", ratio: str = "balanced") -> list[str]:
    return [SQL_TRACKS, SQL_COUNTS, sql_scaled(), sql_pos(mode), sql_frac(ratio), sql_examples()]
