"""Scoring: margins, thresholded predictions and per-track tag rankings.

Two plans, by the shape of the input:

* tag-keyed rows (examples, test sets): the weight table (one row per tag) is
  joined on ``tag`` and the margin is plain arithmetic inside codegen;
* every track against every tag: the weight matrix is broadcast in parts of a
  fixed size and each Arrow batch of tracks is multiplied in one matrix product
  inside ``mapInPandas`` -- with one part there is no join and no shuffle, and
  the per-track ranking comes out of the same batch.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.config import WEIGHTS_AT_ONCE, materialize
from tagloom.functions.vectors import dot_columns


#: Margins that a task holds at a time.
MARGINS_AT_ONCE = 4_000_000


def weight_cols(feature_cols: Sequence[str]) -> list[str]:
    return [f"w_{c}" for c in feature_cols]


def class_mean_weights(examples: DataFrame, feature_cols: Sequence[str], group_col: str = "tag") -> DataFrame:
    """A fixed linear rule per tag from class means (nearest class mean).

    w = mean(x | y=1) - mean(x | y=0); bias = -w . (m1 + m0) / 2.
    One grouped aggregate; the output has one row per tag.
    """
    aggs = []
    for c in feature_cols:
        aggs.append(F.avg(F.when(F.col("y") == 1.0, F.col(c))).alias(f"_m1_{c}"))
        aggs.append(F.avg(F.when(F.col("y") != 1.0, F.col(c))).alias(f"_m0_{c}"))
    means = examples.groupBy(group_col).agg(*aggs)
    w = {f"w_{c}": F.coalesce(F.col(f"_m1_{c}"), F.lit(0.0)) - F.coalesce(F.col(f"_m0_{c}"), F.lit(0.0))
         for c in feature_cols}
    mid = {c: (F.coalesce(F.col(f"_m1_{c}"), F.lit(0.0)) + F.coalesce(F.col(f"_m0_{c}"), F.lit(0.0))) / 2
           for c in feature_cols}
    bias = -dot_columns([w[f"w_{c}"] for c in feature_cols], [mid[c] for c in feature_cols])
    return means.select(group_col, *[w[k].alias(k) for k in w], bias.alias("bias"))


def with_margin(df: DataFrame, weights: DataFrame, feature_cols: Sequence[str], group_col: str = "tag") -> DataFrame:
    """Adds ``margin`` = w . x + bias, weights joined by tag (one row per tag)."""
    wc = weight_cols(feature_cols)
    # One row per tag: the planner broadcasts it where it is small.
    joined = df.join(weights.select(group_col, *wc, "bias"), group_col)
    return joined.withColumn("margin", dot_columns(wc, list(feature_cols)) + F.col("bias")).drop(*wc, "bias")


def with_prediction(df: DataFrame, kind: str = "svm", margin: str = "margin") -> DataFrame:
    """0/1 ``prediction``: svm thresholds the margin at 0, logistic the probability at 0.5."""
    m = F.col(margin)
    if kind == "svm":
        pred = F.when(m > 0, 1.0).otherwise(0.0)
    elif kind == "logistic":
        pred = F.when(F.lit(1.0) / (F.lit(1.0) + F.exp(-m)) > 0.5, 1.0).otherwise(0.0)
    else:
        raise ValueError(f"unknown model kind {kind!r}")
    return df.withColumn("prediction", pred)


def _collected(rows: list, d: int):
    """(tags, W, b), tags sorted, from collected weight rows."""
    rows = sorted(rows, key=lambda r: r[0])
    tags = np.asarray([r[0] for r in rows], dtype=object)
    return tags, np.array([r[1:-1] for r in rows], float).reshape(len(rows), d), np.array([r[-1] for r in rows], float)


def _best(margins: np.ndarray, k: int) -> np.ndarray:
    """Column numbers of each row's k largest entries, ties by column, in order."""
    n = margins.shape[1]
    if k * 4 >= n:
        return np.argsort(-margins, axis=1, kind="stable")[:, :k]
    part = np.sort(np.argpartition(-margins, k - 1, axis=1)[:, :k], axis=1)
    own = np.take_along_axis(margins, part, axis=1)
    # Where entries tie with the last one taken, the partition's choice is open.
    least = own.min(axis=1, keepdims=True)
    tied = (margins == least).sum(axis=1) > (own == least).sum(axis=1)
    out = np.take_along_axis(part, np.argsort(-own, axis=1, kind="stable"), axis=1)
    out[tied] = np.argsort(-margins[tied], axis=1, kind="stable")[:, :k]
    return out


def score_all_tags(
    tracks: DataFrame,
    weights: DataFrame,
    feature_cols: Sequence[str],
    id_col: str = "track_id",
    top_k: int | None = None,
    group_col: str = "tag",
) -> DataFrame:
    """(track_id, tag, margin, rank) for every track and its ``top_k`` best tags
    (None: every tag, so tracks x tags rows).

    ``rank`` is 1 for the highest margin of a track (ties by tag name). Weights
    are broadcast WEIGHTS_AT_ONCE numbers at a time; if there are more, each part
    ranks its own tags and the parts' ranks are merged for each track. Rows are
    multiplied in pieces whose margins stay below MARGINS_AT_ONCE.
    """
    spark, cols, d = tracks.sparkSession, list(feature_cols), len(feature_cols)
    schema = f"{id_col} string, {group_col} string, margin double, rank int"
    table = weights.select(group_col, *weight_cols(feature_cols), "bias")
    each = max(1, WEIGHTS_AT_ONCE // (d + 1))
    rows = table.limit(each + 1).collect()
    if len(rows) <= each:
        parts = [rows]
    else:
        stored = materialize(table, "weights")
        n = -(-stored.count() * 5 // (4 * each))
        part = F.pmod(F.xxhash64(group_col), F.lit(n))
        parts = (stored.filter(part == i).collect() for i in range(n))
    scored = None
    for rows in parts:
        made = _score_part(spark, tracks.select(id_col, *cols), _collected(rows, d), cols, id_col, group_col, top_k, schema)
        scored = made if scored is None else scored.unionByName(made)
        several = scored is not made
    if several:
        best = Window.partitionBy(id_col).orderBy(F.desc("margin"), group_col)
        scored = scored.withColumn("rank", F.row_number().over(best))
        if top_k is not None:
            scored = scored.filter(F.col("rank") <= top_k)
    return scored


def _score_part(spark, tracks, part, cols, id_col, group_col, top_k, schema) -> DataFrame:
    bc = spark.sparkContext.broadcast(part)
    k = len(part[0]) if top_k is None else max(0, min(int(top_k), len(part[0])))

    def score(batches):
        tags, w, b = bc.value
        if not k:
            return
        size = max(1, MARGINS_AT_ONCE // len(tags))
        for whole in batches:
            for at in range(0, len(whole), size):
                pdf = whole.iloc[at : at + size]
                margins = pdf[cols].to_numpy(dtype=np.float64) @ w.T + b
                best = _best(margins, k)
                rows, idx = np.repeat(np.arange(len(pdf)), k), best.ravel()
                yield pd.DataFrame(
                    {
                        id_col: pdf[id_col].to_numpy()[rows],
                        group_col: tags[idx],
                        "margin": margins[rows, idx],
                        "rank": np.tile(np.arange(1, k + 1, dtype=np.int32), len(pdf)),
                    }
                )

    return tracks.mapInPandas(score, schema)
