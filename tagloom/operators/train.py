"""Linear classifiers: many tags in one batched job, or one tag with pyspark.ml.

Batched trainers
    All tags are trained in the same jobs. A tag whose examples fit a task
    (NUMBERS_A_TASK) is trained inside one: its rows meet there once, and all
    passes over them cost no job. How many numbers a tag has is counted first.

    The examples of larger tags are packed into blocks, one row for each Arrow
    batch: tag codes, labels and a feature matrix, sorted by tag. The blocks are
    cached; each pass multiplies them with the broadcast weights in NumPy and sums
    the partial gradients by (tag, feature) with a map-side combined aggregate.
    They are taken in portions of WEIGHTS_AT_ONCE numbers, so the driver holds no
    more than that. Both run the same steps.

    ``train_linear_all_tags``: the library's SGD with an L2 updater and
    mini-batch fraction 1:

        eta_t = step / sqrt(t)
        w <- w * (1 - eta_t * reg) - eta_t * g / n

    with the intercept as a trailing feature fixed at 1.0 whose weight starts
    at 1.0 (other weights start at 0). A tag stops when
    ||w_t - w_{t-1}|| < tol * max(||w_t||, 1) (checked from t = 2 on).

    ``train_lbfgs_all_tags``: logistic regression by limited-memory BFGS with a
    backtracking line search, each tag with its own history and step length.

    Gradients: hinge  g = sum over rows with s * m < 1 of -s * x, s = 2y - 1;
               logistic g = sum (sigmoid(m) - y) * x.

One-tag trainers (``train_one_tag``)
    A ``PipelineModel`` of VectorAssembler -> StandardScaler -> LinearSVC or
    LogisticRegression, so the scaler is saved and loaded with the model.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.config import (
    DEFAULT_ITERATIONS,
    DEFAULT_REG,
    DEFAULT_STEP,
    DEFAULT_TOL,
    WEIGHTS_AT_ONCE,
    materialize,
)

LOSSES = ("hinge", "logistic")

#: Numbers (features and label, for each row) of a tag that one task may hold.
NUMBERS_A_TASK = 16_000_000


def _gradient_sql(train_view: str, weights_view: str, feature_cols: Sequence[str], loss: str, group_col: str) -> str:
    """One iteration's gradient as SQL text over two views (fixed per training run)."""
    q = [f"`{c}`" for c in feature_cols]
    margin = " + ".join(f"w.`w_{c}` * t.{x}" for c, x in zip(feature_cols, q)) + " + w.w_bias"
    if loss == "hinge":
        mult = "CASE WHEN s * m < 1.0 THEN -s ELSE 0.0 END"
        row_loss = "CASE WHEN s * m < 1.0 THEN 1.0 - s * m ELSE 0.0 END"
    elif loss == "logistic":
        mult = "1.0 / (1.0 + exp(-m)) - y"
        # log(1 + exp(-m)) for y = 1, log(1 + exp(m)) for y = 0
        row_loss = "log1p(exp(-s * m))"
    else:
        raise ValueError(f"unknown loss {loss!r}")
    cols = ", ".join(f"t.{x}" for x in q)
    sums = ", ".join(f"sum(_mult * {x}) AS `g_{c}`" for c, x in zip(feature_cols, q))
    return f"""
SELECT `{group_col}`, count(1) AS n, {sums}, sum(_mult) AS g_bias, sum(_loss) AS loss_sum
FROM (SELECT `{group_col}`, {", ".join(q)}, {mult} AS _mult, {row_loss} AS _loss
      FROM (SELECT t.`{group_col}`, {cols}, t.y, t.y * 2.0 - 1.0 AS s, {margin} AS m
            FROM {train_view} t JOIN {weights_view} w ON t.`{group_col}` = w.`{group_col}`))
GROUP BY `{group_col}`"""


def gradient_sums(
    train: DataFrame,
    weights: DataFrame,
    feature_cols: Sequence[str],
    loss: str = "hinge",
    group_col: str = "tag",
) -> DataFrame:
    """(tag, n, g_<feature>..., g_bias, loss_sum) for the given weights.

    ``weights`` holds (tag, w_<feature>..., w_bias). This is one iteration's
    distributed work; it is also exposed as a query on its own.
    """
    spark = train.sparkSession
    suffix = uuid.uuid4().hex[:12]
    tv, wv = f"_tagloom_train_{suffix}", f"_tagloom_w_{suffix}"
    train.createOrReplaceTempView(tv)
    weights.createOrReplaceTempView(wv)
    try:
        # spark.sql analyses eagerly, so the views can be dropped afterwards.
        return spark.sql(_gradient_sql(tv, wv, feature_cols, loss, group_col))
    finally:
        spark.catalog.dropTempView(tv)
        spark.catalog.dropTempView(wv)


def _pack(train: DataFrame, feature_cols: Sequence[str], group_col: str) -> DataFrame:
    """(tags, counts, y, x): each batch of rows as one block, sorted by tag."""
    cols = list(feature_cols)

    def pack(batches):
        for pdf in batches:
            pdf = pdf[pdf[group_col].notna()].sort_values(group_col, kind="stable")
            if not len(pdf):
                continue
            tags, counts = np.unique(pdf[group_col].to_numpy(dtype=str), return_counts=True)
            yield pd.DataFrame(
                {
                    "tags": [tags.tolist()],
                    "counts": [counts.tolist()],
                    "y": [pdf["y"].to_numpy(np.float64).tobytes()],
                    "x": [np.ascontiguousarray(pdf[cols].to_numpy(np.float64)).tobytes()],
                }
            )

    return train.mapInPandas(pack, "tags array<string>, counts array<long>, y binary, x binary")


def _row_terms(m: np.ndarray, y: np.ndarray, loss: str) -> tuple[np.ndarray, np.ndarray]:
    """What each row's features are multiplied by in the gradient, and its loss, at margins ``m``."""
    s = 2.0 * y - 1.0
    if loss == "hinge":
        return np.where(s * m < 1.0, -s, 0.0), np.maximum(1.0 - s * m, 0.0)
    return 1.0 / (1.0 + np.exp(-np.clip(m, -700, 700))) - y, np.logaddexp(0.0, -s * m)


def _mine(block: dict, known: np.ndarray, place: np.ndarray, d: int):
    """The rows of a block that belong to the ``known`` tags: x, y, codes, rows a code."""
    names, counts = np.asarray(block["tags"], dtype=str), np.asarray(block["counts"])
    at = np.minimum(np.searchsorted(known, names), len(known) - 1)
    mine = known[at] == names
    rows = np.repeat(mine, counts)
    x, y = np.frombuffer(block["x"]).reshape(-1, d)[rows], np.frombuffer(block["y"])[rows]
    return x, y, place[at[mine]], counts[mine]


class _Blocks:
    """The packed examples of large tags and their gradient passes, a job each."""

    def __init__(self, train: DataFrame, feature_cols: Sequence[str], group_col: str, store: bool):
        self.spark, self.d = train.sparkSession, len(feature_cols)
        packed = _pack(train, feature_cols, group_col)
        cores = self.spark.sparkContext.defaultParallelism
        if packed.rdd.getNumPartitions() < cores:  # every pass should use all cores
            packed = packed.repartition(cores)
        # Without a stored copy a lost executor's blocks are packed again from the examples' own table.
        self.blocks = (materialize(packed, "blocks") if store else packed).persist(StorageLevel.MEMORY_AND_DISK)

    def portions(self, sizes: DataFrame, group_col: str):
        """Lists of (tag, n): all tags, WEIGHTS_AT_ONCE numbers of weights at a time."""
        each = max(1, WEIGHTS_AT_ONCE // (self.d + 1))
        held = []
        # Tags arrive one partition at a time, sorted, and never all together.
        for r in sizes.orderBy(group_col).toLocalIterator():
            held.append((r[group_col], r["n"]))
            if len(held) == each:
                yield held
                held = []
        if held:
            yield held

    def gradients(self, tags: list[str], weights: np.ndarray, loss: str) -> tuple[np.ndarray, np.ndarray]:
        """Gradient sums (tags x features + 1) and loss sums at ``weights``, by a job."""
        known, place = np.unique(np.array(tags, dtype=str), return_index=True)
        shared = self.spark.sparkContext.broadcast((known, place, weights))
        d = self.d

        def step(batches):
            known, place, w = shared.value
            for pdf in batches:
                for block in pdf.to_dict("records"):
                    x, y, code, n = _mine(block, known, place, d)
                    if len(y):
                        each = np.repeat(w[code], n, axis=0)
                        mult, cost = _row_terms(np.einsum("ij,ij->i", x, each[:, :d]) + each[:, d], y, loss)
                        parts = np.column_stack([mult[:, None] * x, mult, cost])
                        sums = np.add.reduceat(parts, np.cumsum(n) - n, axis=0)
                        yield pd.DataFrame(
                            {
                                "code": np.repeat(code, d + 2),
                                "k": np.tile(np.arange(d + 2, dtype=np.int32), len(code)),
                                "v": sums.ravel(),
                            }
                        )

        parts = self.blocks.mapInPandas(step, "code long, k int, v double")
        got = parts.groupBy("code", "k").agg(F.sum("v").alias("v")).collect()  # WEIGHTS_AT_ONCE numbers at most
        shared.destroy()
        out = np.zeros((len(tags), d + 2))
        for r in got:
            out[r["code"], r["k"]] = r["v"]
        return out[:, : d + 1], out[:, d + 1]

    def close(self) -> None:
        self.blocks.unpersist()


_MODEL_SCHEMA = "weights array<double>, intercept double, iterations int, converged boolean, loss double, batch_seconds double"


def _model_frame(spark, group_col: str, portions: list[DataFrame]) -> DataFrame:
    if not portions:
        return spark.createDataFrame([], f"{group_col} string, {_MODEL_SCHEMA}")
    out = portions[0]
    for more in portions[1:]:
        out = out.unionByName(more)
    return out


def train_linear_all_tags(
    examples: DataFrame,
    feature_cols: Sequence[str],
    loss: str = "hinge",
    iterations: int = DEFAULT_ITERATIONS,
    step: float = DEFAULT_STEP,
    reg: float = DEFAULT_REG,
    tol: float = DEFAULT_TOL,
    intercept: bool = True,
    group_col: str = "tag",
    split: str | None = "train",
    checkpoint: bool = True,
) -> DataFrame:
    """Train one linear model per tag by SGD, all tags in the same jobs.

    Returns (tag, weights ARRAY<DOUBLE>, intercept, iterations, converged,
    loss, batch_seconds); ``batch_seconds`` is the time of the tag's own passes, or,
    for a large tag, the wall time of the portion of tags it was trained with.
    """
    if loss not in LOSSES:
        raise ValueError(f"unknown loss {loss!r}")
    options = {"iterations": iterations, "step": step, "reg": reg, "tol": tol, "intercept": intercept}
    return _trained(examples, feature_cols, group_col, split, checkpoint, loss, _sgd, options)


def _trained(examples, feature_cols, group_col, split, checkpoint, loss, method, options) -> DataFrame:
    d = len(feature_cols)
    train = examples
    if split is not None and "split" in examples.columns:
        train = train.filter(F.col("split") == split)
    train = train.select(
        group_col, F.col("y").cast("double").alias("y"), *[F.col(c).cast("double") for c in feature_cols]
    ).filter(F.col(group_col).isNotNull())
    if checkpoint:
        train = materialize(train, "train")
    sizes = materialize(train.groupBy(group_col).agg(F.count(F.lit(1)).alias("n")), "sizes")
    most = NUMBERS_A_TASK // (d + 1)
    large = sizes.filter(F.col("n") > most)
    some_large = not large.isEmpty()
    small = train.join(sizes.filter(F.col("n") <= most), group_col, "left_semi") if some_large else train
    model = materialize(_in_tasks(small, feature_cols, group_col, loss, method, options), "model")
    if some_large:
        rest = train.join(large, group_col, "left_semi")
        model = model.unionByName(_in_passes(rest, large, feature_cols, group_col, checkpoint, loss, method, options))
    return model


def _in_tasks(train: DataFrame, feature_cols, group_col: str, loss: str, method, options: dict) -> DataFrame:
    """The models of tags that fit a task, each trained where its rows meet."""
    cols, d = list(feature_cols), len(feature_cols)

    def fit(key, table):
        started = time.time()
        x = np.column_stack([table.column(c).to_numpy() for c in cols]) if cols else np.zeros((table.num_rows, 0))
        y = table.column("y").to_numpy()

        def gradient(rows, w):
            mult, cost = _row_terms(x @ w[0, :d] + w[0, d], y, loss)
            return np.append(mult @ x, mult.sum())[None, :], np.array([cost.sum()])

        w, ended, done, cost = method(gradient, np.array([float(len(y))]), d, **options)
        told = {
            group_col: pa.array([key[0].as_py()], pa.string()),
            "weights": pa.array([w[0, :d].tolist()], pa.list_(pa.float64())),
            "intercept": pa.array([float(w[0, d])], pa.float64()),
            "iterations": pa.array([int(ended[0])], pa.int32()),
            "converged": pa.array([bool(done[0])], pa.bool_()),
            "loss": pa.array([float(cost[0])], pa.float64()),
            "batch_seconds": pa.array([time.time() - started], pa.float64()),
        }
        return pa.table(told)

    # A fixed number of partitions, several a core: tags differ in size.
    tasks = 4 * train.sparkSession.sparkContext.defaultParallelism
    dealt = train.repartition(max(tasks, int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))), group_col)
    return dealt.groupBy(group_col).applyInArrow(fit, f"{group_col} string, {_MODEL_SCHEMA}")


def _in_passes(train, sizes, feature_cols, group_col, checkpoint, loss, method, options) -> DataFrame:
    """The models of larger tags, by a job for each pass over all of them."""
    spark, d = train.sparkSession, len(feature_cols)
    blocks = _Blocks(train, feature_cols, group_col, checkpoint)
    made = []
    try:
        for portion in blocks.portions(sizes, group_col):
            started = time.time()
            tags = [t for t, _ in portion]
            n = np.array([c for _, c in portion], float)

            def gradient(rows, w, tags=tags):
                return blocks.gradients([tags[i] for i in rows], w, loss)

            w, ended, done, cost = method(gradient, n, d, **options)
            made.append(_portion_frame(spark, group_col, tags, w, d, ended, done, cost, time.time() - started))
        return _model_frame(spark, group_col, made)
    finally:
        blocks.close()


def _sgd(gradient, n: np.ndarray, d: int, iterations: int, step: float, reg: float, tol: float, intercept: bool):
    """Weights, iterations, whether converged, and losses of all tags by the SGD rule."""
    w = np.zeros((len(n), d + 1))
    w[:, d] = 1.0 if intercept else 0.0
    cost, ended, done = np.full(len(n), np.nan), np.zeros(len(n), int), np.zeros(len(n), bool)
    for t in range(1, iterations + 1):
        live = np.flatnonzero(~done)
        if not len(live):
            break
        g, losses = gradient(live, w[live])
        if not intercept:
            g = np.column_stack([g[:, :d], np.zeros(len(live))])
        eta = step / math.sqrt(t)
        after = w[live] * (1.0 - eta * reg) - eta * g / n[live, None]
        moved = np.linalg.norm(after - w[live], axis=1)
        size = np.linalg.norm(after, axis=1)
        if t > 1:
            done[live] = moved < tol * np.maximum(size, 1.0)
        cost[live] = losses / n[live] + 0.5 * reg * size**2
        w[live], ended[live] = after, t
    return w, ended, done, cost


def _portion_frame(spark, group_col, tags, w, d, ended, done, cost, seconds) -> DataFrame:
    rows = [
        (t, w[i, :d].tolist(), float(w[i, d]), int(ended[i]), bool(done[i]), float(cost[i]), seconds)
        for i, t in enumerate(tags)
    ]
    return spark.createDataFrame(rows, f"{group_col} string, {_MODEL_SCHEMA}")


def train_lbfgs_all_tags(
    examples: DataFrame,
    feature_cols: Sequence[str],
    iterations: int = DEFAULT_ITERATIONS,
    reg: float = 0.0,
    tol: float = 1e-6,
    memory: int = 10,
    group_col: str = "tag",
    split: str | None = "train",
    checkpoint: bool = True,
) -> DataFrame:
    """Logistic regression per tag by L-BFGS, all tags in the same jobs; the
    columns of ``train_linear_all_tags``. ``reg`` weighs half the squared norm of
    the weights without the intercept. A tag stops when no entry of the mean
    gradient is larger than ``tol``."""
    options = {"iterations": iterations, "reg": reg, "tol": tol, "memory": memory}
    return _trained(examples, feature_cols, group_col, split, checkpoint, "logistic", _lbfgs, options)


def _lbfgs(gradient, n: np.ndarray, d: int, iterations: int, reg: float, tol: float, memory: int):
    """As ``_sgd``, by L-BFGS with a backtracking line search."""
    penal = np.append(np.full(d, reg), 0.0)

    def value(rows, w):
        g, losses = gradient(rows, w)
        return losses / n[rows] + 0.5 * (penal * w**2).sum(axis=1), g / n[rows, None] + penal * w

    w = np.zeros((len(n), d + 1))
    f, g = value(np.arange(len(n)), w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    ended = np.zeros(len(n), int)
    done = np.abs(g).max(axis=1) <= tol
    for t in range(1, iterations + 1):
        live = np.flatnonzero(~done)
        if not len(live):
            break
        p = _lbfgs_direction(g, past)
        size = np.ones(len(n)) if past else 1.0 / np.maximum(np.abs(g).sum(axis=1), 1.0)
        slope = (g * p).sum(axis=1)
        w_new, f_new, g_new = w.copy(), f.copy(), g.copy()
        todo, stuck = live, np.zeros(0, int)
        for _ in range(30):
            trial = w[todo] + size[todo, None] * p[todo]
            f_t, g_t = value(todo, trial)
            good = f_t <= f[todo] + 1e-4 * size[todo] * slope[todo] + 1e-14 * np.abs(f[todo])
            ok = todo[good]
            w_new[ok], f_new[ok], g_new[ok] = trial[good], f_t[good], g_t[good]
            todo = todo[~good]
            if not len(todo):
                break
            size[todo] *= 0.5
        else:
            stuck = todo
        s, y = w_new - w, g_new - g
        past = [*past, (s, y)][-memory:]
        w, f, g = w_new, f_new, g_new
        ended[live] = t
        done |= np.abs(g).max(axis=1) <= tol
        done_here = done.copy()
        done_here[stuck] = True  # no smaller value along the direction: as close as the numbers allow
        if done_here.all():
            break
    return w, ended, np.abs(g).max(axis=1) <= max(tol, 1e-6), f


def _lbfgs_direction(g: np.ndarray, past: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The two-loop recursion for each row; pairs without curvature count as none."""
    q, kept = g.copy(), []
    for s, y in reversed(past):
        sy = (s * y).sum(axis=1)
        use = sy > 1e-12 * (y * y).sum(axis=1)
        rho = np.where(use, 1.0 / np.where(use, sy, 1.0), 0.0)
        a = rho * (s * q).sum(axis=1)
        q -= a[:, None] * y
        kept.append((s, y, rho, a))
    if past:
        s, y = past[-1]
        yy = (y * y).sum(axis=1)
        scale = np.where(yy > 0, (s * y).sum(axis=1) / np.where(yy > 0, yy, 1.0), 1.0)
        q *= np.where(scale > 0, scale, 1.0)[:, None]
    for s, y, rho, a in reversed(kept):
        b = rho * (y * q).sum(axis=1)
        q += (a - b)[:, None] * s
    return -q


def weights_table(model: DataFrame, feature_cols: Sequence[str], group_col: str = "tag") -> DataFrame:
    """(tag, w_<feature>..., bias) from a trainer's output, for scoring."""
    return model.select(
        group_col,
        *[F.col("weights")[i].alias(f"w_{c}") for i, c in enumerate(feature_cols)],
        F.col("intercept").alias("bias"),
    )


def train_one_tag(
    examples: DataFrame,
    feature_cols: Sequence[str],
    model: str = "logistic",
    iterations: int = DEFAULT_ITERATIONS,
    reg: float = 0.0,
    scale: bool = True,
):
    """Fit a ``PipelineModel`` (assembler, optional scaler, classifier) on (y, features)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LinearSVC, LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    stages = [VectorAssembler(inputCols=list(feature_cols), outputCol="_raw")]
    feats = "_raw"
    if scale:
        stages.append(StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True))
        feats = "_scaled"
    if model == "logistic":
        clf = LogisticRegression(featuresCol=feats, labelCol="y", maxIter=iterations, regParam=reg)
    elif model == "svm":
        clf = LinearSVC(featuresCol=feats, labelCol="y", maxIter=iterations, regParam=reg)
    else:
        raise ValueError(f"unknown model {model!r}")
    stages.append(clf)
    return Pipeline(stages=stages).fit(examples)


def _without_summaries(pipeline_model, spark):
    """A copy of the fitted pipeline whose models lack their training summaries. A
    summary holds its session, which can't be sent to tasks once anything in it was
    observed; the model given keeps its own."""
    out = pipeline_model.copy()
    for stage in out.stages:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(spark._jvm.scala.Option.empty())
    return out


def margins_from_pipeline(pipeline_model, df: DataFrame) -> DataFrame:
    """Adds ``margin`` (raw score of class 1) and ``prediction`` from a fitted pipeline."""
    from pyspark.ml.functions import vector_to_array

    out = _without_summaries(pipeline_model, df.sparkSession).transform(df)
    out = out.withColumn("margin", vector_to_array("rawPrediction")[1])
    return out.drop("_raw", "_scaled", "rawPrediction", "probability")
