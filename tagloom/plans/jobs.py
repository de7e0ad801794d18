"""End-to-end jobs, and the catalogue queries that run them.

Jobs (each takes the caller's session and paths):

* ``ingest_text_job``     legacy text lines -> typed store partitioned by letter
* ``ingest_files_job``    per-track binary files -> typed store
* ``tag_count_job``       typed store -> tag counts (+ run-time row)
* ``train_job``           tracks + tag counts -> weights and per-tag metrics for
                          every popular tag in one run, committed together (+ run time)
* ``predict_job``         tracks + weights -> ranked tags per track
* ``summarize_job``       tag counts + metrics -> summary CSV, means, quartiles

The queries (``JOB_QUERIES``) exercise the trainers, persistence and the sources on
the given tables, writing into the shared checkpoint folder; each has its SQL.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tagloom.config import DEFAULT_MIN_COUNT, DEFAULT_SEED, materialize, shared_dir
from tagloom.functions.hashing import unit_hash_sql
from tagloom.functions.vectors import features_array, round_sig, round_sig_sql
from tagloom.operators import labels as L
from tagloom.operators import metrics as M
from tagloom.operators import scaling
from tagloom.operators import score as SC
from tagloom.operators import summary as SU
from tagloom.operators import tags as T
from tagloom.operators import train as TR
from tagloom.plans import stages as G
from tagloom.plans.catalog import _SUMMARY_CHAIN_SQL, CONFUSION_SQL, ORACLE_SQL, SAMPLED_TRACK_SQL
from tagloom.plans.stages import FEATS, SEED, with_ctes
from tagloom.sources import binary as B
from tagloom.sources import legacy_text as LT
from tagloom.sources import results as R
from tagloom.sources import sinks as K
from tagloom.sources import testdata as td

# ---------------------------------------------------------------------------
# Jobs
# ---------------------------------------------------------------------------


def ingest_text_job(
    spark: SparkSession, text_glob: str, out: str, feature_names: Sequence[str], run_times: str | None = None
) -> DataFrame:
    """Parse legacy text into the typed store; returns the rejected lines. The
    numbers of lines read and rejected come from the pass that writes the store."""
    started = time.time()
    parsed = LT.read_track_text(spark, text_glob)
    typed = LT.features_to_columns(parsed, feature_names).withColumn("letter", F.substring("track_id", 3, 1))
    seen = Observation()
    rejected = F.coalesce(F.sum(F.when(F.col("parse_ok"), 0).otherwise(1)), F.lit(0))
    typed = typed.observe(seen, F.count(F.lit(1)).alias("read"), rejected.alias("rejected"))
    K.write_track_store(typed.filter("parse_ok").drop("parse_ok"), out)
    if run_times:
        K.append_run_time(spark, run_times, "ingest", started, None, seen.get["read"], seen.get["rejected"])
    return parsed.filter(~F.col("parse_ok"))


def ingest_files_job(spark: SparkSession, root: str, out: str, decoder=B.json_lines_decoder, glob: str = "*.h5",
                     feature_names: Sequence[str] = td.PART_FEATURES, run_times: str | None = None) -> DataFrame:
    """Decode per-track files into the typed store; returns (source_file, error) of
    those that could not be read."""
    started, seen = time.time(), Observation()
    found = B.read_track_files(spark, root, decoder, glob, feature_names)
    told = found.observe(seen, F.count(F.lit(1)).alias("read"), F.count("error").alias("rejected"))
    K.write_track_store(B.tracks_only(told).drop("source_file"), out)
    if run_times:
        K.append_run_time(spark, run_times, "ingest_files", started, None, seen.get["read"], seen.get["rejected"])
    return B.rejects(found)


def tag_count_job(spark: SparkSession, tracks: DataFrame, out: str, run_times: str | None = None) -> DataFrame:
    started = time.time()
    counts = T.tag_counts(tracks)
    K.write_tag_counts(counts, out)
    if run_times:
        K.append_run_time(spark, run_times, "tag_count", started)
    return spark.read.parquet(out)


OPTIMIZERS = ("svm_sgd", "logistic_sgd", "logistic_lbfgs")


def train_and_evaluate(
    examples: DataFrame,
    feature_cols: Sequence[str],
    optimizer: str = "svm_sgd",
    iterations: int = 100,
    score: str = "label",
    step: float = 1.0,
    reg: float | None = None,
    intercept: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(model, metrics) for every tag of ``examples`` in one batched run.

    ``optimizer`` is one of ``OPTIMIZERS``; ``reg`` is by default 0.01 for SGD and
    0 for L-BFGS, as in the library. ``score="label"`` evaluates the thresholded
    0/1 predictions (so AUROC is balanced accuracy, as in the published numbers);
    ``"margin"`` the raw margin. ``train_seconds`` is the tag's share of the batch's
    wall time, by its rows and iterations.
    """
    if optimizer not in OPTIMIZERS:
        raise ValueError(f"unknown optimizer {optimizer!r}")
    # Both splits are read (train by the trainer, test here): write the
    # examples once instead of labelling every track twice.
    examples = materialize(examples, "examples")
    if optimizer == "logistic_lbfgs":
        model = TR.train_lbfgs_all_tags(examples, feature_cols, iterations=iterations, reg=reg or 0.0, checkpoint=False)
    else:
        loss = "hinge" if optimizer == "svm_sgd" else "logistic"
        model = TR.train_linear_all_tags(
            examples, feature_cols, loss=loss, iterations=iterations, step=step,
            reg=0.01 if reg is None else reg, intercept=intercept, checkpoint=False,
        )
    w = TR.weights_table(model, feature_cols)
    test = examples.filter(F.col("split") == "test")
    kind = "svm" if optimizer == "svm_sgd" else "logistic"
    pred = SC.with_prediction(SC.with_margin(test, w, feature_cols), kind)
    scored = pred.withColumn("score", F.col("prediction") if score == "label" else F.col("margin"))
    areas = M.curve_areas(scored)
    rows = examples.filter(F.col("split") == "train").groupBy("tag").agg(F.count(F.lit(1)).alias("_rows"))
    work = F.col("_rows") * F.greatest(F.col("iterations"), F.lit(1))
    told = model.join(rows, "tag").withColumn("_work", work.cast("double"))
    batch = told.groupBy("batch_seconds").agg(F.sum("_work").alias("_all"))
    told = told.join(batch, "batch_seconds").withColumn(
        "train_seconds", F.col("batch_seconds") * F.col("_work") / F.col("_all")
    )
    metrics = areas.join(told.select("tag", "train_seconds", "iterations", "converged"), "tag")
    return model, metrics


def train_job(
    spark: SparkSession,
    tracks: DataFrame,
    counts: DataFrame,
    feature_cols: Sequence[str],
    out: str,
    min_count: int = DEFAULT_MIN_COUNT,
    mode: str = "substring",
    optimizer: str = "svm_sgd",
    iterations: int = 100,
    seed: int = DEFAULT_SEED,
    skip_trained: bool = True,
) -> DataFrame:
    """Train every popular tag that has no stored results, and store weights and
    metrics as one run: a run that ends on the way leaves neither, and the next
    one trains its tags. Earlier runs' results stay as they are. The scaler is
    stored beside the weights.
    """
    started = time.time()
    done, popular = R.committed(spark, out), T.popular_tags(counts, min_count)
    if done and skip_trained:
        popular = T.untrained_tags(popular, K.read_results(spark, f"{out}/weights"))
    popular = materialize(popular, "untrained")
    n_tags = popular.count()
    if done and not n_tags:
        K.append_run_time(spark, f"{out}/run_times", "train", started)
        return K.read_results(spark, f"{out}/metrics")
    run = R.Run(spark, out, n_tags)
    tracks = materialize(tracks, "tracks")
    stats = scaling.fit_scaler(tracks, feature_cols)
    scaled = scaling.apply_scaler(tracks, stats, feature_cols)
    examples = L.labelled_examples(scaled, popular, feature_cols, mode=mode, seed=seed)
    model, metrics = train_and_evaluate(examples, feature_cols, optimizer, iterations)
    positives = L.class_counts(tracks, popular, mode).select("tag", "n_positive")
    run.write("weights", scaling.with_scaler(model, stats, feature_cols))
    run.write("metrics", metrics.join(positives, "tag"))
    run.commit()
    K.append_run_time(spark, f"{out}/run_times", "train", started)
    return K.read_results(spark, f"{out}/metrics")


def predict_job(
    spark: SparkSession, tracks: DataFrame, out: str, feature_cols: Sequence[str], top_k: int | None = None
) -> DataFrame:
    """Ranked tags for ``tracks`` (raw features) by the models that ``train_job``
    stored at ``out``; each tag is scored through the scaler it was trained behind."""
    model = K.read_results(spark, f"{out}/weights")
    return SC.score_all_tags(tracks, scaling.raw_weights(model, feature_cols), feature_cols, top_k=top_k)


def summarize_job(spark: SparkSession, counts: DataFrame, metrics: DataFrame, out: str, min_count: int) -> DataFrame:
    summary = SU.summarize_models(counts, metrics, min_count).select(
        "tag", "song_count", "auroc", "auprc", "train_seconds"
    )
    K.write_summary_csv(summary, f"{out}/summary_csv")
    K.write_summary_csv(SU.summary_rounded(summary), f"{out}/summary_rounded_csv")
    return K.read_summary_csv(spark, f"{out}/summary_csv")


# ---------------------------------------------------------------------------
# Queries on the given tables
# ---------------------------------------------------------------------------

JOB_QUERIES: dict = {}
JOB_ORACLE_SQL: dict = {}

_FEATS_SQL = ", ".join(f"{round_sig_sql(c, 8)} AS {c}" for c in FEATS)


def job_query(name: str, sql: str | None = None):
    def register(fn):
        JOB_QUERIES[name] = fn
        if sql is not None:
            JOB_ORACLE_SQL[name] = sql
        return fn

    return register


def _trained(spark, sf, optimizer):
    ex = G.examples(spark, sf)
    return train_and_evaluate(ex, FEATS, optimizer=optimizer)


def _told(metrics):
    areas = [F.round(c, 6).alias(c) for c in ("auroc", "auprc")]
    return metrics.select("tag", "n_pos", "n_neg", *areas, "iterations", "converged")


@job_query("train_svm_all_tags", sql=G.sql_trained("hinge"))
def q_train_svm_all_tags(spark, sf):
    """Batched hinge-loss SGD for every popular tag, evaluated on the hold-out."""
    _, metrics = _trained(spark, sf, "svm_sgd")
    return _told(metrics)


@job_query("train_logistic_all_tags", sql=G.sql_trained("logistic"))
def q_train_logistic_all_tags(spark, sf):
    _, metrics = _trained(spark, sf, "logistic_sgd")
    return _told(metrics)


def _top_tag(spark, sf) -> str:
    """The most frequent popular tag (one driver-side value)."""
    top = G.popular(spark, sf).orderBy(F.desc("n"), "tag").first()
    return top["tag"] if top is not None else ""


def _one_tag_examples(spark, sf):
    return G.examples(spark, sf).filter(F.col("tag") == _top_tag(spark, sf))


_TOP_TAG_SQL = with_ctes(*G.sql_examples_chain()) + """
, top AS (SELECT tag FROM popular ORDER BY n DESC, tag LIMIT 1),
one AS (SELECT e.* FROM examples e JOIN top USING (tag))
"""
_ONE_TAG_COUNTS_SQL = _TOP_TAG_SQL + (
    "SELECT tag, CAST(count(*) FILTER (y = 1 AND split = 'test') AS BIGINT) AS n_pos, "
    "CAST(count(*) FILTER (y <> 1 AND split = 'test') AS BIGINT) AS n_neg, true AS {} FROM one GROUP BY tag"
)


def _one_tag(spark, sf, model: str):
    ex = _one_tag_examples(spark, sf)
    pm = TR.train_one_tag(ex.filter(F.col("split") == "train"), FEATS, model=model, scale=False)
    w = pm.stages[-1]
    row = (_top_tag(spark, sf), *[float(v) for v in w.coefficients], float(w.intercept))
    names = ["tag", *[f"w_{c}" for c in FEATS], "w_bias"]
    weights = spark.createDataFrame([row], ", ".join(f"{n} {'string' if n == 'tag' else 'double'}" for n in names))
    counts = ex.filter(F.col("split") == "test").groupBy("tag").agg(
        F.sum(F.when(F.col("y") == 1.0, 1).otherwise(0)).alias("n_pos"),
        F.sum(F.when(F.col("y") == 1.0, 0).otherwise(1)).alias("n_neg"),
    )
    loss = "logistic" if model == "logistic" else "hinge"
    return TR.gradient_sums(ex.filter(F.col("split") == "train"), weights, FEATS, loss), counts


def _largest_slope():
    return F.greatest(*[F.abs(F.col(f"g_{c}")) for c in FEATS], F.abs(F.col("g_bias"))) / F.col("n")


@job_query("train_one_tag_logistic", sql=_ONE_TAG_COUNTS_SQL.format("stationary"))
def q_train_one_tag_logistic(spark, sf):
    """pyspark.ml LogisticRegression (L-BFGS, no regularisation) for one tag: at its
    weights the loss's gradient, summed by this package's own step, is zero."""
    slopes, counts = _one_tag(spark, sf, "logistic")
    told = slopes.select("tag", (_largest_slope() < 1e-4).alias("stationary"))
    return counts.join(told, "tag").select("tag", "n_pos", "n_neg", "stationary")


@job_query("train_one_tag_svm", sql=_ONE_TAG_COUNTS_SQL.format("below_start"))
def q_train_one_tag_svm(spark, sf):
    """pyspark.ml LinearSVC for one tag: its hinge loss, summed by this package's own
    step, is below that of zero weights, which is 1 a row."""
    slopes, counts = _one_tag(spark, sf, "svm")
    told = slopes.select("tag", (F.col("loss_sum") / F.col("n") < 1.0).alias("below_start"))
    return counts.join(told, "tag").select("tag", "n_pos", "n_neg", "below_start")


@job_query("train_logistic_lbfgs_all_tags", sql=with_ctes(*G.sql_examples_chain())
           + "SELECT tag, CAST(count(*) AS BIGINT) AS n, true AS stationary FROM examples "
           "WHERE split = 'train' GROUP BY tag")
def q_train_logistic_lbfgs_all_tags(spark, sf):
    """Logistic regression by L-BFGS for every popular tag at once: the gradient at
    each tag's weights, summed by the SQL step, is zero."""
    train = G.examples(spark, sf).filter(F.col("split") == "train")
    model = TR.train_lbfgs_all_tags(train, FEATS, split=None)
    weights = TR.weights_table(model, FEATS).withColumnRenamed("bias", "w_bias")
    slopes = TR.gradient_sums(train, weights, FEATS, "logistic")
    return slopes.select("tag", "n", (_largest_slope() < 1e-5).alias("stationary"))


@job_query("model_round_trip", sql=_TOP_TAG_SQL + "SELECT tag, CAST(count(*) AS BIGINT) AS n, true AS same "
           "FROM one WHERE split = 'test' GROUP BY tag")
def q_model_round_trip(spark, sf):
    """Scaler and classifier saved as one PipelineModel, loaded, and applied: the
    margins of the hold-out are those of the model that was saved."""
    from pyspark.ml import PipelineModel

    ex = _one_tag_examples(spark, sf)
    pm = TR.train_one_tag(ex.filter(F.col("split") == "train"), FEATS, model="logistic", scale=True)
    path = shared_dir(spark, "model")
    pm.write().overwrite().save(path)
    test = ex.filter(F.col("split") == "test")
    before = TR.margins_from_pipeline(pm, test).select("tag", "track_id", "margin")
    after = TR.margins_from_pipeline(PipelineModel.load(path), test).select("tag", "track_id", F.col("margin").alias("m"))
    both = before.join(after, ["tag", "track_id"])
    return both.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("m") == F.col("margin")).alias("same"))


# Embeddings: ten tags with signal, 64 features.
_EMB_FEATS = [f"e{i}" for i in range(64)]
_EMB_SQL = f"""
tracks AS (SELECT CAST(vec_id AS VARCHAR) AS track_id, 'label_' || label AS own,
                  list_append(CAST(embedding AS DOUBLE[]), CAST(1 AS DOUBLE)) AS x FROM embeddings),
sizes AS (SELECT own AS tag, count(*) AS p, (SELECT count(*) FROM tracks) AS n FROM tracks GROUP BY own),
drawn AS (SELECT *, {unit_hash_sql("track_id", salt="sample", seed=SEED)} AS u,
                 {unit_hash_sql("track_id", salt="split", seed=SEED)} AS v FROM tracks),
examples AS (
  SELECT s.tag, d.track_id, CAST(CASE WHEN d.own = s.tag THEN 1 ELSE 0 END AS DOUBLE) AS y, d.x,
         CASE WHEN d.v < {G.TRAIN_FRACTION} THEN 'train' ELSE 'test' END AS split
  FROM drawn d CROSS JOIN sizes s WHERE d.own = s.tag OR d.u < least(s.p / (s.n - s.p), 1)),
train_x AS (SELECT tag, y, x FROM examples WHERE split = 'train')"""
_EMB_TRAIN_SQL = with_ctes(
    _EMB_SQL, G.sql_sgd("hinge", feats=_EMB_FEATS),
    """
scored AS (SELECT e.tag, e.y, CAST(CASE WHEN list_dot_product(m.w, e.x) > 0 THEN 1 ELSE 0 END AS DOUBLE) AS score
           FROM examples e JOIN model m ON m.tag = e.tag WHERE e.split = 'test')""",
    M.CURVE_AREAS_SQL,
).replace("WITH ", "WITH RECURSIVE ", 1) + (
    "SELECT a.tag, n_pos, n_neg, round(auroc, 6) AS auroc, round(auprc, 6) AS auprc, "
    "CAST(m.t AS INTEGER) AS iterations, m.done AS converged FROM areas a JOIN model m ON m.tag = a.tag"
)


@job_query("train_svm_embeddings", sql=_EMB_TRAIN_SQL)
def q_train_svm_embeddings(spark, sf):
    """The same trainer on data with signal: ten label tags, 64 features."""
    tracks = td.embedding_tracks(spark, sf)
    ex = L.labelled_examples(tracks, T.tag_counts(tracks), _EMB_FEATS, mode="exact", seed=SEED)
    _, metrics = train_and_evaluate(ex, _EMB_FEATS)
    return _told(metrics)


def _rounded_features(df: DataFrame) -> list:
    return [round_sig(F.col(c), 8).alias(c) for c in FEATS]


@job_query("partitioned_store_round_trip", sql=with_ctes(G.SQL_TRACKS) + "SELECT track_id, letter, " + _FEATS_SQL
           + " FROM tracks WHERE letter = (SELECT min(letter) FROM tracks)")
def q_partitioned_store_round_trip(spark, sf):
    """Typed store written partitioned by letter; one letter read back (partition pruning)."""
    path = shared_dir(spark, "store")
    K.write_track_store(G.tracks(spark, sf), path)
    letter = G.tracks(spark, sf).agg(F.min("letter")).first()[0]
    got = K.read_track_store(spark, path, letter)
    return got.select("track_id", "letter", *_rounded_features(got))


def _text_glob(spark, sf, letters: str):
    path = shared_dir(spark, "text")
    lines = LT.format_track_lines(G.stored_tracks(spark, sf), FEATS)
    lines.write.mode("overwrite").partitionBy("letter").text(path)
    parsed = LT.features_to_columns(LT.read_track_text(spark, f"{path}/letter=[{letters}]"), FEATS)
    return parsed.select("track_id", F.array_join("tags", "|").alias("tags"), *_rounded_features(parsed))


_GLOB_SQL = with_ctes(G.SQL_TRACKS) + "SELECT track_id, array_to_string(tags, '|') AS tags, " + _FEATS_SQL + " FROM tracks "


@job_query("text_glob_scan", sql=_GLOB_SQL + "WHERE letter BETWEEN '0' AND '7'")
def q_text_glob_scan(spark, sf):
    """Legacy text lines in letter folders, scanned by a folder glob and parsed."""
    return _text_glob(spark, sf, "0-7")


@job_query("text_glob_scan_rest", sql=_GLOB_SQL + "WHERE letter NOT BETWEEN '0' AND '7'")
def q_text_glob_scan_rest(spark, sf):
    """The other folders of the same scan."""
    return _text_glob(spark, sf, "89a-f")


@job_query("partitioned_store_other_letters", sql=with_ctes(G.SQL_TRACKS) + "SELECT track_id, letter, " + _FEATS_SQL
           + " FROM tracks")
def q_partitioned_store_other_letters(spark, sf):
    """The typed store read back one letter at a time, all letters: no row is lost."""
    path = shared_dir(spark, "store")
    K.write_track_store(G.stored_tracks(spark, sf), path)
    whole = None
    for letter in "0123456789abcdef":
        one = K.read_track_store(spark, path, letter)
        whole = one if whole is None else whole.unionByName(one)
    return whole.select("track_id", F.col("letter").cast("string").alias("letter"), *_rounded_features(whole))


@job_query("artist_tables_round_trip", sql=ORACLE_SQL["labels_join_features"])
def q_artist_tables_round_trip(spark, sf):
    """Artist tags and track-artist edges stored as tables -> track labels -> features."""
    at = materialize(td.artist_tags(spark, sf), "artist_mbtag")
    ta = materialize(td.track_artist(spark, sf), "songs")
    labels = L.track_labels(ta, L.artist_has_tag(at, G.ARTIST_TAGSTRING))
    j = L.labels_with_features(labels, td.order_tracks(spark, sf))
    return j.select("track_id", "y", *[round_sig(F.col(c), 8).alias(c) for c in td.ORDER_FEATURES])


@job_query("binary_ingest", sql=with_ctes(G.SQL_TRACKS) + "SELECT track_id, array_to_string(tags, '|') AS tags, "
           + _FEATS_SQL + " FROM tracks")
def q_binary_ingest(spark, sf):
    """Track files (JSON-lines stand-in for HDF5) -> binaryFile scan -> decoded rows."""
    path = shared_dir(spark, "files")
    t = G.tracks(spark, sf).select("track_id", "tags", features_array(FEATS).alias("features"), "letter")
    t.write.mode("overwrite").partitionBy("letter").json(path)
    got = B.tracks_only(B.read_track_files(spark, path, B.json_lines_decoder, "*.json", FEATS))
    return got.select("track_id", F.array_join("tags", "|").alias("tags"), *_rounded_features(got))


@job_query("csv_round_trip", sql=_SUMMARY_CHAIN_SQL + "SELECT tag, song_count, round(auroc, 2) AS auroc, "
           "round(auprc, 2) AS auprc, CAST(NULL AS DOUBLE) AS train_seconds FROM summary")
def q_csv_round_trip(spark, sf):
    """Per-tag summary written as one CSV with a header and read back with a schema."""
    path = shared_dir(spark, "csv")
    p = G.test_predictions(spark, sf).withColumn("score", F.col("prediction"))
    metrics = M.curve_areas(p).withColumn("train_seconds", F.lit(None).cast("double"))
    summary = SU.summarize_models(G.popular(spark, sf), metrics).select(
        "tag", "song_count", "auroc", "auprc", "train_seconds"
    )
    K.write_summary_csv(SU.summary_rounded(summary), path)
    return K.read_summary_csv(spark, path)


@job_query("metric_files_scan", sql=_SUMMARY_CHAIN_SQL.replace(", summary AS", ", unused AS")
           + "SELECT replace(replace(tag, ' ', '_'), '\\', '') AS clean_tag, round(auroc, 6) AS auroc, "
           "round(auprc, 6) AS auprc, train_seconds FROM metrics")
def q_metric_files_scan(spark, sf):
    """Three metric lines per tag in per-tag folders, read in one scan and pivoted."""
    path = shared_dir(spark, "results")
    p = G.test_predictions(spark, sf).withColumn("score", F.col("prediction"))
    metrics = M.curve_areas(p).withColumn("train_seconds", (F.col("n_pos") + F.col("n_neg")))
    lines = LT.format_metric_lines(metrics).join(
        T.with_clean_names(metrics.select("tag")), "tag"
    )
    K.write_metric_text(lines, path)
    m = LT.read_metric_files(spark, path, tag_col="clean_tag")
    return m.select("clean_tag", F.round("auroc", 6).alias("auroc"), F.round("auprc", 6).alias("auprc"), "train_seconds")


@job_query("run_time_log", sql=with_ctes(G.SQL_TRACKS, G.SQL_COUNTS)
           + "SELECT 'tag_count' AS job, true AS sane_seconds, CAST(count(*) AS BIGINT) AS n_tags, "
           "CAST(sum(n) AS BIGINT) AS n_occurrences FROM counts")
def q_run_time_log(spark, sf):
    """Tag counts job with its run time appended to the run-time log."""
    base = shared_dir(spark, "runs")
    stored = tag_count_job(spark, G.tracks(spark, sf), f"{base}/tags", f"{base}/run_times")
    log = spark.read.parquet(f"{base}/run_times")
    sane = (F.col("seconds") >= 0) & (F.col("seconds") < 86400) & (F.col("started_at") > 0)
    totals = stored.agg(F.count(F.lit(1)).alias("n_tags"), F.sum("n").alias("n_occurrences"), F.lit("tag_count").alias("job"))
    return log.select("job", sane.alias("sane_seconds")).join(totals, "job")


__all__ = ["JOB_ORACLE_SQL", "JOB_QUERIES", "SEED"]


# ---------------------------------------------------------------------------
# Streaming: incremental ingest and running tag counts
# ---------------------------------------------------------------------------


def _stream_source(spark, sf) -> str:
    """Legacy text lines of every track, as files in a fresh source folder."""
    src = shared_dir(spark, "stream-src")
    LT.format_track_lines(G.tracks(spark, sf), FEATS).select("value").write.mode("overwrite").text(src)
    return src


@job_query("streaming_ingest", sql=with_ctes(G.SQL_TRACKS) + "SELECT track_id, array_to_string(tags, '|') AS tags, "
           + _FEATS_SQL + " FROM tracks")
def q_streaming_ingest(spark, sf):
    """File stream of legacy text -> typed store (availableNow, checkpointed)."""
    from tagloom.streaming.ingest import stream_text_ingest

    src = _stream_source(spark, sf)
    store = shared_dir(spark, "stream-store")
    q = stream_text_ingest(spark, src, store, shared_dir(spark, "stream-ckpt"), FEATS,
                           letter_expr=F.substring(F.md5("track_id"), 1, 1), max_files=4)
    q.awaitTermination()
    got = spark.read.parquet(store)
    return got.select("track_id", F.array_join("tags", "|").alias("tags"), *_rounded_features(got))


@job_query("streaming_tag_counts", sql=ORACLE_SQL["tag_counts"])
def q_streaming_tag_counts(spark, sf):
    """Streaming aggregation of tag counts over the ingested files."""
    from tagloom.streaming.ingest import stream_tag_counts

    src = _stream_source(spark, sf)
    out = shared_dir(spark, "stream-counts")
    q = stream_tag_counts(spark, src, out, shared_dir(spark, "stream-counts-ckpt"), max_files=4)
    q.awaitTermination()
    return spark.read.parquet(out)


# ---------------------------------------------------------------------------
# One tag, with the old command's options as keyword arguments
# ---------------------------------------------------------------------------


def one_tag_job(
    spark: SparkSession,
    tracks: DataFrame,
    feature_cols: Sequence[str],
    tag: str = "rock",
    model: str = "logistic",
    step: float = 1.0,
    iterations: int = 100,
    holdout: float = 0.1,
    intercept: bool = True,
    mode: str = "substring_ci",
    seed: int = DEFAULT_SEED,
    verbose: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Train and evaluate one tag with SGD; returns (model, confusion report).

    Options mirror the old one-tag command: tag string, model (svm/logistic),
    step, iterations, hold-out share, intercept. Arguments are validated.
    """
    if str(model).lower() not in ("logistic", "svm"):
        raise ValueError("model must be 'logistic' or 'svm'")
    if not 0.0 < holdout < 1.0:
        raise ValueError("the hold-out share has to lie between 0 and 1")
    loss = "hinge" if str(model).lower() == "svm" else "logistic"
    tags_df = T.tags_frame(spark, [tag.lower() if mode == "substring_ci" else tag])
    scaled = scaling.standard_scale(materialize(tracks, "tracks"), feature_cols)
    ex = L.labelled_examples(scaled, tags_df, feature_cols, mode=mode, seed=seed, ratio="prior",
                             train_fraction=1.0 - holdout)
    ex = materialize(ex, "examples")
    T.preview(ex, enabled=verbose, label="examples")
    fitted = TR.train_linear_all_tags(ex, feature_cols, loss=loss, iterations=iterations, step=step,
                                      intercept=intercept, checkpoint=False)
    test = ex.filter(F.col("split") == "test")
    kind = "svm" if loss == "hinge" else "logistic"
    pred = SC.with_prediction(SC.with_margin(test, TR.weights_table(fitted, feature_cols), feature_cols), kind)
    return fitted, M.confusion_report(pred)


_ONE_TAG_CHAIN = [
    G.SQL_TRACKS,
    "\npopular AS (SELECT 'brand#1' AS tag)",
    G.sql_scaled(),
    G.sql_pos("substring_ci"),
    G.sql_frac("prior"),
    G.sql_examples().replace(f"d.v < {G.TRAIN_FRACTION}", "d.v < 0.9"),
    f"\ntrain_x AS (SELECT e.tag, e.y, {G.sql_x()} AS x FROM examples e WHERE e.split = 'train')",
    G.sql_sgd("logistic"),
    G.sql_model_predictions("logistic"),
]


@job_query("one_tag_sgd_report", sql=with_ctes(*_ONE_TAG_CHAIN).replace("WITH ", "WITH RECURSIVE ", 1) + CONFUSION_SQL)
def q_one_tag_sgd_report(spark, sf):
    """One tag ('brand#1', case-folded substring) with logistic SGD, old defaults."""
    _, report = one_tag_job(spark, G.stored_tracks(spark, sf), FEATS, tag="Brand#1")
    ints = ["tag", "n", "n0", "n1"]
    return report.select(*ints, *[F.round(c, 6).alias(c) for c in report.columns if c not in ints])


def _min_count(spark, sf, share: int) -> int:
    return -(-G.n_tracks(spark, sf) // share)  # ceil: the catalogue's cut-off


@job_query("train_job_end_to_end", sql=G.sql_trained("hinge").rsplit("SELECT a.tag", 1)[0]
           + "SELECT a.tag, p.n AS song_count, c.n_positive, round(auroc, 6) AS auroc, round(auprc, 6) AS auprc, "
           "true AS timed FROM areas a JOIN popular p ON p.tag = a.tag JOIN cc c ON c.tag = a.tag")
def q_train_job_end_to_end(spark, sf):
    """Train every popular tag, write weights, metrics and run times, and summarise
    from what is stored; the summary also goes to CSV."""
    out = shared_dir(spark, "train-job")
    tracks = G.stored_tracks(spark, sf)
    counts = T.tag_counts(tracks)
    min_count = _min_count(spark, sf, G.SHARE_DEN)
    train_job(spark, tracks, counts, FEATS, out, min_count=min_count)
    metrics = K.read_results(spark, f"{out}/metrics")
    summarize_job(spark, counts, metrics, out, min_count)
    summary = SU.summarize_models(counts, metrics, min_count)
    return summary.select(
        "tag", "song_count", "n_positive", F.round("auroc", 6).alias("auroc"), F.round("auprc", 6).alias("auprc"),
        (F.col("train_seconds") > 0).alias("timed"),
    )


@job_query("train_job_incremental", sql=with_ctes(G.SQL_TRACKS, G.SQL_COUNTS) + f"""
SELECT tag, CAST(CASE WHEN n * {G.SHARE_DEN // 2} >= (SELECT n_tracks FROM ntracks) THEN 1 ELSE 2 END AS BIGINT) AS run,
       true AS has_metrics, true AS unchanged FROM popular""")
def q_train_job_incremental(spark, sf):
    """A run, a re-run and a run with a lower cut-off: every popular tag has weights
    and metrics, and the first run's weights are as they were."""
    out = shared_dir(spark, "train-job")
    tracks = G.stored_tracks(spark, sf)
    counts = materialize(T.tag_counts(tracks), "counts")
    first = _min_count(spark, sf, G.SHARE_DEN // 2)
    train_job(spark, tracks, counts, FEATS, out, min_count=first)
    old = materialize(K.read_results(spark, f"{out}/weights").select("tag", F.col("weights").alias("old")), "old")
    train_job(spark, tracks, counts, FEATS, out, min_count=first)
    train_job(spark, tracks, counts, FEATS, out, min_count=_min_count(spark, sf, G.SHARE_DEN))
    weights, metrics = (K.read_results(spark, f"{out}/{name}") for name in ("weights", "metrics"))
    told = metrics.select("tag", F.col("run").alias("_run"))
    both = weights.join(told, "tag", "full").join(old, "tag", "left")
    return both.select(
        "tag", "run", F.col("_run").eqNullSafe(F.col("run")).alias("has_metrics"),
        (F.col("old").isNull() | (F.col("old") == F.col("weights"))).alias("unchanged"),
    )


@job_query("predict_from_store", sql=with_ctes(
    *G.sql_examples_chain(),
    f"\ntrain_x AS (SELECT e.tag, e.y, {G.sql_x()} AS x FROM examples e WHERE e.split = 'train')", G.sql_sgd("hinge"),
).replace("WITH ", "WITH RECURSIVE ", 1) + SAMPLED_TRACK_SQL + f"""
, margins AS (SELECT s.track_id, m.tag, list_dot_product(m.w, {G.sql_x("s")}) AS margin
              FROM scaled s JOIN picked p ON p.track_id = s.track_id, model m)
SELECT track_id, tag, round(margin, 6) AS margin,
       CAST(row_number() OVER (ORDER BY margin DESC, tag) AS INTEGER) AS rank FROM margins""")
def q_predict_from_store(spark, sf):
    """Train, write, read, and score one sampled track from its raw features by the
    stored weights and scaler."""
    from tagloom.operators import sampling as S

    out = shared_dir(spark, "train-job")
    tracks = G.stored_tracks(spark, sf)
    train_job(spark, tracks, T.tag_counts(tracks), FEATS, out, min_count=_min_count(spark, sf, G.SHARE_DEN))
    letter = S.sample_one(tracks.select("letter").distinct(), "letter", SEED)
    one = S.sample_one(tracks.join(letter, "letter", "left_semi"), "track_id", SEED)
    ranked = predict_job(spark, one, out, FEATS)
    return ranked.select("track_id", "tag", F.round("margin", 6).alias("margin"), "rank")


@job_query("model_of_one_tag", sql=with_ctes(
    *G.sql_examples_chain(),
    f"\ntrain_x AS (SELECT e.tag, e.y, {G.sql_x()} AS x FROM examples e WHERE e.split = 'train')", G.sql_sgd("hinge"),
).replace("WITH ", "WITH RECURSIVE ", 1) + """
, top AS (SELECT tag FROM popular ORDER BY n DESC, tag LIMIT 1)
SELECT m.tag, CAST(1 AS BIGINT) AS run, CAST(m.t AS INTEGER) AS iterations, m.done AS converged,
       CAST(i AS INTEGER) AS k, round(m.w[i], 6) AS weight
FROM model m JOIN top USING (tag), (SELECT unnest(range(1, len(m.w) + 1)) AS i)""")
def q_model_of_one_tag(spark, sf):
    """One tag's model looked up in the store of all tags: the weights, intercept last."""
    out = shared_dir(spark, "train-job")
    tracks = G.stored_tracks(spark, sf)
    train_job(spark, tracks, T.tag_counts(tracks), FEATS, out, min_count=_min_count(spark, sf, G.SHARE_DEN))
    model = R.read_tag(spark, out, "weights", _top_tag(spark, sf))
    whole = F.concat("weights", F.array("intercept"))
    return model.select("tag", "run", "iterations", "converged", F.posexplode(whole).alias("k", "weight")).select(
        "tag", "run", "iterations", "converged", (F.col("k") + 1).alias("k"), F.round("weight", 6).alias("weight")
    )


@job_query("train_svm_other_step", sql=G.sql_trained("hinge", step=0.25, intercept=False, reg=0.05))
def q_train_svm_other_step(spark, sf):
    """The trainer's parameters as they vary: another step and penalty, no intercept."""
    model, metrics = train_and_evaluate(G.examples(spark, sf), FEATS, step=0.25, reg=0.05, intercept=False)
    return _told(metrics)


_BROKEN_LINES = "letter = '0'"


def _written_lines(spark, sf) -> str:
    """Legacy text of all tracks; the lines of one letter are cut off in the middle."""
    path = shared_dir(spark, "text")
    lines = LT.format_track_lines(G.stored_tracks(spark, sf), FEATS)
    value = F.when(F.expr(_BROKEN_LINES), F.substring("value", 1, 15)).otherwise(F.col("value"))
    lines.select(value.alias("value")).write.text(path)
    return path


@job_query("ingest_run_time_log", sql=with_ctes(G.SQL_TRACKS) + "SELECT 'ingest' AS job, true AS sane_seconds, "
           f"CAST(count(*) AS BIGINT) AS rows_read, CAST(count(*) FILTER ({_BROKEN_LINES}) AS BIGINT) AS rows_rejected, "
           f"CAST(count(*) FILTER (NOT ({_BROKEN_LINES})) AS BIGINT) AS n_stored FROM tracks")
def q_ingest_run_time_log(spark, sf):
    """Text with broken lines into the typed store; lines read and rejected are
    observed while the store is written, and logged with the run's time."""
    base = shared_dir(spark, "ingest")
    ingest_text_job(spark, _written_lines(spark, sf), f"{base}/store", FEATS, f"{base}/run_times")
    stored = K.read_track_store(spark, f"{base}/store").agg(F.count(F.lit(1)).alias("n_stored"), F.lit("ingest").alias("job"))
    sane = (F.col("seconds") >= 0) & (F.col("seconds") < 86400) & (F.col("started_at") > 0)
    log = spark.read.parquet(f"{base}/run_times")
    return log.select("job", sane.alias("sane_seconds"), "rows_read", "rows_rejected").join(stored, "job")


@job_query("text_to_models", sql=JOB_ORACLE_SQL["train_job_end_to_end"].replace(", true AS timed", ""))
def q_text_to_models(spark, sf):
    """From legacy text to stored models: lines -> typed store -> tag counts ->
    every popular tag trained for 100 iterations -> summary of what is stored."""
    base, text = shared_dir(spark, "text-job"), shared_dir(spark, "text")
    LT.format_track_lines(G.stored_tracks(spark, sf), FEATS).select("value").write.text(text)
    ingest_text_job(spark, text, f"{base}/store", FEATS, f"{base}/run_times")
    store = K.read_track_store(spark, f"{base}/store").drop("letter")
    counts = tag_count_job(spark, store, f"{base}/counts", f"{base}/run_times")
    min_count = -(-store.count() // G.SHARE_DEN)
    train_job(spark, store, counts, FEATS, f"{base}/models", min_count=min_count)
    summary = SU.summarize_models(counts, K.read_results(spark, f"{base}/models/metrics"), min_count)
    return summary.select(
        "tag", "song_count", "n_positive", F.round("auroc", 6).alias("auroc"), F.round("auprc", 6).alias("auprc")
    )


@job_query("verbose_preview", sql=with_ctes(G.SQL_TRACKS) + "SELECT CAST(least(count(*), 4) AS BIGINT) AS n, true AS all_known "
           "FROM tracks")
def q_verbose_preview(spark, sf):
    """The rows that a verbose run shows: four of the table's own."""
    tracks = G.stored_tracks(spark, sf)
    shown = T.preview(tracks.select("track_id", "letter"), 4, enabled=True, label="tracks")
    rows = spark.createDataFrame(shown, "track_id string, letter string")
    known = rows.join(tracks.select("track_id", F.col("letter").alias("_own")), "track_id", "left")
    same = F.col("letter").cast("string").eqNullSafe(F.col("_own").cast("string"))
    return known.agg(F.count(F.lit(1)).alias("n"), F.bool_and(same).alias("all_known"))


@job_query("track_lines_ingest", sql=with_ctes(G.SQL_TRACKS) + "SELECT track_id, array_to_string(tags, '|') AS tags, "
           + _FEATS_SQL + ", CAST(NULL AS VARCHAR) AS error FROM tracks UNION ALL SELECT NULL, NULL, "
           + ", ".join("NULL" for _ in FEATS) + ", 'not a track: ' || track_id FROM tracks WHERE " + _BROKEN_LINES)
def q_track_lines_ingest(spark, sf):
    """Files of track records, cut at line ends; broken lines among them are told apart."""
    path = shared_dir(spark, "files")
    t = G.stored_tracks(spark, sf)
    good = t.select("letter", F.to_json(F.struct("track_id", "tags", features_array(FEATS).alias("features"))).alias("value"))
    broken = t.filter(_BROKEN_LINES).select("letter", F.col("track_id").alias("value"))
    good.unionByName(broken).write.partitionBy("letter").text(path)
    got = B.read_track_lines(spark, path, "*.txt", FEATS)
    return got.select("track_id", F.array_join("tags", "|").alias("tags"), *_rounded_features(got), "error")
