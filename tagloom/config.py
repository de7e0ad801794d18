"""Fixed values and session-derived settings shared by the whole package."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# ---------------------------------------------------------------------------
# Fixed values. These must equal the legacy data formats for results to match.
# ---------------------------------------------------------------------------

# Audio features kept per track, in the order the legacy text lines store them.
TRACK_FEATURES = [
    "duration",
    "end_of_fade_in",
    "key",
    "key_confidence",
    "loudness",
    "mode",
    "mode_confidence",
    "start_of_fade_out",
    "tempo",
    "time_signature",
    "time_signature_confidence",
]

# Positions of those features (and of the track id) in a row of the per-track
# HDF5 "analysis/songs" table.
TRACK_FEATURE_POSITIONS = [3, 4, 21, 22, 23, 24, 25, 26, 27, 28, 29]
TRACK_ID_POSITION = 30

# The older seven-feature subset, by position.
SEVEN_FEATURE_POSITIONS = [3, 4, 21, 23, 24, 27, 28]
SEVEN_FEATURE_INDEXES = [TRACK_FEATURE_POSITIONS.index(p) for p in SEVEN_FEATURE_POSITIONS]

# Metric line prefixes, one line each per trained tag.
METRIC_AUROC_PREFIX = "Area Under ROC"
METRIC_AUPRC_PREFIX = "Area Under Precision-Recall"
METRIC_TIME_PREFIX = "Total time"

# Separator of the track-info text file.
TRACK_INFO_SEP = "<SEP>"

# Header of the model-summary CSV.
SUMMARY_HEADER = ["Tag", "Song Count", "AUROC", "AUPRC", "Time to Train"]

# Tag popularity cut-off used for training.
DEFAULT_MIN_COUNT = 1000

# Gradient-descent defaults of the linear trainers: step size, iterations,
# L2 regularisation, convergence tolerance.
DEFAULT_STEP = 1.0
DEFAULT_ITERATIONS = 100
DEFAULT_REG = 0.01
DEFAULT_TOL = 0.001

# Training share of the hold-out split.
DEFAULT_TRAIN_FRACTION = 0.7

DEFAULT_SEED = 42

# Headings of the prediction report (fixed values of its format).
REPORT_TRACK, REPORT_ARTIST, REPORT_TITLE = "TRACK ID: ", "ARTIST: ", "SONG TITLE: "
REPORT_TAG_HEADING, REPORT_MARGIN_HEADING = "GENRE TAG", " | SVM MARGIN"

# Weights that one pass trains or scores with at a time; more are taken in
# blocks of this many numbers, one after the other, with the same results.
WEIGHTS_AT_ONCE = 2_000_000


def _base_dir(spark: SparkSession) -> str:
    """The shared folder of the session: ``spark.checkpoint.dir``, or the context's
    checkpoint directory. Only a local master, where the driver and the tasks are
    one process, may have neither; it gets one temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_BASES:
        _LOCAL_BASES[app] = tempfile.mkdtemp(prefix="tagloom-")
    return _LOCAL_BASES[app]


_LOCAL_BASES: dict[str, str] = {}
# Tables stored once per application and key: (application id, key) -> path.
_STORED: dict[tuple, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The application's own folder for intermediates under the shared folder."""
    return f"{_base_dir(spark)}/tagloom/{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh path (not created yet) for intermediates of this application."""
    if spark.sparkContext.applicationId not in _CLEARED_AT_EXIT:
        _CLEARED_AT_EXIT.add(spark.sparkContext.applicationId)
        atexit.register(_clear_quietly, spark)
    return f"{scratch_root(spark)}/{name or 'tmp'}-{uuid.uuid4().hex[:12]}"


_CLEARED_AT_EXIT: set[str] = set()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that Spark uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediates of this application (also done at exit)."""
    app = spark.sparkContext.applicationId
    for key in [k for k in _STORED if k[0] == app]:
        del _STORED[key]
    remove_path(spark, scratch_root(spark))


def _clear_quietly(spark: SparkSession) -> None:
    try:
        clear_scratch(spark)
    except Exception:  # noqa: BLE001 - the session has ended; its folder stays for the cluster's own cleaning
        pass


def materialize(df, name: str = "table", key: tuple | None = None):
    """Write ``df`` as Parquet to the shared folder and read it back: later passes
    scan the written table (column pruning, no recomputation of the upstream
    joins and aggregates), and the lineage is cut, so a lost executor does not
    replay the upstream work. With a ``key`` the table is stored once per
    application; the caller answers for the key naming the same rows."""
    spark = df.sparkSession
    known = (spark.sparkContext.applicationId, name, *key) if key is not None else None
    path = _STORED.get(known)
    if path is None:
        path = shared_dir(spark, name)
        df.write.parquet(path)
        if known is not None:
            _STORED[known] = path
    return spark.read.schema(df.schema).parquet(path)
