"""Writers: the typed stores, run times, CSV reports.

All writes are distributed DataFrame writes into a path the caller gives
(normally under the shared checkpoint folder); re-running a job overwrites
its output. Per-tag results of training runs are in ``results``.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.config import SUMMARY_HEADER
from tagloom.sources.results import read_results  # noqa: F401 - read beside the writers here


def write_track_store(tracks: DataFrame, path: str) -> None:
    """Tracks as Parquet partitioned by ``letter`` (one write, no per-letter loop).
    Each file is sorted by id and has Bloom filters on it, so that the look-up of one
    track reads the row groups that may hold it."""
    dealt = tracks.sortWithinPartitions("letter", "track_id").write.mode("overwrite").partitionBy("letter")
    dealt.option("parquet.bloom.filter.enabled#track_id", "true").parquet(path)


def read_track_store(spark: SparkSession, path: str, letter: str | None = None) -> DataFrame:
    """The typed store; ``letter`` is a partition filter (only that folder is listed and read)."""
    df = spark.read.parquet(path)
    return df.filter(F.col("letter") == letter) if letter is not None else df


def write_tag_counts(counts: DataFrame, path: str) -> None:
    """Tag counts, most frequent first, replacing the previous output."""
    counts.orderBy(F.desc("n"), F.asc("tag")).write.mode("overwrite").parquet(path)


def write_metric_text(lines: DataFrame, path: str) -> None:
    """Legacy three-line metric files, one folder per (clean) tag name."""
    lines.select("clean_tag", "value").write.mode("overwrite").partitionBy("clean_tag").text(path)


def append_run_time(
    spark: SparkSession,
    path: str,
    job: str,
    started_at: float,
    seconds: float | None = None,
    rows_read: int | None = None,
    rows_rejected: int | None = None,
) -> None:
    """Append one (job, started_at, seconds, rows_read, rows_rejected) row to the
    run-time log; the rows are null for jobs that don't tell them. Each row is a
    partition (``entry``) of its own, so jobs that end at once don't meet."""
    secs = float(seconds if seconds is not None else time.time() - started_at)
    row = [(job, int(started_at), secs, rows_read, rows_rejected)]
    schema = "job string, started_at bigint, seconds double, rows_read bigint, rows_rejected bigint"
    spark.createDataFrame(row, schema).coalesce(1).write.parquet(f"{path}/entry=r{uuid.uuid4().hex}")


def write_summary_csv(summary: DataFrame, path: str, header_names: list[str] | None = None) -> None:
    """One CSV file with a header row (the summary is one row per tag)."""
    names = header_names or SUMMARY_HEADER
    cols = summary.columns
    renamed = summary.select(*[F.col(c).alias(n) for c, n in zip(cols, names)])
    renamed.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


SUMMARY_SCHEMA = "tag string, song_count bigint, auroc double, auprc double, train_seconds double"


def read_summary_csv(spark: SparkSession, path: str, schema: str = SUMMARY_SCHEMA) -> DataFrame:
    """The summary CSV with an explicit schema (no inference pass)."""
    return spark.read.option("header", True).schema(schema).csv(path)
