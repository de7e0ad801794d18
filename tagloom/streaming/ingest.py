"""Incremental ingest with Structured Streaming.

New legacy text files dropped into a folder are parsed and appended to the
typed store (Parquet, partitioned by letter). The stream's checkpoint (in the
shared folder) records which files are done, so a re-run -- or a restart
after a lost driver -- only processes new files: the streaming form of
"skip what is already done". ``trigger(availableNow=True)`` processes the
backlog in bounded micro-batches (``maxFilesPerTrigger``) and stops.

``stream_tag_counts`` keeps running tag counts over the same files as a
streaming aggregation; each micro-batch rewrites the (small, one row per tag)
result table through ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagloom.sources.legacy_text import features_to_columns, parse_track_lines


def _parsed_stream(spark: SparkSession, source_dir: str, feature_names: Sequence[str], max_files: int) -> DataFrame:
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(source_dir)
    return features_to_columns(parse_track_lines(lines), feature_names)


def stream_text_ingest(
    spark: SparkSession,
    source_dir: str,
    store_path: str,
    checkpoint_path: str,
    feature_names: Sequence[str],
    letter_expr=None,
    max_files: int = 1000,
) -> StreamingQuery:
    """Start the ingest stream (availableNow); returns the running query."""
    parsed = _parsed_stream(spark, source_dir, feature_names, max_files)
    letter = letter_expr if letter_expr is not None else F.substring("track_id", 3, 1)
    good = parsed.filter(F.col("parse_ok")).drop("parse_ok").withColumn("letter", letter)
    return (
        good.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_path)
        .partitionBy("letter")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(store_path)
    )


def stream_tag_counts(
    spark: SparkSession,
    source_dir: str,
    out_path: str,
    checkpoint_path: str,
    max_files: int = 1000,
) -> StreamingQuery:
    """Running (tag, n) over all ingested lines; the result table is replaced per batch."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(source_dir)
    tags = parse_track_lines(lines).filter(F.col("parse_ok")).select(F.explode("tags").alias("tag"))
    counts = tags.filter(F.col("tag").isNotNull()).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))

    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    return (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint_path)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
