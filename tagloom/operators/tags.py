"""Tag histogram, popularity cut and bookkeeping of trained tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import clean_tag_name


def tags_frame(spark, tags: list[str]) -> DataFrame:
    """A fixed tag list (e.g. ["rock", "hip hop", "country"]) as a tag table."""
    return spark.createDataFrame([(t,) for t in tags], "tag string")


def preview(df: DataFrame, n: int = 4, enabled: bool = False, label: str = "") -> list:
    """Log and return the first ``n`` rows when ``enabled`` (verbose runs); otherwise
    nothing is read."""
    if not enabled:
        return []
    import logging

    rows = df.take(n)
    logging.getLogger("tagloom").info("%s%s", f"{label}: " if label else "", rows)
    return rows


def explode_tags(tracks: DataFrame, id_col: str = "track_id", tags_col: str = "tags") -> DataFrame:
    """(track_id, tag), one row per distinct tag of a track. Empty lists give no rows."""
    return tracks.select(id_col, F.explode(F.array_distinct(F.col(tags_col))).alias("tag")).filter(
        F.col("tag").isNotNull()
    )


def tag_counts(tracks: DataFrame, tags_col: str = "tags") -> DataFrame:
    """(tag, n): occurrences of each tag over all tracks.

    explode + groupBy: the count is combined map-side, so a tag carried by a
    third of all tracks still ships one partial row per task.
    """
    tags = tracks.select(F.explode(F.col(tags_col)).alias("tag")).filter(F.col("tag").isNotNull())
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def sorted_tag_counts(counts: DataFrame) -> DataFrame:
    """Tag counts by count descending, ties by tag (range-partitioned sort)."""
    return counts.orderBy(F.desc("n"), F.asc("tag"))


def popular_tags(counts: DataFrame, min_count: int) -> DataFrame:
    """Tags seen at least ``min_count`` times."""
    return counts.filter(F.col("n") >= F.lit(min_count))


def popular_tags_by_share(counts: DataFrame, n_tracks: int, share_denominator: int) -> DataFrame:
    """Tags carried by at least 1/``share_denominator`` of ``n_tracks`` tracks.

    Integer arithmetic (n * d >= tracks), so the cut is exact on any engine.
    """
    return counts.filter(F.col("n") * F.lit(share_denominator) >= F.lit(n_tracks))


def with_clean_names(tags: DataFrame, tag_col: str = "tag") -> DataFrame:
    """Adds ``clean_tag``, the file-safe name used for per-tag outputs."""
    return tags.withColumn("clean_tag", clean_tag_name(F.col(tag_col)))


def untrained_tags(tags: DataFrame, trained: DataFrame) -> DataFrame:
    """Tags without a stored model (anti join on ``tag``)."""
    return tags.join(trained.select("tag").distinct(), "tag", "left_anti")
