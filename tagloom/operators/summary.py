"""Model summary: per-tag results table, means, quartiles, rounding, reports.

All inputs here are per-tag tables (one row per trained tag), so their size
is bounded by the number of popular tags.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.config import (
    REPORT_ARTIST,
    REPORT_MARGIN_HEADING,
    REPORT_TAG_HEADING,
    REPORT_TITLE,
    REPORT_TRACK,
    materialize,
)


def summarize_models(tag_counts: DataFrame, metrics: DataFrame, min_count: int = 0) -> DataFrame:
    """(tag, song_count, auroc, auprc, ...): popular tags that have results.

    Inner join on ``tag``: a tag without a metrics row is left out. Further
    columns are taken where ``metrics`` has them: ``n_positive`` (tracks that the
    label mode marks, which for substrings is more than the exact
    ``song_count``) and ``train_seconds``.
    """
    popular = tag_counts.filter(F.col("n") >= F.lit(min_count)).select("tag", F.col("n").alias("song_count"))
    cols = ["tag", "auroc", "auprc"] + [c for c in ("n_positive", "train_seconds") if c in metrics.columns]
    return popular.join(metrics.select(*cols), "tag", "inner")


def metric_means(summary: DataFrame, cols: Sequence[str] = ("auroc", "auprc")) -> DataFrame:
    """One row: n_tags and the mean of each metric (NULL when there are no rows)."""
    return summary.agg(F.count(F.lit(1)).alias("n_tags"), *[F.avg(c).alias(f"mean_{c}") for c in cols])


def exact_quantiles(values: DataFrame, probs: Sequence[float], group_col: str = "metric", col: str = "v") -> DataFrame:
    """(group, q0, q1, ..): exact, linearly interpolated quantiles of each group.

    Selection by counting: equal values are counted, the counts dealt to ranges of
    values and stored, and sums of the ranges tell which values have the ranks
    in question. No task holds more than a range, whatever the size of a group.
    """
    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = values.filter(F.col(col).isNotNull()).groupBy(group_col, col).agg(F.count(F.lit(1)).alias("_n"))
    dealt = counted.repartitionByRange(n, group_col, col).withColumn("_range", F.spark_partition_id())
    ranged = materialize(dealt, "values")
    before = Window.partitionBy(group_col).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = ranged.groupBy(group_col, "_range").agg(F.sum("_n").alias("_m")).select(
        group_col, "_range",
        F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_before"),
        F.sum("_m").over(Window.partitionBy(group_col)).alias("_all"),
    )
    inside = Window.partitionBy(group_col, "_range").orderBy(col).rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranged.withColumn("_upto", F.sum("_n").over(inside)).join(per_range, [group_col, "_range"])
    end = F.col("_before") + F.col("_upto")
    aggs = []
    for k, q in enumerate(probs):
        place = (F.col("_all") - 1).cast("double") * float(q)
        for name, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            aggs.append(F.max(F.when((rank < end) & (rank >= end - F.col("_n")), F.col(col))).alias(f"_{name}{k}"))
        aggs.append(F.max(place - F.floor(place)).alias(f"_part{k}"))
    picked = ranked.groupBy(group_col).agg(*aggs)
    between = [
        (F.col(f"_lo{k}") * (1.0 - F.col(f"_part{k}")) + F.col(f"_hi{k}") * F.col(f"_part{k}")).alias(f"q{k}")
        for k in range(len(probs))
    ]
    return picked.select(group_col, *between)


def summary_quartiles(summary: DataFrame, cols: Sequence[str] = ("auroc", "auprc")) -> DataFrame:
    """(metric, min, q1, median, mean, q3, max): exact, linearly interpolated quartiles."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__min"), F.avg(c).alias(f"{c}__mean"), F.max(c).alias(f"{c}__max")]
    parts = ", ".join(f"'{c}', `{c}__min`, `{c}__mean`, `{c}__max`" for c in cols)
    told = summary.agg(*aggs).selectExpr(f"stack({len(cols)}, {parts}) AS (metric, min, mean, max)")
    values = summary.select(*[F.col(c).cast("double").alias(c) for c in cols]).selectExpr(
        f"stack({len(cols)}, " + ", ".join(f"'{c}', `{c}`" for c in cols) + ") AS (metric, v)"
    )
    out = told.join(exact_quantiles(values, (0.25, 0.5, 0.75)), "metric", "left")
    return out.select("metric", "min", F.col("q0").alias("q1"), F.col("q1").alias("median"), "mean", F.col("q2").alias("q3"), "max")


def summary_rounded(summary: DataFrame, cols: Sequence[str] = ("auroc", "auprc"), digits: int = 2) -> DataFrame:
    """The summary with the metric columns rounded half-up to ``digits`` places."""
    return summary.withColumns({c: F.round(F.col(c), digits) for c in cols})


def prediction_report_lines(ranked: DataFrame, name_width: int = 28) -> DataFrame:
    """(track_id, rank, line): ``tag padded to width | margin`` per ranked tag; the
    margin is printed in full."""
    line = F.format_string(f"%-{name_width}s | %s", F.col("tag"), F.col("margin").cast("string"))
    return ranked.select("track_id", "rank", line.alias("line"))


def prediction_report(ranked: DataFrame, info: DataFrame, name_width: int = 28) -> DataFrame:
    """(track_id, line_no, line): header from the track info, then ranked tags.

    ``ranked`` holds (track_id, tag, margin, rank) and ``info`` (track_id,
    artist, title); the info is joined on the key, once per track.
    """
    header = info.select(
        "track_id",
        F.inline(F.array(
            F.struct(F.lit(-5).alias("line_no"), F.concat(F.lit(REPORT_TRACK), F.col("track_id")).alias("line")),
            F.struct(F.lit(-4).alias("line_no"), F.concat(F.lit(REPORT_ARTIST), F.col("artist")).alias("line")),
            F.struct(F.lit(-3).alias("line_no"), F.concat(F.lit(REPORT_TITLE), F.col("title")).alias("line")),
            F.struct(F.lit(-2).alias("line_no"), F.lit(REPORT_TAG_HEADING.ljust(name_width) + REPORT_MARGIN_HEADING).alias("line")),
            F.struct(F.lit(-1).alias("line_no"), F.lit("-" * (name_width + 1) + "+" + "-" * 29).alias("line")),
        )),
    )
    tracks = ranked.select("track_id").distinct()
    body = prediction_report_lines(ranked, name_width).select("track_id", F.col("rank").alias("line_no"), "line")
    return header.join(tracks, "track_id", "left_semi").unionByName(body)
