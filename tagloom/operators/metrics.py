"""Per-tag evaluation: confusion counts and areas under the ROC and PR curves.

Every metric is computed for all tags in one distributed pass, grouped by tag.

Curve areas (``curve_areas``) follow the library definitions: points are the
distinct scores in descending order (ties share one point); the ROC curve
starts at (0, 0); the PR curve starts at recall 0 with the precision of the
first point; areas are trapezoid sums.

Plan, built to survive one tag holding a third of all rows: a prefix sum over
ranges.

1. rows are combined to one row per (tag, score) with map-side partial counts;
2. the points are dealt to ranges by (tag, score descending) and stored with the
   number of their range, so a big tag spreads over many ranges and a range
   holds many small tags;
3. sums for each tag and range (a small table) give what lies above a range;
4. running sums inside (tag, range) plus that carry give the cumulative counts
   at every point; the area terms are summed by tag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.config import materialize


def confusion_report(
    pred: DataFrame, group_col: str = "tag", label: str = "y", prediction: str = "prediction"
) -> DataFrame:
    """Per tag: class sizes, recall and precision for both classes, accuracy,
    test error, positive rate, mean label and mean prediction."""
    y = F.col(label)
    p = F.col(prediction)

    def cnt(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    agg = pred.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("n"),
        cnt(y == 1.0).alias("n1"),
        cnt(y != 1.0).alias("n0"),
        cnt((y == 1.0) & (p == 1.0)).alias("tp"),
        cnt((y != 1.0) & (p != 1.0)).alias("tn"),
        cnt(p == 1.0).alias("pred1"),
        cnt(p != 1.0).alias("pred0"),
        cnt(y == p).alias("right"),
    )

    def ratio(a, b):
        return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))

    return agg.select(
        group_col,
        "n",
        "n0",
        "n1",
        ratio("tn", "n0").alias("recall0"),
        ratio("tn", "pred0").alias("precision0"),
        ratio("tp", "n1").alias("recall1"),
        ratio("tp", "pred1").alias("precision1"),
        ratio("right", "n").alias("accuracy"),
        F.try_divide((F.col("n") - F.col("right")).cast("double"), F.col("n").cast("double")).alias("test_error"),
        ratio("n1", "n").alias("positive_rate"),
        ratio("n1", "n").alias("mean_label"),
        ratio("pred1", "n").alias("mean_prediction"),
    )


def confusion_report_lines(report: DataFrame, group_col: str = "tag") -> DataFrame:
    """(tag, line_no, line): the confusion report as readable text lines."""
    lines = F.array(
        F.struct(F.lit(0).alias("line_no"), F.format_string(
            "label 0: %d rows, recall %s, precision %s", "n0", "recall0", "precision0").alias("line")),
        F.struct(F.lit(1).alias("line_no"), F.format_string(
            "label 1: %d rows, recall %s, precision %s", "n1", "recall1", "precision1").alias("line")),
        F.struct(F.lit(2).alias("line_no"), F.format_string("test error %s", "test_error").alias("line")),
        F.struct(F.lit(3).alias("line_no"), F.format_string("share of label 1 %s", "positive_rate").alias("line")),
        F.struct(F.lit(4).alias("line_no"), F.format_string("mean label %s", "mean_label").alias("line")),
        F.struct(F.lit(5).alias("line_no"), F.format_string("mean prediction %s", "mean_prediction").alias("line")),
    )
    return report.select(group_col, F.inline(lines))


def curve_areas(
    scored: DataFrame, group_col: str = "tag", score: str = "score", label: str = "y",
    points_per_bucket: int | None = None,
) -> DataFrame:
    """(tag, n_pos, n_neg, auroc, auprc) for every tag at once."""
    pts = scored.groupBy(group_col, F.col(score).alias("s")).agg(
        F.sum(F.when(F.col(label) == 1.0, 1).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when(F.col(label) == 1.0, 0).otherwise(1)).cast("bigint").alias("fp"),
    )
    return areas_of_points(pts, group_col, points_per_bucket)


def areas_of_points(pts: DataFrame, group_col: str = "tag", points_per_bucket: int | None = None) -> DataFrame:
    """The areas from counted points (tag, s, tp, fp), one per tag and score.

    The points are dealt to as many ranges as the session has shuffle partitions,
    or to ranges of about ``points_per_bucket``, for which they are counted
    first. The ranges are stored before they are read twice: their ends come
    from a sample, and must not be drawn anew.
    """
    n = int(pts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if points_per_bucket is not None:
        n = max(1, -(-pts.count() // points_per_bucket))
    dealt = pts.repartitionByRange(n, F.col(group_col), F.desc("s")).withColumn("_bucket", F.spark_partition_id())
    pts = materialize(dealt, "points")
    per_range = pts.groupBy(group_col, "_bucket").agg(F.sum("tp").alias("_btp"), F.sum("fp").alias("_bfp"))
    w_b = Window.partitionBy(group_col).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(group_col)
    offsets = per_range.select(
        group_col,
        "_bucket",
        F.coalesce(F.sum("_btp").over(w_b), F.lit(0)).alias("_otp"),
        F.coalesce(F.sum("_bfp").over(w_b), F.lit(0)).alias("_ofp"),
        F.sum("_btp").over(w_all).alias("P"),
        F.sum("_bfp").over(w_all).alias("N"),
    )

    w_in = Window.partitionBy(group_col, "_bucket").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    cum = pts.select(
        group_col, "_bucket", "tp", "fp",
        F.sum("tp").over(w_in).alias("_ctp"),
        F.sum("fp").over(w_in).alias("_cfp"),
    ).join(offsets, [group_col, "_bucket"])
    # Products of counts leave the range of BIGINT: they are taken as DOUBLE.
    TP = (F.col("_ctp") + F.col("_otp")).cast("double")
    FP = (F.col("_cfp") + F.col("_ofp")).cast("double")
    TP0 = TP - F.col("tp")
    FP0 = FP - F.col("fp")
    prec = TP / (TP + FP)
    prec0 = F.when(TP0 + FP0 == 0, prec).otherwise(TP0 / (TP0 + FP0))
    terms = cum.select(
        group_col, "P", "N",
        (F.col("fp").cast("double") * (TP + TP0)).alias("_roc2"),
        (F.col("tp").cast("double") * (prec + prec0)).alias("_pr2"),
    )
    return terms.groupBy(group_col).agg(
        F.max("P").alias("n_pos"),
        F.max("N").alias("n_neg"),
        F.try_divide(F.sum("_roc2"), F.max("P").cast("double") * F.max("N").cast("double") * 2.0).alias("auroc"),
        F.try_divide(F.sum("_pr2"), F.max("P").cast("double") * 2.0).alias("auprc"),
    )


CURVE_AREAS_SQL = """
pts AS (
  SELECT tag, score AS s,
         sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS fp
  FROM scored GROUP BY tag, score),
cum AS (
  SELECT tag, tp, fp,
         sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp,
         sum(tp) OVER (PARTITION BY tag) AS P, sum(fp) OVER (PARTITION BY tag) AS N
  FROM pts WINDOW w AS (PARTITION BY tag ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
terms AS (
  SELECT tag, P, N, fp * (2 * ctp - tp) AS roc2,
         tp * (ctp / (ctp + cfp) + CASE WHEN ctp - tp + cfp - fp = 0 THEN ctp / (ctp + cfp)
                                       ELSE (ctp - tp) / (ctp - tp + cfp - fp) END) AS pr2
  FROM cum),
areas AS (
  SELECT tag, CAST(max(P) AS BIGINT) AS n_pos, CAST(max(N) AS BIGINT) AS n_neg,
         CAST(sum(roc2) AS DOUBLE) / NULLIF(CAST(max(P) * max(N) * 2 AS DOUBLE), 0) AS auroc,
         sum(pr2) / NULLIF(CAST(max(P) * 2 AS DOUBLE), 0) AS auprc
  FROM terms GROUP BY tag)"""
