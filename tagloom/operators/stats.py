"""Column statistics and per-class feature means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, n, mean, variance, stddev, min, max): one global pass, then stacked.

    Variance and standard deviation are the sample (n - 1) forms.
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"{c}__n"),
            F.avg(x).alias(f"{c}__mean"),
            F.var_samp(x).alias(f"{c}__var"),
            F.stddev_samp(x).alias(f"{c}__sd"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    wide = df.agg(*aggs)
    parts = ", ".join(
        f"'{c}', `{c}__n`, `{c}__mean`, `{c}__var`, `{c}__sd`, `{c}__min`, `{c}__max`" for c in cols
    )
    return wide.selectExpr(f"stack({len(cols)}, {parts}) AS (feature, n, mean, variance, stddev, min, max)")


def class_feature_means(examples: DataFrame, cols: Sequence[str], group_col: str = "tag") -> DataFrame:
    """(tag, y, n, mean_<feature>...) -- feature means by tag and class."""
    return examples.groupBy(group_col, "y").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in cols]
    )
