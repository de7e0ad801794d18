"""Standard scaling (zero mean, unit sample standard deviation)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.vectors import array_dot


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """{feature: (mean, sample std)} from one aggregate; only 2 x d numbers reach the driver."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__m"), F.stddev_samp(c).alias(f"{c}__s")]
    row = df.agg(*aggs).first()
    return {c: (row[f"{c}__m"] or 0.0, row[f"{c}__s"] or 0.0) for c in cols}


def apply_scaler(df: DataFrame, stats: dict[str, tuple[float, float]], cols: Sequence[str] | None = None) -> DataFrame:
    """Replace each feature by (x - mean) / std; a zero-variance feature becomes 0.0."""
    cols = list(cols or stats)
    out = {}
    for c in cols:
        m, s = stats[c]
        out[c] = (F.col(c) - F.lit(m)) / F.lit(s) if s else F.lit(0.0)
    return df.withColumns(out)


def standard_scale(df: DataFrame, cols: Sequence[str], fit_on: str = "all", split: str = "split") -> DataFrame:
    """Fit and apply. ``fit_on="all"`` fits on all rows of ``df`` (the scaler sees
    every row, as before); ``"train"`` on the rows whose ``split`` is 'train' only,
    so nothing of the hold-out reaches the features."""
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    seen = df.filter(F.col(split) == "train") if fit_on == "train" else df
    return apply_scaler(df, fit_scaler(seen, cols), cols)


def with_scaler(model: DataFrame, stats: dict[str, tuple[float, float]], cols: Sequence[str]) -> DataFrame:
    """``model`` with the scaler it was trained behind: ``features``, ``mean``, ``std``."""
    means, stds = [float(stats[c][0]) for c in cols], [float(stats[c][1]) for c in cols]
    return model.withColumns(
        {
            "features": F.array(*[F.lit(c) for c in cols]),
            "mean": F.array(*[F.lit(v) for v in means]),
            "std": F.array(*[F.lit(v) for v in stds]),
        }
    )


def raw_weights(model: DataFrame, cols: Sequence[str], group_col: str = "tag") -> DataFrame:
    """(tag, w_<feature>..., bias) that score unscaled features as ``model`` (with
    its scaler) scores scaled ones; a feature without variance has weight 0."""
    scaled = F.transform(
        F.arrays_zip("weights", "std"), lambda z: F.when(z["std"] == 0, 0.0).otherwise(z["weights"] / z["std"])
    )
    shift = array_dot("_raw", "mean")
    out = model.withColumn("_raw", scaled)
    return out.select(
        group_col,
        *[F.col("_raw")[i].alias(f"w_{c}") for i, c in enumerate(cols)],
        (F.col("intercept") - shift).alias("bias"),
    )
