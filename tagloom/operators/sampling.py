"""Seeded, partition-independent rebalancing and splitting.

A row's fate is a function of its key and the seed (``unit_hash``), so a
recomputed partition after an executor loss keeps exactly the same rows, and
DuckDB can select the same rows for the oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.config import DEFAULT_SEED, DEFAULT_TRAIN_FRACTION
from tagloom.functions.hashing import unit_hash

SAMPLE_SALT = "sample"
SPLIT_SALT = "split"
PICK_SALT = "pick"


def negative_fraction(n_positive: Column, n_total: Column, ratio: str = "balanced") -> Column:
    """Share of negatives to keep.

    ``balanced``: P / (N - P), clamped to 1 (as many negatives as positives).
    ``prior``: P / N_total, the older rule that keeps fewer negatives.
    """
    if ratio == "balanced":
        neg = n_total - n_positive
        frac = F.when(neg <= 0, F.lit(1.0)).otherwise(n_positive.cast("double") / neg)
    elif ratio == "prior":
        frac = F.when(n_total <= 0, F.lit(1.0)).otherwise(n_positive.cast("double") / n_total)
    else:
        raise ValueError(f"unknown ratio {ratio!r}")
    return F.least(frac, F.lit(1.0))


def with_sample_draws(df: DataFrame, key: str = "track_id", seed: int = DEFAULT_SEED) -> DataFrame:
    """Adds ``u`` (sampling draw) and ``v`` (split draw), both in [0, 1)."""
    return df.withColumn("u", unit_hash(key, salt=SAMPLE_SALT, seed=seed)).withColumn(
        "v", unit_hash(key, salt=SPLIT_SALT, seed=seed)
    )


def rebalance(
    labelled: DataFrame,
    fractions: DataFrame,
    key: str = "track_id",
    seed: int = DEFAULT_SEED,
    group_col: str = "tag",
) -> DataFrame:
    """Keep every positive and each negative with probability ``fraction``.

    ``labelled`` has (group_col, key, y); ``fractions`` has (group_col, fraction)
    with one row per group; the planner broadcasts it where it is small.
    """
    drawn = labelled.withColumn("u", unit_hash(key, salt=SAMPLE_SALT, seed=seed))
    joined = drawn.join(fractions.select(group_col, "fraction"), group_col)
    return joined.filter((F.col("y") == 1.0) | (F.col("u") < F.col("fraction"))).drop("u", "fraction")


def split_index(key: Column | str, weights: Sequence[float], seed: int = DEFAULT_SEED) -> Column:
    """0-based part index for an n-way split by cumulative normalised weights."""
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative with a positive sum")
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(acc)
    v = unit_hash(key, salt=SPLIT_SALT, seed=seed)
    idx = F.lit(0)
    for b in bounds:
        idx = idx + F.when(v >= F.lit(b), 1).otherwise(0)
    return idx


def split_train_test(
    df: DataFrame, key: str = "track_id", train_fraction: float = DEFAULT_TRAIN_FRACTION, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Adds ``split`` = 'train' / 'test' by the split draw of the key."""
    v = unit_hash(key, salt=SPLIT_SALT, seed=seed)
    return df.withColumn("split", F.when(v < F.lit(train_fraction), "train").otherwise("test"))


def sample_one(df: DataFrame, key: str = "track_id", seed: int = DEFAULT_SEED) -> DataFrame:
    """One row chosen by seed: the smallest draw wins (top-1, no full sort)."""
    return df.withColumn("_pick", unit_hash(key, salt=PICK_SALT, seed=seed)).orderBy("_pick", key).limit(1).drop("_pick")
