"""Linear algebra on columns: dot products without leaving the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot_columns(weights: Sequence[Column | str], features: Sequence[Column | str]) -> Column:
    """Sum of products of two equally long lists of scalar columns.

    Compiles to plain arithmetic inside whole-stage codegen.
    """
    if len(weights) != len(features):
        raise ValueError("weights and features differ in length")
    terms = [
        (F.col(w) if isinstance(w, str) else w) * (F.col(x) if isinstance(x, str) else x)
        for w, x in zip(weights, features)
    ]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def array_dot(a: Column | str, b: Column | str) -> Column:
    """Dot product of two ARRAY<DOUBLE> columns via ``zip_with`` + ``aggregate``."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def features_array(cols: Sequence[str]) -> Column:
    """ARRAY<DOUBLE> of named scalar feature columns (the SQL-side vector)."""
    return F.array(*[F.col(c).cast("double") for c in cols])


def round_sig(c: Column | str, digits: int = 8) -> Column:
    """Round to ``digits`` significant digits (NULL, NaN and 0 pass through).

    Float sums differ in their last bits with the order of addition, which is
    partition-dependent; results compared across engines are rounded with
    this first.
    """
    c = F.col(c) if isinstance(c, str) else c
    k = F.lit(digits - 1) - F.floor(F.log10(F.abs(c)))
    up = F.pow(F.lit(10.0), k)
    down = F.pow(F.lit(10.0), -k)
    rounded = F.when(k >= 0, F.round(c * up) / up).otherwise(F.round(c / down) * down)
    return F.when(c.isNull() | F.isnan(c) | (c == 0), c).otherwise(rounded)


def round_sig_sql(expr: str, digits: int = 8) -> str:
    """DuckDB twin of :func:`round_sig`."""
    k = f"({digits - 1} - floor(log10(abs({expr}))))"
    return (
        f"(CASE WHEN ({expr}) IS NULL OR isnan({expr}) OR ({expr}) = 0 THEN ({expr}) "
        f"WHEN {k} >= 0 THEN round(({expr}) * pow(10.0, {k})) / pow(10.0, {k}) "
        f"ELSE round(({expr}) / pow(10.0, -{k})) * pow(10.0, -{k}) END)"
    )
