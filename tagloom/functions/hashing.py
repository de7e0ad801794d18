"""Deterministic, engine-independent pseudo-random numbers from md5.

``rand(seed)`` depends on how rows are partitioned, so a recomputed task (after
an executor loss) or another engine gives other numbers. A hash of the row's
key does not: every sample and split in this package is a pure function of
(salt, seed, key), and the same expression runs in DuckDB for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def unit_hash(*keys: Column | str, salt: str, seed: int) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of md5(salt|seed|keys)."""
    parts = [F.lit(salt), F.lit(str(seed))] + [F.col(k) if isinstance(k, str) else k for k in keys]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def unit_hash_sql(*key_exprs: str, salt: str, seed: int) -> str:
    """DuckDB twin of :func:`unit_hash` for oracle SQL."""
    inner = ", ".join([f"'{salt}'", f"'{seed}'", *key_exprs])
    return f"((('0x' || substr(md5(concat_ws('|', {inner})), 1, 8))::UBIGINT) / {TWO_POW_32})"
