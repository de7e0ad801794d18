"""Exact deduplication over an extendible-hash index on shared files.

Keys are 64-bit hashes of the normalised text. A directory over the leading
bits of the key doubles until no bucket holds more than ``capacity`` distinct
entries; buckets that were not overfull keep a shorter prefix (local depth).
The index is written to the shared folder, ranged by bucket and key, so that
each owner task holds a range of keys. Equal keys form a chain whose entries
are told apart by their bytes.

Everything is DataFrame code. Copies are combined before each shuffle, so a
text that makes up a third of all rows reaches its owner as one row per task.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.store import fresh, partitions, removed, stored, text_or_empty

#: Distinct texts that a bucket holds before it splits.
CAPACITY = 50_000
MAX_DEPTH = 62


def normalised(text_col: str):
    """Each run of ``[\\x20\\x09-\\x0D]`` becomes one space. The pattern skips
    single spaces, which stay as they are; null counts as empty."""
    return F.regexp_replace(text_or_empty(text_col), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def directory(entries: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(cell, local_depth, bucket) for ``entries`` with a long ``h``, and the depth.

    The directory starts at the depth that the number of entries asks for and
    doubles while a cell is overfull and its keys can still be told apart. The
    table has about four cells per bucket and stays a DataFrame."""
    n = entries.count()
    depth = min(MAX_DEPTH, max(1, ceil(log2(max(1, n / capacity))) + 2))
    while True:
        cells = entries.groupBy(F.shiftrightunsigned("h", 64 - depth).alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")
        )
        overfull = cells.filter((F.col("n") > capacity) & (F.col("lo") < F.col("hi")))
        if depth >= MAX_DEPTH or overfull.isEmpty():
            break
        depth += 1
    local = F.lit(depth)
    for d in range(depth - 1, -1, -1):
        prefix = F.shiftright("cell", depth - d) if d else F.lit(0)
        cells = cells.withColumn(f"n{d}", F.sum("n").over(Window.partitionBy(prefix)))
        local = F.when(F.col(f"n{d}") <= capacity, F.lit(d)).otherwise(local)
    # The shallowest prefix that fits wins: a later test overrides a deeper one.
    cells = cells.withColumn("local_depth", local)
    first = F.expr(f"cell - cell % shiftleft(1L, {depth} - local_depth)")
    return cells.select("cell", "local_depth", first.alias("bucket")), depth


def build_index(docs: DataFrame, id_col: str, text_col: str, capacity: int = CAPACITY) -> DataFrame:
    """The index of ``docs``: (bucket, h, chain, sha, keep_id, group_size), one row
    per distinct normalised text, on shared files ranged by bucket and key."""
    text = normalised(text_col)
    # Grouping by the text itself compares bytes; partial aggregation collapses
    # copies before the shuffle.
    entries = stored(
        docs.select(F.col(id_col).alias("id"), text.alias("t"))
        .withColumn("h", F.xxhash64("t"))
        .groupBy("h", "t")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("h", F.sha2("t", 256).alias("sha"), "keep_id", "group_size"),
        "entries",
    )
    cells, depth = directory(entries.select("h"), capacity)
    dealt = entries.withColumn("cell", F.shiftrightunsigned("h", 64 - depth)).join(cells, "cell")
    ranged = dealt.repartitionByRange(partitions(docs), "bucket", "h").sortWithinPartitions("bucket", "h", "sha")
    index = stored(ranged.select("bucket", "local_depth", "h", "sha", "keep_id", "group_size"), "index")
    removed(entries)
    chain = F.row_number().over(Window.partitionBy("h").orderBy("sha")) - 1
    return index.withColumn("chain", chain)


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``, ``bucket``, ``chain``.

    Of equal normalised texts the smallest id stays. A null text is an empty
    one. Of rows repeated with the same id one stays. A null id never stays
    before a non-null one; where a group has null ids only, one of them stays.
    An empty table gives an empty result; other columns are not read.
    """
    index = build_index(docs, id_col, text_col, capacity)
    t = normalised(text_col)
    rows = (
        docs.select(F.col(id_col).alias("id"), F.xxhash64(t).alias("h"), F.sha2(t, 256).alias("sha"))
        .groupBy("id", "h", "sha")
        .agg(F.count(F.lit(1)).alias("m"))
    )
    out = rows.join(index, ["h", "sha"]).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    return out.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "bucket",
        F.col("chain").cast("long").alias("chain"),
    )


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns."""
    sha = fresh(docs, "_sha")
    kept = exact_dedup(docs, id_col, text_col).filter("kept")
    kept = kept.select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"))
    rows = docs.withColumn(sha, F.sha2(normalised(text_col), 256))
    same = (rows[sha] == kept["_kept_sha"]) & rows[id_col].eqNullSafe(kept["_kept_id"])
    # Rows that repeat an id and a text all match; one of them stays.
    return rows.join(kept, same, "left_semi").dropDuplicates([id_col, sha]).drop(sha)
