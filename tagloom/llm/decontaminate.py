"""Benchmark decontamination: a prefix-filtered join of document windows with
the windows of benchmark items.

A window can only occur where all its two-word shingles occur, so one of them,
its prefix token, is enough to find candidates. Shingles are ordered by rarity
over the whole corpus and the rarest one is taken; a window with a shingle that
the corpus lacks is dropped. A candidate must fit into its document (length and
position), and then its words are compared one by one.

All steps are built-in functions. The words of a document are exploded beside
their array inside one generated stage, so the array is not copied per word,
and only matches leave the stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.store import fresh, removed, stored, text_or_empty

WINDOW_WORDS = 10
#: Windows that are broadcast at most (about 0.2 KB each); more are joined by shuffle.
BROADCAST_WINDOWS = 250_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    lowered = F.translate(text, _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def item_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(win, n, items): the distinct windows, their lengths and the ids, as
    strings, of the items that have them."""
    rows = benchmark.select(
        F.col(id_col).cast("string").alias("item"), words(text_or_empty(text_col)).alias("words")
    ).filter(F.size("words") > 0)
    n = F.least(F.size("words"), F.lit(WINDOW_WORDS))
    starts = F.sequence(F.lit(1), F.size("words") - n + 1)
    each = rows.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, n))).alias("win"))
    # A null item id makes windows that mark words but belong to no listed item.
    return each.groupBy("win").agg(F.collect_set("item").alias("items")).withColumn("n", F.size("win"))


def _token(a, b) -> Column:
    return F.xxhash64(a, b)


def _document_tokens(docs: DataFrame) -> DataFrame:
    """Each word's place with the token of the shingle that starts there; the last
    word's token stands for the word alone."""
    exploded = docs.select("*", F.posexplode("words").alias("pos", "word"))
    return exploded.withColumn("token", _token(F.col("word"), F.get("words", F.col("pos") + 1)))


def _broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_WINDOWS else df


def prefixed(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """``windows`` with the token and offset of their rarest shingle."""
    shingles = windows.filter("n > 1").select(
        "win", F.posexplode(F.slice("win", F.lit(1), F.col("n") - 1)).alias("offset", "a")
    )
    shingles = shingles.withColumn("token", _token(F.col("a"), F.get("win", F.col("offset") + 1)))
    tokens = stored(shingles.select("token").distinct(), "tokens")
    n = tokens.count()
    counts = (
        _document_tokens(docs)
        .join(_broadcast_if_small(tokens, n), "token")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("seen"))
    )
    rarest = F.min(F.struct("seen", "offset", "token")).alias("rarest")
    # Windows that lack the count of a shingle can't occur.
    whole = F.count(F.lit(1)) == F.count("seen")
    chosen = (
        shingles.join(counts, "token", "left").groupBy("win").agg(rarest, whole.alias("whole")).filter("whole")
    )
    kept = windows.join(chosen, "win").select("win", "n", "items", "rarest.offset", "rarest.token")
    out = stored(kept, "windows")
    removed(tokens)
    return out


def find_windows(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Occurrences (key, doc_id, start, end, items) of benchmark windows in ``docs``
    (key, doc_id, words)."""
    windows = stored(item_windows(benchmark, item_col, text_col), "items")
    chosen = prefixed(windows, docs)
    found = _document_tokens(docs).join(_broadcast_if_small(chosen, chosen.count()), "token")
    start = F.col("pos") - F.col("offset")
    fits = (start >= 0) & (start + F.col("n") <= F.size("words"))
    same = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("n")) == F.col("win")
    hits = found.filter(fits & same).select(
        "key", "doc_id", start.alias("start"), (start + F.col("n")).alias("end"), "items"
    )
    single = windows.filter("n = 1").select(F.col("win")[0].alias("word"), "items")
    if not single.isEmpty():
        alone = docs.select("key", "doc_id", F.posexplode("words").alias("start", "word"))
        more = alone.join(_broadcast_if_small(single, single.count()), "word")
        hits = hits.unionByName(more.select("key", "doc_id", "start", (F.col("start") + 1).alias("end"), "items"))
    return hits


def _key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), text_or_empty(text_col))


def _worded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, doc_id, words). Rows are told apart by their id and text, so a
    repeated or null id is safe."""
    return docs.select(
        _key(id_col, text_col).alias("key"), F.col(id_col).alias("doc_id"), words(text_or_empty(text_col)).alias("words")
    )


def without_benchmark(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark window occurs."""
    hits = find_windows(_worded(docs, id_col, text_col), benchmark)
    hit = stored(hits.select(F.col("key").alias("_hit"), F.col("doc_id").alias("_id")).distinct(), "hits")
    key = fresh(docs, "_key")
    rows = docs.withColumn(key, _key(id_col, text_col))
    return rows.join(hit, (rows[key] == hit["_hit"]) & rows[id_col].eqNullSafe(hit["_id"]), "left_anti").drop(key)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit`` (words inside
    an occurrence of a benchmark window), ``n_items`` (items with occurring
    windows), ``items_sha256``, ``contaminated``.

    Null texts have no words; an empty benchmark hits nothing; an item shorter
    than a window is one window. Rows that repeat an id and a text get the same
    row each; other columns are not read.
    """
    rows = _worded(docs, id_col, text_col)
    hits = find_windows(rows, benchmark, item_col, item_text_col)
    mine = Window.partitionBy("key", "doc_id").orderBy("start", "end")
    reached = F.max("end").over(mine.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.coalesce(reached, F.lit(0))))
    marks = (
        hits.withColumn("fresh", fresh)
        .groupBy("key", "doc_id")
        .agg(F.sum("fresh").alias("n_hit"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
        .withColumnRenamed("doc_id", "_id")
    )
    counted = rows.select("key", "doc_id", F.size("words").cast("long").alias("n_words"))
    out = counted.join(marks, (counted["key"] == marks["key"]) & counted["doc_id"].eqNullSafe(marks["_id"]), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return out.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
