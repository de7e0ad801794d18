"""N-gram Jaccard self-join by chosen paths.

Documents are sets of ``SHINGLE``-word shingles; equal sets are one class. A
path is a sequence of tokens that a set chose: at each level the token of the
set that is least under that level's hash, so two sets choose the same one with
a probability equal to their similarity. Sets with equal paths share a bucket; a
bucket with more than ``BUCKET`` classes is split by one more token (and, for a
quarter of the paths, by a second token as well, which keeps the expected number
of common paths of a similar pair level). Runs with fresh tokens repeat until
the target recall is reached, for a pair at the threshold all whose buckets are
crowded: it meets in a run with probability 0.514 (``meeting``), so 0.9999 takes 13
runs. Where buckets are small at once it meets with probability 0.8, and pairs
that all buckets miss are still compared if any other link connects them.

Buckets only nominate: their pairs are compared by sketch, and what is left
forms candidate groups. Inside a group all pairs are compared exactly, by counts
of common shingles. Large groups are cut into blocks, and each pair of blocks is
a task, so a group of any size spreads over the cluster; pairs are counted where
they are found and never become rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.components import components
from tagloom.llm.store import fresh, removed, stored, text_or_empty
from tagloom.llm.wordarrays import ALNUM, Words, joined_hashes, mixed, slices

SHINGLE = 5
#: Similarity as a ratio of whole numbers, so that the test has no rounding.
THRESHOLD = (4, 5)
#: Target recall of a pair at the threshold whose buckets are crowded at every level.
RECALL = 0.9999
LEVELS = 4
#: Classes in a bucket that are compared at once.
BUCKET = 32
#: Similarity of sketches from which a pair is a candidate: five standard
#: deviations of a sketch of 64 tokens (8 runs) below the threshold, more with more runs.
CANDIDATE = 0.55
#: Classes and shingles of a block of a large group.
BLOCK, BLOCK_SHINGLES = 256, 2_000_000
UNNAMED = 1 << 62


def meeting(similarity: float) -> float:
    """The probability that a pair meets in a run if all its buckets are crowded."""
    met = 1.0
    for _ in range(LEVELS - 1):
        one = similarity * met
        met = 0.75 * one + 0.25 * (1 - (1 - one) ** 2)
    return similarity * met


def runs_for(recall: float) -> int:
    """Runs that miss a pair at the threshold with a probability of 1 - ``recall`` at most.
    At least 8, which the sketch needs."""
    if not 0 < recall < 1:
        raise ValueError("recall must be between 0 and 1")
    top, of = THRESHOLD
    return max(8, math.ceil(math.log(1 - recall) / math.log(1 - meeting(top / of))))


def _shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each distinct shingle, by row; a row with fewer words than
    a shingle but at least one has one shingle, all its words."""
    words = Words(column, ALNUM, lower=True)
    hashes = words.hashes()
    at = words.runs(SHINGLE)
    row, key = words.row[at], joined_hashes(hashes, SHINGLE)[at]
    sizes = np.diff(words.first)
    for r in np.flatnonzero((sizes > 0) & (sizes < SHINGLE)).tolist():
        some = joined_hashes(hashes[words.first[r] : words.first[r + 1]], int(sizes[r]))
        row, key = np.append(row, r), np.append(key, some)
    by = np.lexsort((key, row))
    row, key = row[by], key[by]
    once = np.ones(len(row), bool)
    once[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return row[once], key[once]


def _sketches(docs: DataFrame, runs: int) -> DataFrame:
    """(doc_id, node, mark, k1, k2, n, mins, low) of ``docs`` (doc_id, node, mark, text): a key of
    the set of shingles, its size, its least tokens and their low bytes."""
    count = runs * LEVELS * 2
    seeds = mixed(np.arange(1, count + 1, dtype=np.uint64)) | np.uint64(1)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch, 3):
                m = part.num_rows
                row, key = _shingles(part.column(3))
                n = np.bincount(row, minlength=m)
                have = np.flatnonzero(n)
                at = np.cumsum(n)[have] - n[have]
                k1, k2 = np.zeros(m, np.uint64), np.zeros(m, np.uint64)
                mins = np.zeros((m, count), np.uint32)
                if len(have):
                    with np.errstate(over="ignore"):
                        k1[have] = np.add.reduceat(key, at)
                        k2[have] = np.add.reduceat(mixed(key + np.uint64(7)), at)
                        for k in range(count):
                            tokens = ((key * seeds[k]) >> np.uint64(32)).astype(np.uint32)
                            mins[have, k] = np.minimum.reduceat(tokens, at)
                low = (mins & 0xFF).astype(np.uint8)
                ints = pa.array(mins.reshape(-1).view(np.int32))
                lists = pa.ListArray.from_arrays(np.arange(0, m * count + 1, count, dtype=np.int32), ints)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:3],
                        pa.array(k1.view(np.int64)),
                        pa.array(k2.view(np.int64)),
                        pa.array(n, pa.int64()),
                        lists,
                        pa.array([x.tobytes() for x in low], pa.binary()),
                    ],
                    ["doc_id", "node", "mark", "k1", "k2", "n", "mins", "low"],
                )

    return docs.mapInArrow(batches, "doc_id long, node long, mark long, k1 long, k2 long, n long, mins array<int>, low binary")


def _leaves(sets: DataFrame, runs: int) -> list[DataFrame]:
    """The buckets of all runs as tables (path, id, n)."""
    state = sets.select(
        "id", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"), "mins"
    ).select(
        "id",
        F.slice("mins", F.col("run") * (2 * LEVELS) + 1, F.lit(2 * LEVELS)).alias("tokens"),
        F.xxhash64("run", F.get("mins", F.col("run") * (2 * LEVELS))).alias("path"),
    )
    out = []
    for level in range(LEVELS):
        sizes = state.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared = stored(state.join(sizes, "path"), f"level{level}")
        if level:
            removed(before)
        before = shared
        if level == LEVELS - 1:
            out.append(stored(shared.select("path", "id", "n"), "leaves"))
            removed(shared)
            break
        out.append(stored(shared.filter(F.col("n") <= BUCKET).select("path", "id", "n"), "leaves"))
        deep = shared.filter(F.col("n") > BUCKET)
        first = F.xxhash64("path", F.get("tokens", F.lit(2 * level + 2)))
        second = F.xxhash64("path", F.lit(1), F.get("tokens", F.lit(2 * level + 3)))
        state = deep.select("id", "tokens", first.alias("path")).unionByName(
            deep.filter(F.pmod("path", F.lit(4)) == 0).select("id", "tokens", second.alias("path"))
        )
    return out


def _groups(rows: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups: rows that agree in the first ``keys`` columns, which
    lie together."""
    held: list[pa.RecordBatch] = []
    for batch in rows:
        if not batch.num_rows:
            continue
        cut = batch.num_rows - 1
        last = [batch.column(k)[cut] for k in range(keys)]
        same = np.ones(batch.num_rows, bool)
        for k in range(keys):
            same &= batch.column(k).to_numpy(zero_copy_only=False) == last[k].as_py()
        begin = int(np.flatnonzero(same)[0])
        if begin:
            yield pa.Table.from_batches([*held, batch.slice(0, begin)])
            held = []
        elif held and any(held[-1].column(k)[held[-1].num_rows - 1] != last[k] for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def _bounds(table: pa.Table, keys: int) -> np.ndarray:
    """Where the groups of ``table`` begin, and its end."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in range(keys):
        x = table.column(k).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def _roots(ids: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The least id connected to each row by the symmetric matrix ``near``."""
    label = ids.copy()
    while True:
        after = np.minimum(label, np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max))
        if (after == label).all():
            return label
        label = after


def _nominated(buckets: DataFrame) -> DataFrame:
    """(a, b): edges that connect the candidates of each small bucket (path, id, low)."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(rows, 1):
            at = _bounds(table, 1)
            ids = table.column(1).to_numpy()
            low = np.frombuffer(b"".join(table.column(2).to_pylist()), np.uint8).reshape(len(ids), -1)
            a, b = [], []
            for begin, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                x = low[begin:end]
                alike = (x[:, None, :] == x[None, :, :]).mean(axis=2)
                near = (alike - 1 / 256) * 256 / 255 >= CANDIDATE
                root = _roots(ids[begin:end], near)
                other = root != ids[begin:end]
                a.append(ids[begin:end][other])
                b.append(root[other])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    dealt = buckets.select("path", "id", "low").repartition("path").sortWithinPartitions("path")
    return dealt.mapInArrow(batches, "a long, b long")


def _compared(blocks: DataFrame) -> DataFrame:
    """(id, links, root) for each class in each pair of blocks (group, low, high,
    block, id, shingles): its links there, and the least id they connect it to."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(rows, 3):
            at = _bounds(table, 3)
            low, high, block, ids = (table.column(k).to_numpy() for k in (1, 2, 3, 4))
            lists = table.column(5).combine_chunks()
            if isinstance(lists, pa.ChunkedArray):
                lists = pa.concat_arrays(lists.chunks)
            edge, key = lists.offsets.to_numpy(), lists.values.to_numpy()
            out: list[list[np.ndarray]] = [[], [], []]
            for begin, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = ids[begin:end]
                n = np.diff(edge[begin : end + 1])
                common = _common(key[edge[begin] : edge[end]], n)
                top, of = THRESHOLD
                near = (of + top) * common >= top * (n[:, None] + n[None, :])
                np.fill_diagonal(near, False)
                if low[begin] != high[begin]:
                    side = block[begin:end] == low[begin]
                    near &= side[:, None] != side[None, :]
                out[0].append(own)
                out[1].append(near.sum(axis=1))
                out[2].append(_roots(own, near))
            cols = [pa.array(np.concatenate(x), pa.int64()) for x in out]
            yield pa.RecordBatch.from_arrays(cols, ["id", "links", "root"])

    dealt = blocks.select("group", "low", "high", "block", "id", "shingles")
    dealt = dealt.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high")
    return dealt.mapInArrow(batches, "id long, links long, root long")


def _common(key: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Common shingles of each two of the sets that lie end to end in ``key``."""
    m = len(n)
    _, which, counts = np.unique(key, return_inverse=True, return_counts=True)
    several = counts > 1
    column = np.cumsum(several) - 1
    use = several[which]
    row, col = np.repeat(np.arange(m), n)[use], column[which[use]]
    out = np.zeros((m, m), np.int64)
    by = np.argsort(col, kind="stable")
    row, col = row[by], col[by]
    width = 8192
    for first in range(0, int(several.sum()), width):
        a, b = np.searchsorted(col, [first, first + width])
        inside = np.zeros((m, width), np.float32)
        inside[row[a:b], col[a:b] - first] = 1
        out += (inside @ inside.T).astype(np.int64)
    return out


def _members(texts: DataFrame) -> DataFrame:
    """``texts`` (group, blocks, block, id, text) with shingles for the text."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch, 4):
                row, key = _shingles(part.column(4))
                n = np.bincount(row, minlength=part.num_rows)
                lists = pa.ListArray.from_arrays(
                    np.append(0, np.cumsum(n)).astype(np.int32), pa.array(key.view(np.int64))
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], lists], ["group", "blocks", "block", "id", "shingles"]
                )

    return texts.mapInArrow(batches, "group long, blocks long, block long, id long, shingles array<long>")


def _node(id_col: str, text_col: str):
    unnamed = F.shiftrightunsigned(F.xxhash64(text_or_empty(text_col)), 2) + F.lit(UNNAMED)
    return F.coalesce(F.col(id_col).cast("long"), unnamed)


def _told(docs: DataFrame, id_col: str, text_col: str, recall: float) -> DataFrame:
    """``near_duplicates`` with two columns more: ``mark``, a hash of the text, and
    ``first``, whether the row's text is the one that stands for its class."""
    runs = runs_for(recall)
    node, text = _node(id_col, text_col), text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), node.alias("node"), F.xxhash64(text).alias("mark"), text.alias("text"))
    base = stored(_sketches(rows, runs), "sketches")
    worded = base.filter("n > 0")
    one = F.min(F.struct("node", "mark"))
    classes = worded.groupBy("k1", "k2", "n").agg(one.alias("one"), F.count(F.lit(1)).alias("n_copies"))
    classes = stored(classes.select("k1", "k2", "n", "one.*", "n_copies"), "classes")
    # A set goes by its least id; sets of texts that share one go by a number of their own.
    shared = classes.groupBy("node").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1").select("node", "sets")
    own = F.shiftrightunsigned(F.xxhash64("k1", "k2", "n"), 2) + F.lit(UNNAMED)
    named = classes.join(shared, "node", "left").withColumn("id", F.when(F.col("sets").isNull(), F.col("node")).otherwise(own))
    named = stored(named.drop("sets"), "classes")
    removed(classes)
    classes = named
    # One row of each class carries its sketch; equal sets have equal sketches.
    sketched = worded.select("node", "mark", "mins", "low").dropDuplicates(["node", "mark"])
    sets = stored(sketched.join(classes.select("node", "mark", "id", "n"), ["node", "mark"]).drop("node", "mark"), "sets")
    leaves = _leaves(sets.select("id", "mins"), runs)
    buckets = leaves[0]
    for more in leaves[1:]:
        buckets = buckets.unionByName(more)
    small = buckets.filter(F.col("n") <= BUCKET).join(sets.select("id", "low"), "id")
    large = buckets.filter(F.col("n") > BUCKET)
    least = large.groupBy("path").agg(F.min("id").alias("b"))
    edges = _nominated(small).unionByName(large.join(least, "path").select(F.col("id").alias("a"), "b"))
    groups = stored(components(edges).withColumnRenamed("root", "group"), "groups")
    removed(*leaves)
    sized = groups.join(sets.select("id", "n"), "id")
    cuts = sized.groupBy("group").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("long")
    placed = (
        groups.join(cuts.select("group", blocks.alias("blocks")), "group")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
        .select("group", "blocks", "block", "id")
        .join(classes.select("id", "node", "mark"), "id")
    )
    keyed = rows.join(placed, ["node", "mark"]).dropDuplicates(["id"])
    members = stored(_members(keyed.select("group", "blocks", "block", "id", "text")), "members")
    pairs = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "group", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "shingles"
    )
    found = stored(_compared(pairs), "found")
    removed(members, groups, sets)
    roots = stored(components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))), "roots")
    links = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    told = classes.join(links, "id", "left").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    told = stored(told.withColumn("n_links", F.coalesce("n_links", F.lit(0))), "told")
    removed(classes, found, roots)
    heads = told.groupBy("root").agg(F.min(F.struct("node", "mark")).alias("head"))
    out = base.select("doc_id", "node", "mark", "k1", "k2", "n").join(
        told.select("k1", "k2", "n", F.col("node").alias("set_id"), "n_copies", "n_links", "root"), ["k1", "k2", "n"], "left"
    ).join(heads, "root", "left")
    head = F.coalesce("head", F.struct("node", "mark"))
    return out.select(
        "doc_id",
        head["node"].alias("class_id"),
        F.coalesce("set_id", "node").alias("set_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "node",
        "mark",
        (head == F.struct("node", "mark")).alias("first"),
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL) -> DataFrame:
    """One row per input row: ``doc_id``; ``class_id``, the least id that links of
    similarity 0.8 or more connect it to; ``set_id``, the least id with the same
    set of shingles; ``n_copies``, the rows with that set; ``n_links``, the other
    sets it is linked to.

    Words are as in the contracts, lower-cased. Texts of one to four words have
    one shingle, all of them. A text without words, null included, is a class of
    its own with no links. Rows that repeat an id count as copies if their texts
    have one set of shingles, and are compared by themselves if not; ids then show
    the same number for different sets. Rows with a null id take part under a
    number of their text above ``UNNAMED``, which is theirs as a class only where no
    row with an id is in the class. ``node`` is the id or that number. ``recall`` is
    the probability that a pair at the threshold is compared, however crowded its buckets.
    """
    return _told(docs, id_col, text_col, recall).drop("mark", "first")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with the least id of each class; where that
    id has several texts, the row with the text that is in the class."""
    first = _told(docs, id_col, text_col, RECALL).filter("first").select(F.col("node").alias("_kept"), F.col("mark").alias("_text"))
    node = fresh(docs, "_node")
    mark = fresh(docs, "_mark")
    rows = docs.withColumn(node, _node(id_col, text_col)).withColumn(mark, F.xxhash64(text_or_empty(text_col)))
    same = (rows[node] == first["_kept"]) & (rows[mark] == first["_text"])
    return rows.join(first, same, "left_semi").dropDuplicates([node, mark]).drop(node, mark)
