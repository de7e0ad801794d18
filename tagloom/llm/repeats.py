"""Substring deduplication with automata of repeated phrases.

A phrase is ``WINDOW`` consecutive words. Every window has an anchor, the
shingle of ``SHINGLE`` words in it whose hash is least, so equal windows have
equal anchors and about one word in five starts an anchor. Windows whose anchor
occurs in one row only can't repeat. For the others the passages around their
anchors are gathered by anchor and equal passages are combined. A passage that
is the only one of its anchor repeats as a whole or not at all, which its count
confirms. Where passages differ around an anchor, each shard of anchors confirms
which phrases start in several documents, compiles them into Aho-Corasick
automata and streams its passages through them. The places found go back to the
documents, which drop the covered words.

An anchor that many rows share does not gather its passages: these are cut into
single phrases with keys of their own, so that equal ones combine before the
shuffle and no shard grows with a frequent anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.store import removed, stored, text_or_empty
from tagloom.llm.wordarrays import NOT_SPACE, Words, joined_hashes, mixed, slices, spread

WINDOW, SHINGLE = 13, 5
#: Rows that share an anchor before its passages are cut into single phrases.
FREQUENT = 1000
#: Passages that one automaton is compiled from at least, whole anchors each.
AUTOMATON_PASSAGES = 2_000
#: What a null id counts as.
LAST_ID = (1 << 63) - 1


class Anchors:
    """The anchors of some rows' words: ``key`` of each, ``a`` and ``b``: the first
    and last window (by first word) that it is the anchor of."""

    def __init__(self, words: Words, window: int, shingle: int):
        self.hashes = words.hashes()
        starts = words.runs(window)
        self.key = np.zeros(0, np.uint64)
        self.a = self.b = np.zeros(0, np.int64)
        if not len(starts):
            return
        order = joined_hashes(self.hashes, shingle)
        m = len(order) - (window - shingle)  # windows of all words, also across rows
        least, step = order[:m].copy(), np.zeros(m, np.int8)
        for k in range(1, window - shingle + 1):
            other = order[k : k + m]
            step[other < least] = k
            np.minimum(least, other, out=least)
        least, where = least[starts], starts + step[starts]
        # Where the anchor moves, or the row changes, another run of windows begins.
        new = np.ones(len(starts), bool)
        new[1:] = (where[1:] != where[:-1]) | (starts[1:] != starts[:-1] + 1)
        at = np.flatnonzero(new)
        self.key, self.a = least[at], starts[at]
        self.b = starts[np.append(at[1:], len(starts)) - 1]


def _anchor_rows(docs: DataFrame, window: int, shingle: int) -> DataFrame:
    """(rid, anchor), once for each row and anchor."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch, 1):
                words = Words(part.column(1), NOT_SPACE)
                found = Anchors(words, window, shingle)
                row = words.row[found.a] if len(found.a) else found.a
                by = np.lexsort((found.key, row))
                row, key = row[by], found.key[by]
                once = np.ones(len(row), bool)
                once[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
                rid = part.column(0).to_numpy()[row[once]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid, pa.int64()), pa.array(key[once].view(np.int64))], ["rid", "anchor"]
                )

    return docs.select("rid", "text").mapInArrow(batches, "rid long, anchor long")


def _passages(docs: DataFrame, window: int, shingle: int) -> DataFrame:
    """(rid, doc_id, start, key, passage) for the rows of ``docs`` (rid, doc_id,
    text, anchors, frequent): the words, set apart by one space, of the windows
    whose anchor is one of ``anchors``; those of the anchors that are also
    ``frequent`` one window at a time. ``key`` is the anchor or the window."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch, 2):
                words = Words(part.column(2), NOT_SPACE)
                found = Anchors(words, window, shingle)
                if not len(found.a):
                    continue
                row = words.row[found.a]
                listed = [_listed(part.column(k), row, found.key) for k in (3, 4)]
                hot = listed[1]
                cold = listed[0] & ~hot
                a, b, key = found.a[cold], found.b[cold], found.key[cold]
                single = spread(found.a[hot], found.b[hot] - found.a[hot] + 1)
                whole = joined_hashes(found.hashes, window)
                a, b = np.append(a, single), np.append(b, single)
                key = np.append(key, mixed(whole[single] + np.uint64(1)))
                if not len(a):
                    continue
                yield from _passage_batches(part, words, a, b, key, window)

    def _listed(column: pa.Array, row: np.ndarray, key: np.ndarray) -> np.ndarray:
        sizes = np.diff(column.offsets.to_numpy())
        if not sizes.sum():
            return np.zeros(len(row), bool)
        mine = np.repeat(np.arange(len(column)), sizes)
        have = column.flatten().to_numpy().view(np.uint64)
        out = np.zeros(len(row), bool)
        first, last = np.searchsorted(row, np.arange(len(column))), np.searchsorted(row, np.arange(len(column)), "right")
        ends = np.cumsum(sizes)
        for r in np.unique(mine):
            out[first[r] : last[r]] = np.isin(key[first[r] : last[r]], have[ends[r] - sizes[r] : ends[r]])
        return out

    def _passage_batches(part, words, a, b, key, window):
        # All words of the slice, each followed by one space.
        sizes = words.ends - words.starts
        at = spread(words.starts, sizes + 1)
        stops = np.cumsum(sizes + 1)
        text = words.data[np.minimum(at, len(words.data) - 1)]
        text[stops - 1] = 0x20
        begins = stops - sizes - 1
        for low in range(0, len(a), 50_000):
            x, y, k = a[low : low + 50_000], b[low : low + 50_000], key[low : low + 50_000]
            start, stop = begins[x], stops[y + window - 1] - 1
            flat = text[spread(start, stop - start)]
            offsets = np.append(0, np.cumsum(stop - start)).astype(np.int32)
            strings = pa.StringArray.from_buffers(len(x), pa.py_buffer(offsets), pa.py_buffer(flat))
            row = words.row[x]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(row)),
                    part.column(1).take(pa.array(row)),
                    pa.array((x - words.first[row]).astype(np.int32)),
                    pa.array(k.view(np.int64)),
                    strings,
                ],
                ["rid", "doc_id", "start", "key", "passage"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("rid", "doc_id", "text", "anchors", "frequent")
    return rows.mapInArrow(batches, f"rid long, doc_id {kind}, start int, key long, passage string")


def _located(passages: DataFrame, window: int) -> DataFrame:
    """(key, passage, offsets, owners) for distinct ``passages`` (key, passage,
    owner, last) that lie together by key: the words at which repeated phrases
    start, and the least id of a document in which each phrase starts."""

    def automaton(rows: list[tuple]):
        import ahocorasick

        seen: dict[str, list] = {}
        for _, passage, owner, last in rows:
            places = _word_places(passage)
            for i in range(len(places) - window):
                phrase = passage[places[i] : places[i + window] - 1]
                known = seen.get(phrase)
                if known is None:
                    seen[phrase] = [owner, last]
                else:
                    known[0], known[1] = min(known[0], owner), max(known[1], last)
        found = ahocorasick.Automaton()
        for phrase, (owner, last) in seen.items():
            if owner < last:
                found.add_word(f" {phrase} ", (len(phrase), owner))
        found.make_automaton()
        return found

    def located(rows: list[tuple]) -> pa.RecordBatch | None:
        found = automaton(rows)
        if not len(found):
            return None
        keys, texts, offsets, owners = [], [], [], []
        for key, passage, _, _ in rows:
            word = {at: i for i, at in enumerate(_word_places(passage))}
            # Padded by a space on each side, a phrase ends one space after its last character.
            hits = [(word[end - size - 1], owner) for end, (size, owner) in found.iter(f" {passage} ")]
            if hits:
                keys.append(key)
                texts.append(passage)
                offsets.append([i for i, _ in hits])
                owners.append([owner for _, owner in hits])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.int64()),
                pa.array(texts, pa.string()),
                pa.array(offsets, pa.list_(pa.int32())),
                pa.array(owners, pa.list_(owner_kind)),
            ],
            ["key", "passage", "offsets", "owners"],
        )

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in rows:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(held) >= AUTOMATON_PASSAGES and row[0] != held[-1][0]:
                    if (out := located(held)) is not None:
                        yield out
                    held = []
                held.append(row)
        if held and (out := located(held)) is not None:
            yield out

    owner_kind = pa.int64()
    return passages.mapInArrow(batches, "key long, passage string, offsets array<int>, owners array<long>")


def _word_places(passage: str) -> list[int]:
    """Where the words of ``passage`` start, and where one more would."""
    out, at = [0], passage.find(" ")
    while at >= 0:
        out.append(at + 1)
        at = passage.find(" ", at + 1)
    out.append(len(passage) + 1)
    return out


def repeated_windows(docs: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(rid, doc_id, starts) of the rows of ``docs`` (rid, doc_id, text) with
    windows that also start in a document with a smaller id; ``starts`` are those
    windows' first words."""
    seen = _anchor_rows(docs, window, shingle)
    shared = stored(
        seen.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "anchors"
    )
    frequent = F.col("n") > FREQUENT
    lists = (
        seen.join(shared, "anchor")
        .groupBy("rid")
        .agg(
            F.collect_list("anchor").alias("anchors"),
            F.collect_list(F.when(frequent, F.col("anchor"))).alias("frequent"),
        )
    )
    occurrences = stored(
        _passages(docs.join(lists, "rid"), window, shingle).withColumn("sid", F.xxhash64("passage")), "passages"
    )
    removed(shared)
    order = F.coalesce("doc_id", F.lit(LAST_ID))
    combined = occurrences.groupBy("key", "passage").agg(F.min(order).alias("owner"), F.max(order).alias("last"))
    # A key has FREQUENT passages at most: more frequent anchors are cut.
    alike = F.count(F.lit(1)).over(Window.partitionBy("key")).alias("alike")
    distinct = stored(combined.select("key", "passage", "owner", "last", alike), "distinct")
    mixed_keys = distinct.filter("alike > 1").select("key", "passage", "owner", "last")
    dealt = mixed_keys.repartition("key").sortWithinPartitions("key")
    sid = F.xxhash64("passage").alias("sid")
    starts = F.sequence(F.lit(0), F.size(F.split("passage", " ")) - window)
    alone = distinct.filter("alike = 1 AND owner < last").select("key", sid, starts.alias("offsets"), "owner")
    whole = alone.select("key", "sid", "offsets", F.transform("offsets", lambda _: F.col("owner")).alias("owners"))
    places = stored(whole.unionByName(_located(dealt, window).select("key", sid, "offsets", "owners")), "places")
    removed(distinct)
    found = occurrences.select("rid", "doc_id", "start", "key", "sid").join(places, ["key", "sid"])
    earlier = F.filter(
        F.arrays_zip("offsets", "owners"),
        lambda z: z["owners"] < order,
    )
    starts = F.transform(earlier, lambda z: z["offsets"] + F.col("start"))
    hit = found.select("rid", "doc_id", starts.alias("starts")).filter(F.size("starts") > 0)
    out = stored(hit.groupBy("rid", "doc_id").agg(F.flatten(F.collect_list("starts")).alias("starts")), "starts")
    removed(occurrences, places)
    return out


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, digest: bool = False
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``n_removed`` and ``text``,
    the words that stay joined by one space, or with ``digest`` its
    ``kept_sha256``. A word goes if a window of ``window`` words that covers it
    also starts in a document with a smaller id, judged on the input.

    Ids are integers. A null id is behind all others: its row loses what any
    other document has and takes nothing from others. Rows that repeat an id are
    one document for that purpose. Null texts have no words.
    """
    text = text_or_empty(text_col)
    rows = docs.select(
        F.xxhash64(F.col(id_col), text).alias("rid"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text")
    )
    starts = repeated_windows(rows, window).withColumnRenamed("doc_id", "_id")
    both = rows.join(
        starts, (rows["rid"] == starts["rid"]) & rows["doc_id"].eqNullSafe(starts["_id"]), "left"
    ).select("doc_id", "text", F.coalesce("starts", F.array().cast("array<int>")).alias("starts"))
    last = "kept_sha256" if digest else "text"

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch, 1):
                words = Words(part.column(1), NOT_SPACE)
                sizes = np.diff(words.first)
                at = part.column(2).flatten().to_numpy()
                of = np.repeat(np.arange(len(sizes)), np.diff(part.column(2).offsets.to_numpy()))
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, words.first[of] + at, 1)
                np.add.at(change, words.first[of] + at + window, -1)
                stays = np.cumsum(change)[:-1] == 0
                removed_words = sizes - np.add.reduceat(np.append(stays, 0), words.first[:-1]) * (sizes > 0)
                kept = _joined(words, stays)
                if digest:
                    kept = [hashlib.sha256(x).hexdigest() for x in kept]
                else:
                    kept = [x.decode() for x in kept]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(removed_words, pa.int64()), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "n_removed", last],
                )

    def _joined(words: Words, stays: np.ndarray) -> list[bytes]:
        starts, ends, row = words.starts[stays], words.ends[stays], words.row[stays]
        sizes = ends - starts + 1
        flat = words.data[np.minimum(spread(starts, sizes), max(0, len(words.data) - 1))] if len(starts) else np.zeros(0, np.uint8)
        stops = np.cumsum(sizes)
        if len(stops):
            flat[stops - 1] = 0x20
        data = flat.tobytes()
        edges = np.append(0, stops)[np.searchsorted(row, np.arange(len(words.first)))].tolist()
        return [data[a : max(a, b - 1)] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    return both.mapInArrow(batches, f"doc_id long, n_words long, n_removed long, {last} string")
