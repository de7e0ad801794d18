"""Phrase collocation mining on sorted count streams.

Counting takes three passes over the texts: words; hashes of the pairs of words
that are both frequent; phrases whose pairs are all frequent. What is frequent
enough to go on is looked up in a Bloom filter of fixed size, which lets some rare
phrases through but holds back no frequent one, as a pair's hash occurs as often
as the pair or more; the counts of phrases themselves are exact.

All phrases that reach ``LEAST`` make one count stream, which is sorted twice: by
its words (prefix order) and by its words from the last to the first (suffix
order). In prefix order a phrase follows its own beginnings, so one walk with
the chain of open prefixes at hand tells the counts of all left parts, and each
phrase's count as an extension of its beginning; in suffix order the same walk
tells the right parts and extensions to the left. A stream is cut into ranges at
phrases of its own; a range starts with the chain of its first phrase, which is
looked up once for each range. So a word that starts a third of all phrases
spreads over ranges. The walks' results are sorted by phrase and merged in
lockstep.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.store import partitions, removed, stored
from tagloom.llm.wordarrays import joined_hashes, mixed, slices, spread, text_bytes

#: Longest phrase, least count of a candidate, results a language.
LONGEST, LEAST, KEPT = 5, 100, 2000
#: Bits of the filter of frequent phrases; a multiple of the 32,768 of one of Spark's bitmaps.
FILTER_BITS = 1 << 27
#: Bytes of words that are spread out or joined to phrases at a time, eight or more of memory for each.
CHUNK_BYTES = 1 << 18
#: Phrases drawn for each range that a stream is cut into.
DRAWS = 50

_U = np.uint64
_SECOND = _U(0xA24BAED4963EE407)
_PIECE_END = np.array([chr(b) in ".,;:!?" or 0x0A <= b <= 0x0D for b in range(256)])
_INSIDE = np.array([not (b in (0x20, 0x09) or _PIECE_END[b]) for b in range(256)])
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
_WORDS = [f"w{k}" for k in range(1, LONGEST + 1)]


class _Part:
    """Words of a slice of (lang, text) rows: ``ids``, equal where language and
    word are, ``lang`` of each word, and how many words of its piece follow it."""

    def __init__(self, part: pa.RecordBatch):
        langs = part.column(0).dictionary_encode()
        self.names = langs.dictionary
        raw, at = text_bytes(part.column(1))
        data = _LOWER[raw]
        inside = _INSIDE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        before = np.append(False, inside[:-1]) if len(data) else inside
        after = np.append(inside[1:], False) if len(data) else inside
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.data, self.starts = data, starts
        self.sizes = np.flatnonzero(inside & (~after | edge[1:])) + 1 - starts
        row = np.searchsorted(at, starts, "right") - 1
        self.lang = np.asarray(langs.indices).astype(np.int64)[row]
        cut = np.searchsorted(np.flatnonzero(_PIECE_END[data]), starts)
        # The words of a piece are numbered alike.
        piece = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (cut[1:] != cut[:-1]))) if len(starts) else starts
        ends = np.append(piece[1:], len(starts))
        self.room = np.repeat(ends, ends - piece) - np.arange(len(starts))
        self.hash = mixed(self._hashes() + mixed(_lang_hashes(self.names))[self.lang]) if len(starts) else np.zeros(0, _U)
        self.ids = self._ids()

    def __len__(self) -> int:
        return len(self.starts)

    def _hashes(self) -> np.ndarray:
        return _bytes_hashes(self.data, self.starts, self.sizes)

    def _ids(self) -> np.ndarray:
        """Numbers of the distinct (language, word): by hash, held against the bytes."""
        _, first, ids = np.unique(self.hash, return_index=True, return_inverse=True)
        same = first[ids]
        alike = (self.sizes[same] == self.sizes) & (self.lang[same] == self.lang)
        if alike.all() and all(self._alike(same, a, b) for a, b in _chunks(self.sizes)):
            return ids.astype(np.int64)
        # Two words with one hash: numbers by the words themselves.
        told = [(int(c), self.data[a : a + n].tobytes()) for c, a, n in zip(self.lang, self.starts, self.sizes, strict=True)]
        number = {w: i for i, w in enumerate(dict.fromkeys(told))}
        return np.array([number[w] for w in told], np.int64)

    def _alike(self, same: np.ndarray, a: int, b: int) -> bool:
        """Whether the words ``a`` to ``b`` - 1 have the bytes of the words ``same``."""
        here, there = (self.data[spread(x[a:b], self.sizes[a:b])] for x in (self.starts, self.starts[same]))
        return bool((here == there).all())

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        """The ``n`` words from each word in ``at`` on, joined by spaces."""
        which = (at[:, None] + np.arange(n)).ravel()
        sizes = self.sizes[which] + 1  # a space after each word, cut off at the end
        flat = np.empty(int(sizes.sum()), np.uint8)
        ends = np.cumsum(sizes)
        flat[ends - 1] = 0x20
        room = np.ones(len(flat), bool)
        room[ends - 1] = False
        flat[room] = self.data[spread(self.starts[which], sizes - 1)]
        stops = ends[n - 1 :: n]
        room[:] = True
        room[stops - 1] = False
        offsets = np.append(0, stops - np.arange(1, len(stops) + 1)).astype(np.int32)
        return pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(flat[room])])

    def counted(self, at: np.ndarray, keys: np.ndarray, n: int, of: np.ndarray) -> Iterator[pa.RecordBatch]:
        """(lang, phrase, words, n) of the phrases at ``at``, equal where ``keys`` are."""
        _, first, count = np.unique(keys, return_index=True, return_counts=True)
        at = at[first]
        # From each phrase's first byte to its last, what lies between words included.
        wide = self.starts[at + n - 1] + self.sizes[at + n - 1] - self.starts[at]
        for a, b in _chunks(wide):
            langs = self.names.take(pa.array(of[at[a:b]]))
            yield pa.RecordBatch.from_arrays(
                [langs, self.phrases(at[a:b], n), pa.array(np.full(b - a, n, np.int32)), pa.array(count[a:b].astype(np.int64))],
                ["lang", "phrase", "words", "n"],
            )


def _chunks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges (a, b) of entries of about CHUNK_BYTES; a larger entry is one by itself."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHUNK_BYTES, "right")))
        yield a, b
        a = b


def _bytes_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes, wherever it lies."""
    out = np.empty(len(starts), _U)
    for a, b in _chunks(sizes):
        out[a:b] = _hashes_of(data, starts[a:b], sizes[a:b])
    return out


def _hashes_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    with np.errstate(over="ignore"):
        x = mixed((data[spread(starts, sizes)].astype(_U) + _U(1)) * mixed(place.astype(_U) + _U(1)))
        total = np.append(_U(0), np.cumsum(x))
        ends = np.cumsum(sizes)
        return mixed(total[ends] - total[ends - sizes] + sizes.astype(_U))


def _lang_hashes(names: pa.Array) -> np.ndarray:
    langs = [(x or "").encode() for x in names.to_pylist()]
    sizes = np.array([len(x) for x in langs], np.int64)
    return _bytes_hashes(np.frombuffer(b"".join(langs), np.uint8), np.cumsum(sizes) - sizes, sizes)


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple((x & _U(FILTER_BITS - 1)).astype(np.int64) for x in (mixed(hashes), mixed(hashes * _SECOND)))


class _Filter:
    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        a, b = _places(hashes)
        return ((self.bits[a >> 3] >> (a & 7)) & (self.bits[b >> 3] >> (b & 7)) & 1).astype(bool)


def _words_hashed(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Hashes of (lang, phrase) rows of one word each."""
    for piece in slices(batch, 1):
        yield _Part(piece).hash


def _told_hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield np.asarray(batch.column(0)).view(_U)


def _filter_of(table: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> bytes:
    """The filter of the hashes of a table's rows: FILTER_BITS bits whatever their
    number, gathered as bitmaps of 4 kB. Hashing and placing share one Python
    worker; a second for each task would stay in memory for the passes that follow."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in hashes(batch):
                at = np.concatenate(_places(found))
                yield pa.RecordBatch.from_arrays([pa.array(at // 32_768), pa.array(at % 32_768)], ["bucket", "bit"])

    rows = table.mapInArrow(places, "bucket long, bit long")
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        bits[r["bucket"] * 4096 : (r["bucket"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return bits.tobytes()


_COUNTED = "lang string, phrase string, words int, n long"


def _count_words(texts: DataFrame) -> DataFrame:
    def work(batches):
        for batch in batches:
            for piece in slices(batch, 1):
                part = _Part(piece)
                yield from part.counted(np.arange(len(part)), part.ids, 1, part.lang)

    return _summed(texts.mapInArrow(work, _COUNTED))


def _pair_hashes(texts: DataFrame, frequent: bytes) -> DataFrame:
    """(h, n): how often each hash of two words occurs that are both frequent."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)  # FILTER_BITS bits

    def work(batches):
        known = _Filter(shared.value)
        for batch in batches:
            for piece in slices(batch, 1):
                part = _Part(piece)
                often = known.has(part.hash)
                on = (part.room[:-1] > 1) & often[:-1] & often[1:]
                found, n = np.unique(joined_hashes(part.hash, 2)[on], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    return texts.mapInArrow(work, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _count_phrases(texts: DataFrame, frequent: bytes) -> DataFrame:
    """(lang, phrase, words, n) of the phrases of two words or more whose pairs all
    pass the filter."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)  # FILTER_BITS bits

    def work(batches):
        known = _Filter(shared.value)
        for batch in batches:
            for piece in slices(batch, 1):
                part = _Part(piece)
                if len(part) < 2:
                    continue
                linked = known.has(joined_hashes(part.hash, 2)) & (part.room[:-1] > 1)
                wide = int(part.ids.max()) + 1
                at = np.flatnonzero(linked)
                keys = part.ids[at] * wide + part.ids[at + 1]
                for n in range(2, LONGEST + 1):
                    if n > 2:
                        on = (at + n - 2 < len(linked)) & linked[np.minimum(at + n - 2, len(linked) - 1)]
                        _, rank = np.unique(keys[on], return_inverse=True)
                        at = at[on]
                        keys = rank.astype(np.int64) * wide + part.ids[at + n - 1]
                    if not len(at):
                        break
                    yield from part.counted(at, keys, n, part.lang)

    return _summed(texts.mapInArrow(work, _COUNTED))


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))


def count_stream(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of every phrase of 1 to LONGEST words that occurs
    LEAST times or more, and (lang, n): all words of each language."""
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    words = stored(_count_words(texts), "words")
    totals = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    once = stored(words.filter(F.col("n") >= LEAST), "frequent")
    removed(words)
    pairs = stored(_pair_hashes(texts, _filter_of(once.select("lang", "phrase"), _words_hashed)).filter(F.col("n") >= LEAST).select("h"), "pairs")
    more = stored(_count_phrases(texts, _filter_of(pairs, _told_hashes)).filter(F.col("n") >= LEAST), "frequent")
    stream = stored(once.unionByName(more).withColumnRenamed("n", "f"), "stream")
    removed(once, pairs, more)
    return stream, totals


def _ordered(stream: DataFrame, back: bool) -> DataFrame:
    """The stream with its phrases' words as columns, from the last one on if ``back``."""
    words = F.split("phrase", " ")
    words = F.reverse(words) if back else words
    return stream.select("lang", *[F.get(words, F.lit(k)).alias(w) for k, w in enumerate(_WORDS)], "words", "f")


def _key(row) -> tuple:
    """A phrase's place in its order: a null word comes before any other."""
    return (row["lang"].encode(), *[row[w].encode() for w in _WORDS if row[w] is not None])


def walked(stream: DataFrame, back: bool) -> DataFrame:
    """(lang, w1.., words, parts, up): each phrase of the stream with the counts of
    its beginnings of 1, 2, .. words (``parts``), in the order of its words from
    the first one on or, if ``back``, from the last one on; ``up`` is whether the
    phrase is all there is of its longest beginning."""
    rows = stored(_ordered(stream, back), "suffixes" if back else "prefixes")
    n = max(1, partitions(rows))
    total = rows.count()
    drawn = rows.select("lang", *_WORDS).filter(F.pmod(F.xxhash64("lang", *_WORDS), F.lit(max(1, total // (n * DRAWS)))) == 0)
    # A bounded draw of about n x DRAWS phrases; it decides where ranges end, not what is in them.
    first = sorted({_key(r) for r in drawn.orderBy(F.xxhash64("lang", *_WORDS, F.lit(1))).limit(2 * n * DRAWS).collect()})
    cuts = [first[i * len(first) // n] for i in range(1, n)] if len(first) > n else first
    cuts = sorted(set(cuts))
    # The chain of open prefixes at each cut: their counts, at most LONGEST - 1 a cut.
    wanted = sorted({k[: m + 1] for k in cuts for m in range(1, min(len(k) - 1, LONGEST - 1) + 1)})
    spark = rows.sparkSession
    chains = {}
    if wanted:
        asked = spark.createDataFrame(
            [tuple(x.decode() for x in k) + (None,) * (LONGEST + 1 - len(k)) for k in wanted],
            "lang string, " + ", ".join(f"{w} string" for w in _WORDS),
        )
        same = [rows[c].eqNullSafe(asked[c]) for c in ("lang", *_WORDS)]
        chains = {_key(r): r["f"] for r in rows.join(F.broadcast(asked), same, "left_semi").collect()}
    shared = spark.sparkContext.broadcast((cuts, chains))
    kind = "lang string, " + ", ".join(f"{w} string" for w in _WORDS) + ", words int, f long, part int"

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_right

        ends, _ = shared.value
        for batch in batches:
            part = [bisect_right(ends, _key(r)) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], [*batch.schema.names, "part"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, counts = shared.value
        now, chain = None, []
        for batch in batches:
            rows, parts, up = batch.to_pylist(), [], []
            for r in rows:
                key = _key(r)
                if r["part"] != now:
                    now, chain = r["part"], []
                    if now:
                        # A prefix of the cut that is frequent has a count; each that is not a phrase of its own range is open.
                        cut = ends[now - 1]
                        chain = [(cut[: m + 1], counts[cut[: m + 1]]) for m in range(1, len(cut)) if cut[: m + 1] in counts]
                while chain and chain[-1][0] != key[: len(chain[-1][0])]:
                    chain.pop()
                if chain and chain[-1][0] == key:  # the cut itself, met in its own range
                    chain.pop()
                parts.append([c for _, c in chain])
                up.append(bool(chain) and chain[-1][1] == r["f"])
                chain.append((key, r["f"]))
            cols = [batch.column(batch.schema.get_field_index(c)) for c in ("lang", *_WORDS, "words", "f")]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(parts, pa.list_(pa.int64())), pa.array(up, pa.bool_())],
                ["lang", *_WORDS, "words", "f", "parts", "up"],
            )

    order = ["part", "lang", *_WORDS]
    ranges = rows.mapInArrow(dealt, kind).repartition("part").sortWithinPartitions(*order)
    return ranges.mapInArrow(walk, kind.rsplit(",", 1)[0] + ", parts array<long>, up boolean")


def _told(walks: DataFrame, back: bool) -> tuple[DataFrame, DataFrame]:
    """Two tables by phrase: its parts, and the phrases that an extension equals."""
    words = F.filter(F.array(*_WORDS), lambda w: w.isNotNull())
    shown = F.array_join(F.reverse(words) if back else words, " ")
    some = F.slice(words, F.lit(1), F.col("words") - 1)
    parent = F.array_join(F.reverse(some) if back else some, " ")
    parts = walks.filter("words > 1").select("lang", shown.alias("phrase"), "words", "f", "parts")
    return parts, walks.filter("up AND words > 2").select("lang", parent.alias("phrase"))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", kept: int = KEPT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2
    to LONGEST words with a = f(phrase) >= LEAST, at their lowest-scoring cut into
    l = f(left part) and r = f(right part), score floor(1000 * a * n / (l * r)),
    without phrases inside a longer one of the same count.

    A null language is ``und``, a null text is empty. Repeated rows count as often
    as they occur. Ties of score and count go by the phrase's bytes."""
    stream, totals = count_stream(docs, lang_col, text_col)
    left, inner = _told(stored(walked(stream, False), "walked"), False)
    right, outer = _told(stored(walked(stream, True), "walked"), True)
    removed(stream)
    none = F.lit(None)
    lists = "array<long>"
    rows = (
        left.select("lang", "phrase", "f", F.col("parts").alias("ls"), none.cast(lists).alias("rs"), F.lit(False).alias("drop"))
        .unionByName(right.select("lang", "phrase", none.cast("long").alias("f"), none.cast(lists).alias("ls"), F.col("parts").alias("rs"), F.lit(False).alias("drop")))
        .unionByName(
            inner.unionByName(outer).select(
                "lang", "phrase", none.cast("long").alias("f"), none.cast(lists).alias("ls"), none.cast(lists).alias("rs"), F.lit(True).alias("drop")
            )
        )
    )
    # At most four rows a phrase: one of each walk and one of each kind of extension.
    merged = rows.join(F.broadcast(totals), "lang").repartitionByRange(partitions(rows), "lang", "phrase").sortWithinPartitions("lang", "phrase")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (r for batch in batches for r in batch.to_pylist())
        out = []
        for (lang, phrase), same in groupby(each, key=lambda r: (r["lang"], r["phrase"])):
            same = list(same)
            if any(r["drop"] for r in same):
                continue
            a = next(r["f"] for r in same if r["f"] is not None)
            ls = next(r["ls"] for r in same if r["ls"] is not None)
            rs = next(r["rs"] for r in same if r["rs"] is not None)
            n = same[0]["n"]
            # The right part of a cut after k words has words - k words.
            cuts = [(1000 * a * n // (l * r), k, l, r) for k, (l, r) in enumerate(zip(ls, reversed(rs), strict=True))]
            score, _, l, r = min(cuts)
            out.append((lang, phrase, a, l, r, n, score))
            if len(out) == 10_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    scored = merged.mapInArrow(merge, "lang string, phrase string, a long, l long, r long, n long, score long")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= kept)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["lang", "phrase", "a", "l", "r", "n", "score"]
    kinds = [pa.string()] * 2 + [pa.int64()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
