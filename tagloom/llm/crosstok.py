"""Alignment of two tokenizers by inverted pair bitmaps.

Every text is encoded by a byte-level BPE (A) and a piece BPE (B). Where tokens of
both end at the same byte the text is cut into groups; an A and a B token whose
bytes overlap are linked. Each pair of linked ids has postings: documents are
numbered within blocks, and a pair has one row a block with compressed bitmaps:
the block's documents that hold the pair, and planes with the bits of how often
they hold it beyond once. The bitmaps of a pair's blocks are disjoint parts of one
bitmap, so their union's popcount, the documents with the pair, is the sum of
theirs; the planes' popcounts times their place values give its links. The
counts go back over the postings to the documents.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tagloom.llm import bpe
from tagloom.llm.store import removed, stored
from tagloom.llm.wordarrays import spread

#: A block of documents ends when it has so many documents or (document, pair) entries.
BLOCK_DOCS, BLOCK_ENTRIES = 16_384, 3_000_000
#: A pair's number is its A id times this plus its B id.
WIDTH = 1 << 32
#: Distinct pieces that a worker remembers of each tokenizer.
KNOWN_PIECES = 300_000

_DENSE = np.uint16(0x8000)


def a_model(path: str) -> tuple[str, list[bytes]]:
    """The byte-level BPE file as a model for pieces mapped to characters, and
    each id's bytes. Special tokens are left out: their strings are plain text."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte = {c: b for b, c in enumerate(bpe.byte_table())}
    known = [b""] * (max(spec["model"]["vocab"].values()) + 1)
    for shown, number in spec["model"]["vocab"].items():
        known[number] = bytes(byte[c] for c in shown)
    none = dict.fromkeys(("normalizer", "pre_tokenizer", "post_processor", "decoder"))
    return json.dumps({"version": "1.0", "added_tokens": [], **none, "model": spec["model"]}), known


def b_bytes(model) -> list[bytes]:
    """The bytes of each piece: byte pieces as their byte, U+2581 as a space."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return out


class _Pieces:
    """Encodes texts that start with a space by the piece model. No piece has a
    space mark after another character, so merges never reach over the start of
    a run of spaces: each run with what follows it is encoded by itself, once."""

    def __init__(self, proto: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.space = self.model.piece_to_id("▁")
        if any("▁" in self.model.id_to_piece(i).lstrip("▁") for i in range(self.model.get_piece_size())):
            raise ValueError("the piece model has pieces that reach over spaces")
        known = b_bytes(self.model)
        self.flat = np.frombuffer(b"".join(known), np.uint8)
        self.size = np.array([len(x) for x in known], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.step = np.uint64(0x9E3779B97F4A7C15)
        self.forget()

    def forget(self):
        self.places: dict[int, int] = {}
        self.counts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, pieces: list[str], keys: list[int]) -> None:
        # The model puts a space before what it is given.
        made = [ids or [self.space] for ids in self.model.encode([p[1:] for p in pieces], num_threads=1)]
        self.places.update(zip(keys, range(len(self.counts), len(self.counts) + len(keys)), strict=True))
        self.counts = np.append(self.counts, np.array([len(x) for x in made], np.int64))
        self.ids = np.append(self.ids, np.array([i for x in made for i in x], np.int64))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and each text's first place in them (and the end)."""
        data = "".join(texts)
        points = np.frombuffer(data.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(x) for x in texts], np.int64)
        ends = np.cumsum(sizes)
        first = np.zeros(len(points), bool)
        first[(ends - sizes)[sizes > 0]] = True
        white = points == 32
        cut = first.copy()
        cut[1:] |= white[1:] & ~white[:-1]
        cuts = np.flatnonzero(cut)
        stops = np.append(cuts[1:], len(points))
        keys = bpe.piece_hashes(points, cuts, stops, self.step)
        distinct, at, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.places) > KNOWN_PIECES:
            self.forget()
        known = distinct.tolist()
        new = [i for i, k in enumerate(known) if k not in self.places]
        if new:
            self.learn([data[cuts[i] : stops[i]] for i in at[new].tolist()], [known[i] for i in new])
        place = np.array([self.places[k] for k in known], np.int64)[which]
        counts = self.counts[place]
        ids = self.ids[spread((np.cumsum(self.counts) - self.counts)[place], counts)]
        total = np.append(0, np.cumsum(counts))
        return ids, total[np.searchsorted(cuts, np.append(ends - sizes, len(points)))]


class Aligner:
    """Both tokenizers and the alignment of their tokens, for lists of texts."""

    def __init__(self, spec: str, known: list[bytes], proto: bytes, classes: np.ndarray):
        self.a, self.b = bpe.Encoder(spec, classes, known), _Pieces(proto)
        shown = [str(i).encode() for i in range(max(len(known), len(self.b.size)))]
        self.digits = np.frombuffer(b"".join(x + b"-" for x in shown), np.uint8)
        self.digit_len = np.array([len(x) + 1 for x in shown], np.int64)
        self.digit_at = np.cumsum(self.digit_len) - self.digit_len

    def align(self, texts: list[str]):
        """For each of the texts, which are not empty and start with the added
        space: whether both give back its bytes; numbers of A ids, B ids, groups,
        links; the digest of its groups; and (text, pair) of every link."""
        want = [t.encode() for t in texts]
        ids_a, in_a = self.a.encode(texts)[:2]
        ids_b, in_b = self.b.encode(texts)
        ids_a, in_a, good_a = self._checked(texts, want, ids_a.astype(np.int64), in_a, self.a.byte_at, self.a.byte_len, self.a.bytes_flat, self._plain_a)
        ids_b, in_b, good_b = self._checked(texts, want, ids_b, in_b, self.b.at, self.b.size, self.b.flat, self._plain_b)
        good = good_a & good_b
        n_a, n_b = np.diff(in_a), np.diff(in_b)
        ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
        n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        # Ends are marked byte by byte; between two ends of either kind lies exactly one link.
        end_a, end_b = np.cumsum(self.a.byte_len[ids_a]), np.cumsum(self.b.size[ids_b])
        mark = np.zeros(1 + int(end_a[-1]) if len(end_a) else 1, np.uint8)
        mark[end_a] = 1
        mark[end_b] |= 2
        ends = np.flatnonzero(mark)
        in_a, in_b = (mark[ends] & 1) > 0, (mark[ends] & 2) > 0
        in_both = in_a & in_b
        left, right, group = (np.cumsum(x) - x for x in (in_a, in_b, in_both))
        pair = ids_a[left] * WIDTH + ids_b[right]
        text = np.repeat(np.arange(len(texts)), n_a)[left]
        n_groups = np.bincount(text[in_both], minlength=len(texts))
        n_links = np.bincount(text, minlength=len(texts))
        shas = self._digests(ids_a, ids_b, group[in_a], group[in_b], int(in_both.sum()), n_a, n_b, good)
        return good, n_a, n_b, n_groups, n_links, shas, text, pair

    def _plain_a(self, text: str) -> list[int]:
        piece = [text[m : n] for m, n in pairwise([*bpe.piece_starts(np.array([ord(c) for c in text], np.uint32), np.zeros(1, int), self.a.classes).tolist(), len(text)])]
        mapped = [p.encode().decode("latin-1").translate(self.a.chars) for p in piece]
        return [i for e in self.a.tok.encode_batch_fast(mapped, add_special_tokens=False) for i in e.ids]

    def _plain_b(self, text: str) -> list[int]:
        return self.b.model.encode(text[1:])

    def _checked(self, texts, want, ids, bounds, at, size, flat, plain):
        """Whether the ids' bytes are the text's. Where not, the whole text is
        encoded once more without remembered pieces, which then decides."""
        def told(numbers):
            return flat[spread(at[numbers], size[numbers])].tobytes()

        if told(ids) == b"".join(want):
            return ids, bounds, np.ones(len(texts), bool)
        good, parts = np.ones(len(texts), bool), []
        for i, (a, b) in enumerate(pairwise(bounds.tolist())):
            mine = ids[a:b]
            if told(mine) != want[i]:
                mine = np.array(plain(texts[i]), np.int64)
                good[i] = told(mine) == want[i]
            parts.append(mine)
        return np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts])), good

    def _digests(self, ids_a, ids_b, group_a, group_b, n_groups, n_a, n_b, good) -> list[str]:
        per_a, per_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        before_a, before_b = np.cumsum(per_a), np.cumsum(per_b) - per_b
        # In the digest's order each group's A ids come before its B ids.
        put_a = np.arange(len(ids_a)) + before_b[group_a]
        put_b = np.arange(len(ids_b)) + before_a[group_b]
        order, mark = np.empty(len(ids_a) + len(ids_b), np.int64), np.empty(len(ids_a) + len(ids_b), np.uint8)
        order[put_a], order[put_b] = ids_a, ids_b
        mark[put_a] = np.where(np.append(group_a[1:] != group_a[:-1], True)[: len(ids_a)], ord("|"), ord(","))
        mark[put_b] = np.where(np.append(group_b[1:] != group_b[:-1], True)[: len(ids_b)], ord(";"), ord(","))
        sizes = self.digit_len[order]
        flat = self.digits[spread(self.digit_at[order], sizes)]
        last = np.cumsum(sizes)
        flat[last - 1] = mark
        stop = np.append(0, last)[np.append(0, np.cumsum(n_a + n_b))]
        return [hashlib.sha256(flat[a : b - 1]).hexdigest() if ok else "" for (a, b), ok in zip(pairwise(stop.tolist()), good, strict=True)]


def compressed(pair: np.ndarray, doc: np.ndarray, times: np.ndarray, n_docs: int):
    """Bitmaps of entries (pair, doc, times), sorted by pair and doc: the distinct
    pairs, the places of their 16-bit words (and the end), and the words. A
    pair's first bitmap tells its documents; the one of plane k those where bit
    k of times - 1 is set. A bitmap is a word with the number of words that
    follow, then document numbers, or, marked by the top bit, words of bits."""
    starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(pair))))
    wide = -(-n_docs // 16)
    beyond = times - 1
    most = np.maximum.reduceat(beyond, starts) if len(starts) else beyond
    planes, counts = [np.arange(len(pair))], []  # members of each bitmap, and how many a pair has
    for k in range(int(most.max(initial=0)).bit_length()):
        planes.append(np.flatnonzero((beyond >> k) & 1))
    depth = 1 + np.frexp(most.astype(float))[1]  # bitmaps of a pair: one, and one for each bit of the most
    size = np.zeros(len(starts), np.int64)
    for k, members in enumerate(planes):
        n = np.bincount(of[members], minlength=len(starts))
        counts.append(n)
        size += np.where(depth > k, 1 + np.minimum(n, wide), 0)
    ends = np.cumsum(size)
    at = ends - size
    words = np.zeros(int(size.sum()), np.uint16)
    for k, members in enumerate(planes):
        n, has = counts[k], depth > k
        thick = has & (n > wide)
        thin = has & ~thick
        words[at[thin]] = n[thin]
        words[at[thick]] = _DENSE | np.uint16(wide)
        entry = of[members]
        few = thin[entry]
        words[spread(at[thin] + 1, n[thin])] = doc[members][few]
        many, where = doc[members][~few], at[entry[~few]] + 1
        np.bitwise_or.at(words, where + (many >> 4), np.left_shift(np.uint16(1), (many & 15).astype(np.uint16)))
        at = at + np.where(has, 1 + np.where(thick, wide, n), 0)
    return pair[starts], np.append(0, ends), words


def _walk(words: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """For each plane: its value, the rows that have it, whether their bitmaps are
    dense, the place after the head and the number of words."""
    at, k = starts.copy(), 0
    while len(live := np.flatnonzero(at < ends)):
        head = words[at[live]]
        n = (head & ~_DENSE).astype(np.int64)
        yield 1 << max(k - 1, 0), live, (head & _DENSE) > 0, at[live] + 1, n
        at[live] += 1 + n
        k += 1


def popcounts(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents (the first bitmap's popcount) and links (with the planes') of each row."""
    docs, links = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    for k, (value, rows, dense, at, n) in enumerate(_walk(words, starts, ends)):
        bits = n.copy()
        if dense.any():
            ones = np.append(0, np.cumsum(np.bitwise_count(words[spread(at[dense], n[dense])]).astype(np.int64)))
            stop = np.cumsum(n[dense])
            bits[dense] = ones[stop] - ones[stop - n[dense]]
        links[rows] += value * bits
        if k == 0:
            docs[rows] = bits
    return docs, links


def expanded(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(value, row, document) of every bit set in the rows' bitmaps, a plane at a time."""
    for value, rows, dense, at, n in _walk(words, starts, ends):
        few = ~dense
        yield value, np.repeat(rows[few], n[few]), words[spread(at[few], n[few])].astype(np.int64)
        if dense.any():
            some = words[spread(at[dense], n[dense])]
            bit = np.flatnonzero(np.unpackbits(some.astype("<u2").view(np.uint8), bitorder="little"))
            word = bit >> 4
            base = np.repeat(np.cumsum(n[dense]) - n[dense], n[dense])
            yield value, np.repeat(rows[dense], n[dense])[word], bit - 16 * base[word]


def _words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    words = np.frombuffer(data, np.uint16, count=int(at[-1]) // 2) if data is not None else np.zeros(0, np.uint16)
    return words, at[:-1] // 2, at[1:] // 2


_MADE: dict[str, Aligner] = {}


def _aligner(shared) -> Aligner:
    spec, known, proto, classes = shared.value
    key = hashlib.sha256(spec.encode() + proto).hexdigest()
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Aligner(spec, known, proto, classes)
    return _MADE[key]


_DOC = ["n_a", "n_b", "n_groups", "n_links"]
_NAMES = ["block", "place", "doc_id", *_DOC, "groups_sha256", "pair", "n_docs", "n_pair_links", "bits"]


def inverted(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Both kinds of rows of one pass over the texts: documents (block, place,
    doc_id, n_a, n_b, n_groups, n_links, groups_sha256) and, where ``pair`` is not
    null, postings (block, pair, n_docs, n_pair_links, bits)."""
    spark = docs.sparkSession
    spec, known = a_model(a_path)
    with open(b_path, "rb") as f:
        proto = f.read()
    # Vocabularies and a byte for each code point: sizes that don't grow with the data.
    shared = spark.sparkContext.broadcast((spec, known, proto, bpe.char_classes()))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _aligner(shared)
        block, n_docs, held, n_held = TaskContext.get().partitionId() << 24, 0, [], 0
        for batch in batches:
            at = 0
            for some in bpe._calls([t or "" for t in batch.column(1).to_pylist()]):
                use = [i for i, t in enumerate(some) if t]
                good, n_a, n_b, n_groups, n_links, shas, text, pair = tool.align([" " + some[i] for i in use])
                told = np.zeros((len(_DOC), len(some)), np.int64)
                told[:, use] = n_a, n_b, n_groups, n_links
                sha = [""] * len(some)
                for i, x in zip(use, shas, strict=True):
                    sha[i] = x
                spot = n_docs + np.array(use, np.int64)[text] if use else np.zeros(0, np.int64)
                (some_pairs, spots), times = _counted(pair, spot)
                held.append((some_pairs, spots, times))
                n_held += len(times)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), block)), pa.array(np.arange(n_docs, n_docs + len(some), dtype=np.int32)),
                        batch.column(0).slice(at, len(some)), *[pa.array(x) for x in told], pa.array(sha, pa.string()),
                        *[pa.nulls(len(some), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())],
                    ],
                    _NAMES,
                )
                at += len(some)
                n_docs += len(some)
                if n_docs >= BLOCK_DOCS or n_held >= BLOCK_ENTRIES:
                    yield from _postings(block, held, n_docs, kind_arrow)
                    block, n_docs, held, n_held = block + 1, 0, [], 0
        if held:
            yield from _postings(block, held, n_docs, kind_arrow)

    kind_arrow = to_arrow_type(rows.schema["doc_id"].dataType)
    schema = (
        f"block long, place int, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pair long, n_docs long, n_pair_links long, bits binary"
    )
    return rows.mapInArrow(work, schema)


def _counted(pair: np.ndarray, spot: np.ndarray):
    """Distinct (pair, document), sorted, and how often each occurs."""
    order = np.lexsort((spot, pair))
    pair, spot = pair[order], spot[order]
    new = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (spot[1:] != spot[:-1]))) if len(pair) else np.zeros(0, np.int64)
    return (pair[new], spot[new]), np.diff(np.append(new, len(pair)))


def _postings(block: int, held: list, n_docs: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    pair, doc, times = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(pair, kind="stable")  # documents came in order
    pairs, at, words = compressed(pair[order], doc[order], times[order], n_docs)
    n_pair_docs, links = popcounts(words, at[:-1], at[1:])
    bits = pa.Array.from_buffers(
        pa.binary(), len(pairs), [None, pa.py_buffer((2 * at).astype(np.int32)), pa.py_buffer(words)]
    )
    n = len(pairs)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, block)), pa.nulls(n, pa.int32()), pa.nulls(n, kind), *[pa.nulls(n, pa.int64())] * 4,
            pa.nulls(n, pa.string()), pa.array(pairs), pa.array(n_pair_docs), pa.array(links), bits,
        ],
        _NAMES,
    )


def pair_counts(postings: DataFrame) -> DataFrame:
    """(pair, a, b, n_docs, n_links, best): in how many documents each pair is
    linked, how often, and whether no pair of its B id is linked more often."""
    counts = postings.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_pair_links").alias("n_links"))
    counts = stored(
        counts.withColumn("a", F.floor(F.col("pair") / WIDTH).cast("long")).withColumn("b", F.col("pair") % WIDTH), "pairs"
    )
    top = counts.groupBy("b").agg(F.max("n_links").alias("_top"))
    told = counts.join(top, "b")
    return told.select("pair", "a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("_top")).alias("best"))


def returned(postings: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, place, n_best, count_sum): the pairs' counts summed over each
    document's links, by way of the postings; a block's rows meet in one task,
    and there are no more of them than a block has entries."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, None
        for batch in batches:
            block = np.asarray(batch.column(0))
            score, best = np.asarray(batch.column(1)), np.asarray(batch.column(2).cast(pa.int64()))
            words, starts, ends = _words_of(batch.column(3))
            edge = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            for a, b in pairwise([*edge.tolist(), len(block)]):
                if block[a] != now:
                    if now is not None:
                        yield _sums(now, sums)
                    now, sums = block[a], np.zeros((2, 1 << 16), np.int64)
                for value, row, doc in expanded(words, starts[a:b], ends[a:b]):
                    np.add.at(sums[0], doc, value * best[a + row])
                    np.add.at(sums[1], doc, value * score[a + row])
        if now is not None:
            yield _sums(now, sums)

    joined = postings.select("block", "pair", "bits").join(counts.select("pair", "n_links", "best"), "pair")
    dealt = joined.select("block", "n_links", "best", "bits").repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(add, "block long, place int, n_best long, count_sum long")


def _sums(block: int, sums: np.ndarray) -> pa.RecordBatch:
    place = np.flatnonzero(sums[1])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(place), block)), pa.array(place.astype(np.int32)), pa.array(sums[0][place]), pa.array(sums[1][place])],
        ["block", "place", "n_best", "count_sum"],
    )


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best`` (links whose pair has its B id's highest count, ties included),
    ``count_sum`` (the pair's count, summed over links), ``groups_sha256``.

    Both encode a space and the text. Texts that are null or empty, or that the
    tokens of either do not give back, have zeros and ''. Repeated rows count as
    often as they occur; a null id is kept."""
    both = stored(inverted(docs, a_path, b_path, id_col, text_col), "inverted")
    postings = both.filter("pair IS NOT NULL").select("block", "pair", "n_docs", "n_pair_links", "bits")
    counts = stored(pair_counts(postings), "counts")
    sums = stored(returned(postings, counts), "sums")
    removed(counts)
    rows = both.filter("pair IS NULL").select("block", "place", "doc_id", *_DOC, "groups_sha256")
    out = rows.join(sums, ["block", "place"], "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return out.select("doc_id", *_DOC, *zero, "groups_sha256")
