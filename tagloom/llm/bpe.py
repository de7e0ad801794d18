"""Byte-level BPE encoding and decoding with the tokenizers library.

A rank file (token bytes and rank, one a line) becomes a vocabulary and its
merges: the two parts that a token last consists of when its bytes are merged
by rank. Text is split by the pattern, bytes are mapped to characters, and
Arrow batches are encoded in the executors; decoding reverses the byte table,
so a character that is split over tokens comes back whole.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.store import text_or_empty

#: Characters of text that one call of the library encodes.
CALL_CHARS = 1 << 20
#: Distinct pieces that a worker remembers.
KNOWN_PIECES = 400_000
#: Fixed value: the pattern whose matches are encoded separately.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_table() -> list[str]:
    """The character for each byte: printable Latin-1 bytes stand for themselves,
    the others take the code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def last_parts(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The parts of ``token`` before its last merge; more than two if merging by
    rank never reaches the whole token."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best = min(
            ((r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None),
            default=None,
        )
        if best is None:
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """The library's own description of the model, to send to the executors. It
    gets text that is split and mapped to characters already."""
    chars = byte_table()
    shown = {token: "".join(chars[b] for b in token) for token in ranks}
    ordered = sorted(ranks, key=ranks.get)
    merges = []
    for token in ordered:
        if len(token) > 1 and len(parts := last_parts(token, ranks)) == 2:
            merges.append([shown[parts[0]], shown[parts[1]]])
    # A piece that is a token by itself is that token, whatever merges give.
    model = {"type": "BPE", "vocab": {shown[t]: ranks[t] for t in ordered}, "merges": merges, "ignore_merges": True}
    none = dict.fromkeys(("normalizer", "pre_tokenizer", "post_processor", "decoder"))
    return json.dumps({"version": "1.0", "added_tokens": [], **none, "model": model})


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    """The byte table reversed: bytes by id."""
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def char_classes() -> np.ndarray:
    """For each code point: 0 white space, 1 letter, 2 number, 3 anything else."""
    import regex

    points = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)))
    out = np.full(0x110000, 3, np.uint8)
    for k, name in enumerate((r"\s", r"\p{L}", r"\p{N}")):
        for run in regex.finditer(f"{name}+", points):
            out[ord(run[0][0]) : ord(run[0][-1]) + 1] = k
    out[0xD800:0xE000] = 3
    return out


def piece_starts(points: np.ndarray, starts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where ``PATTERN``'s matches start in code points of texts set end to end;
    ``starts`` are the texts' first points. A run of one class is a piece; one
    space before a run of another class belongs to that run, other white space
    before it ends one character early; a suffix after an apostrophe that starts
    a piece goes with the apostrophe."""
    n = len(points)
    kind = classes[points]
    first = np.zeros(n + 1, bool)
    first[starts] = True
    first[n] = True
    run = first.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    cut = run[:n].copy()
    white = kind == 0
    # The last character of white space that something follows in the same text.
    last = np.flatnonzero(white[:-1] & run[1:n] & ~first[1:n]) if n else np.zeros(0, int)
    cut[last] = True
    joined = last[points[last] == 32] + 1
    cut[joined] = first[joined]
    mark = np.flatnonzero((points == 39) & cut)  # an apostrophe that starts a piece
    if len(mark):
        far = np.append(points, [0, 0])
        ends = np.flatnonzero(first)
        room = ends[np.searchsorted(ends, mark, "right")] - mark
        a, b = far[mark + 1], far[mark + 2]
        pair = lambda x, y: (a == ord(x)) & (b == ord(y)) & (room > 2)
        two = pair("r", "e") | pair("v", "e") | pair("l", "l")
        one = np.isin(a, [ord(c) for c in "stmd"]) & (room > 1)
        for which, size in ((one, 2), (two & ~one, 3)):
            at = mark[which]
            cut[at + 1] = False
            rest = at + size
            rest = rest[rest < n]
            # what follows the suffix starts a piece, unless a space takes that over
            cut[rest] = True
    return np.flatnonzero(cut)


class Encoder:
    """Encodes batches of texts: each distinct piece goes through the library
    once, and the ids of all pieces are gathered from the table of known ones."""

    def __init__(self, spec: str, classes: np.ndarray, known: list[bytes]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok, self.classes = Tokenizer.from_str(spec), classes
        self.chars = {b: c for b, c in enumerate(byte_table())}
        self.bytes_flat = np.frombuffer(b"".join(known), np.uint8)
        self.byte_len = np.array([len(x) for x in known], np.int64)
        self.byte_at = np.cumsum(self.byte_len) - self.byte_len
        # Odd multipliers, fixed so that a task that runs again does the same.
        self.step = np.uint64(0x9E3779B97F4A7C15)
        self.forget()

    def forget(self):
        self.places: dict[int, int] = {}
        self.counts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def learn(self, pieces: list[str], keys: list[int]) -> None:
        mapped = [p.encode().decode("latin-1").translate(self.chars) for p in pieces]
        made = [e.ids for e in self.tok.encode_batch_fast(mapped, add_special_tokens=False)]
        self.places.update(zip(keys, range(len(self.counts), len(self.counts) + len(keys)), strict=True))
        self.counts = np.append(self.counts, [len(x) for x in made])
        self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(made), np.uint32))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each text's first place in them (and the
        end), the pieces' first code points and numbers of tokens."""
        data = "".join(texts)
        points = np.frombuffer(data.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(x) for x in texts], np.int64)
        ends = np.cumsum(sizes)
        starts = (ends - sizes)[sizes > 0]
        cuts = piece_starts(points, starts, self.classes)
        if len(self.places) > KNOWN_PIECES:
            self.forget()
        stops = np.append(cuts[1:], len(points))
        keys = piece_hashes(points, cuts, stops, self.step)
        distinct, at, which = np.unique(keys, return_index=True, return_inverse=True)
        known = distinct.tolist()
        new = [i for i, k in enumerate(known) if k not in self.places]
        if new:
            self.learn([data[cuts[i] : stops[i]] for i in at[new].tolist()], [known[i] for i in new])
        place = np.array([self.places[k] for k in known], np.int64)[which]
        counts = self.counts[place]
        ids = self.ids[spread((np.cumsum(self.counts) - self.counts)[place], counts)]
        total = np.append(0, np.cumsum(counts))
        bounds = total[np.searchsorted(cuts, np.append(ends - sizes, len(points)))]
        return ids, bounds, cuts, counts

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids and where each id's bytes end."""
        sizes = self.byte_len[ids]
        return self.bytes_flat[spread(self.byte_at[ids], sizes)], np.cumsum(sizes)


def spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (counts[0] of them), first[1], ..."""
    before = np.cumsum(counts) - counts
    return np.repeat(first - before, counts) + np.arange(int(counts.sum()))


def piece_hashes(points: np.ndarray, starts: np.ndarray, stops: np.ndarray, step: np.uint64) -> np.ndarray:
    """A 64-bit key for each piece. That ids decode to the text is checked, so an
    accident of equal keys can't pass."""
    with np.errstate(over="ignore"):
        x = points.astype(np.uint64) + np.uint64(1)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        place = np.arange(len(points), dtype=np.int64) - np.repeat(starts, stops - starts)
        power = np.cumprod(np.full(int(place.max(initial=0)) + 1, step))
        x *= power[place]
        out = np.add.reduceat(x, starts) if len(starts) else np.zeros(0, np.uint64)
        return out ^ ((stops - starts).astype(np.uint64) * np.uint64(0x94D049BB133111EB))


_MADE: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    """The encoder of a broadcast (spec, classes, known), once in each worker."""
    spec, classes, known = shared.value
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Encoder(spec, classes, known)
    return _MADE[key]


def _share(spark, ranks: dict[bytes, int]):
    # The vocabulary and a byte for each code point: sizes that don't grow with the data.
    return spark.sparkContext.broadcast((tokenizer_json(ranks), char_classes(), token_bytes(ranks)))


def _calls(texts: list[str]) -> Iterator[list[str]]:
    some, chars = [], 0
    for text in texts:
        some.append(text)
        chars += len(text)
        if chars >= CALL_CHARS:
            yield some
            some, chars = [], 0
    if some:
        yield some


def encode(
    docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text", offsets: bool = False
) -> DataFrame:
    """One row per input row: ``doc_id``, ``ids`` (array of int) and, on request,
    ``starts`` and ``ends``: code points of each token; a token that is a part of
    a character spans that whole character. Null and empty texts have no ids."""
    shared = _share(docs.sparkSession, ranks)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(shared)
        for batch in rows:
            at = 0
            for some in _calls(batch.column(1).to_pylist()):
                ids, bounds, _, _ = coder.encode(some)
                lists = lambda x, to=bounds: pa.ListArray.from_arrays(to.astype(np.int32), pa.array(x, pa.int32()))
                cols = [batch.column(0).slice(at, len(some)), lists(ids.astype(np.int32))]
                if offsets:
                    data, stop = coder.decode(ids)
                    char = np.cumsum((data & 0xC0) != 0x80)  # the character that each byte is a part of, from 1
                    begin = np.append(0, stop[:-1])[: len(ids)]
                    chars = np.cumsum([0, *map(len, some)])
                    base = np.repeat(chars[:-1], np.diff(bounds))
                    cols += [lists(char[begin] - 1 - base), lists(char[stop - 1] - base)]
                at += len(some)
                yield pa.RecordBatch.from_arrays(cols, names)

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    names = ["doc_id", "ids"] + ["starts", "ends"] * offsets
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"doc_id {kind}, ids array<int>" + ", starts array<int>, ends array<int>" * offsets)


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``data``, the bytes of the ids in order, and
    ``text``, those bytes as UTF-8 with a replacement mark for broken characters."""
    table = encoded.sparkSession.sparkContext.broadcast(token_bytes(ranks))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table.value
        for batch in rows:
            data = [b"".join([known[i] for i in ids or ()]) for ids in batch.column(1).to_pylist()]
            text = [x.decode("utf-8", "replace") for x in data]
            cols = [*batch.columns, pa.array(data, pa.binary()), pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "ids", "data", "text"])

    rows = encoded.select("doc_id", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"doc_id {kind}, ids array<int>, data binary, text string")


def round_trip(
    docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Encoding and decoding in one pass: ``doc_id``, ``n_tokens``, ``ids_sha256``,
    ``decoded_sha256`` and, on request, ``ids``. Null texts are empty. Ids that
    don't decode to the text's bytes end the job."""
    shared = _share(docs.sparkSession, ranks)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(shared)
        for batch in rows:
            at = 0
            for some in _calls(batch.column(1).to_pylist()):
                ids, bounds, _, _ = coder.encode(some)
                data, stop = coder.decode(ids)
                if data.tobytes() != "".join(some).encode():
                    raise ValueError("ids do not decode to their texts")
                stop = np.append(0, stop)[bounds].tolist()
                wide, tell = ids.astype("<u4"), bounds.tolist()
                ids_sha = [hashlib.sha256(wide[a:b]).hexdigest() for a, b in pairwise(tell)]
                out_sha = [hashlib.sha256(data[a:b]).hexdigest() for a, b in pairwise(stop)]
                cols = [batch.column(0).slice(at, len(some)), pa.array(np.diff(bounds)), pa.array(ids_sha), pa.array(out_sha)]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(ids.astype(np.int32))))
                at += len(some)
                yield pa.RecordBatch.from_arrays(cols, names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return rows.mapInArrow(batches, schema)
