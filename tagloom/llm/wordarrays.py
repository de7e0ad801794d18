"""Words of Arrow text columns as NumPy arrays: places and hashes, without a
Python object per word. Used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time; a longer text is worked on alone.
SLICE_BYTES = 2 << 20

_U = np.uint64
#: Odd multipliers; fixed, so that a task that runs again does the same.
_STEP, _MIX, _FINAL = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)

#: Which bytes belong to words, for ``[^\x20\x09-\x0D]+`` and for
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
NOT_SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
ALNUM = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in row ranges of about SLICE_BYTES of text."""
    ends = np.cumsum(text_sizes(batch.column(text)))
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def text_sizes(column: pa.Array) -> np.ndarray:
    """Bytes of each text; null has none."""
    return np.diff(_offsets(column))


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    got = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
    return got.astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes end to end and their len + 1 places. No nulls."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = _offsets(column)
    buffer = column.buffers()[2]
    if buffer is None:
        return np.zeros(0, np.uint8), np.zeros(len(at), np.int64)
    return np.frombuffer(buffer, np.uint8)[at[0] : at[-1]], at - at[0]


class Words:
    """``data`` (bytes), ``starts`` and ``ends`` of each word, ``row`` of each word
    and ``first``: the first word of each row, and the number of words."""

    def __init__(self, column: pa.Array, table: np.ndarray, lower: bool = False):
        data, at = text_bytes(column)
        self.data = LOWER[data] if lower else data
        n = len(data)
        inside = table[self.data]
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        begins = inside & (~before | edge[:n])
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        stops = inside & (~after | edge[1:])
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, at)
        self.row = np.repeat(np.arange(len(column)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes: a polynomial, by differences of its
        running sum over all bytes, shifted back to the word's start."""
        if not len(self):
            return np.zeros(0, _U)
        power, inverse = _powers(len(self.data))
        with np.errstate(over="ignore"):
            total = np.zeros(len(self.data) + 1, _U)
            np.cumsum((self.data + _ONE) * power[: len(self.data)], out=total[1:])
            x = (total[self.ends] - total[self.starts]) * inverse[self.starts]
            return mixed(x + (self.ends - self.starts).astype(_U))

    def runs(self, n: int) -> np.ndarray:
        """Where ``n`` consecutive words of one row start."""
        if len(self) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.row[n - 1 :] == self.row[: len(self) - n + 1])


_ONE = np.uint16(1)
_TABLES: list[np.ndarray] = [np.ones(0, _U), np.ones(0, _U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _STEP and of its inverse modulo 2^64, at least ``n`` of each; kept
    for slices of the usual size."""
    if n <= len(_TABLES[0]):
        return _TABLES[0], _TABLES[1]
    size = max(n, 2 * SLICE_BYTES)
    made = []
    for base in (_STEP, _U(pow(int(_STEP), -1, 1 << 64))):
        table = np.full(size, base, _U)
        table[0] = 1
        with np.errstate(over="ignore"):
            made.append(np.cumprod(table, out=table))
    if size <= 8 * SLICE_BYTES:
        _TABLES[:] = made
    return made[0], made[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """``x`` (uint64) scrambled so that all bits depend on all."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _MIX
        x = (x ^ (x >> _U(27))) * _FINAL
        return x ^ (x >> _U(31))


def joined_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each ``n`` consecutive entries of ``words``, whatever their rows."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        out = words[:m].copy()
        for k in range(1, n):
            out = out * _STEP + words[k : k + m]
    return mixed(out)


def spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (counts[0] of them), first[1], ..."""
    before = np.cumsum(counts) - counts
    return np.repeat(first - before, counts) + np.arange(int(counts.sum()))
