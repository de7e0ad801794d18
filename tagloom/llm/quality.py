"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting visits the features in turn; each visit fits a shallow tree to
the loss's gradients over that feature's bins and adds a part of it to the
feature's lookup table. Then the pairs of features that explain most of what is
left get tables of their own, learnt the same way from one cut on each axis. A
score is the sum of a row's table entries, so scoring is a few look-ups a row.

The tables are learnt on the driver from a bounded sample of labelled rows'
features; features and scores are computed for all rows by the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.store import stored, text_or_empty
from tagloom.llm.wordarrays import NOT_SPACE, Words, joined_hashes, slices

#: Labelled rows that the tables are learnt from at most: those with the least
#: hash of their id. More rows don't change tables of this size.
TRAIN_ROWS = 20_000
#: Rows with this remainder of crc32(id as text) are never learnt from.
FOLDS, HELD_OUT = 5, 0
KEEP_SCORE = 0.3
BINS, PAIR_BINS, ROUNDS, PAIRS, PAIR_ROUNDS, RATE = 32, 8, 150, 10, 60, 0.1
#: Weight of a prior second derivative, against extreme leaves.
RIDGE = 1.0

FEATURES = [
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "marks", "odd_marks", "bars", "wide", "stops",
    "distinct_words", "distinct_pairs", "same_next", "short_words", "upper_words", "marked_words", "line_words",
    "distinct_lines", "longest_word", "sentence_words",
]


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _table("0123456789")
_ODD = _table("#$%&*@^~_=+<>{}[]\\/!")
_BAR, _STOP = _table("|"), _table(".?!")
_MARK = np.array([33 <= b <= 126 and not chr(b).isalnum() for b in range(256)])
_WIDE = np.array([b >= 0x80 for b in range(256)])


def _distinct(row: np.ndarray, key: np.ndarray, m: int) -> np.ndarray:
    """Distinct keys of each row."""
    by = np.lexsort((key, row))
    row, key = row[by], key[by]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return np.bincount(row[new], minlength=m).astype(float)


def text_features(column: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for each text; shares of nothing are 0."""
    m = len(column)
    words = Words(column, NOT_SPACE)
    data = words.data
    sizes = np.diff(_places(column))
    of = np.repeat(np.arange(m), sizes)
    bytes_, n = sizes.astype(float), np.diff(words.first).astype(float)
    share = lambda x, y: np.divide(x, y, out=np.zeros(m), where=y > 0)
    count = lambda table: np.bincount(of, weights=table[data], minlength=m)
    length = words.ends - words.starts
    hashes = words.hashes()
    pair = words.runs(2)
    row = words.row
    per_word = lambda flag: np.bincount(row, weights=flag, minlength=m)
    first, last = data[words.starts], data[words.ends - 1]
    lines = np.bincount(of, weights=data == 10, minlength=m) + 1
    line = np.zeros(len(words), np.int64)
    if len(words):
        # Words of one line share a number; a line's key is the sum of its words' hashes by place.
        line = np.cumsum(data == 10)[words.starts] + 2 * row
        new = np.ones(len(words), bool)
        new[1:] = (line[1:] != line[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        place = np.arange(len(words)) - np.repeat(at, np.diff(np.append(at, len(words))))
        with np.errstate(over="ignore"):
            line_key = np.add.reduceat(hashes * (2 * place + 1).astype(np.uint64), at)
        distinct_lines = share(_distinct(row[at], line_key, m), np.bincount(row[at], minlength=m).astype(float))
    else:
        distinct_lines = np.zeros(m)
    longest = np.zeros(m)
    np.maximum.at(longest, row, length)
    pairs = np.bincount(row[pair], minlength=m).astype(float)
    stops = count(_STOP)
    columns = [
        np.log1p(bytes_), np.log1p(n), share(per_word(length), n), share(count(_UPPER), bytes_),
        share(count(_DIGIT), bytes_), share(count(_MARK), bytes_), share(count(_ODD), bytes_),
        share(count(_BAR), n), share(count(_WIDE), bytes_), share(stops, n),
        share(_distinct(row, hashes, m), n), share(_distinct(row[pair], joined_hashes(hashes, 2)[pair], m), pairs),
        share(np.bincount(row[pair], weights=hashes[pair] == hashes[pair + 1], minlength=m) if len(pair) else np.zeros(m), pairs),
        share(per_word(length <= 3), n), share(per_word(_UPPER[first]), n), share(per_word(_MARK[last]), n),
        share(n, lines), distinct_lines, np.log1p(longest), share(n, stops + 1),
    ]
    return np.stack(columns, axis=1)


def _places(column: pa.Array) -> np.ndarray:
    from tagloom.llm.wordarrays import text_bytes

    return text_bytes(column)[1]


@dataclass
class Model:
    """Score tables. ``edges``: cuts of each feature; ``tables``: a value a bin;
    ``pairs``: (i, j, values by coarse bins); ``coarse``: coarse cuts."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edges, x[:, k], "right")]
        for i, j, table in self.pairs:
            a = np.searchsorted(self.coarse[i], x[:, i], "right")
            b = np.searchsorted(self.coarse[j], x[:, j], "right")
            out += table[a, b]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="inverted_cdf"))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values for each bin of the tree of ``depth`` that best fits gradient sums
    ``g`` and ``h`` over ordered bins."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    total_g, total_h = g.sum(), h.sum()
    if depth and len(g) > 1:
        gains = _gain(left_g, left_h) + _gain(total_g - left_g, total_h - left_h)
        at = int(np.argmax(gains))
        if gains[at] > _gain(total_g, total_h) + 1e-9:
            return np.append(_tree(g[: at + 1], h[: at + 1], depth - 1), _tree(g[at + 1 :], h[at + 1 :], depth - 1))
    return np.full(len(g), -total_g / (total_h + RIDGE))


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best single cut on each axis for sums over a grid: gain and values."""
    best, values = 0.0, np.zeros_like(g)
    cg, ch = (np.cumsum(np.cumsum(x, 0), 1) for x in (g, h))
    for i in range(g.shape[0] - 1):
        for j in range(g.shape[1] - 1):
            parts = []
            for c in (cg, ch):
                a, b, d, e = c[i, j], c[i, -1], c[-1, j], c[-1, -1]
                parts.append(np.array([[a, b - a], [d - a, e - b - d + a]]))
            gain = _gain(*parts).sum()
            if gain > best:
                best = gain
                leaf = -parts[0] / (parts[1] + RIDGE)
                rows = (np.arange(g.shape[0]) > i).astype(int)
                cols = (np.arange(g.shape[1]) > j).astype(int)
                values = leaf[np.ix_(rows, cols)]
    return best, values


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Learn the tables from rows ``x`` with labels ``y`` (0 or 1). Without rows
    every score is one half; with one label only, scores lean to it."""
    model = Model()
    if not len(x):
        return model
    share = (y.sum() + 1) / (len(y) + 2)
    model.base = float(np.log(share / (1 - share)))
    model.edges = [_cuts(col, BINS) for col in x.T]
    model.coarse = [_cuts(col, PAIR_BINS) for col in x.T]
    fine = [np.searchsorted(e, col, "right") for e, col in zip(model.edges, x.T, strict=True)]
    rough = [np.searchsorted(e, col, "right") for e, col in zip(model.coarse, x.T, strict=True)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    margin = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-margin))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for k, bins in enumerate(fine):
            g, h = slopes()
            size = len(model.tables[k])
            step = RATE * _tree(np.bincount(bins, g, size), np.bincount(bins, h, size))
            model.tables[k] += step
            margin += step[bins]

    def grid(i, j):
        g, h = slopes()
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        flat = rough[i] * shape[1] + rough[j]
        sums = [np.bincount(flat, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)]
        return flat, shape, _quadrants(*sums)

    gains = sorted(
        ((-grid(i, j)[2][0], i, j) for i in range(x.shape[1]) for j in range(i + 1, x.shape[1])), key=lambda t: t
    )
    chosen = {(i, j): None for gain, i, j in gains[:PAIRS] if gain < 0}
    for _ in range(PAIR_ROUNDS):
        for i, j in chosen:
            flat, shape, (_, values) = grid(i, j)
            step = RATE * values
            chosen[i, j] = step if chosen[i, j] is None else chosen[i, j] + step
            margin += step.reshape(-1)[flat]
    model.pairs = [(i, j, table) for (i, j), table in chosen.items() if table is not None]
    return model


def held_out(id_col: str):
    """Whether a row's label is never learnt from; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, features) of every row; null texts are empty."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch, 1):
                x = text_features(part.column(1))
                at = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
                lists = pa.ListArray.from_arrays(at, pa.array(x.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "features"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"doc_id {kind}, features array<double>")


def train(known: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """Learn from at most ``rows`` rows of ``known`` (doc_id, features) that have a
    label of 0 or 1 and are not held out, taken in the order of a hash of their id.
    A label given twice for one id counts once, the larger of them."""
    marks = (
        labels.filter(F.col(label_col).isin(0, 1) & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max(label_col).alias("_label"))
    )
    # The hash as a number in [0, 1): about 1.5 times the rows wanted lie below
    # the cut, so that only so many are ordered, however many have labels.
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)
    both = known.join(marks, "doc_id").withColumn("_place", place)
    cut = 1.5 * rows / max(1, both.count())
    sample = both.filter(F.col("_place") < cut).orderBy("_place", "doc_id").limit(rows)
    got = sample.select("features", "_label").collect()  # TRAIN_ROWS rows of FEATURES numbers
    x = np.array([r[0] for r in got], float).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r[1] for r in got], float))


def score(known: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for ``known`` (doc_id, features)."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["doc_id", "score"])

    kind = known.schema["doc_id"].dataType.simpleString()
    return known.select("doc_id", "features").mapInArrow(batches, f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``score`` (0 to 1, higher:
    good), ``predicted`` (1 from ``KEEP_SCORE`` on, else 0). Scores come from the
    text alone; an empty or null text is scored as one of no words."""
    known = stored(features(docs, id_col, text_col), "features")
    model = train(known, labels)
    return score(known, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject."""
    model = train(stored(features(docs, id_col, text_col), "features"), labels)
    at = docs.columns.index(text_col)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = batch.column(at).fill_null("")
            whole = pa.RecordBatch.from_arrays([texts, pa.array(np.arange(batch.num_rows))], ["text", "i"])
            good = [model.score(text_features(part.column(0))) >= KEEP_SCORE for part in slices(whole, 0)]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))

    return docs.mapInArrow(batches, docs.schema)
