"""Language identification by bit-sliced Bloom filters over character n-grams.

Learning counts the n-grams of all training texts by language in one grouped
aggregate. A language's filter holds the n-grams that are typical of it: those
whose share of its n-grams is at least ``SHARE`` of the largest such share. All
filters use the same ``SLOTS`` places, and the filters are stored by place: a
place's row is a mask with a bit for each language. The rows at an n-gram's
``HASHES`` places, ANDed, give the mask of all languages that contain it.

A text's popcount for a language is the number of its n-grams whose mask has the
language's bit. A filter with a share ``fill`` of its bits set answers yes by
accident with probability fill^HASHES; the popcounts are corrected for that, and
the largest decides. The model is SLOTS masks, whatever the amount of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.bpe import char_classes
from tagloom.llm.store import removed, stored
from tagloom.llm.wordarrays import joined_hashes, mixed, slices

#: Lengths of the n-grams, a mark for the word's edge included.
ORDERS = (2, 3, 4, 5)
#: Places of a filter; a multiple of the 32,768 bits of one of Spark's bitmaps.
SLOTS = 1 << 22
HASHES = 2
#: A language holds an n-gram whose share in it is at least this part of the largest share in any.
SHARE = 0.5
#: What is predicted for texts without letters.
UNDETERMINED = "und"
#: Rows of documents whose hash leaves this rest are held out of learning.
FOLDS, HELD_OUT = 4, 2

_BITS = 32_768
_U = np.uint64
_SALT = _U(0xD6E8FEB86659FD93)


def held_out(id_col: str):
    """Whether a row is held out: crc32 of the id as text (null: empty) modulo 4 is 2."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % FOLDS == HELD_OUT


def _grams(column: pa.Array, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order: the n-grams' hashes, which are n-grams of one word, and the
    first place of each row. Texts are lower-cased; anything but a letter is an
    edge, and an n-gram has edges at its ends only."""
    texts = [" " + (t or "").lower() + " " for t in column.to_pylist()]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    letter = letters[points]
    codes = mixed(np.where(letter, points, 0).astype(_U) + _U(1))
    for n in ORDERS:
        m = max(len(points) - n + 1, 0)
        inside = np.ones(m, bool)
        for k in range(1, n - 1):
            inside &= letter[k : k + m]
        if n == 2:
            inside &= letter[:m] | letter[1 : 1 + m]
        keys = joined_hashes(codes, n)
        with np.errstate(over="ignore"):
            yield keys + _U(n), inside, np.minimum(first, m)


def _places(keys: np.ndarray, slots: int) -> list[np.ndarray]:
    out = []
    for k in range(HASHES):
        with np.errstate(over="ignore"):
            out.append((mixed(keys + _SALT * _U(k + 1)) & _U(slots - 1)).astype(np.int64))
    return out


def gram_counts(rows: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, gram, n): how often each n-gram (by its hash) occurs in each language."""
    shared = rows.sparkSession.sparkContext.broadcast(char_classes() == 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                langs = part.column(0).dictionary_encode()
                names, code = langs.dictionary, np.asarray(langs.indices)
                for keys, inside, first in _grams(part.column(1), letters):
                    row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
                    kept, of = keys[inside], code[row[inside]]
                    for c in range(len(names)):
                        found, n = np.unique(kept[of == c] if len(names) > 1 else kept, return_counts=True)
                        who = pa.array([names[c].as_py()], pa.string()).take(pa.array(np.zeros(len(found), np.int32)))
                        yield pa.RecordBatch.from_arrays(
                            [who, pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"]
                        )

    texts = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    found = texts.mapInArrow(count, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def typical(counts: DataFrame) -> DataFrame:
    """(lang, gram) of the n-grams that each language's filter holds."""
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))  # a row for each language
    shares = counts.join(F.broadcast(totals), "lang").select("gram", "lang", (F.col("n") / F.col("total")).alias("p"))
    by_gram = shares.groupBy("gram").agg(F.max("p").alias("top"), F.collect_list(F.struct("lang", "p")).alias("all"))
    held = F.filter("all", lambda x: x["p"] >= F.col("top") * SHARE)
    return by_gram.select("gram", F.explode(held).alias("x")).select("x.lang", "gram")


@dataclass
class Filters:
    """``langs`` in order, ``masks`` (slots x bytes: bit l of a row is language l),
    ``accident``: each filter's probability of a wrong yes, ``common``: the
    language with most training text, for texts that no filter knows."""

    langs: list[str]
    masks: np.ndarray
    accident: np.ndarray
    common: int

    def popcounts(self, keys: np.ndarray, inside: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rows x languages: how many n-grams of a row each filter holds."""
        size = np.diff(np.append(first, len(keys)))
        out = np.zeros((len(first), len(self.langs)), np.int64)
        full = np.flatnonzero(size)
        if not len(full):
            return out
        a, *rest = _places(keys, len(self.masks))
        for byte in range(self.masks.shape[1]):
            column = self.masks[:, byte]
            mask = column[a]
            for b in rest:
                mask &= column[b]
            mask[~inside] = 0
            for bit in range(min(8, len(self.langs) - 8 * byte)):
                out[full, 8 * byte + bit] = np.add.reduceat((mask >> bit) & 1, first[full], dtype=np.int64)
        return out


def learn(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", slots: int = SLOTS) -> Filters:
    """The filters of all languages in ``rows``. The driver gets SLOTS bits for each
    language and one row a language besides."""
    counts = stored(gram_counts(rows, lang_col, text_col), "grams")
    sizes = sorted((r["lang"], r["total"]) for r in counts.groupBy("lang").agg(F.sum("n").alias("total")).collect())
    langs = [name for name, _ in sizes]
    code = F.create_map(*[F.lit(x) for i, name in enumerate(langs) for x in (name, i)]) if langs else F.lit(None)
    masks = np.zeros((slots, max(1, -(-len(langs) // 8))), np.uint8)
    fill = np.zeros(len(langs))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column(1)).view(_U)
            for at in _places(keys, slots):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at)], ["code", "place"])

    if langs:
        held = typical(counts).select(code[F.col("lang")].alias("code"), "gram")
        bits = held.mapInArrow(places, "code int, place long").select(
            "code", F.floor(F.col("place") / _BITS).cast("int").alias("part"), (F.col("place") % _BITS).cast("long").alias("bit")
        )
        for r in bits.groupBy("code", "part").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
            on = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
            at = r["part"] * _BITS
            masks[at : at + _BITS, r["code"] // 8] |= (on << (r["code"] % 8)).astype(np.uint8)
            fill[r["code"]] += on.sum() / slots
    removed(counts)
    common = max(range(len(sizes)), key=lambda i: (sizes[i][1], -i), default=-1)
    return Filters(langs, masks, fill**HASHES, common)


def predict(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``lang_pred``, ``score`` (the
    corrected share of the text's n-grams that the predicted language holds) and
    ``n_grams``. A text that is null or has no letter is ``und`` with score 0, as
    is every text when nothing was learnt; letters that no filter knows give the
    language with most training text, with score 0. Ties go to the language
    that comes first by name. A null id counts as the empty text."""
    shared = docs.sparkSession.sparkContext.broadcast((filters, char_classes() == 1))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, letters = shared.value
        names = pa.array([*model.langs, UNDETERMINED], pa.string())
        for batch in batches:
            for part in slices(batch, 2):
                hits = np.zeros((part.num_rows, len(model.langs)))
                total = np.zeros(part.num_rows, np.int64)
                for keys, inside, first in _grams(part.column(2), letters):
                    hits += model.popcounts(keys, inside, first)
                    seen = np.append(0, np.cumsum(inside))
                    total += np.diff(np.append(seen[first], seen[-1]))
                sure = np.maximum(hits - total[:, None] * model.accident, 0.0) / np.maximum(1.0 - model.accident, 1e-9)
                none = (total == 0) | (not model.langs)
                best = sure.argmax(axis=1) if model.langs else np.zeros(part.num_rows, np.int64)
                top = sure[np.arange(len(best)), best] if model.langs else np.zeros(part.num_rows)
                best = np.where(none, len(model.langs), np.where(top > 0, best, model.common))
                score = np.where(none, 0.0, np.minimum(top / np.maximum(total, 1), 1.0))
                cols = [part.column(0), part.column(1), names.take(pa.array(best)), pa.array(score), pa.array(total)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "lang_pred", "score", "n_grams"])

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(decide, f"doc_id {kind}, held_out boolean, lang_pred string, score double, n_grams long")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", slots: int = SLOTS) -> DataFrame:
    """Learn from the rows of ``docs`` that are not held out and have a language,
    and predict all rows (``predict``)."""
    return predict(docs, learn(docs.filter(~held_out(id_col)), lang_col, text_col, slots), id_col, text_col)
