import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tagloom.llm import bpe, crosstok

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


class Plain:
    """Both libraries on whole texts, and the alignment token by token."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        byte = {c: bytes([i]) for i, c in enumerate(bpe.byte_table())}
        self.bytes_a = {i: b"".join(byte[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}

    def bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def align(self, text):
        if not text:
            return None
        want = f" {text}".encode()
        a, b = self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text)
        if b"".join(self.bytes_a[i] for i in a) != want or b"".join(map(self.bytes_b, b)) != want:
            return None
        spans_a, spans_b = (
            np.cumsum([0, *[len(x) for x in parts]]) for parts in ([self.bytes_a[i] for i in a], [self.bytes_b(i) for i in b])
        )
        links = [
            (a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if max(spans_a[i], spans_b[j]) < min(spans_a[i + 1], spans_b[j + 1])
        ] if len(a) < 400 else _swept(a, b, spans_a, spans_b)
        cuts = sorted(set(spans_a.tolist()) & set(spans_b.tolist()))
        groups = []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            parts = [
                ",".join(str(x) for k, x in enumerate(ids) if lo <= at[k] < hi) for ids, at in ((a, spans_a), (b, spans_b))
            ] if len(a) < 400 else [",".join(map(str, ids[np.searchsorted(at, lo) : np.searchsorted(at, hi)])) for ids, at in ((a, spans_a), (b, spans_b))]
            groups.append("|".join(parts))
        return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()

    def table(self, rows):
        told = [(i, self.align(t)) for i, t in rows]
        counts, top = Counter(), defaultdict(int)
        for _, x in told:
            counts.update(x[3] if x else ())
        for (_, b), n in counts.items():
            top[b] = max(top[b], n)
        docs = Counter(p for _, x in told if x for p in set(x[3]))
        best = lambda p: counts[p] == top[p[1]]
        out = [
            (i, *x[:3], len(x[3]), sum(map(best, x[3])), sum(counts[p] for p in x[3]), x[4]) if x else (i, 0, 0, 0, 0, 0, 0, "")
            for i, x in told
        ]
        return sorted(out, key=repr), {p: (docs[p], n, best(p)) for p, n in counts.items()}


def _swept(a, b, at_a, at_b):
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        out.append((a[i], b[j]))
        x, y = at_a[i + 1], at_b[j + 1]
        i, j = i + (x <= y), j + (y <= x)
    return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def run(docs):
    return sorted(map(tuple, crosstok.align(docs, A, B).collect()), key=repr)


def test_documents(spark, sf, plain, monkeypatch):
    # Several blocks, and bitmaps of both forms.
    monkeypatch.setattr(crosstok, "BLOCK_DOCS", 64)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want, pairs = plain.table([(r.doc_id, r.text) for r in docs.collect()])
    assert run(docs) == want
    both = crosstok.inverted(docs, A, B).filter("pair IS NOT NULL")
    assert {(r.a, r.b): (r.n_docs, r.n_links, r.best) for r in crosstok.pair_counts(both).collect()} == pairs


def test_odd_rows(odd, empty, plain):
    assert run(odd) == plain.table([(r.doc_id, r.text) for r in odd.collect()])[0]
    assert run(empty) == []


def odd_texts():
    random.seed(3)
    alphabet = list("ab's're 'll  \n\t  12!,.é語👍▁\x00\u0085　ﬁ�<>|") + ["<|endoftext|>", "<s>", "<unk>", "<0x0A>", "    "]
    texts = ["".join(random.choices(alphabet, k=random.randint(0, 30))) for _ in range(1500)]
    return [*texts, " ", "  ", "   x   ", "\n", "▁", "a ▁b", "the " * 500, " " * 100, "x" * 2000]


def test_odd_texts(spark, plain):
    rows = list(enumerate(odd_texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got, (want, _) = run(docs), plain.table(rows)
    assert got == want
    assert sum(r[1] == 0 and bool(rows[r[0]][1]) for r in got) > 100  # texts with U+2581 are not given back


def test_a_collision_of_pieces_is_found(plain, monkeypatch):
    """Pieces that share a key are told apart by the bytes their ids give."""
    spec, known = crosstok.a_model(A)
    with open(B, "rb") as f:
        tool = crosstok.Aligner(spec, known, f.read(), bpe.char_classes())
    monkeypatch.setattr(bpe, "piece_hashes", lambda points, starts, stops, step: (stops - starts).astype(np.uint64))
    texts = [" one two six", " ten a b"]
    good, n_a, n_b, n_groups, n_links, shas, _, _ = tool.align(texts)
    for i, t in enumerate(texts):
        x = plain.align(t[1:])
        assert good[i] and (n_a[i], n_b[i], n_groups[i], n_links[i], shas[i]) == (*x[:3], len(x[3]), x[4])


@pytest.mark.parametrize("seed", range(8))
def test_bitmaps(seed):
    """Packed and unpacked: sparse and dense, one time and many."""
    rng = np.random.default_rng(seed)
    n_docs = int(rng.choice([1, 16, 17, 200, 5000]))
    told = {}
    for pair in rng.choice(10**12, 40, replace=False).tolist():
        for doc in rng.choice(n_docs, rng.integers(1, n_docs + 1), replace=False).tolist():
            told[pair, doc] = int(rng.choice([1, 1, 1, 2, 3, 40, 100_000]))
    keys = sorted(told)
    pair, doc, times = np.array([k[0] for k in keys]), np.array([k[1] for k in keys]), np.array([told[k] for k in keys])
    pairs, at, words = crosstok.compressed(pair, doc, times, n_docs)
    assert pairs.tolist() == sorted({k[0] for k in keys})
    docs, links = crosstok.popcounts(words, at[:-1], at[1:])
    back = Counter()
    for value, row, place in crosstok.expanded(words, at[:-1], at[1:]):
        for r, d in zip(row.tolist(), place.tolist(), strict=True):
            back[pairs[r], d] += value
    assert back == told
    for p, d, n in zip(pairs, docs, links, strict=True):
        mine = [v for k, v in told.items() if k[0] == p]
        assert (d, n) == (len(mine), sum(mine))


def test_no_pairs():
    pairs, at, words = crosstok.compressed(*[np.zeros(0, np.int64)] * 3, 5)
    assert len(pairs) == len(words) == 0 and at.tolist() == [0]
    words, starts, ends = crosstok._words_of(pa.array([], pa.binary()))
    assert crosstok.popcounts(words, starts, ends)[0].tolist() == []
