import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tagloom.llm import bpe
from tagloom.llm.catalog import rank_file

from .conftest import odd_rows


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(rank_file())


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pattern_is_the_public_one():
    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_random_texts(ranks, reference):
    coder = bpe.Encoder(bpe.tokenizer_json(ranks), bpe.char_classes(), bpe.token_bytes(ranks))
    random.seed(1)
    alphabet = list("ab's're 've'll'd'm't  \n\t  12!,.é語👍\u0085  '' lrvestmd")
    texts = ["".join(random.choices(alphabet, k=random.randint(0, 40))) for _ in range(20000)]
    texts += [f"a{chr(c)}b 1{chr(c)} {chr(c)}" for c in range(0, 0x110000, 37) if not 0xD800 <= c <= 0xDFFF]
    ids, bounds, _, _ = coder.encode(texts)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == reference.encode_ordinary(text), repr(text)


def test_digest_of_documents(spark, sf, ranks, reference):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = bpe.round_trip(docs, ranks, with_ids=True).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows_offsets_and_decoding(odd, empty, ranks):
    made = bpe.encode(odd, ranks, offsets=True)
    want = sorted(((i, t or "") for i, t, _ in odd_rows()), key=repr)
    rows = made.collect()
    back = bpe.decode(made, ranks).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=repr) == want
    texts = {(r.doc_id, tuple(r.ids)): r.text for r in back}
    for r in rows:
        text = texts[r.doc_id, tuple(r.ids)]
        assert len(r.ids) == len(r.starts) == len(r.ends)
        assert "".join(text[a:b] for k, (a, b) in enumerate(zip(r.starts, r.ends)) if not k or a >= r.ends[k - 1]) == text
    assert bpe.round_trip(odd, ranks).count() == odd.count()
    assert bpe.round_trip(empty, ranks).count() == 0 == bpe.encode(empty, ranks).count()
