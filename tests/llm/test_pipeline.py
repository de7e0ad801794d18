"""The pipeline against brute force."""

import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from tagloom.llm import bpe, quality
from tagloom.llm.catalog import rank_file

from .test_decontaminate import brute as hits
from .test_exact_dedup import plain
from .test_nearjoin import brute as classes


def test_run_equals_brute_force(spark, sf):
    docs, labels, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    good = {r.doc_id for r in quality.classify(docs, labels).collect() if r.predicted}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in good)
    first = {}
    for doc, text in rows:
        first.setdefault(plain(text), doc)
    rows = [(doc, text) for doc, text in rows if first[plain(text)] == doc]
    near = {x[0] for x in classes(rows) if x[0] == x[1]}
    rows = [x for x in rows if x[0] in near]
    clean = {x[0] for x in hits(rows, [tuple(r) for r in bench.collect()]) if not x[-1]}
    rows = [x for x in rows if x[0] in clean]
    known = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(rank_file()), special_tokens={}
    )
    want = {}
    for doc, text in rows:
        ids = known.encode_ordinary(text)
        want[doc] = (len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want and 0 < len(got) < docs.count()


def test_stages_keep_columns_and_stand_odd_rows(spark, odd, empty, sf):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, sf).columns == odd.columns, name
        assert stage(spark, empty, sf).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, odd, sf).count() == odd.count()
