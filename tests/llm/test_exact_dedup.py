import hashlib
import re

from pyspark.sql import functions as F

from tagloom.llm import exact_dedup

from .conftest import odd_rows


def plain(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def brute(rows):
    groups = {}
    for doc, text, _ in rows:
        groups.setdefault(plain(text), []).append(doc)
    out = []
    for doc, text, _ in rows:
        ids = [i for i in groups[plain(text)] if i is not None]
        keep = min(ids) if ids else None
        out.append((doc, keep, len(groups[plain(text)]), hashlib.sha256(plain(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_odd_rows(odd):
    got = exact_dedup.exact_dedup(odd).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(odd_rows())
    kept = [r.text_sha256 for r in got if r.kept]
    assert sorted(kept) == sorted({r.text_sha256 for r in got})


def test_small_buckets_split_and_chain(spark):
    rows = [(i, f"text {i % 300}", "en") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = exact_dedup.exact_dedup(docs, capacity=7).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(rows)
    entries = exact_dedup.build_index(docs, "doc_id", "text", 7)
    assert entries.groupBy("bucket", "local_depth").count().agg(F.max("count")).first()[0] <= 7
    assert entries.select("local_depth").distinct().count() > 1


def test_filter_keeps_columns(odd):
    kept = exact_dedup.distinct_documents(odd)
    assert kept.columns == odd.columns
    texts = [plain(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({plain(t) for _, t, _ in odd_rows()})


def test_empty_table(empty):
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert exact_dedup.distinct_documents(empty).count() == 0
