import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tagloom.llm import langid


def grams(text):
    low = (text or "").lower()
    words = "".join(c if c.isalpha() or _letter(c) else " " for c in low).split()
    for word in words:
        marked = f" {word} "
        for n in langid.ORDERS:
            yield from ((n, marked[i : i + n]) for i in range(len(marked) - n + 1))


def _letter(c):
    import regex

    return bool(regex.match(r"\p{L}", c))


def brute(rows):
    """Exact sets in place of filters: (doc_id, held_out, language, share)."""
    counts = defaultdict(Counter)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 4 == 2
    for i, text, lang in rows:
        if not held(i) and lang is not None and text is not None:
            counts[lang].update(grams(text))
    langs = sorted(counts)
    size = {x: sum(counts[x].values()) for x in langs}
    share = lambda x, g: counts[x][g] / size[x] if size[x] else 0
    kept = {x: {g for g in counts[x] if share(x, g) >= langid.SHARE * max(share(y, g) for y in langs)} for x in langs}
    out = []
    for i, text, _ in rows:
        mine = Counter(grams(text))
        hits = [sum(n for g, n in mine.items() if g in kept[x]) for x in langs]
        if not mine or not langs:
            out.append((i, held(i), "und", 0.0))
        elif max(hits) == 0:
            out.append((i, held(i), max(langs, key=lambda x: (size[x], [-ord(c) for c in x])), 0.0))
        else:
            out.append((i, held(i), langs[hits.index(max(hits))], max(hits) / sum(mine.values())))
    return out


def run(df):
    return [(r.doc_id, r.held_out, r.lang_pred, r.score) for r in langid.identify(df).collect()]


def agree(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=repr), sorted(want, key=repr), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 0.02, (a, b)


def test_equals_exact_sets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    agree(run(docs), brute([(r.doc_id, r.text, r.lang) for r in docs.collect()]))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for slots in (langid.SLOTS, 1 << 15):  # the small filters are crowded: corrected popcounts still decide
        told = langid.identify(docs, slots=slots).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
        n, right = told.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
        assert n > 200 and right >= 0.99 * n


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    agree(run(odd), brute(rows))
    assert run(empty) == []


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some words", None), (2, None, "en"), (3, "", None)], "doc_id long, text string, lang string")
    assert {r[2:] for r in run(df)} == {("und", 0.0)}


def test_texts_without_letters_or_unknown_ones(spark):
    rows = [(i, "the word and other words", "en") for i in range(40)] + [(100 + i, "das wort und andere", "de") for i in range(10)]
    rows += [(200, "12 + 34 !", "en"), (201, None, "de"), (202, "語彙", None)]
    told = {r[0]: r[2:] for r in run(spark.createDataFrame(rows, "doc_id long, text string, lang string"))}
    assert told[200] == told[201] == ("und", 0.0) and told[202][0] == "en"
    assert all(told[i][0] == "en" for i in range(40)) and all(told[100 + i][0] == "de" for i in range(10))


def test_held_out_labels_are_not_inputs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    changed = docs.withColumn("lang", F.when(langid.held_out("doc_id"), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert sorted(run(docs)) == sorted(run(changed))


def test_more_languages_than_a_byte_has_bits(spark):
    """Ten languages: masks of two bytes."""
    rows = [(i, " ".join(f"{c}{c}{d}" for d in "abcxyz"), f"l{c}") for i in range(40) for c in "fghijklmno"]
    got = langid.predict(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"),
        langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string")),
    ).join(spark.createDataFrame(rows, "id long, text string, lang string").select("lang", F.col("lang").alias("want")).distinct(), F.col("want") == F.col("lang_pred"))
    assert got.count() == len(rows) and {r.lang_pred for r in got.collect()} == {f"l{c}" for c in "fghijklmno"}


@pytest.mark.parametrize("keys", [0, 5])
def test_places_stay_in_the_filter(keys):
    import numpy as np

    for at in langid._places(np.arange(keys, dtype=np.uint64), 1 << 15):
        assert ((at >= 0) & (at < 1 << 15)).all()
