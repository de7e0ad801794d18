import re
from collections import Counter

import pytest

from tagloom.llm import phrases


def brute(rows, least, kept=2000):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 6):
                counts.update((lang, tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    often = {k: v for k, v in counts.items() if len(k[1]) > 1 and v >= least}
    inside = set()
    for (lang, w), f in often.items():
        for n in range(2, len(w)):
            inside.update((lang, w[i : i + n]) for i in range(len(w) - n + 1) if f >= counts[lang, w[i : i + n]])
    found = []
    for (lang, w), a in often.items():
        if (lang, w) in inside:
            continue
        cuts = [(counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w))]
        score, k = min((1000 * a * total[lang] // (x * y), k) for k, (x, y) in enumerate(cuts))
        found.append((lang, -score, -a, " ".join(w).encode(), *cuts[k]))
    out, rank = [], Counter()
    for lang, score, a, phrase, x, y in sorted(found, key=lambda r: (r[0].encode(), *r[1:4])):
        rank[lang] += 1
        if rank[lang] <= kept:
            out.append((lang, rank[lang], phrase.decode(), -a, x, y, total[lang], -score))
    return sorted(out)


def run(df, **more):
    return sorted(map(tuple, phrases.collocations(df, **more).collect()))


@pytest.mark.parametrize("least", [2, 5, 40])
def test_documents(spark, sf, monkeypatch, least):
    """With a low threshold the stream has far more phrases than it has ranges."""
    monkeypatch.setattr(phrases, "LEAST", least)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = run(docs, kept=50)
    assert got == brute([(r.lang, r.text) for r in docs.collect()], least, kept=50)


def test_every_range_starts_with_its_chain(spark, monkeypatch):
    """One word starts all phrases; ranges end everywhere, inside long chains too."""
    monkeypatch.setattr(phrases, "LEAST", 2)
    monkeypatch.setattr(phrases, "DRAWS", 100)
    rows = [(i, f"the {a} {b} {c} the {b} {a} {c}", "en") for i in range(2) for a in "abcd" for b in "abcd" for c in "efgh"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    for parts in ("3", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            assert run(df) == brute([(r[2], r[1]) for r in rows], 2)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_odd_rows(odd, empty, monkeypatch):
    monkeypatch.setattr(phrases, "LEAST", 2)
    assert run(odd) == brute([(r.lang, r.text) for r in odd.collect()], 2)
    assert run(empty) == []


def test_odd_words(spark, monkeypatch):
    """Control characters below the space, words at piece ends, ties, no language."""
    monkeypatch.setattr(phrases, "LEAST", 2)
    texts = ["a\x01 b a b", "a\x01 b, a b", "a b\x0bA B", "x y z. x y z! x y", "É é É é É é", "\x00 \x00 \x00", "und und und", ""]
    rows = [(1, t, lang) for t in texts for lang in ("en", None, "und", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert run(df) == brute([(r[2], r[1]) for r in rows], 2)


def test_filter_lets_all_pass(spark, monkeypatch):
    """A filter that is full changes no result."""
    monkeypatch.setattr(phrases, "LEAST", 2)
    monkeypatch.setattr(phrases._Filter, "has", lambda self, hashes: hashes == hashes)
    rows = [("en", "one two three four five six " * 3), ("en", "two three one")]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert run(df) == brute(rows, 2)


def test_equal_hashes_are_told_apart(monkeypatch):
    """Words are numbered by their bytes where hashes agree."""
    import numpy as np
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de"]), pa.array(["aa bb aa cc", "aa bb"])], ["lang", "text"])
    plain = phrases._Part(batch).ids
    monkeypatch.setattr(phrases, "mixed", lambda x: np.zeros_like(x))
    same = phrases._Part(batch).ids
    for ids in (plain, same):
        assert ids[0] == ids[2] and len(set(ids.tolist())) == 5


def test_products_beyond_64_bits():
    """The score's arithmetic on counts of a very large corpus."""
    a, n, x, y = 4 * 10**9, 9 * 10**14, 5 * 10**9, 6 * 10**9
    assert 1000 * a * n > 2**63 and 1000 * a * n // (x * y) == 120_000_000


def test_phrases_of_a_slice_come_in_bounded_batches(monkeypatch):
    """The counts of a slice do not depend on the batches' bytes, which have a limit."""
    import pyarrow as pa

    texts = [" ".join(f"w{(i * j) % 97}" for j in range(200)) + ". " + "x" * 500 for i in range(20)]
    part = phrases._Part(pa.RecordBatch.from_arrays([pa.array(["en"] * 20), pa.array(texts)], ["lang", "text"]))
    at = phrases.np.flatnonzero(part.room >= 3)
    keys = part.hash[at] + part.hash[at + 1] * phrases._U(3) + part.hash[at + 2] * phrases._U(7)
    whole = [r for b in part.counted(at, keys, 3, part.lang) for r in b.to_pylist()]
    hashes = part._hashes()
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 300)
    parts = list(part.counted(at, keys, 3, part.lang))
    assert [r for b in parts for r in b.to_pylist()] == whole and len(parts) > 10
    assert all(sum(map(len, b.column(1).to_pylist())) <= 300 for b in parts)
    assert (part._hashes() == hashes).all() and len(part._ids()) == len(part)
