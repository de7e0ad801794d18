import hashlib
import re

from tagloom.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    wins = {}
    for item, text in items:
        w = words(text)
        k = min(len(w), 10)
        for i in range(len(w) - k + 1 if w else 0):
            wins.setdefault(tuple(w[i : i + k]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                if (x := tuple(w[i : i + k])) in wins:
                    hit |= set(range(i, i + k))
                    found |= wins[x]
        told = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), told, bool(hit)))
    return sorted(out, key=repr)


ITEMS = [
    (1, "Two three four five six seven eight nine ten eleven twelve"),
    (2, "short"),
    (3, "a b"),
    (4, None),
    (5, ""),
    (10, "two three four FIVE six seven eight nine ten eleven"),
    (11, "the the the the the the the the the the the the"),
]


def run(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in decontaminate.decontaminate(docs, bench).collect()), key=repr)


def test_odd_rows(spark, odd):
    got = run(spark, odd, ITEMS)
    assert got == brute([(r.doc_id, r.text) for r in odd.collect()], ITEMS)
    assert any(x[-1] for x in got) and not all(x[-1] for x in got)


def test_repeats_and_overlaps(spark):
    rows = [(i, "the " * i) for i in range(30)] + [(99, "A b a b, a-b. short SHORT")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(spark, docs, ITEMS) == brute(rows, ITEMS)


def test_join_without_broadcast(spark, odd, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert run(spark, odd, ITEMS) == brute([(r.doc_id, r.text) for r in odd.collect()], ITEMS)


def test_filter_and_empty(spark, odd, empty):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = decontaminate.without_benchmark(odd, bench)
    assert clean.columns == odd.columns
    want = [x[0] for x in brute([(r.doc_id, r.text) for r in odd.collect()], ITEMS) if not x[-1]]
    assert sorted(map(repr, want)) == sorted(repr(r.doc_id) for r in clean.collect())
    assert run(spark, empty, ITEMS) == []
    assert not any(x[-1] for x in run(spark, odd, []) or [(False,)])
    assert decontaminate.without_benchmark(odd, bench.limit(0)).count() == odd.count()
