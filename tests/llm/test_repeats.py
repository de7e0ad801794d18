import random
import re

from tagloom.llm import repeats

from .conftest import odd_rows


def brute(rows, window=13):
    split = [(doc, re.findall("[^\x20\x09-\x0d]+", text or "")) for doc, text in rows]
    order = lambda doc: (doc is None, doc or 0)
    owner = {}
    for doc, w in split:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            owner[key] = min(owner.get(key, order(doc)), order(doc))
    out = []
    for doc, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if owner[tuple(w[i : i + window])] < order(doc):
                gone |= set(range(i, i + window))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def check(spark, rows, **kinds):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in repeats.remove_repeats(df, **kinds).collect()), key=repr)
    assert got == brute(rows, kinds.get("window", 13))


def test_odd_rows(spark, odd, empty):
    got = sorted((tuple(r) for r in repeats.remove_repeats(odd).collect()), key=repr)
    assert got == brute([(i, t) for i, t, _ in odd_rows()])
    assert repeats.remove_repeats(empty).count() == 0


def test_shared_passages(spark):
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "語"]
    passages = [" ".join(random.choices(vocabulary, k=random.randint(13, 60))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [" ".join(random.choices(vocabulary, k=random.randint(0, 40)))]
        for _ in range(random.randint(0, 3)):
            p = random.choice(passages).split()
            a = random.randint(0, 5)
            parts += [" ".join(p[a : len(p) - random.randint(0, 5)]), " ".join(random.choices(vocabulary, k=3))]
        rows.append((i, random.choice([" ", "\n", "\t "]).join(parts)))
    rows.append((500, "der " * 80))
    rows.append((501, "x " + "der " * 40))
    check(spark, rows)


def test_frequent_anchors_are_cut(spark, monkeypatch):
    monkeypatch.setattr(repeats, "FREQUENT", 3)
    random.seed(4)
    line = " ".join(f"c{i}" for i in range(16))
    rows = [(i, " ".join(random.choices("abcdefgh", k=20)) + " " + line + " " + " ".join(random.choices("xyz", k=15))) for i in range(60)]
    check(spark, rows)


def test_small_automata(spark, monkeypatch):
    monkeypatch.setattr(repeats, "AUTOMATON_PASSAGES", 2)
    rows = [(i, " ".join(f"v{(j * (i % 4 + 1)) % 50}" for j in range(70))) for i in range(20)]
    check(spark, rows)
