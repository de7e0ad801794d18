import random

from tagloom.llm import nearjoin
from tagloom.llm.components import components

from .conftest import odd_rows
from .test_decontaminate import words


def shingles(text):
    w = words(text)
    k = min(len(w), 5)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute(rows):
    sets = {}
    for doc, text in rows:
        if s := shingles(text):
            sets.setdefault(s, []).append(doc)
    links = {s: [t for t in sets if t != s and 5 * len(s & t) >= 4 * len(s | t)] for s in sets}
    rank = lambda ids: min((i for i in ids if i is not None), default=1 << 62)
    out = []
    for doc, text in rows:
        s = shingles(text)
        if not s:
            out.append((doc, doc, doc, 1, 0))
            continue
        seen, todo = {s}, [s]
        while todo:
            for t in links[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        out.append((doc, min(rank(sets[t]) for t in seen), rank(sets[s]), len(sets[s]), len(links[s])))
    return sorted(out, key=repr)


def variants(n, seed):
    random.seed(seed)
    base = [f"w{random.randint(0, 400)}" for _ in range(120)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(random.randint(0, 3)):
            w[random.randrange(len(w))] = f"x{random.randint(0, 10**6)}"
        out.append(" ".join(w))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in nearjoin.near_duplicates(df).drop("node").collect()), key=repr)
    assert got == brute(rows)


def test_odd_rows(odd, empty):
    got = nearjoin.near_duplicates(odd).collect()
    known = [(r.doc_id, r.class_id, r.set_id, r.n_copies, r.n_links) for r in got if r.doc_id is not None]
    want = [x for x in brute([(i, t) for i, t, _ in odd_rows()]) if x[0] is not None]
    assert sorted(known, key=repr) == want and len(got) == odd.count()
    assert [r.class_id for r in got if r.doc_id is None and r.n_copies > 1] == [1]
    kept = nearjoin.one_of_each(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({r.class_id for r in got})
    assert nearjoin.near_duplicates(empty).count() == 0 == nearjoin.one_of_each(empty).count()


def test_groups_and_noise(spark):
    random.seed(9)
    rows = [(i, t) for i, t in enumerate(variants(25, 1) + variants(25, 2) + variants(3, 3))]
    rows += [(100 + i, " ".join(f"w{random.randint(0, 400)}" for _ in range(80))) for i in range(60)]
    check(spark, rows)


def test_texts_that_share_an_id_are_kept(spark):
    """Three distinct texts, two with one id, and near copies of each."""
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    rows = [(1, a), (1, b), (2, c), (3, a + " end"), (4, b + " end"), (1, a), (5, "!!"), (5, "??"), (5, "??")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(tuple(r) for r in nearjoin.one_of_each(df).collect())
    assert kept == sorted([(1, a), (1, b), (2, c), (5, "!!"), (5, "??")])
    got = {(r.doc_id, r.class_id, r.set_id, r.n_copies, r.n_links) for r in nearjoin.near_duplicates(df).collect()}
    assert got == {(1, 1, 1, 2, 1), (1, 1, 1, 1, 1), (2, 2, 2, 1, 0), (3, 1, 3, 1, 1), (4, 1, 4, 1, 1), (5, 5, 5, 1, 0)}


def test_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nearjoin, "BLOCK", 16)
    monkeypatch.setattr(nearjoin, "BUCKET", 4)
    check(spark, [(i, t) for i, t in enumerate(variants(90, 4))] + [(200, "alone in the world today"), (201, "alone")])


def test_components(spark):
    random.seed(2)
    edges = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 450)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_recall_of_isolated_pairs_in_crowded_buckets(spark, monkeypatch):
    assert nearjoin.runs_for(0.9999) == 13 and 1 - (1 - nearjoin.meeting(0.8)) ** 13 >= 0.9999
    monkeypatch.setattr(nearjoin, "BUCKET", 1)
    pairs = 3000
    rows = []
    for k in range(pairs):
        # 18 shingles, two of them everyone's; a pair shares 16 of 20.
        words = ["one", "hot", "passage", "of", "six", "words", *(f"w{k}x{n}" for n in range(14))]
        rows += [(2 * k, " ".join([*words, f"a{k}", f"b{k}"])), (2 * k + 1, " ".join([*words, f"c{k}", f"d{k}"]))]
    got = nearjoin.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    # 8 runs miss about 9 pairs, 13 runs 0.3.
    assert got.filter("n_links = 0").count() <= 4
