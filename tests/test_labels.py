"""Label modes, odd tag lists, examples and the artist path."""

from pyspark.sql import functions as F

from tagloom.operators import labels as L
from tagloom.operators import tags as T
from tagloom.operators.sampling import with_sample_draws


def _tracks(spark):
    return spark.createDataFrame(
        [
            ("1", ["rock", "punk rock"], 1.0),
            ("2", ["Rock", "industrial"], 2.0),
            ("3", [], 3.0),
            ("4", ["pop", "pop"], 4.0),
            ("5", None, 5.0),
        ],
        "track_id string, tags array<string>, f double",
    )


def _pairs(df):
    return sorted((r.tag, r.track_id) for r in df.collect())


def test_tag_counts_drop_empty(spark):
    c = {r.tag: r.n for r in T.tag_counts(_tracks(spark)).collect()}
    assert c == {"rock": 1, "punk rock": 1, "Rock": 1, "industrial": 1, "pop": 2}


def test_modes(spark):
    tags = spark.createDataFrame([("rock",), ("us",), ("pop",)], "tag string")
    tr = _tracks(spark)
    exact = _pairs(L.positive_pairs(tr, tags, "exact"))
    sub = _pairs(L.positive_pairs(tr, tags, "substring"))
    ci = _pairs(L.positive_pairs(tr, tags, "substring_ci"))
    assert exact == [("pop", "4"), ("rock", "1")]
    assert sub == [("pop", "4"), ("rock", "1"), ("us", "2")]  # 'us' inside 'industrial'
    assert ci == [("pop", "4"), ("rock", "1"), ("rock", "2"), ("us", "2")]


def _carries(tags, tag, mode):
    texts = [t for t in tags or [] if t is not None]
    if mode == "exact":
        return tag in texts
    if mode == "substring":
        return any(tag in t for t in texts)
    return any(tag.lower() in t.lower() for t in texts)


ODD = [
    ("1", ["rock", "punk rock"]), ("2", ["Rock", None, "industrial"]), ("3", []), ("4", None), ("5", [None]),
    ("6", ["pop", "pop", ""]), ("7", ["\u00e9t\u00e9 rock", "a\u0000b"]), ("8", [""]),
]
ODD_TAGS = ["", "rock", "ROCK", "us", "pop", "absent", "\u00e9t", "k", "b", "punk rock"]


def test_odd_lists_in_every_mode(spark):
    """NULL lists, NULL elements, empty tags and texts, in all modes, against plain code."""
    tr = spark.createDataFrame([(i, t, 1.0) for i, t in ODD], "track_id string, tags array<string>, f double")
    tags = spark.createDataFrame([(t,) for t in ODD_TAGS], "tag string")
    for mode in L.MATCH_MODES:
        want = sorted((tag, i) for tag in ODD_TAGS for i, t in ODD if _carries(t, tag, mode))
        assert _pairs(L.positive_pairs(tr, tags, mode)) == want, mode
        ex = L.labelled_examples(tr, tags, ["f"], mode=mode, cell_rows=3).collect()
        assert sorted((r.tag, r.track_id) for r in ex if r.y == 1.0) == want
        assert all(r.y in (0.0, 1.0) and r.split in ("train", "test") for r in ex)
        assert not {(r.tag, r.track_id) for r in ex if r.y == 0.0} & set(want)
        counts = {r.tag: r.n_positive for r in L.class_counts(tr, tags, mode).collect()}
        assert counts == {tag: sum(1 for t, _ in want if t == tag) for tag in ODD_TAGS}


def test_no_tags_and_no_nested_loop(spark):
    tr = _tracks(spark)
    none = spark.createDataFrame([], "tag string")
    for mode in L.MATCH_MODES:
        assert L.positive_pairs(tr, none, mode).count() == 0
        tags = spark.createDataFrame([("rock",), ("us",)], "tag string")
        ex = L.labelled_examples(tr, tags, ["f"], mode=mode)
        for df in (L.positive_pairs(tr, tags, mode), ex):
            plan = df._jdf.queryExecution().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_examples_keep_positives_and_drawn_negatives(spark):
    tr = spark.range(400).select(
        F.col("id").cast("string").alias("track_id"),
        F.when(F.col("id") % 7 == 0, F.array(F.lit("rock"))).otherwise(F.array(F.lit("jazz"), F.lit("x"))).alias("tags"),
        (F.col("id") * 1.0).alias("f"),
    )
    tags = spark.createDataFrame([("rock",), ("jazz",)], "tag string")
    draws = {r.track_id: r.u for r in with_sample_draws(tr).collect()}
    for cell_rows in (1, 30, 100_000):
        ex = L.labelled_examples(tr, tags, ["f"], mode="exact", cell_rows=cell_rows).collect()
        assert sum(1 for r in ex if r.tag == "rock" and r.y == 1.0) == 58  # every positive kept
        kept = {r.track_id for r in ex if r.tag == "rock" and r.y == 0.0}
        assert kept == {k for k, u in draws.items() if int(k) % 7 and u < 58 / 342}
        assert len({(r.tag, r.track_id) for r in ex}) == len(ex)


def test_cells_make_the_rows_that_are_kept(spark):
    """Every (tag, track) below the fraction once, and nothing else, for odd fractions
    and draws, whole cells split or not."""
    edge = 1 / 2**32
    fractions = [0.0, edge, 2 * edge, 0.5, 1 / 3, 1 / 16, 1.0 - edge, 1.0, 0.123456789, 15 / 16, 1e-12]
    tags = spark.createDataFrame([(str(i), f) for i, f in enumerate(fractions)], "tag string, fraction double")
    draws = sorted({0.0, edge, 2 * edge, 1 - edge, 0.5, 0.5 - edge, 1 / 16, 1 / 16 - edge, *[(i * 2654435761 % 2**32) * edge for i in range(300)]})
    tracks = spark.createDataFrame([(f"t{i}", u) for i, u in enumerate(draws)], "track_id string, u double")
    want = sorted((str(i), f"t{k}") for i, f in enumerate(fractions) for k, u in enumerate(draws) if u < f)
    for cell_rows in (1, 7, 10**6):
        covered = L.covered_cells(tags, len(draws), cell_rows)
        cells = L.drawn_cells(tracks, len(draws), cell_rows, "track_id")
        joined = cells.join(covered, ["_level", "_cell", "_salt"])
        assert sorted((r.tag, r.track_id) for r in joined.collect()) == want
        hot = cells.groupBy("_level", "_cell", "_salt").count().agg(F.max("count")).first()[0]
        assert cell_rows > 7 or hot <= 4 * cell_rows + 4


def _brute_map(texts, tags, fold):
    low = str.lower if fold else str
    return sorted((t, g) for t in set(texts) if t is not None for g in set(tags) if low(g) in low(t))


def test_substring_map_with_long_and_short_tags(spark):
    """A tag of 200 characters, tags shorter than a q-gram, repeats and overlaps."""
    long = "".join(chr(97 + (i * i) % 23) for i in range(200))
    texts = [long, "x" + long + "y", long[:-1], "aaaa", "aa", "a", "", "aAaB", "b" * 50, "ab" * 30, "\u00e9t\u00e9", "a\u0000b", None, "aaaa"]
    tags = [long, "a", "aa", "aaa", "aaaaa", "ab", "ba", "b", "", "abab", "\u00e9t", "absent", "zz", "z", long[50:120], "A", "AB"]
    tx = spark.createDataFrame([(t,) for t in texts], "text string")
    tg = spark.createDataFrame([(t,) for t in tags], "tag string")
    for fold in (False, True):
        got = sorted((r.text, r.tag) for r in L.substring_map(tx, tg, fold).collect())
        assert got == _brute_map(texts, tags, fold)


def test_substring_map_random(spark):
    import random

    random.seed(7)
    texts = ["".join(random.choices("abcA ", k=random.randint(0, 25))) for _ in range(400)]
    tags = ["".join(random.choices("abcA ", k=random.randint(0, 7))) for _ in range(150)]
    tx = spark.createDataFrame([(t,) for t in texts], "text string")
    tg = spark.createDataFrame([(t,) for t in tags], "tag string")
    for fold in (False, True):
        got = sorted((r.text, r.tag) for r in L.substring_map(tx, tg, fold).collect())
        assert got == _brute_map(texts, tags, fold)


def test_a_text_makes_no_more_entries_than_characters(spark):
    """However long the tags are, the index has one entry a place."""
    text = "".join(chr(97 + i % 26) for i in range(399))
    tx = spark.createDataFrame([(text,), ("",)], "text string")
    assert L._entries(tx, "text").count() == 399 + 1
    tg = spark.createDataFrame([(text[100:300],), ("z",)], "tag string")
    assert sorted(r.tag for r in L.substring_map(tx, tg).collect()) == sorted([text[100:300], "z"])


def test_artist_path(spark):
    at = spark.createDataFrame([("a1", "Rock"), ("a1", "pop"), ("a2", "jazz")], "artist_id string, mbtag string")
    ta = spark.createDataFrame([("a1", "t1"), ("a2", "t2"), ("a3", "t3")], "artist_id string, track_id string")
    feats = spark.createDataFrame([("t1", 1.0), ("t3", 3.0)], "track_id string, f double")
    ay = L.artist_has_tag(at, "rock", ignore_case=True)
    labels = {r.track_id: r.y for r in L.track_labels(ta, ay).collect()}
    assert labels == {"t1": 1.0, "t2": 0.0, "t3": 0.0}  # artist without tags -> 0
    joined = {r.track_id for r in L.labels_with_features(L.track_labels(ta, ay), feats).collect()}
    assert joined == {"t1", "t3"}  # track without features drops
    lists = {r.artist_id: r.tags for r in L.artist_tag_lists(at).collect()}
    assert lists == {"a1": "Rock,pop", "a2": "jazz"}
    cs = {r.artist_id: r.y for r in L.artist_has_tag(at, "rock", ignore_case=False).collect()}
    assert cs == {"a1": 0.0, "a2": 0.0}
