"""Legacy text formats: hand-written track lines incl. the awkward cases."""

from pyspark.sql import functions as F

from tagloom.functions.text import clean_tag_name
from tagloom.sources import legacy_text as LT

LINES = [
    "('TRAAA', (['rock', 'punk rock'], [252.5, 0.0, 1, 0.6, -8.1, 1, 0.5, 240.2, 120.0, 4, 0.9]))",
    "('TRAAB', ([], [180.0, 0.2, 3, 0.1, -12.0, 0, 0.4, 171.3, 98.5, 3, 0.2]))",
    "('TRAAC', (['am\\xc3\\xa9ricain'], [200.0, 0.0, 7, 0.3, -6.0, 1, 0.7, 190.0, 140.1, 4, 1.0]))",
    "('TRAAD', ([\"rock 'n' roll\", 'a, b'], [150.0, 0.1, 2, 0.2, -9.9, 1, 0.3, 149.0, 101.0, 4, 0.5]))",
    "('TRAAE', (['odd ] tag'], [150.0, 0.1, 2, 0.2, -9.9, 1, 0.3, 149.0, 101.0, 4, 0.5]))",
    "('TRAAF', (['x'], [1.0, oops]))",
    "garbage line",
]


def _parse(spark):
    df = spark.createDataFrame([(v,) for v in LINES], "value string")
    return {r.track_id: r for r in LT.parse_track_lines(df).collect() if r.track_id}, LT.parse_track_lines(df)


def test_parse_track_lines(spark):
    rows, df = _parse(spark)
    assert rows["TRAAA"].tags == ["rock", "punk rock"]
    assert rows["TRAAA"].features[0] == 252.5 and len(rows["TRAAA"].features) == 11
    assert rows["TRAAB"].tags == [] and rows["TRAAB"].parse_ok
    assert rows["TRAAC"].tags == ["américain"]
    assert rows["TRAAD"].tags == ["rock 'n' roll", "a, b"]
    assert rows["TRAAE"].tags == ["odd ] tag"]
    assert rows["TRAAF"].parse_ok is False  # bad number: counted, not dropped
    assert df.filter(~F.col("parse_ok")).count() == 2  # bad number + garbage line


def test_format_then_parse_round_trip(spark):
    tracks = spark.createDataFrame(
        [("T1", ["rock 'n' roll", "a\\b", "plain"], 1.5, -2.0), ("T2", [], 0.0, 3.25)],
        "track_id string, tags array<string>, f0 double, f1 double",
    )
    back = LT.parse_track_lines(LT.format_track_lines(tracks, ["f0", "f1"])).orderBy("track_id").collect()
    assert back[0].tags == ["rock 'n' roll", "a\\b", "plain"] and back[0].features == [1.5, -2.0]
    assert back[1].tags == [] and back[1].features == [0.0, 3.25]


def test_bracket_groups_break_on_bracket_in_tag(spark):
    df = spark.createDataFrame([(LINES[4],)], "value string")
    g = LT.bracket_groups(df).first()
    assert g.tags_text == "['odd ]"  # the lazy match stops early: the reason for the strict parser


def test_tag_count_lines(spark):
    counts = spark.createDataFrame([("rock", 49449), ("a, b", 3), ("it's", 2)], "tag string, n bigint")
    lines = LT.format_tag_count_lines(counts)
    strict = {r.tag: r.n for r in LT.parse_tag_count_lines(lines).collect()}
    assert strict == {"rock": 49449, "a, b": 3, "it's": 2}
    legacy = {r.tag: r.n for r in LT.parse_tag_count_lines(lines, legacy=True).collect()}
    assert legacy["rock"] == 49449 and legacy["a"] is None and legacy["its"] == 2


def test_metric_lines(spark):
    m = spark.createDataFrame([("rock", 0.5264948976103123, 0.6777005205224684, 115)],
                              "tag string, auroc double, auprc double, train_seconds bigint")
    back = LT.parse_metric_lines(LT.format_metric_lines(m)).first()
    assert back.auroc == 0.5264948976103123 and back.auprc == 0.6777005205224684 and back.train_seconds == 115


def test_track_info_and_clean_names(spark):
    df = spark.createDataFrame([("TRX<SEP>SOY<SEP>Artist A<SEP>Song B",)], "value string")
    r = LT.parse_track_info(df).first()
    assert (r.track_id, r.info1, r.artist, r.title) == ("TRX", "SOY", "Artist A", "Song B")
    t = spark.createDataFrame([("hip hop",), ("a\\b c",)], "tag string")
    assert [x[0] for x in t.select(clean_tag_name("tag")).collect()] == ["hip_hop", "ab_c"]
