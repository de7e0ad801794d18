"""The query catalogue: one Spark query per operator, each with a DuckDB twin.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]``.
Float outputs are rounded on both sides (6 decimals for bounded values,
8 significant digits for raw magnitudes) since float sums differ in their
last bits with the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.config import (
    METRIC_AUPRC_PREFIX,
    METRIC_AUROC_PREFIX,
    METRIC_TIME_PREFIX,
    REPORT_ARTIST,
    REPORT_MARGIN_HEADING,
    REPORT_TAG_HEADING,
    REPORT_TITLE,
    REPORT_TRACK,
    SEVEN_FEATURE_INDEXES,
    shared_dir,
)
from tagloom.functions.hashing import unit_hash_sql
from tagloom.functions.text import clean_tag_name
from tagloom.functions.vectors import round_sig, round_sig_sql
from tagloom.operators import labels as L
from tagloom.operators import metrics as M
from tagloom.operators import sampling as S
from tagloom.operators import scaling
from tagloom.operators import score as SC
from tagloom.operators import stats as ST
from tagloom.operators import summary as SU
from tagloom.operators import tags as T
from tagloom.operators import train as TR
from tagloom.plans import stages as G
from tagloom.plans.stages import FEATS, SEED, SHARE_DEN, with_ctes
from tagloom.sources import legacy_text as LT
from tagloom.sources import results as R
from tagloom.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return register


def r6(c):
    return F.round(c if not isinstance(c, str) else F.col(c), 6)


def rs(c):
    return round_sig(c, 8)


def rs_sql(expr: str) -> str:
    return round_sig_sql(expr, 8)


# ---------------------------------------------------------------------------
# Tags: histogram, popularity, names, trained-model bookkeeping
# ---------------------------------------------------------------------------


@query("tag_counts", with_ctes(G.SQL_TRACKS, G.SQL_COUNTS) + "SELECT tag, n FROM counts")
def q_tag_counts(spark, sf):
    return T.sorted_tag_counts(G.counts(spark, sf))


@query("popular_tags", with_ctes(G.SQL_TRACKS, G.SQL_COUNTS) + "SELECT tag, n FROM popular")
def q_popular_tags(spark, sf):
    return T.sorted_tag_counts(G.popular(spark, sf))


@query(
    "clean_tag_names",
    with_ctes(G.SQL_TRACKS, G.SQL_COUNTS)
    + "SELECT tag, replace(replace(tag, ' ', '_'), '\\', '') AS clean_tag FROM counts",
)
def q_clean_tag_names(spark, sf):
    return T.with_clean_names(G.counts(spark, sf)).select("tag", "clean_tag")


@query(
    "untrained_tags",
    with_ctes(G.SQL_TRACKS, G.SQL_COUNTS)
    + f"SELECT p.tag, p.n FROM popular p WHERE p.tag NOT IN "
    f"(SELECT tag FROM counts WHERE n * {SHARE_DEN // 2} >= (SELECT n_tracks FROM ntracks))",
)
def q_untrained_tags(spark, sf):
    """Popular tags without stored results, after a run over those of twice the cut-off."""
    out = shared_dir(spark, "store")
    run = R.Run(spark, out, 1)
    run.write("weights", G.popular(spark, sf, SHARE_DEN // 2).withColumn("intercept", F.lit(0.0)))
    run.commit()
    return T.untrained_tags(G.popular(spark, sf), R.read_results(spark, f"{out}/weights"))


# ---------------------------------------------------------------------------
# Legacy text: track lines, tag-count lines, metric lines, track info
# ---------------------------------------------------------------------------

_FEAT_TXT_SQL = ", ".join(f"CAST({c} AS VARCHAR)" for c in FEATS)
_TRACK_LINE_SQL = f"""
lines AS (
  SELECT '(''' || track_id || ''', ([' || array_to_string(list_transform(tags, lambda x: '''' || x || ''''), ', ')
         || '], [' || concat_ws(', ', {_FEAT_TXT_SQL}) || ']))' AS value FROM tracks)"""

_LINE_RE = r"^\('((?:[^'\\]|\\.)*)', \(\[(.*)\], \[([^\[\]]*)\]\)\)\s*$"
_ITEM_RE = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\""""


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_PARSE_SQL = f"""
parsed AS (
  SELECT regexp_extract(value, {_sql_str(_LINE_RE)}, 1) AS track_id,
         list_transform(regexp_extract_all(regexp_extract(value, {_sql_str(_LINE_RE)}, 2), {_sql_str(_ITEM_RE)}, 0),
                        lambda x: substr(x, 2, length(x) - 2)) AS tags,
         list_transform(string_split(regexp_replace(regexp_extract(value, {_sql_str(_LINE_RE)}, 3), '[\\[\\]\\s]', '', 'g'), ','),
                        lambda x: TRY_CAST(x AS DOUBLE)) AS features,
         regexp_matches(value, {_sql_str(_LINE_RE)}) AS parse_ok
  FROM lines)"""


@query(
    "parse_track_lines",
    with_ctes(G.SQL_TRACKS, _TRACK_LINE_SQL, _PARSE_SQL)
    + "SELECT track_id, array_to_string(tags, '|') AS tags, len(tags) AS n_tags, "
    + ", ".join(f"{rs_sql(f'features[{i + 1}]')} AS {c}" for i, c in enumerate(FEATS))
    + ", parse_ok FROM parsed",
)
def q_parse_track_lines(spark, sf):
    lines = LT.format_track_lines(G.tracks(spark, sf), FEATS)
    p = LT.parse_track_lines(lines)
    return p.select(
        "track_id",
        F.array_join("tags", "|").alias("tags"),
        F.size("tags").cast("bigint").alias("n_tags"),
        *[rs(F.get("features", i)).alias(c) for i, c in enumerate(FEATS)],
        "parse_ok",
    )


@query(
    "bracket_groups",
    with_ctes(G.SQL_TRACKS, _TRACK_LINE_SQL)
    + "SELECT regexp_extract_all(value, '\\[.*?\\]', 0)[1] AS tags_text, "
    "CAST(len(string_split(regexp_extract_all(value, '\\[.*?\\]', 0)[2], ',')) AS BIGINT) AS n_numbers FROM lines",
)
def q_bracket_groups(spark, sf):
    g = LT.bracket_groups(LT.format_track_lines(G.tracks(spark, sf), FEATS))
    return g.select("tags_text", F.size(F.split("numbers_text", ",")).cast("bigint").alias("n_numbers"))


_TAG_COUNT_LINES_SQL = """
tc_lines AS (SELECT printf('(''%s'',%d)', tag, n) AS value FROM counts)"""


@query(
    "parse_tag_count_lines",
    with_ctes(G.SQL_TRACKS, G.SQL_COUNTS, _TAG_COUNT_LINES_SQL)
    + "SELECT regexp_extract(value, '^\\(''(.*)'',\\s*(-?\\d+)\\)\\s*$', 1) AS tag, "
    "TRY_CAST(regexp_extract(value, '^\\(''(.*)'',\\s*(-?\\d+)\\)\\s*$', 2) AS BIGINT) AS n FROM tc_lines",
)
def q_parse_tag_count_lines(spark, sf):
    return LT.parse_tag_count_lines(LT.format_tag_count_lines(G.counts(spark, sf)))


@query(
    "parse_tag_count_lines_legacy",
    with_ctes(G.SQL_TRACKS, G.SQL_COUNTS, _TAG_COUNT_LINES_SQL)
    + "SELECT string_split(regexp_replace(value, '[''()]', '', 'g'), ',')[1] AS tag, "
    "TRY_CAST(string_split(regexp_replace(value, '[''()]', '', 'g'), ',')[2] AS BIGINT) AS n FROM tc_lines",
)
def q_parse_tag_count_lines_legacy(spark, sf):
    return LT.parse_tag_count_lines(LT.format_tag_count_lines(G.counts(spark, sf)), legacy=True)


_LEGACY_LABELS_SQL = (
    with_ctes(G.SQL_TRACKS, G.SQL_COUNTS, _TRACK_LINE_SQL)
    + "SELECT p.tag, string_split(l.value, chr(39))[2] AS track_id, CAST(1 AS DOUBLE) AS y, "
    "CAST(len(string_split(regexp_extract_all(l.value, '\\[.*?\\]', 0)[2], ',')) AS BIGINT) AS n_features "
    "FROM lines l JOIN popular p ON contains(regexp_extract_all(l.value, '\\[.*?\\]', 0)[1], p.tag)"
)


@query("legacy_line_labels", _LEGACY_LABELS_SQL)
def q_legacy_line_labels(spark, sf):
    lines = LT.format_track_lines(G.tracks(spark, sf), FEATS)
    lab = LT.legacy_line_labels(lines, G.popular(spark, sf))
    return lab.select("tag", "track_id", "y", F.size("features").cast("bigint").alias("n_features"))


# ---------------------------------------------------------------------------
# Labels
# ---------------------------------------------------------------------------


def _label_sql(mode: str) -> str:
    return with_ctes(G.SQL_TRACKS, G.SQL_COUNTS, G.sql_pos(mode)) + "SELECT tag, track_id FROM pos"


@query("label_substring", _label_sql("substring"))
def q_label_substring(spark, sf):
    return L.positive_pairs(G.tracks(spark, sf), G.popular(spark, sf), "substring")


@query("label_exact", _label_sql("exact"))
def q_label_exact(spark, sf):
    return L.positive_pairs(G.tracks(spark, sf), G.popular(spark, sf), "exact")


@query("label_substring_ci", _label_sql("substring_ci"))
def q_label_substring_ci(spark, sf):
    return L.positive_pairs(G.tracks(spark, sf), G.popular(spark, sf), "substring_ci")


@query(
    "label_all_tags",
    with_ctes(G.SQL_TRACKS, G.SQL_COUNTS, G.sql_pos("substring").replace("JOIN popular p", "JOIN counts p"))
    + "SELECT tag, CAST(count(*) AS BIGINT) AS n_positive FROM pos GROUP BY tag",
)
def q_label_all_tags(spark, sf):
    """Every tag as a label, however rare: positives per tag."""
    t = G.stored_tracks(spark, sf)
    pairs = L.positive_pairs(t, T.tag_counts(t), "substring")
    return pairs.groupBy("tag").agg(F.count(F.lit(1)).alias("n_positive"))


@query(
    "class_balance",
    with_ctes(G.SQL_TRACKS, G.SQL_COUNTS, G.sql_pos("substring"), G.sql_frac("balanced"))
    + "SELECT tag, n_total, n_positive, round(positive_rate, 6) AS positive_rate, round(fraction, 6) AS fraction FROM frac",
)
def q_class_balance(spark, sf):
    cc = L.class_counts(G.tracks(spark, sf), G.popular(spark, sf), "substring")
    return cc.select("tag", "n_total", "n_positive", r6("positive_rate").alias("positive_rate"), r6("fraction").alias("fraction"))


@query(
    "class_balance_prior",
    with_ctes(G.SQL_TRACKS, G.SQL_COUNTS, G.sql_pos("exact"), G.sql_frac("prior"))
    + "SELECT tag, n_total, n_positive, round(positive_rate, 6) AS positive_rate, round(fraction, 6) AS fraction FROM frac",
)
def q_class_balance_prior(spark, sf):
    cc = L.class_counts(G.tracks(spark, sf), G.popular(spark, sf), "exact", ratio="prior")
    return cc.select("tag", "n_total", "n_positive", r6("positive_rate").alias("positive_rate"), r6("fraction").alias("fraction"))


# Artist path: artist tags -> artist label -> track label -> features


@query(
    "artist_tag_lists",
    with_ctes(td.ARTIST_TAGS_SQL)
    + "SELECT artist_id, array_to_string(list_sort(list(DISTINCT mbtag)), ',') AS tags, "
    "CAST(count(DISTINCT mbtag) AS BIGINT) AS n_tags FROM artist_tags WHERE mbtag IS NOT NULL GROUP BY artist_id",
)
def q_artist_tag_lists(spark, sf):
    return L.artist_tag_lists(td.artist_tags(spark, sf))


_ARTIST_LABEL_SQL = f"""
artist_y AS (
  SELECT artist_id, max(CASE WHEN contains(lower(mbtag), '{G.ARTIST_TAGSTRING}') THEN 1.0 ELSE 0.0 END)::DOUBLE AS y
  FROM artist_tags GROUP BY artist_id),
track_y AS (
  SELECT ta.track_id, coalesce(ay.y, 0.0)::DOUBLE AS y FROM track_artist ta LEFT JOIN artist_y ay ON ay.artist_id = ta.artist_id)"""


@query("artist_has_tag", with_ctes(td.ARTIST_TAGS_SQL, td.TRACK_ARTIST_SQL, _ARTIST_LABEL_SQL) + "SELECT artist_id, y FROM artist_y")
def q_artist_has_tag(spark, sf):
    return L.artist_has_tag(td.artist_tags(spark, sf), G.ARTIST_TAGSTRING, ignore_case=True)


@query("track_labels_left_join", with_ctes(td.ARTIST_TAGS_SQL, td.TRACK_ARTIST_SQL, _ARTIST_LABEL_SQL) + "SELECT track_id, y FROM track_y")
def q_track_labels_left_join(spark, sf):
    ay = L.artist_has_tag(td.artist_tags(spark, sf), G.ARTIST_TAGSTRING, ignore_case=True)
    return L.track_labels(td.track_artist(spark, sf), ay)


@query(
    "labels_join_features",
    with_ctes(td.ARTIST_TAGS_SQL, td.TRACK_ARTIST_SQL, _ARTIST_LABEL_SQL, td.ORDER_TRACKS_SQL)
    + "SELECT ty.track_id, ty.y, "
    + ", ".join(f"{rs_sql('o.' + c)} AS {c}" for c in td.ORDER_FEATURES)
    + " FROM track_y ty JOIN order_tracks o ON o.track_id = ty.track_id",
)
def q_labels_join_features(spark, sf):
    ay = L.artist_has_tag(td.artist_tags(spark, sf), G.ARTIST_TAGSTRING, ignore_case=True)
    lab = L.track_labels(td.track_artist(spark, sf), ay)
    j = L.labels_with_features(lab, td.order_tracks(spark, sf))
    return j.select("track_id", "y", *[rs(c).alias(c) for c in td.ORDER_FEATURES])


@query(
    "track_info_lookup",
    with_ctes(G.SQL_TRACKS, td.TRACK_INFO_SQL)
    + "SELECT t.track_id, string_split(i.value, '<SEP>')[2] AS info1, string_split(i.value, '<SEP>')[3] AS artist, "
    "string_split(i.value, '<SEP>')[4] AS title, CAST(len(t.tags) AS BIGINT) AS n_tags "
    "FROM tracks t JOIN track_info_lines i ON string_split(i.value, '<SEP>')[1] = t.track_id",
)
def q_track_info_lookup(spark, sf):
    info = LT.parse_track_info(td.track_info_lines(spark, sf))
    t = G.tracks(spark, sf).select("track_id", F.size("tags").cast("bigint").alias("n_tags"))
    return t.join(info, "track_id").select("track_id", "info1", "artist", "title", "n_tags")


# ---------------------------------------------------------------------------
# Statistics and scaling
# ---------------------------------------------------------------------------


@query(
    "column_stats",
    with_ctes(G.SQL_TRACKS)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(count({c}) AS BIGINT) AS n, {rs_sql(f'avg({c})')} AS mean, "
        f"{rs_sql(f'var_samp({c})')} AS variance, {rs_sql(f'stddev_samp({c})')} AS stddev, "
        f"{rs_sql(f'min({c})')} AS min, {rs_sql(f'max({c})')} AS max FROM tracks"
        for c in FEATS
    ),
)
def q_column_stats(spark, sf):
    s = ST.column_stats(G.tracks(spark, sf), FEATS)
    return s.select("feature", "n", *[rs(c).alias(c) for c in ["mean", "variance", "stddev", "min", "max"]])


@query(
    "scale_features",
    with_ctes(G.SQL_TRACKS, G.sql_scaled())
    + "SELECT track_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in FEATS) + " FROM scaled",
)
def q_scale_features(spark, sf):
    return G.scaled(spark, sf).select("track_id", *[r6(c).alias(c) for c in FEATS])


@query(
    "scale_fit_on_train",
    with_ctes(
        G.SQL_TRACKS,
        f"\nseen AS (SELECT * FROM tracks WHERE {unit_hash_sql('track_id', salt='split', seed=SEED)} < {G.TRAIN_FRACTION})",
        G.sql_scaled().replace("AS (SELECT avg", "AS (SELECT avg").replace(" FROM tracks),", " FROM seen),", 1),
    )
    + "SELECT track_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in FEATS) + " FROM scaled",
)
def q_scale_fit_on_train(spark, sf):
    """The scaler fitted on the training part only, applied to all tracks."""
    t = S.split_train_test(G.stored_tracks(spark, sf), seed=SEED)
    out = scaling.standard_scale(t, FEATS, fit_on="train")
    return out.select("track_id", *[r6(c).alias(c) for c in FEATS])


_SEVEN = [FEATS[i] for i in SEVEN_FEATURE_INDEXES]


@query(
    "project_seven_features",
    with_ctes(G.SQL_TRACKS) + "SELECT track_id, " + ", ".join(f"{rs_sql(c)} AS {c}" for c in _SEVEN) + " FROM tracks",
)
def q_project_seven_features(spark, sf):
    """Track id and the older seven features, from legacy text lines."""
    lines = LT.format_track_lines(G.tracks(spark, sf), FEATS)
    p = LT.seven_features(LT.parse_track_lines(lines), _SEVEN)
    return p.select("track_id", *[rs(c).alias(c) for c in _SEVEN])


@query(
    "class_feature_means",
    with_ctes(*G.sql_examples_chain())
    + "SELECT tag, y, CAST(count(*) AS BIGINT) AS n, "
    + ", ".join(f"round(avg({c}), 6) AS mean_{c}" for c in FEATS)
    + " FROM examples GROUP BY tag, y",
)
def q_class_feature_means(spark, sf):
    m = ST.class_feature_means(G.examples(spark, sf), FEATS)
    return m.select("tag", "y", "n", *[r6(f"mean_{c}").alias(f"mean_{c}") for c in FEATS])


# ---------------------------------------------------------------------------
# Rebalancing and splitting
# ---------------------------------------------------------------------------


@query("rebalance_hash", with_ctes(*G.sql_examples_chain()) + "SELECT tag, track_id, y FROM examples")
def q_rebalance_hash(spark, sf):
    return G.examples(spark, sf).select("tag", "track_id", "y")


@query(
    "rebalance_prior_hash",
    with_ctes(*G.sql_examples_chain(mode="exact", ratio="prior")) + "SELECT tag, track_id, y FROM examples",
)
def q_rebalance_prior_hash(spark, sf):
    return G.examples(spark, sf, mode="exact", ratio="prior").select("tag", "track_id", "y")


@query("split_hash", with_ctes(*G.sql_examples_chain()) + "SELECT tag, track_id, y, split FROM examples")
def q_split_hash(spark, sf):
    return G.examples(spark, sf).select("tag", "track_id", "y", "split")


_SPLIT_WEIGHTS = [0.5, 0.3, 0.2]


@query(
    "split_weights_hash",
    with_ctes(G.SQL_TRACKS)
    + "SELECT track_id, CAST((CASE WHEN v >= 0.5 THEN 1 ELSE 0 END) + (CASE WHEN v >= 0.8 THEN 1 ELSE 0 END) AS INTEGER) AS part "
    + f"FROM (SELECT track_id, {unit_hash_sql('track_id', salt='split', seed=SEED)} AS v FROM tracks)",
)
def q_split_weights_hash(spark, sf):
    t = G.tracks(spark, sf)
    return t.select("track_id", S.split_index("track_id", _SPLIT_WEIGHTS, SEED).cast("int").alias("part"))


@query(
    "sample_one_track",
    with_ctes(G.SQL_TRACKS)
    + f"""SELECT track_id, letter, array_to_string(tags, '|') AS tags FROM tracks
WHERE letter = (SELECT letter FROM (SELECT DISTINCT letter FROM tracks)
                ORDER BY {unit_hash_sql('letter', salt='pick', seed=SEED)}, letter LIMIT 1)
ORDER BY {unit_hash_sql('track_id', salt='pick', seed=SEED)}, track_id LIMIT 1""",
)
def q_sample_one_track(spark, sf):
    t = G.tracks(spark, sf)
    letter = S.sample_one(t.select("letter").distinct(), "letter", SEED)
    chosen = t.join(letter, "letter", "left_semi")
    one = S.sample_one(chosen, "track_id", SEED)
    return one.select("track_id", "letter", F.array_join("tags", "|").alias("tags"))


# ---------------------------------------------------------------------------
# Training steps, scoring, prediction
# ---------------------------------------------------------------------------


def _gradient_sql(loss: str) -> str:
    dot = G.sql_dot("w", "e") + " + w.bias"
    if loss == "hinge":
        s = "(2 * e.y - 1)"
        mult = f"CASE WHEN {s} * ({dot}) < 1 THEN -{s} ELSE 0 END"
        lossx = f"CASE WHEN {s} * ({dot}) < 1 THEN 1 - {s} * ({dot}) ELSE 0 END"
    else:
        mult = f"1 / (1 + exp(-({dot}))) - e.y"
        lossx = f"ln(1 + exp(CASE WHEN e.y = 1 THEN -({dot}) ELSE ({dot}) END))"
    gs = ", ".join(f"round(sum(({mult}) * e.{c}), 6) AS g_{c}" for c in FEATS)
    return (
        with_ctes(*G.sql_examples_chain(), G.sql_weights())
        + f"SELECT e.tag, CAST(count(*) AS BIGINT) AS n, {gs}, round(sum({mult}), 6) AS g_bias, "
        f"round(sum({lossx}), 6) AS loss_sum FROM examples e JOIN weights w ON w.tag = e.tag "
        "WHERE e.split = 'train' GROUP BY e.tag"
    )


def _gradient_query(loss: str) -> Query:
    def q(spark, sf):
        ex = G.examples(spark, sf)
        w = G.weights(ex).withColumnRenamed("bias", "w_bias")
        train = ex.filter(F.col("split") == "train")
        g = TR.gradient_sums(train, w, FEATS, loss)
        outs = [c for c in g.columns if c not in ("tag", "n")]
        return g.select("tag", "n", *[r6(c).alias(c) for c in outs])

    return q


query("svm_gradient_step", _gradient_sql("hinge"))(_gradient_query("hinge"))
query("logistic_gradient_step", _gradient_sql("logistic"))(_gradient_query("logistic"))


_SCORE_ALL_SQL = with_ctes(*G.sql_examples_chain(), G.sql_weights()) + f"""
, margins AS (SELECT s.track_id, w.tag, ({G.sql_dot('w', 's')}) + w.bias AS margin FROM scaled s CROSS JOIN weights w),
ranked AS (SELECT track_id, tag, margin, CAST(row_number() OVER (PARTITION BY track_id ORDER BY margin DESC, tag) AS INTEGER) AS rank FROM margins)
"""


def _score_all(spark, sf, top_k=None):
    ex = G.examples(spark, sf)
    return SC.score_all_tags(G.scaled(spark, sf), G.weights(ex), FEATS, top_k=top_k)


@query("score_margins", _SCORE_ALL_SQL + "SELECT track_id, tag, round(margin, 6) AS margin FROM ranked")
def q_score_margins(spark, sf):
    return _score_all(spark, sf).select("track_id", "tag", r6("margin").alias("margin"))


@query("rank_tags_per_track", _SCORE_ALL_SQL + "SELECT track_id, tag, rank FROM ranked WHERE rank <= 5")
def q_rank_tags_per_track(spark, sf):
    return _score_all(spark, sf, top_k=5).select("track_id", "tag", "rank")


SAMPLED_TRACK_SQL = f"""
, picked AS (
  SELECT track_id FROM tracks
  WHERE letter = (SELECT letter FROM (SELECT DISTINCT letter FROM tracks)
                  ORDER BY {unit_hash_sql('letter', salt='pick', seed=SEED)}, letter LIMIT 1)
  ORDER BY {unit_hash_sql('track_id', salt='pick', seed=SEED)}, track_id LIMIT 1)
"""


@query(
    "prediction_report_lines",
    _SCORE_ALL_SQL + SAMPLED_TRACK_SQL
    + "SELECT r.track_id, r.rank, printf('%-28s | %s', r.tag, CAST(round(r.margin, 6) AS VARCHAR)) AS line FROM ranked r JOIN picked p ON p.track_id = r.track_id",
)
def q_prediction_report_lines(spark, sf):
    t = G.tracks(spark, sf)
    letter = S.sample_one(t.select("letter").distinct(), "letter", SEED)
    one = S.sample_one(t.join(letter, "letter", "left_semi"), "track_id", SEED).select("track_id")
    ex = G.examples(spark, sf)
    chosen = G.scaled(spark, sf).join(one, "track_id", "left_semi")
    ranked = SC.score_all_tags(chosen, G.weights(ex), FEATS)
    return SU.prediction_report_lines(ranked.withColumn("margin", r6("margin")))


@query(
    "prediction_report",
    _SCORE_ALL_SQL + SAMPLED_TRACK_SQL + ", " + td.TRACK_INFO_SQL.strip("\n") + """
, info AS (SELECT string_split(value, '<SEP>')[1] AS track_id, string_split(value, '<SEP>')[3] AS artist,
                  string_split(value, '<SEP>')[4] AS title FROM track_info_lines)
SELECT i.track_id, h.line_no, h.line FROM info i JOIN picked p ON p.track_id = i.track_id,
  LATERAL (SELECT * FROM (VALUES (-5, '""" + REPORT_TRACK + """' || i.track_id), (-4, '""" + REPORT_ARTIST + """' || i.artist),
                                 (-3, '""" + REPORT_TITLE + """' || i.title),
                                 (-2, '""" + REPORT_TAG_HEADING.ljust(28) + REPORT_MARGIN_HEADING + """'),
                                 (-1, repeat('-', 29) || '+' || repeat('-', 29))) AS v(line_no, line)) h
UNION ALL
SELECT r.track_id, r.rank AS line_no, printf('%-28s | %s', r.tag, CAST(round(r.margin, 6) AS VARCHAR)) AS line
FROM ranked r JOIN picked p ON p.track_id = r.track_id""",
)
def q_prediction_report(spark, sf):
    t = G.tracks(spark, sf)
    letter = S.sample_one(t.select("letter").distinct(), "letter", SEED)
    one = S.sample_one(t.join(letter, "letter", "left_semi"), "track_id", SEED).select("track_id")
    ex = G.examples(spark, sf)
    chosen = G.scaled(spark, sf).join(one, "track_id", "left_semi")
    ranked = SC.score_all_tags(chosen, G.weights(ex), FEATS)
    info = LT.parse_track_info(td.track_info_lines(spark, sf))
    return SU.prediction_report(ranked.withColumn("margin", r6("margin")), info).select("track_id", F.col("line_no").cast("int").alias("line_no"), "line")


_PRED_CHAIN = [*G.sql_examples_chain(), G.sql_weights(), G.sql_test_pred()]


@query("predict_labels", with_ctes(*_PRED_CHAIN) + "SELECT tag, track_id, y, prediction FROM test_pred")
def q_predict_labels(spark, sf):
    return G.test_predictions(spark, sf).select("tag", "track_id", "y", "prediction")


CONFUSION_SQL = """
SELECT tag, n, n0, n1,
  round(tn / NULLIF(n0, 0), 6) AS recall0, round(tn / NULLIF(pred0, 0), 6) AS precision0,
  round(tp / NULLIF(n1, 0), 6) AS recall1, round(tp / NULLIF(pred1, 0), 6) AS precision1,
  round(rightc / NULLIF(n, 0), 6) AS accuracy, round((n - rightc) / NULLIF(n, 0), 6) AS test_error,
  round(n1 / NULLIF(n, 0), 6) AS positive_rate, round(n1 / NULLIF(n, 0), 6) AS mean_label,
  round(pred1 / NULLIF(n, 0), 6) AS mean_prediction
FROM (SELECT tag, CAST(count(*) AS BIGINT) AS n,
        CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n1,
        CAST(sum(CASE WHEN y <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS n0,
        CAST(sum(CASE WHEN y = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
        CAST(sum(CASE WHEN y <> 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
        CAST(sum(CASE WHEN prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pred1,
        CAST(sum(CASE WHEN prediction <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS pred0,
        CAST(sum(CASE WHEN y = prediction THEN 1 ELSE 0 END) AS BIGINT) AS rightc
      FROM test_pred GROUP BY tag)"""


@query("confusion_report", with_ctes(*_PRED_CHAIN) + CONFUSION_SQL)
def q_confusion_report(spark, sf):
    c = M.confusion_report(G.test_predictions(spark, sf))
    ints = ["tag", "n", "n0", "n1"]
    return c.select(*ints, *[r6(x).alias(x) for x in c.columns if x not in ints])


_REPORT_LINES_SQL = with_ctes(*_PRED_CHAIN) + f"""
, report AS ({CONFUSION_SQL}),
told AS (SELECT tag, CAST(n0 AS VARCHAR) AS n0, CAST(n1 AS VARCHAR) AS n1,
  {", ".join(f"coalesce(CAST({c} AS VARCHAR), 'null') AS {c}" for c in (
      "recall0", "precision0", "recall1", "precision1", "test_error", "positive_rate", "mean_label", "mean_prediction"))}
  FROM report)
SELECT tag, l.line_no, l.line FROM told, LATERAL (SELECT * FROM (VALUES
  (0, 'label 0: ' || n0 || ' rows, recall ' || recall0 || ', precision ' || precision0),
  (1, 'label 1: ' || n1 || ' rows, recall ' || recall1 || ', precision ' || precision1),
  (2, 'test error ' || test_error), (3, 'share of label 1 ' || positive_rate),
  (4, 'mean label ' || mean_label), (5, 'mean prediction ' || mean_prediction)) AS v(line_no, line)) l"""


@query("confusion_report_lines", _REPORT_LINES_SQL)
def q_confusion_report_lines(spark, sf):
    return M.confusion_report_lines(q_confusion_report(spark, sf))


def _areas_sql(score_col: str) -> str:
    scored = f"\nscored AS (SELECT tag, y, {score_col} AS score FROM test_pred)"
    return with_ctes(*_PRED_CHAIN, scored, M.CURVE_AREAS_SQL)


_AREAS_SELECT = "SELECT tag, n_pos, n_neg, round(auroc, 6) AS auroc, round(auprc, 6) AS auprc FROM areas"


def _areas(spark, sf, score_col):
    p = G.test_predictions(spark, sf).withColumn("score", F.col(score_col))
    a = M.curve_areas(p)
    return a.select("tag", "n_pos", "n_neg", r6("auroc").alias("auroc"), r6("auprc").alias("auprc"))


@query("auc_by_tag_label", _areas_sql("prediction") + _AREAS_SELECT)
def q_auc_by_tag_label(spark, sf):
    return _areas(spark, sf, "prediction")


@query("auc_by_tag_margin", _areas_sql("margin") + _AREAS_SELECT)
def q_auc_by_tag_margin(spark, sf):
    return _areas(spark, sf, "margin")


# ---------------------------------------------------------------------------
# Metric lines and the model summary
# ---------------------------------------------------------------------------


def _metrics(spark, sf) -> DataFrame:
    """(tag, auroc, auprc, train_seconds) from the label-score evaluation.

    ``train_seconds`` carries the test-set size here: the catalogue has no
    wall-clock times that both engines could agree on.
    """
    p = G.test_predictions(spark, sf).withColumn("score", F.col("prediction"))
    a = M.curve_areas(p)
    return a.select("tag", "auroc", "auprc", (F.col("n_pos") + F.col("n_neg")).alias("train_seconds"))


_METRICS_SQL = "\nmetrics AS (SELECT tag, auroc, auprc, n_pos + n_neg AS train_seconds FROM areas)"


@query(
    "parse_metric_lines",
    _areas_sql("prediction")[:-1] + "," + _METRICS_SQL.strip("\n") + f"""
, mlines AS (
  SELECT tag, '{METRIC_AUROC_PREFIX} = ' || CAST(auroc AS VARCHAR) AS value FROM metrics
  UNION ALL SELECT tag, '{METRIC_AUPRC_PREFIX} = ' || CAST(auprc AS VARCHAR) FROM metrics
  UNION ALL SELECT tag, '{METRIC_TIME_PREFIX}: ' || CAST(train_seconds AS VARCHAR) FROM metrics)
SELECT tag,
  round(max(CASE WHEN string_split(value, ' = ')[1] = '{METRIC_AUROC_PREFIX}' THEN TRY_CAST(string_split(value, ' = ')[2] AS DOUBLE) END), 6) AS auroc,
  round(max(CASE WHEN string_split(value, ' = ')[1] = '{METRIC_AUPRC_PREFIX}' THEN TRY_CAST(string_split(value, ' = ')[2] AS DOUBLE) END), 6) AS auprc,
  max(CASE WHEN string_split(value, ': ')[1] = '{METRIC_TIME_PREFIX}' THEN TRY_CAST(string_split(value, ': ')[2] AS BIGINT) END) AS train_seconds
FROM mlines GROUP BY tag""",
)
def q_parse_metric_lines(spark, sf):
    lines = LT.format_metric_lines(_metrics(spark, sf))
    p = LT.parse_metric_lines(lines)
    return p.select("tag", r6("auroc").alias("auroc"), r6("auprc").alias("auprc"), "train_seconds")


_SUMMARY_CHAIN_SQL = _areas_sql("prediction")[:-1] + "," + _METRICS_SQL.strip("\n") + f"""
, summary AS (
  SELECT c.tag, c.n AS song_count, m.auroc, m.auprc, m.train_seconds
  FROM popular c JOIN metrics m ON m.tag = c.tag)
"""


def _summary(spark, sf) -> DataFrame:
    return SU.summarize_models(G.popular(spark, sf), _metrics(spark, sf))


@query(
    "model_summary",
    _SUMMARY_CHAIN_SQL + "SELECT tag, song_count, round(auroc, 6) AS auroc, round(auprc, 6) AS auprc FROM summary",
)
def q_model_summary(spark, sf):
    s = _summary(spark, sf)
    return s.select("tag", "song_count", r6("auroc").alias("auroc"), r6("auprc").alias("auprc"))


@query(
    "summary_means",
    _SUMMARY_CHAIN_SQL
    + "SELECT CAST(count(*) AS BIGINT) AS n_tags, round(avg(auroc), 6) AS mean_auroc, round(avg(auprc), 6) AS mean_auprc FROM summary",
)
def q_summary_means(spark, sf):
    m = SU.metric_means(_summary(spark, sf))
    return m.select("n_tags", r6("mean_auroc").alias("mean_auroc"), r6("mean_auprc").alias("mean_auprc"))


@query(
    "summary_quartiles",
    _SUMMARY_CHAIN_SQL
    + " UNION ALL ".join(
        f"SELECT '{c}' AS metric, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q1, "
        f"round(quantile_cont({c}, 0.5), 6) AS median, round(avg({c}), 6) AS mean, "
        f"round(quantile_cont({c}, 0.75), 6) AS q3, round(max({c}), 6) AS max FROM summary"
        for c in ("auroc", "auprc")
    ),
)
def q_summary_quartiles(spark, sf):
    q = SU.summary_quartiles(_summary(spark, sf))
    return q.select("metric", *[r6(c).alias(c) for c in ["min", "q1", "median", "mean", "q3", "max"]])


@query(
    "summary_rounded",
    _SUMMARY_CHAIN_SQL + "SELECT tag, song_count, round(auroc, 2) AS auroc, round(auprc, 2) AS auprc FROM summary",
)
def q_summary_rounded(spark, sf):
    return SU.summary_rounded(_summary(spark, sf)).select("tag", "song_count", "auroc", "auprc")


__all__ = ["ORACLE_SQL", "QUERIES", "clean_tag_name"]
