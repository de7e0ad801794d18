"""Reading and writing the legacy text records.

Formats (see :mod:`tagloom.functions.text` for the fixed patterns):

* track line:  ``('TRACKID', (['tag1', 'tag2'], [1.0, 2.0, ...]))``
* tag count:   ``('tag',123)``
* metrics:     ``Area Under ROC = x`` / ``Area Under Precision-Recall = x`` /
  ``Total time: s``, three lines per tag, one folder per tag
* track info:  ``id<SEP>x<SEP>artist<SEP>title``

Everything is a column expression over ``spark.read.text``: the scan is split
by file blocks and parsing runs in codegen; no line passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.config import (
    METRIC_AUPRC_PREFIX,
    METRIC_AUROC_PREFIX,
    METRIC_TIME_PREFIX,
    SEVEN_FEATURE_INDEXES,
    TRACK_INFO_SEP,
)
from tagloom.functions.text import (
    BRACKET_GROUP_PATTERN,
    TAG_COUNT_LINE_PATTERN,
    TAG_COUNT_STRIP_PATTERN,
    TRACK_LINE_PATTERN,
    parse_number_list,
    parse_printed_list,
)

# ---------------------------------------------------------------------------
# Track lines
# ---------------------------------------------------------------------------


def _quote_item(t):
    """Printed form of one string: double quotes when it holds a single quote only."""
    single = F.concat(F.lit("'"), F.replace(F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit('"'))
    return F.when(t.contains("'") & ~t.contains('"'), double).otherwise(single)


def format_track_lines(tracks: DataFrame, feature_cols: Sequence[str], id_col: str = "track_id") -> DataFrame:
    """value: one legacy text line per track (the old text store's format)."""
    tags = F.array_join(F.transform(F.coalesce(F.col("tags"), F.array().cast("array<string>")), _quote_item), ", ")
    nums = F.concat_ws(", ", *[F.col(c).cast("string") for c in feature_cols])
    line = F.concat(F.lit("('"), F.col(id_col), F.lit("', (["), tags, F.lit("], ["), nums, F.lit("]))"))
    out = tracks.select(line.alias("value"), *(["letter"] if "letter" in tracks.columns else []))
    return out


def parse_track_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """(track_id, tags, features, parse_ok) from legacy track lines.

    ``parse_ok`` is false for lines that do not match the format or hold a
    number that does not parse; such lines are kept (and can be counted)
    rather than silently dropped.
    """
    v = F.col(value_col)
    ok = v.rlike(TRACK_LINE_PATTERN)
    track_id = F.regexp_extract(v, TRACK_LINE_PATTERN, 1)
    tags = parse_printed_list(F.regexp_extract(v, TRACK_LINE_PATTERN, 2))
    feats = parse_number_list(F.regexp_extract(v, TRACK_LINE_PATTERN, 3))
    parsed = lines.select(
        F.when(ok, track_id).alias("track_id"),
        F.when(ok, tags).alias("tags"),
        F.when(ok, feats).alias("features"),
        ok.alias("_line_ok"),
    )
    return parsed.withColumn(
        "parse_ok", F.col("_line_ok") & ~F.exists("features", lambda x: x.isNull())
    ).drop("_line_ok")


def bracket_groups(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """(tags_text, numbers_text): the first two lazily matched ``[...]`` groups.

    The older reader's way to split a line; it breaks on a ``]`` inside a tag.
    """
    groups = F.regexp_extract_all(F.col(value_col), F.lit(BRACKET_GROUP_PATTERN), 0)
    return lines.select(F.get(groups, 0).alias("tags_text"), F.get(groups, 1).alias("numbers_text"))


def read_track_text(spark: SparkSession, path: str) -> DataFrame:
    """Scan legacy track text (a folder, glob or letter folders) and parse it."""
    return parse_track_lines(spark.read.text(path))


def features_to_columns(parsed: DataFrame, feature_names: Sequence[str]) -> DataFrame:
    """Named DOUBLE columns from the parsed ``features`` array (NULL where missing)."""
    return parsed.select(
        "*", *[F.get(F.col("features"), i).alias(name) for i, name in enumerate(feature_names)]
    )


# ---------------------------------------------------------------------------
# Tag-count lines
# ---------------------------------------------------------------------------


def format_tag_count_lines(counts: DataFrame) -> DataFrame:
    """value: ``('tag',n)`` per tag."""
    return counts.select(F.format_string("('%s',%d)", F.col("tag"), F.col("n")).alias("value"))


def parse_tag_count_lines(lines: DataFrame, value_col: str = "value", legacy: bool = False) -> DataFrame:
    """(tag, n) from tag-count lines.

    Strict mode matches the whole line (a tag may hold commas and quotes).
    ``legacy`` reproduces the older cleaner: drop ``'()``, split on ``,``;
    a count that does not parse becomes NULL instead of failing the job.
    """
    v = F.col(value_col)
    if legacy:
        parts = F.split(F.regexp_replace(v, TAG_COUNT_STRIP_PATTERN, ""), ",")
        return lines.select(F.get(parts, 0).alias("tag"), F.get(parts, 1).try_cast("bigint").alias("n"))
    ok = v.rlike(TAG_COUNT_LINE_PATTERN)
    return lines.select(
        F.when(ok, F.regexp_extract(v, TAG_COUNT_LINE_PATTERN, 1)).alias("tag"),
        F.when(ok, F.regexp_extract(v, TAG_COUNT_LINE_PATTERN, 2)).try_cast("bigint").alias("n"),
    )


# ---------------------------------------------------------------------------
# Metric lines
# ---------------------------------------------------------------------------


def format_metric_lines(metrics: DataFrame) -> DataFrame:
    """(tag, line_no, value): the three text lines of each tag's result."""
    lines = F.array(
        F.struct(F.lit(0).alias("line_no"), F.concat(F.lit(f"{METRIC_AUROC_PREFIX} = "), F.col("auroc").cast("string")).alias("value")),
        F.struct(F.lit(1).alias("line_no"), F.concat(F.lit(f"{METRIC_AUPRC_PREFIX} = "), F.col("auprc").cast("string")).alias("value")),
        F.struct(F.lit(2).alias("line_no"), F.concat(F.lit(f"{METRIC_TIME_PREFIX}: "), F.col("train_seconds").cast("string")).alias("value")),
    )
    return metrics.select("tag", F.inline(lines))


def parse_metric_lines(lines: DataFrame, tag_col: str = "tag", value_col: str = "value") -> DataFrame:
    """(tag, auroc, auprc, train_seconds): one grouped pass over all tags' lines."""
    v = F.col(value_col)
    eq = F.split(v, " = ")
    colon = F.split(v, ": ")
    key = F.get(eq, 0)
    return lines.groupBy(tag_col).agg(
        F.max(F.when(key == METRIC_AUROC_PREFIX, F.get(eq, 1).try_cast("double"))).alias("auroc"),
        F.max(F.when(key == METRIC_AUPRC_PREFIX, F.get(eq, 1).try_cast("double"))).alias("auprc"),
        F.max(F.when(F.get(colon, 0) == METRIC_TIME_PREFIX, F.get(colon, 1).try_cast("bigint"))).alias("train_seconds"),
    )


def read_metric_files(spark: SparkSession, results_dir: str, tag_col: str = "tag") -> DataFrame:
    """Metric lines of every tag folder under ``results_dir``, tag = folder name.

    One text scan with the file path from ``_metadata``; no per-tag reads.
    """
    raw = spark.read.text(f"{results_dir.rstrip('/')}/*").select("value", "_metadata.file_path")
    def unescape(c):
        return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))

    # file_path is a URI: undo its escaping first.
    folder = unescape(F.regexp_extract("file_path", r"/([^/]+)/[^/]+$", 1))
    # Partitioned writes name folders ``clean_tag=<escaped value>``.
    partition_value = unescape(F.regexp_extract(folder, r"^clean_tag=(.*)$", 1))
    tag = F.when(folder.startswith("clean_tag="), partition_value).otherwise(folder)
    return parse_metric_lines(raw.select(tag.alias(tag_col), "value"), tag_col=tag_col)


# ---------------------------------------------------------------------------
# Track info
# ---------------------------------------------------------------------------


def parse_track_info(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """(track_id, info1, artist, title) from ``<SEP>``-delimited lines."""
    parts = F.split(F.col(value_col), TRACK_INFO_SEP.replace("<", "\\<").replace(">", "\\>"))
    return lines.select(
        F.get(parts, 0).alias("track_id"),
        F.get(parts, 1).alias("info1"),
        F.get(parts, 2).alias("artist"),
        F.get(parts, 3).alias("title"),
    )


def legacy_line_labels(lines: DataFrame, tags: DataFrame, value_col: str = "value") -> DataFrame:
    """(tag, track_id, y, features) for the positive lines of every tag, the older way.

    The label is a case-sensitive substring test on the *printed* tag list
    (first lazily matched bracket group, quotes and separators included); the
    id is the text between the first two single quotes; the vector is the
    second bracket group. The distinct printed lists are matched to the tags once,
    by their substrings, and joined back; only the positives are emitted
    (negatives are every other line of the tag).
    """
    from tagloom.operators.labels import substring_map

    v = F.col(value_col)
    groups = F.regexp_extract_all(v, F.lit(BRACKET_GROUP_PATTERN), 0)
    parsed = lines.select(
        F.get(F.split(v, "'"), 1).alias("track_id"),
        F.get(groups, 0).alias("_tags_text"),
        parse_number_list(F.coalesce(F.get(groups, 1), F.lit(""))).alias("features"),
    )
    found = substring_map(parsed.select(F.col("_tags_text").alias("text")), tags)
    joined = parsed.join(found, F.col("_tags_text") == F.col("text"))
    return joined.select("tag", "track_id", F.lit(1.0).alias("y"), "features")


def seven_features(parsed: DataFrame, names: list[str]) -> DataFrame:
    """(track_id, <names>): the older seven-feature form of parsed track lines."""
    picked = [F.get("features", F.lit(i)).alias(n) for i, n in zip(SEVEN_FEATURE_INDEXES, names, strict=True)]
    return parsed.select("track_id", *picked)
