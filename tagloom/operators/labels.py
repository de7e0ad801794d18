"""Labels: does a track carry a tag? Plus artist-level labels and examples.

Match modes:

* ``substring`` (default, parity): the tag text occurs inside one of the
  track's tags, case-sensitive, so ``rock`` also labels ``punk rock``.
* ``substring_ci``: the same after lower-casing both sides.
* ``exact``: the tag is one of the track's tags.

One plan at every size. The distinct tag texts of the tracks (the vocabulary)
are matched to the tag list once, through a positional q-gram index: a text has
one entry for each place, the Q characters from there on. A tag of Q characters
or more is looked up by its q-gram that the fewest places of texts have, a
shorter one by the start of the entries, and what is found is verified in the
text. The map from text to tag is then joined to the tracks' tags. No track is
tested against a tag it does not carry, and a text makes no more rows than it has
characters, however long the tags are.

Negatives are never materialised in full: examples keep the positives plus a
hash-drawn sample of negatives, those whose draw lies below the tag's fraction.
Draws are whole numbers below 2^32, so the interval of a tag's draws falls into
cells of a fixed grid (16, 16^2, .. 16^8 cells), at most 15 of each size; a track
lies in one cell of each size. Joined by cell they make the rows that are kept
and no others. Cells that hold many tracks are split by a salt.

A track whose tag list is NULL or empty carries no tag, and a NULL element is no
tag; both are ordinary negatives. The empty tag is inside every text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.config import DEFAULT_SEED, DEFAULT_TRAIN_FRACTION, materialize
from tagloom.operators.sampling import negative_fraction, with_sample_draws
from tagloom.operators.tags import explode_tags

MATCH_MODES = ("exact", "substring", "substring_ci")


#: Characters of an entry of the q-gram index.
Q = 3


def _entries(texts: DataFrame, text: str) -> DataFrame:
    """One row for each place of each text: ``_id`` (a hash of the text) and
    ``_gram``, the Q characters from there on, fewer at the end."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    own = F.col("_id") if "_id" in texts.columns else F.xxhash64(text)
    at = texts.select(own.alias("_id"), F.col(text), F.explode(places).alias("_at"))
    return at.select("_id", F.substring(F.col(text), F.col("_at"), F.lit(Q)).alias("_gram"))


def substring_map(texts: DataFrame, tags: DataFrame, ignore_case: bool = False) -> DataFrame:
    """(text, tag) for each distinct ``text`` that contains a ``tag``.

    Candidates come from the q-gram index as (hash of the text, tag); they are
    verified on the text itself, so equal hashes of two texts do no harm. The
    empty tag is inside every text.
    """
    fold = F.lower if ignore_case else (lambda c: c)
    needles = tags.select("tag").distinct().withColumn("_key", fold(F.col("tag")))
    # The distinct texts are read by each look-up: stored once, not worked out from the tracks again.
    folded = texts.select("text").distinct().filter("text IS NOT NULL").withColumn("_t", fold(F.col("text")))
    folded = materialize(folded.withColumn("_id", F.xxhash64("_t")), "texts")
    entries = _entries(folded, "_t")
    found = []
    sizes = needles.select(F.least(F.length("_key"), F.lit(Q)).alias("n")).distinct()
    for n in sorted(r["n"] for r in sizes.collect()):  # Q + 1 numbers at most
        own = needles.filter((F.length("_key") >= Q) if n == Q else (F.length("_key") == n))
        if n == 0:
            # Folded, there is one empty tag: a table of one row, inside every text.
            places, keys = folded.select("_id", F.substring("_t", 1, 0).alias("_gram")), F.broadcast(own.withColumn("_gram", F.col("_key")))
        elif n < Q:
            start = entries.select("_id", F.substring("_gram", 1, n).alias("_gram"))
            places, keys = start.filter(F.length("_gram") == n), own.withColumn("_gram", F.col("_key"))
        else:
            places, keys = entries, _rarest(entries, own)
        found.append(places.join(keys, "_gram").select("_id", "tag", "_key"))
    if not found:
        return folded.limit(0).select("text", F.lit("").alias("tag"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return folded.join(pairs.distinct(), "_id").filter(F.contains("_t", "_key")).select("text", "tag")


def _rarest(entries: DataFrame, needles: DataFrame) -> DataFrame:
    """(tag, _key, _gram): each tag's q-gram that the fewest entries have. A tag with
    a q-gram that no entry has is in no text and left out."""
    starts = F.sequence(F.lit(1), F.length("_key") - (Q - 1))
    grams = F.transform(starts, lambda i: F.substring(F.col("_key"), i, F.lit(Q)))
    each = needles.select("tag", "_key", F.explode(grams).alias("_gram"))
    known = entries.join(each.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rated = each.join(known, "_gram", "left").groupBy("tag", "_key").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("gram"))).alias("_least")
    )
    return rated.filter("_least.n > 0").select("tag", "_key", F.col("_least.gram").alias("_gram"))


def positive_pairs(tracks: DataFrame, tags: DataFrame, mode: str = "substring", id_col: str = "track_id") -> DataFrame:
    """(tag, track_id), once for every track that carries a tag of ``tags``."""
    if mode not in MATCH_MODES:
        raise ValueError(f"unknown match mode {mode!r}")
    carried = explode_tags(tracks, id_col)
    if mode == "exact":
        return carried.join(tags.select("tag").distinct(), "tag").select("tag", id_col)
    carried = carried.withColumnRenamed("tag", "text")
    found = substring_map(carried.select("text"), tags, ignore_case=mode == "substring_ci")
    return carried.join(found, "text").select("tag", id_col).distinct()


def class_counts(
    tracks: DataFrame,
    tags: DataFrame,
    mode: str = "substring",
    id_col: str = "track_id",
    ratio: str = "balanced",
    positives: DataFrame | None = None,
    n_total: int | None = None,
) -> DataFrame:
    """(tag, n_total, n_positive, positive_rate, fraction) per tag.

    ``n_total`` is one scalar, the track count, counted here if the caller doesn't
    know it; positives are counted per tag from the sparse positive pairs with a
    map-side combined count.
    """
    n_total = tracks.count() if n_total is None else n_total
    pairs = positive_pairs(tracks, tags, mode, id_col) if positives is None else positives
    pos = pairs.groupBy("tag").agg(F.count(F.lit(1)).alias("n_positive"))
    out = tags.select("tag").distinct().join(pos, "tag", "left").fillna(0, ["n_positive"])
    total = F.lit(n_total).cast("bigint")
    return out.select(
        "tag",
        total.alias("n_total"),
        F.col("n_positive").cast("bigint").alias("n_positive"),
        F.try_divide(F.col("n_positive").cast("double"), total.cast("double")).alias("positive_rate"),
        negative_fraction(F.col("n_positive"), total, ratio).alias("fraction"),
    )


#: Grid of the draws: sizes of cells, and bits of a draw that each size adds.
LEVELS, LEVEL_BITS = 8, 4
_DRAWS = 1 << (LEVELS * LEVEL_BITS)


def covered_cells(fractions: DataFrame, n_tracks: int, cell_rows: int, group_col: str = "tag") -> DataFrame:
    """(tag, _level, _cell, _salt): the cells that make up [0, fraction) of each tag,
    a cell that holds more than ``cell_rows`` of the tracks once for each salt.

    Level 0 is the whole range; cell c of level k is [c, c + 1) * 2^32 / 16^k."""
    ends = fractions.withColumn("_end", F.ceil(F.least(F.col("fraction"), F.lit(1.0)) * float(_DRAWS)).cast("bigint"))
    steps = [F.struct(F.lit(0).alias("level"), F.shiftright("_end", LEVELS * LEVEL_BITS).alias("digit"), F.lit(0).cast("bigint").alias("before"))]
    for level in range(1, LEVELS + 1):
        shift = LEVEL_BITS * (LEVELS - level)
        digit = F.shiftright("_end", shift).bitwiseAND((1 << LEVEL_BITS) - 1)
        before = F.shiftright("_end", shift + LEVEL_BITS) * (1 << LEVEL_BITS)
        steps.append(F.struct(F.lit(level).alias("level"), digit.alias("digit"), before.alias("before")))
    digits = ends.select(group_col, F.explode(F.array(*steps)).alias("_s")).filter("_s.digit > 0")
    cells = digits.select(
        group_col, F.col("_s.level").alias("_level"),
        F.explode(F.sequence(F.col("_s.before"), F.col("_s.before") + F.col("_s.digit") - 1)).alias("_cell"),
    )
    return cells.withColumn("_salt", F.explode(F.sequence(F.lit(0), _salts("_level", n_tracks, cell_rows) - 1)))


def _salts(level: str, n_tracks: int, cell_rows: int):
    """How many parts a cell of a level is split into: what its share of the tracks asks for."""
    parts = [max(1, -(-n_tracks // (cell_rows << (LEVEL_BITS * k)))) for k in range(LEVELS + 1)]
    return F.get(F.array(*[F.lit(p) for p in parts]), F.col(level))


def drawn_cells(draws: DataFrame, n_tracks: int, cell_rows: int, id_col: str) -> DataFrame:
    """(id, _level, _cell, _salt): the cell of each level that a track's draw ``u`` lies in."""
    rows = draws.select(id_col, (F.col("u") * float(_DRAWS)).cast("bigint").alias("_k"), F.xxhash64(id_col).alias("_h"))
    cells = F.array(*[
        F.struct(F.lit(k).alias("level"), F.shiftright("_k", LEVEL_BITS * (LEVELS - k)).alias("cell")) for k in range(LEVELS + 1)
    ])
    each = rows.select(id_col, "_h", F.explode(cells).alias("_c")).select(
        id_col, "_h", F.col("_c.level").alias("_level"), F.col("_c.cell").alias("_cell")
    )
    salt = F.pmod(F.col("_h"), _salts("_level", n_tracks, cell_rows).cast("bigint")).cast("int")
    return each.select(id_col, "_level", "_cell", salt.alias("_salt"))


def labelled_examples(
    tracks: DataFrame,
    tags: DataFrame,
    feature_cols: Sequence[str],
    mode: str = "substring",
    seed: int = DEFAULT_SEED,
    ratio: str = "balanced",
    train_fraction: float = DEFAULT_TRAIN_FRACTION,
    id_col: str = "track_id",
    cell_rows: int = 100_000,
) -> DataFrame:
    """examples(tag, track_id, y, split, <features>): rebalanced and split.

    Keeps every positive of every tag and each negative whose draw ``u`` is
    below the tag's fraction; ``split`` comes from a second draw ``v`` of the
    track, so a track is in the same part for every tag. ``cell_rows`` is about
    how many tracks meet under one key while negatives are drawn.
    """
    pos = materialize(positive_pairs(tracks, tags, mode, id_col), "positives")
    n_tracks = tracks.count()
    counts = class_counts(tracks, tags, mode, id_col, ratio, positives=pos, n_total=n_tracks).select("tag", "fraction")
    drawn = with_sample_draws(tracks.select(id_col, *feature_cols), id_col, seed)
    covered = covered_cells(counts, n_tracks, cell_rows)
    cells = drawn_cells(drawn.select(id_col, "u"), n_tracks, cell_rows, id_col)
    kept = cells.join(covered, ["_level", "_cell", "_salt"]).select("tag", id_col)
    negatives = kept.join(pos, ["tag", id_col], "left_anti").withColumn("y", F.lit(0.0))
    pairs = pos.withColumn("y", F.lit(1.0)).unionByName(negatives)
    out = drawn.join(pairs, id_col)
    out = out.withColumn("split", F.when(F.col("v") < F.lit(train_fraction), "train").otherwise("test"))
    return out.select("tag", id_col, "y", "split", *feature_cols)


# ---------------------------------------------------------------------------
# Artist-level labels (artist tags -> track labels via the artist of a track)
# ---------------------------------------------------------------------------


def artist_tag_lists(artist_tags: DataFrame) -> DataFrame:
    """(artist_id, tags, n_tags): sorted distinct tags per artist, joined by ','.

    One shuffle: ``collect_set`` de-duplicates map-side (partial sets merge),
    so no list ever holds more than the artist's distinct tags.
    """
    tags = artist_tags.select("artist_id", "mbtag").filter(F.col("mbtag").isNotNull())
    grouped = tags.groupBy("artist_id").agg(F.array_sort(F.collect_set("mbtag")).alias("_set"))
    return grouped.select(
        "artist_id", F.array_join("_set", ",").alias("tags"), F.size("_set").cast("bigint").alias("n_tags")
    )


def artist_has_tag(artist_tags: DataFrame, tagstring: str, ignore_case: bool = True) -> DataFrame:
    """(artist_id, y): 1.0 if any tag of the artist contains ``tagstring``.

    A ``max`` over a boolean per row -- no tag list is built.
    """
    tag = F.lower(F.col("mbtag")) if ignore_case else F.col("mbtag")
    needle = tagstring.lower() if ignore_case else tagstring
    hit = F.when(tag.contains(F.lit(needle)), 1.0).otherwise(0.0)
    return artist_tags.groupBy("artist_id").agg(F.max(hit).alias("y"))


def track_labels(track_artist: DataFrame, artist_labels: DataFrame) -> DataFrame:
    """(track_id, y): left join tracks to artist labels; no label means 0."""
    joined = track_artist.join(artist_labels, "artist_id", "left")
    return joined.select("track_id", F.coalesce(F.col("y"), F.lit(0.0)).alias("y"))


def labels_with_features(labels: DataFrame, features: DataFrame, id_col: str = "track_id") -> DataFrame:
    """Inner join of labels to features on the track key (tracks without features drop)."""
    return labels.join(features, id_col, "inner")
