"""Per-track binary files (HDF5 in the original data) as a distributed scan.

``spark.read.format("binaryFile")`` lists the folder tree in parallel
(``recursiveFileLookup`` + ``pathGlobFilter``), and a decoder turns each
file's bytes into track rows inside ``mapInPandas``. The decoder is a plain
function ``bytes -> list[(track_id, tags, features)]``, so one file may hold
one track (per-track files) or many (summary files).

``hdf5_decoder`` needs ``h5py``, which is optional; ``json_lines_decoder``
reads the JSON-lines stand-in used in tests. A file that can't be decoded gives
one row with its ``error`` and no track, and the others go on.

``read_track_lines`` is for files of many records, one a line: the scan packs
small files into one task and cuts large ones at line ends, so that no file has
to fit a task; a line that can't be parsed is a row with an ``error``.
"""

from __future__ import annotations

import io
import json
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.config import TRACK_FEATURE_POSITIONS, TRACK_FEATURES, TRACK_ID_POSITION

Decoder = Callable[[bytes], list]


def hdf5_decoder(
    positions: Sequence[int] = TRACK_FEATURE_POSITIONS, id_position: int = TRACK_ID_POSITION
) -> Decoder:
    """Decoder for per-track HDF5 files: first row of analysis/songs, artist tags."""

    def decode(content: bytes) -> list:
        try:
            import h5py  # optional dependency
        except ImportError as e:  # pragma: no cover - depends on the image
            raise RuntimeError("h5py is required to decode HDF5 track files") from e
        with h5py.File(io.BytesIO(content), "r") as h5:
            songs = h5["analysis"]["songs"]
            out = []
            for row in songs[:]:
                tid = row[id_position]
                tid = tid.decode() if isinstance(tid, bytes) else str(tid)
                tags = [t.decode("utf-8", "replace") if isinstance(t, bytes) else str(t)
                        for t in h5["musicbrainz"]["artist_mbtags"][:]]
                out.append((tid, tags, [float(row[i]) for i in positions]))
            return out

    return decode


def json_lines_decoder(content: bytes) -> list:
    """Stand-in decoder: one JSON object per line with track_id, tags, features."""
    out = []
    for line in content.decode("utf-8").splitlines():
        if line.strip():
            o = json.loads(line)
            out.append((str(o["track_id"]), list(o.get("tags") or []), [float(x) for x in o["features"]]))
    return out


def read_track_files(
    spark: SparkSession,
    root: str,
    decoder: Decoder = json_lines_decoder,
    glob: str = "*.h5",
    feature_names: Sequence[str] = TRACK_FEATURES,
) -> DataFrame:
    """tracks(track_id, tags, features, <feature_names>..., source_file, error, letter).

    ``error`` is null for tracks; a file that the decoder fails on is one row with
    what it said (``tracks_only`` and ``rejects`` tell them apart)."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "content")
    )

    def decode(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    rows += [(tid, tags, feats, path, None) for tid, tags, feats in decoder(bytes(content))]
                except ImportError:
                    raise
                except Exception as e:  # noqa: BLE001 - whatever a decoder says of a broken file is its row
                    rows.append((None, None, None, path, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["track_id", "tags", "features", "source_file", "error"])

    schema = "track_id string, tags array<string>, features array<double>, source_file string, error string"
    return _named(files.mapInPandas(decode, schema), feature_names)


def _named(tracks: DataFrame, feature_names: Sequence[str]) -> DataFrame:
    named = [F.get(F.col("features"), i).alias(n) for i, n in enumerate(feature_names)]
    return tracks.select("track_id", "tags", "features", *named, "source_file", "error").withColumn(
        "letter", F.substring("track_id", 3, 1)
    )


_LINE = "track_id string, tags array<string>, features array<double>, _broken string"


def read_track_lines(
    spark: SparkSession, root: str, glob: str = "*.json", feature_names: Sequence[str] = TRACK_FEATURES
) -> DataFrame:
    """The columns of ``read_track_files`` from files with one JSON object a line;
    empty lines are no records."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(root)
    lines = lines.select("value", F.col("_metadata.file_path").alias("source_file")).filter(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    read = lines.select("source_file", "value", F.from_json("value", _LINE, options).alias("r"))
    lacks = F.col("r._broken").isNotNull() | F.col("r.track_id").isNull() | F.col("r.features").isNull()
    error = F.when(lacks, F.concat(F.lit("not a track: "), F.substring("value", 1, 200)))
    own = [F.when(~lacks, F.col(f"r.{c}")).alias(c) for c in ("track_id", "features")]
    tags = F.when(~lacks, F.coalesce("r.tags", F.array().cast("array<string>"))).alias("tags")
    return _named(read.select(own[0], tags, own[1], "source_file", error.alias("error")), feature_names)


def tracks_only(read: DataFrame) -> DataFrame:
    return read.filter("error IS NULL").drop("error")


def rejects(read: DataFrame) -> DataFrame:
    """(source_file, error) of what could not be read."""
    return read.filter("error IS NOT NULL").select("source_file", "error")
