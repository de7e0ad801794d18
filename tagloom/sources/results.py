"""The store of trained tags: per-tag tables that several runs add to.

    out/weights/run-<id>/bucket=<b>/...    one folder for each run and table
    out/metrics/run-<id>/bucket=<b>/...
    out/manifest/<number>-<id>.json        a run that is complete

A run writes its tables into folders of its own and then its manifest entry, which
a rename brings into place in one step. Readers take the runs that have an entry
and see all of a run's tables or none: a run that dies on the way leaves folders
that nobody reads (``remove_uncommitted``), and two runs at once don't touch each
other's. A tag that several runs wrote counts from the latest: the highest
number, and of equal numbers (runs at once) the highest id, for all tables alike.

Inside a run a tag lies in the bucket that its crc32 gives, sorted, with a Bloom
filter for each row group, so that reading one tag opens one file of a run.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows that one bucket of a run is meant to hold.
TAGS_A_BUCKET = 10_000


@dataclass(frozen=True)
class Entry:
    """A complete run: its number, id, buckets and rows of each table."""

    number: int
    id: str
    buckets: int
    rows: dict


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def _children(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, seconds of the last change) of what lies in a folder, hidden names left out."""
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        return []
    found = [(s.getPath().getName(), s.getModificationTime() / 1000.0) for s in fs.listStatus(at)]
    return sorted(x for x in found if x[0][0] not in "._")


def _read_text(spark: SparkSession, path: str) -> str:
    fs, at = _fs(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def committed(spark: SparkSession, out: str) -> list[Entry]:
    """The complete runs in their order: those with an entry whose tables are all there."""
    names = [n for n, _ in _children(spark, f"{out}/manifest") if n.endswith(".json")]
    told = [Entry(**json.loads(_read_text(spark, f"{out}/manifest/{n}"))) for n in names]
    there = [e for e in told if all(_exists(spark, f"{out}/{name}/run-{e.id}") for name in e.rows)]
    return sorted(there, key=lambda e: (e.number, e.id))


def _only_runs(spark: SparkSession, path: str) -> None:
    strange = [n for n, _ in _children(spark, path) if not n.startswith("run-")]
    if strange:
        raise RuntimeError(f"{path} holds files that no run of this store wrote, such as {strange[0]}")


class Run:
    """One run's writes: ``write`` each table, then ``commit`` them together."""

    def __init__(self, spark: SparkSession, out: str, n_tags: int):
        self.spark, self.out, self.id = spark, out, uuid.uuid4().hex
        self.number = max((e.number for e in committed(spark, out)), default=0) + 1
        self.buckets = max(1, -(-n_tags // TAGS_A_BUCKET))
        self.rows: dict[str, int] = {}

    def write(self, name: str, table: DataFrame) -> None:
        """Write one row a tag into this run's folder of table ``name``."""
        _only_runs(self.spark, f"{self.out}/{name}")
        seen = Observation()
        rows = table.withColumn("run", F.lit(self.number).cast("bigint")).withColumn("run_id", F.lit(self.id))
        bucket = (F.crc32(F.col("tag").cast("string").cast("binary")) % self.buckets).cast("int")
        dealt = rows.withColumn("bucket", bucket).repartition(self.buckets, "bucket").sortWithinPartitions("bucket", "tag")
        writer = dealt.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy("bucket")
        writer = writer.option("parquet.bloom.filter.enabled#tag", "true")
        writer.option("parquet.bloom.filter.expected.ndv#tag", str(TAGS_A_BUCKET)).parquet(f"{self.out}/{name}/run-{self.id}")
        self.rows[name] = seen.get["rows"]

    def commit(self) -> Entry:
        """Make all tables of the run visible at once."""
        entry = Entry(self.number, self.id, self.buckets, self.rows)
        folder = f"{self.out}/manifest"
        fs, ready = _fs(self.spark, f"{folder}/.{self.id}.tmp")
        stream = fs.create(ready, False)
        stream.write(bytearray(json.dumps(entry.__dict__).encode()))
        stream.close()
        final = self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{self.number:010d}-{self.id}.json")
        if not fs.rename(ready, final):
            raise RuntimeError(f"the manifest entry of run {self.id} could not be put in place")
        return entry


def _latest(rows: DataFrame) -> DataFrame:
    last = rows.groupBy("tag").agg(F.max(F.struct("run", "run_id")).alias("_last"))
    own = F.struct("run", "run_id")
    return rows.join(last.withColumnRenamed("tag", "_tag"), (F.col("tag") == F.col("_tag")) & (own == F.col("_last")), "left_semi")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The latest row of each tag in table ``path`` (``out/weights``), with its ``run``."""
    out, name = path.rstrip("/").rsplit("/", 1)
    _only_runs(spark, f"{out}/{name}")
    runs = committed(spark, out)
    if not runs:
        raise FileNotFoundError(f"no complete run at {out}")
    rows = spark.read.option("recursiveFileLookup", "true").parquet(*[f"{path.rstrip('/')}/run-{e.id}" for e in runs])
    return _latest(rows).drop("run_id")


def read_tag(spark: SparkSession, out: str, name: str, tag: str) -> DataFrame:
    """The latest row of one tag, from the one bucket of each run that may hold it."""
    places = [
        f"{out}/{name}/run-{e.id}/bucket={zlib.crc32(str(tag).encode()) % e.buckets}" for e in committed(spark, out)
    ]
    there = [p for p in places if _exists(spark, p)]
    if not there:
        return read_results(spark, f"{out}/{name}").limit(0)
    rows = spark.read.option("recursiveFileLookup", "true").parquet(*there).filter(F.col("tag") == tag)
    return _latest(rows).drop("run_id")


def remove_uncommitted(spark: SparkSession, out: str, names: list[str], older_than: float) -> list[str]:
    """Delete folders of runs without a manifest entry that have not changed for
    ``older_than`` seconds, so that runs at work are left alone. Returns their names."""
    known = {e.id for e in committed(spark, out)}
    gone = []
    for name in names:
        for folder, changed in _children(spark, f"{out}/{name}"):
            if folder.startswith("run-") and folder[4:] not in known and time.time() - changed > older_than:
                fs, at = _fs(spark, f"{out}/{name}/{folder}")
                fs.delete(at, True)
                gone.append(f"{name}/{folder}")
    return gone
