"""Tables that several passes of one operator read, kept in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.config import scratch_root, shared_dir

#: Spark's setting that lets go of a query's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a fresh folder among the application's own
    intermediates and read back. This cuts the lineage: a lost executor costs a
    reread of its files, no recomputation, and the shuffles behind the table are
    no longer needed on disk. What is left of them goes when the application ends."""
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{name}")
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``stored`` that no later frame reads."""
    for df in tables:
        base = f"{scratch_root(df.sparkSession)}/llm-"
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if at(folder).toUri().getPath().startswith(at(base).toUri().getPath()):
                at(folder).getFileSystem(conf).delete(at(folder), True)


def text_or_empty(text_col: str):
    return F.coalesce(F.col(text_col), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session, the least number of tasks to deal to."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
