"""The given parquet tables and the stand-in views built from them.

Stand-in mapping (track = part, artist = customer):

* ``part_tracks``: one track per part; tags ``[p_name, p_brand, p_type]``;
  eleven numeric features from the part and its line items.
* ``order_tracks``: one track per order with line-item features; the
  artist of the track is the order's customer.
* ``artist_tags``: distinct ``(o_custkey, o_orderpriority)`` of finished orders.
* ``track_artist``: ``(o_custkey, o_orderkey)``.
* ``track_info_lines``: ``<SEP>``-delimited text lines per part.

Every view has a DuckDB twin (``*_SQL``) so the oracle runs the same logic.
All joins are on keys; aggregates combine map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Feature columns of the part stand-in, in vector order.
PART_FEATURES = [
    "size", "retailprice", "n_lines", "sum_qty", "avg_qty", "min_qty", "max_qty",
    "avg_price", "avg_disc", "avg_tax", "sd_price",
]

# Feature columns of the order stand-in.
ORDER_FEATURES = ["totalprice", "n_lines", "sum_qty", "avg_price", "avg_disc", "avg_tax"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lineitem_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy("l_partkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"),
        F.sum("l_quantity").alias("sum_qty"),
        F.avg("l_quantity").alias("avg_qty"),
        F.min("l_quantity").alias("min_qty"),
        F.max("l_quantity").alias("max_qty"),
        F.avg("l_extendedprice").alias("avg_price"),
        F.avg("l_discount").alias("avg_disc"),
        F.avg("l_tax").alias("avg_tax"),
        F.stddev_samp("l_extendedprice").alias("sd_price"),
    )


def part_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tracks(track_id, tags, <PART_FEATURES>, letter)."""
    part = read_table(spark, sf_dir, "part")
    agg = _lineitem_by_part(spark, sf_dir)
    joined = part.join(agg, part.p_partkey == agg.l_partkey, "left")
    cols = [
        F.col("p_partkey").cast("string").alias("track_id"),
        F.array("p_name", "p_brand", "p_type").alias("tags"),
        F.col("p_size").cast("double").alias("size"),
        F.col("p_retailprice").cast("double").alias("retailprice"),
    ] + [F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in PART_FEATURES[2:]]
    out = joined.select(*cols)
    return out.withColumn("letter", F.substring(F.md5("track_id"), 1, 1))


PART_TRACKS_SQL = """
li_by_part AS (
  SELECT l_partkey,
         CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS sum_qty, avg(l_quantity) AS avg_qty,
         min(l_quantity) AS min_qty, max(l_quantity) AS max_qty, avg(l_extendedprice) AS avg_price,
         avg(l_discount) AS avg_disc, avg(l_tax) AS avg_tax, stddev_samp(l_extendedprice) AS sd_price
  FROM lineitem GROUP BY l_partkey),
tracks AS (
  SELECT CAST(p_partkey AS VARCHAR) AS track_id, [p_name, p_brand, p_type] AS tags,
         CAST(p_size AS DOUBLE) AS size, CAST(p_retailprice AS DOUBLE) AS retailprice,
         coalesce(n_lines, 0.0) AS n_lines, coalesce(sum_qty, 0.0) AS sum_qty,
         coalesce(avg_qty, 0.0) AS avg_qty, coalesce(min_qty, 0.0) AS min_qty,
         coalesce(max_qty, 0.0) AS max_qty, coalesce(avg_price, 0.0) AS avg_price,
         coalesce(avg_disc, 0.0) AS avg_disc, coalesce(avg_tax, 0.0) AS avg_tax,
         coalesce(sd_price, 0.0) AS sd_price,
         substr(md5(CAST(p_partkey AS VARCHAR)), 1, 1) AS letter
  FROM part LEFT JOIN li_by_part ON l_partkey = p_partkey)"""


def order_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order-level tracks(track_id, <ORDER_FEATURES>) for the artist path."""
    orders = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem")
    agg = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"),
        F.sum("l_quantity").alias("sum_qty"),
        F.avg("l_extendedprice").alias("avg_price"),
        F.avg("l_discount").alias("avg_disc"),
        F.avg("l_tax").alias("avg_tax"),
    )
    joined = orders.join(agg, orders.o_orderkey == agg.l_orderkey, "inner")
    return joined.select(
        F.col("o_orderkey").cast("string").alias("track_id"),
        F.col("o_totalprice").cast("double").alias("totalprice"),
        *[F.col(c) for c in ORDER_FEATURES[1:]],
    )


ORDER_TRACKS_SQL = """
li_by_order AS (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS sum_qty,
         avg(l_extendedprice) AS avg_price, avg(l_discount) AS avg_disc, avg(l_tax) AS avg_tax
  FROM lineitem GROUP BY l_orderkey),
order_tracks AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS track_id, CAST(o_totalprice AS DOUBLE) AS totalprice,
         n_lines, sum_qty, avg_price, avg_disc, avg_tax
  FROM orders JOIN li_by_order ON l_orderkey = o_orderkey)"""


def artist_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """artist_tags(artist_id, mbtag): one row per distinct tag of an artist."""
    orders = read_table(spark, sf_dir, "orders")
    return (
        orders.filter(F.col("o_orderstatus") == "F")
        .select(
            F.col("o_custkey").cast("string").alias("artist_id"),
            F.col("o_orderpriority").alias("mbtag"),
        )
        .distinct()
    )


ARTIST_TAGS_SQL = """
artist_tags AS (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS artist_id, o_orderpriority AS mbtag
  FROM orders WHERE o_orderstatus = 'F')"""


def track_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """track_artist(artist_id, track_id)."""
    orders = read_table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_custkey").cast("string").alias("artist_id"),
        F.col("o_orderkey").cast("string").alias("track_id"),
    )


TRACK_ARTIST_SQL = """
track_artist AS (
  SELECT CAST(o_custkey AS VARCHAR) AS artist_id, CAST(o_orderkey AS VARCHAR) AS track_id FROM orders)"""


def track_info_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value: ``track_id<SEP>type<SEP>brand<SEP>name`` per part."""
    part = read_table(spark, sf_dir, "part")
    return part.select(
        F.concat_ws("<SEP>", F.col("p_partkey").cast("string"), "p_type", "p_brand", "p_name").alias("value")
    )


TRACK_INFO_SQL = """
track_info_lines AS (
  SELECT concat_ws('<SEP>', CAST(p_partkey AS VARCHAR), p_type, p_brand, p_name) AS value FROM part)"""


def embedding_tracks(spark: SparkSession, sf_dir: str, dims: int = 64) -> DataFrame:
    """Trainable set with signal: tags = [label as text], features e0..e{dims-1}."""
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").cast("string").alias("track_id"),
        F.array(F.concat(F.lit("label_"), F.col("label").cast("string"))).alias("tags"),
        *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(dims)],
    )
