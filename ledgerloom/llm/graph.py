"""Connected components of an edge table, by alternating large and small stars.

Both star steps are a grouped minimum (combined map-side) and a join on the
node, so a hub with a third of all edges is partial sums and a splittable join
rather than one task. Each round is a written table below the shared folder:
the lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import scratch_path


@contextmanager
def _shuffles_end_with_their_query(spark: SparkSession):
    """Spark removes the shuffle files of a query when it ends, rather than
    when the driver next collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared folder."""
    path = scratch_path(spark, name)
    with _shuffles_end_with_their_query(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _star(edges: DataFrame, own: bool) -> DataFrame:
    """Point every ``v`` at the smallest neighbour of its ``u``; with ``own``
    ``u`` itself is pointed there as well."""
    low = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    out = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if own:
        out = out.unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``: root is the smallest
    node reachable. Nodes without an edge to another node are not listed;
    self loops and repeated edges are ignored; no edges give no rows."""
    now = stored(spark, edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        now = stored(spark, _star(down, own=True), "stars")
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                       F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
