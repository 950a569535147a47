"""Connected components by alternating large and small stars, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from syncloom.session import discard, scratch_path, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node ties its larger (or smaller) neighbours to the smallest node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("w", "m").alias("m"))
    tied = both.join(least, F.col("u") == F.col("w"))
    if large:
        out = tied.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("w").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of every node of ``links`` (columns ``a``, ``b``, any comparable type).

    Rounds until nothing changes, a logarithmic number; each is a table in the shared folder, so no lineage grows and a lost
    executor costs one round. Only the number and a checksum of the edges come to the driver.
    """
    spark = links.sparkSession
    path = scratch_path(spark, "edges")
    edges = stored(links.where("a <> b").distinct(), path)
    before = None
    while True:
        mark = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if mark == before or mark["n"] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        before = mark
        fresh = scratch_path(spark, "edges")
        edges = stored(_star(_star(edges, True), False), fresh)
        discard(spark, path)
        path = fresh
