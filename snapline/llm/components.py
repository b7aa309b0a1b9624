"""Connected components of a link table, with every node's label its smallest reachable node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapline.operators.joins import spread_join
from snapline.session import scratch


def _with_least(edges: DataFrame) -> DataFrame:
    """``u, v, m``: each edge with the least of ``u`` and its neighbours; a hub's edges stay splittable."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return spread_join(edges, least, [("u", "w")], "inner")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller node."""
    starred = _with_least(edges)
    kept = starred.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.union(starred.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``u, v``: each linked node but the least of its component, and that least node.

    ``links`` holds pairs ``u, v`` of comparable values. Alternating large and small stars, which
    end in one star per component after few rounds even for long chains; each round is written to
    the shared scratch folder, so a lost executor repeats one round at most.
    """
    spark = links.sparkSession
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    seen = None
    while True:
        path = scratch(spark, "stars")
        edges.write.parquet(path)
        edges = spark.read.parquet(path)
        digest = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if digest == seen:
            return edges
        seen = digest
        edges = _small_star(_large_star(edges))
