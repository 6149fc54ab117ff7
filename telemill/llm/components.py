"""Connected components of a large link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from telemill.llm.words import kept


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of a link; the component is its smallest node.

    Alternates the two star operations (each node's larger, then smaller neighbours move to the
    smallest neighbour known) until nothing changes, a number of rounds logarithmic in the number
    of nodes. Null and self links are ignored, repeated links count once.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v and v is not null")
    edges, before = kept(edges.distinct(), "links"), None
    while True:
        edges = kept(_small_star(_large_star(edges)), "links")
        now = edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", "m")).filter("u > v").distinct()
