"""Connected components by alternating large-star and small-star, on edge tables of any size."""

from pyspark.sql import DataFrame, functions as F

from reviewsent.sources.shared import stage_table


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node gives its larger neighbours the smallest of its neighbours and itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours with the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes with an edge ``(u, v)``; the component is its smallest node.

    Every round is written to the shared folder and read back, so a lost executor repeats one
    round at most. Rounds end when the edges, then one star per component, stay the same.
    """
    edges = stage_table(edges.select("u", "v").where("u <> v"), "edges")
    before = None
    while (now := _state(edges)) != before and now[0]:
        before = now
        edges = stage_table(_small_star(_large_star(edges)), "edges")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
