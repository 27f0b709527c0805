"""Connected components by alternating large and small stars.

Each round joins every node's neighbours to the smallest of them: the larger
ones in one half-round, the smaller ones in the other.  Components shrink to
stars in a logarithmic number of rounds.  Rounds are cut by written tables; the
driver sees only a count and a checksum of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verilens.session import stored


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its component.

    Edges are pairs of longs; loops, repeats and either direction are fine,
    edges with a null end are dropped.  No edges give no rows."""
    links = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                   .distinct(), "links")
    before = None
    for _ in range(most_rounds):
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        if state[0]:
            links = stored(_small_star(_large_star(links)), "links")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u")
    return (moved.select("v", "m").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
