"""Connected components of an edge table, by alternating stars.

Every round replaces each node's edges by edges to the smallest node it
knows (first for its larger neighbours, then for its smaller ones) until
nothing changes; the result is one edge from each node to the smallest node
it can reach.  Each round is two joins, written to the shared scratch folder
so that the lineage stays short and a lost executor repeats one round only.
Minima are pre-aggregated before the shuffle, so a hub costs its edges once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbend.session import release, save


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` has a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(moved)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (long columns a, b), root the
    smallest node reachable.  Null ends and loops are ignored; repeated and
    reversed edges change nothing; no edges give an empty table."""
    spark = edges.sparkSession
    edges = (edges.where("a is not null and b is not null and a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    now, path = save(edges, "components")
    before = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            break
        before, old = seen, path
        now, path = save(_small_star(_large_star(now).distinct()).distinct(), "components")
        release(spark, old)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
