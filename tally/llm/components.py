"""Connected components of a graph given by links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.storage import stored


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of a link between two nodes.

    Alternates two steps until nothing changes: each node hands its larger neighbours,
    then its smaller ones, to the smallest it knows. Every step is an aggregation with
    map-side combining and a join that Spark may split at hot nodes, because both its
    sides are read from tables. The rounds grow with the logarithm of the longest path.
    Null ends and links of a node with itself are ignored.
    """
    ends = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    edges = stored(
        ends.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links"
    )
    before = _print(edges)
    while before[0]:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = stored(large, "links")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        )
        edges = stored(small.select("e.a", "e.b").where("a <> b").distinct(), "links")
        after = _print(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
