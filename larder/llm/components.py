"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import settle


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component): every node of an edge with the smallest node it is connected to.

    Alternates the large-star and small-star steps until the edges form stars around the smallest nodes,
    which takes about log(n) rounds. A node's neighbours are only ever aggregated or joined, never gathered,
    so hubs do no harm. Null ends and loops are ignored; an empty table gives no rows.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    edges = settle(edges.filter(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(small.unionAll(smallest.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
