"""Connected components of links between numbered rows, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.session import cut, discard


def components(links: DataFrame) -> DataFrame:
    """(node, root) of each node of the links (a, b); root is the smallest node of its component. Each step ties a node's
    neighbours to the smallest one it knows, those above it first, then those below. Neighbours are aggregated and joined,
    never listed; the steps grow with the logarithm of the longest path."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "components")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        above = cut(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "components")
        lower = above.groupBy("u").agg(F.min("v").alias("m"))
        joined = above.join(lower, "u")
        below = cut(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(lower.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "components")
        discard(edges, above)
        edges = below
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
    out = cut(roots, "components-roots")
    discard(edges)
    return out
