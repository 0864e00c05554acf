"""Connected components of a graph whose edges are rows."""

from pyspark.sql import functions as F

from casecast.session import staged


def _digest(edges):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges):
    """`node` and `root`, the smallest node it can reach, for every node of `edges` (`a`, `b`, both bigint).

    Rounds of two steps, after Kiveris et al. 2014: each node ties its larger neighbours to its smallest one, then
    each node ties its smaller neighbours to the smallest. The number of edges never grows, and rounds are about
    the logarithm of the longest chain. A node's smallest neighbour is found by partial aggregation, so hubs send one
    row per task; every round is staged, and only a count and a checksum of its edges reach the driver.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = staged(edges.where("a <> b").select(larger, smaller).distinct(), "edges")
    seen = _digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.where("b > a").join(least, "a").where("b <> least")
        large = large.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        large = staged(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        edges = staged(small.where("a <> b").distinct(), "edges")
        now = _digest(edges)
        if now == seen:
            roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
            hubs = edges.select(F.col("b").alias("node")).distinct()
            return roots.unionByName(hubs.join(roots, "node", "left_anti").select("node", F.col("node").alias("root")))
        seen = now
