"""Connected components of an edge table, in rounds of DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logcube.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b; any orderable type):
    root is the smallest node of its component.

    Alternates two steps until only stars are left: every node ties its larger
    neighbours to its smallest one (large star), then its smaller neighbours
    (small star); rounds grow with the logarithm of the longest path.  Each
    step is one aggregation, whose partial results meet a hot node's edges
    before the shuffle, and one join with one row per node, which Spark can
    split; its result is written out, so a lost executor repeats one step."""
    pairs = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written before the join, so that its hot partitions can be split.
        least = stored(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.where("a <> b").distinct(), "large-star")
        # Small star: the lower neighbours of a node, and itself, go to the lowest.
        low = stored(large.groupBy("a").agg(F.min("b").alias("low")), "lowest")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.unionByName(low.select("a", F.col("low").alias("b")))
        pairs = stored(small.where("a <> b").distinct(), "small-star")
        if _open(pairs).isEmpty():
            break
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))


def _open(pairs: DataFrame) -> DataFrame:
    """Nodes that are tied to two others, or to one that is tied itself."""
    several = pairs.groupBy("a").count().where("count > 1").select("a")
    lower = pairs.join(pairs.select(F.col("a").alias("b")), "b", "left_semi").select("a")
    return several.unionByName(lower)
