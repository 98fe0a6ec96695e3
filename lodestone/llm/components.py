"""Connected components of a distributed graph, by alternating large-star and small-star steps.

Each step moves every edge towards the smallest node it can see, in a logarithmic number of rounds.  No links, labels or
components reach the driver, only a count and a checksum per round; rounds end in a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.shared import cut, join_hot


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component) for every node of the links (a, b): component is the smallest node that can be reached.  Loops and repeated links are harmless."""
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark[0] == 0 or tuple(mark) == before:
            break
        before = tuple(mark)
        both = now.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        up = now.select(F.col("b").alias("u"), F.col("a").alias("v"))  # a is the larger, so these are the neighbours above u
        large = join_hot(up, low, "u", "n", 2 * mark[0]).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        other = F.when(F.col("b") != F.col("m"), F.col("b")).otherwise(F.col("a"))  # a itself moves by its link to m, the other neighbours by theirs
        now = cut(large.join(least, "a").select(other.alias("a"), F.col("m").alias("b")).distinct())
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().join(now.select(F.col("a").alias("node")), "node", "left_anti")
    nodes = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return nodes.union(roots.select("node", F.col("node").alias("component")))
