"""Connected components of a graph given as pairs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.common import staged


def _least(pairs: DataFrame) -> DataFrame:
    """(node, least): the smallest of each node and its neighbours."""
    return pairs.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))


def _digest(edges: DataFrame) -> tuple:
    """Number of pairs and sum of their hashes: equal for two steps only if the pairs are, but for a chance of
    one in 2^64."""
    number = F.xxhash64("hi", "lo").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(number), F.lit(0).cast("decimal(30,0)"))).first())


def connected(pairs: DataFrame) -> DataFrame:
    """(node, label) for each node in ``pairs`` (a, b): label is the smallest node of its component.

    Large-star and small-star steps in turn: the first ties a node's larger neighbours, the second the
    smaller ones, to the smallest of them. Each step's pairs are written to the shared folder. The number
    of rounds grows with the logarithm of the graph. Only minima are grouped, so a node with very many
    neighbours is one row per map task.
    """
    edges = staged(pairs.selectExpr("greatest(a, b) as hi", "least(a, b) as lo").where("hi <> lo").distinct(), "components")
    known = _digest(edges)
    while True:
        both = edges.selectExpr("hi as node", "lo as other").unionByName(edges.selectExpr("lo as node", "hi as other"))
        large = both.join(_least(both), "node").where("other > node").selectExpr("other as hi", "least as lo").distinct()
        large = large.selectExpr("hi as node", "lo as other")
        low = _least(large)
        tied = large.join(low, "node")
        small = tied.selectExpr("other as hi", "least as lo").unionByName(low.selectExpr("node as hi", "least as lo"))
        after = staged(small.where("hi <> lo").distinct(), "components")
        found = _digest(after)
        if found == known:
            return after.selectExpr("hi as node", "lo as label").unionByName(
                after.selectExpr("lo as node", "lo as label").distinct()
            )
        edges, known = after, found
