"""Connected components by local contraction.

Each round orders the nodes at random, lets every node move to the first of its neighbourhood, and
rewrites the links between the places moved to. The graph shrinks by a constant factor a round, so
rounds grow with the logarithm of its size. Rounds are written to the shared folder; joins read
tables from there, so that Spark can split the partition of a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.scratch import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node of the links; nodes of a component have the same root.

    Links with a null end are ignored, loops and repeats do no harm, no links give no rows.
    """
    edges = materialize(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "links"
    )
    result, turn = None, 0
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("n"))  # noqa: E731, B023
        first = both.groupBy("a").agg(F.min(F.least(order("a"), order("b"))).alias("m"))
        moved = materialize(first.select(F.col("a").alias("node"), F.col("m.n").alias("root")), "moved")
        left = moved.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = moved.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = edges.join(left, "a").join(right, "b").where("ra <> rb")
        edges = materialize(edges.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        if result is None:
            result = moved
        else:
            step = moved.select(F.col("node").alias("root"), F.col("root").alias("next"))
            result = materialize(result.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        turn += 1
    if result is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return result
