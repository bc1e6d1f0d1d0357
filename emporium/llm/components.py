"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import cut


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: root is the least node it is linked to.

    Large-star and small-star rounds: each node's neighbours are hung on the
    least of them. Every round is an aggregate and plain equi joins (so a node
    with very many neighbours is pre-aggregated, and its join partition can be
    split); the number of rounds grows with the logarithm of the longest path.
    Null ends are ignored; an empty table gives no rows.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = cut(e)
    last = None
    for _ in range(max_rounds):
        # Large star: larger neighbours go to the least neighbour (or the node itself).
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: smaller neighbours and the node go to the least of them.
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        hung = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
