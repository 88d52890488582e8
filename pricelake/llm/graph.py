"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (u, v)``; a root is one node of each component, the same for all of its nodes.

    Each round every node points to its smallest neighbour, pointers are
    followed once more, and the edges shrink to what still joins different
    targets. Ids should be hashes: descending chains are then short, and the
    rounds grow with the logarithm of the size. Minima are combined before the
    shuffle, so a hub costs its partner no memory. Each round is written, which
    cuts the lineage; null ends and loops are no links.
    """
    spark = edges.sparkSession
    left = written(spark, edges.where("u <> v").select("u", "v").distinct(), "cc-edges")
    found = None
    while not left.isEmpty():
        both = left.union(left.select("v", "u"))
        to = both.groupBy(F.col("u").alias("node")).agg(F.least(F.first("u"), F.min("v")).alias("up"))
        # A node's target has edges too, so it has a row here.
        further = to.select(F.col("node").alias("up"), F.col("up").alias("root"))
        to = written(spark, to.join(further, "up").select("node", "root"), "cc-roots")
        if found is None:
            found = to
        else:
            moved = to.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = written(spark, found.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "cc-found")
        ends = left
        for end in ("u", "v"):
            ends = ends.join(to.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end)
        left = ends.where("u_root <> v_root").select(F.col("u_root").alias("u"), F.col("v_root").alias("v")).distinct()
        left = written(spark, left, "cc-edges")
    if found is None:
        return left.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return found
