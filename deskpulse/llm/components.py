"""Connected components over an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskpulse.llm.io import cut


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component_id): the smallest node reachable from each node that
    has an edge. ``edges`` has columns (a, b) of one integer type.

    Alternating large-star and small-star rounds: each takes the smallest
    neighbour of every node by a grouped minimum (combined before the shuffle,
    so a hub costs one row per task) and joins it back. A round's result is
    cut into the checkpoint folder; rounds grow with the logarithm of the
    number of nodes. Loops and repeated edges are allowed; null ends are
    ignored; no edges give no rows.
    """
    e = cut(
        edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    for _ in range(max_rounds):
        if _is_star_forest(e):
            break
        # large star: neighbours larger than a node are linked to its smallest neighbour
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        # small star: a node and its smaller neighbours are linked to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        e = cut(small.union(low.select("u", F.col("m").alias("v"))).distinct())
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component_id", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component_id")).union(roots)


def _is_star_forest(e: DataFrame) -> bool:
    """Whether every node is either a root or a member of one root."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("member"), F.lit(0).alias("root"))
    ends = ends.union(e.select("v", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("member").alias("member"), F.max("root").alias("root"))
    return seen.where("member > 1 or (member = 1 and root = 1)").isEmpty()
