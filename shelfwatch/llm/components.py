"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.session import stage_table


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(v, root)`` for every vertex of ``edges(a, b)``; vertices of one component share a root.

    In a round each vertex points to its neighbour of least priority (a hash of
    the vertex, new in each round), or to itself if it is the least; the ends of
    all edges are replaced by what they point to, and loops and repeats go. As
    (v, p(v)) is itself an edge, no connection is lost; the hashed priorities
    shrink chains by a constant factor per round, so a chain of n needs
    O(log n) rounds. Each round is written to the shared checkpoint folder.
    Nulls and loops in the input are ignored; an empty input gives no rows.
    """
    left = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    left = stage_table(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    levels: list[DataFrame] = []
    for r in range(max_rounds):
        if left.isEmpty():
            break
        both = left.select(F.col("a").alias("v"), F.col("b").alias("n")).unionAll(left.select("b", "a"))
        best = both.groupBy("v").agg(F.min(F.struct(F.xxhash64("n", F.lit(r)).alias("h"), "n")).alias("m"))
        own = F.struct(F.xxhash64("v", F.lit(r)).alias("h"), F.col("v").alias("n"))
        to = stage_table(best.select("v", F.when(F.col("m") < own, F.col("m.n")).otherwise(F.col("v")).alias("p")), "points")
        levels.append(to)
        pa, pb = to.toDF("a", "pa"), to.toDF("b", "pb")
        moved = left.join(pa, "a").join(pb, "b").where("pa <> pb")
        left = stage_table(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    else:
        raise RuntimeError(f"components not found in {max_rounds} rounds")
    if not levels:
        return left.select(F.col("a").alias("v"), F.col("b").alias("root"))
    out = levels[0].toDF("v", "root")
    for to in levels[1:]:
        out = out.join(to.toDF("root", "p"), "root", "left").select("v", F.coalesce("p", "root").alias("root"))
    return out
