"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, keep_counted


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id, component (smallest id reachable) for each id in links.

    In each round every vertex points to its smallest neighbour or itself,
    pointers jump until they rest, and the graph is contracted: links are
    renamed to what their ends point to, and those within one vertex or repeated
    are dropped.  A round at least halves the vertices that have links, and the
    jumps in it grow with the logarithm of the longest way.  Each round's tables
    are kept in the shared folder and counted as they are written.
    """
    x, y = F.col(a), F.col(b)
    edges, left = keep_counted(links.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct())
    labels = None
    while left:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = keep(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("to")))
        moving = 1
        while moving:  # a pointer's way halves each time
            jump = step.select(F.col("id").alias("to"), F.col("to").alias("far"))
            far, moving = keep_counted(step.join(jump, "to").select("id", "to", "far"), F.col("to") != F.col("far"))
            step = far.select("id", F.col("far").alias("to"))
        step = step.withColumnRenamed("to", "next")
        if labels is None:
            labels = step.select("id", F.col("next").alias("component"))
        else:
            moved = labels.join(step.withColumnRenamed("id", "component"), "component", "left")
            labels = keep(moved.select("id", F.coalesce("next", "component").alias("component")))
        renamed = edges.join(step.toDF("a", "p"), "a").join(step.toDF("b", "q"), "b").where("p <> q")
        edges, left = keep_counted(renamed.select(F.greatest("p", "q").alias("a"), F.least("p", "q").alias("b")).distinct())
    return edges.toDF("id", "component") if labels is None else labels
