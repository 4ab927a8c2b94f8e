"""Connected components of a link table, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, stored


def rounds(links: DataFrame):
    """The link table after each round of steps, as (edges, folder); the last has a star for each component.

    Edges are (low, high).  The large-star step hangs each edge's higher end on the
    least neighbour of its lower end; the small-star step then hangs all lower ends
    of a node, and the node, on the least of them.  Neither adds edges nor joins or
    parts components (Kiveris et al., 2014), and distances halve, so that the
    rounds are some log2 of a component's longest path.  Every round is written to the
    shared folder and read back, so that no round's plan holds those before.
    """
    edges = links.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).where("low < high").distinct()
    edges, at = stored(edges.withColumn("moved", F.lit(True)))
    while True:
        yield edges, at
        if edges.where("moved").isEmpty():
            return
        least = edges.groupBy(F.col("high").alias("low")).agg(F.min("low").alias("least"))
        large = edges.join(least, "low", "left").select(F.coalesce("least", "low").alias("low"), "high", F.col("least").isNotNull().alias("moved"))
        lowest = large.groupBy("high").agg(F.min("low").alias("least"))
        hung = large.join(lowest, "high").select(
            F.col("least").alias("low"), F.explode(F.array(F.struct("high", "moved"), F.struct(F.col("low").alias("high"), (F.col("low") > F.col("least")).alias("moved")))).alias("e")
        )
        small = hung.select("low", "e.*").where("low < high").groupBy("low", "high").agg(F.max("moved").alias("moved"))
        after, path = stored(small)
        discard(edges.sparkSession, at)
        edges, at = after, path


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``links`` (a, b): label is the least node reachable.  No links: no rows."""
    for edges, _ in rounds(links):
        pass
    # a component has one edge for each node but its least
    return edges.select(F.col("high").alias("node"), F.col("low").alias("label")).union(edges.select("low", "low").distinct())
