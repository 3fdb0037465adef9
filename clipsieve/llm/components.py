"""Connected components of an edge table by alternating stars, with every round written out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import delete, durable


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): the least node of each node's component, for all nodes that have an edge (a, b).

    Each round points every neighbour of a node at the least node seen there; the table has at most the
    edges it began with, and of a hub only its minimum is aggregated, in each task first. A round's tables are deleted
    when the next one's are written. Rounds grow with the logarithm of a component's size; ``max_rounds`` only
    ends a run that cannot settle. Rows with a null end or equal ends join nothing and give no node."""
    e = durable(edges.select("a", "b").where("a <> b").distinct())
    last = None
    for _ in range(max_rounds):
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written out, so that both sides of the join are plain shuffles, of which Spark can split a hub's partition
        least = durable(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        # neighbours of a, and a itself, to the least of a's surroundings
        step = both.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        gone = e.inputFiles(), least.inputFiles()
        e = durable(step.where("a <> b").distinct())
        delete(e.sparkSession, *gone)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == last:
            return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        last = now
    raise RuntimeError("components did not settle")
