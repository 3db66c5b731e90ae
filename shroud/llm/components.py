"""Distributed connected components over a table of edges, by DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.llm.common import cut, release


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60, whole: bool = True) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of an edge.

    Every node points to a parent, at first itself. In each round a node and its parent take the
    smallest grandparent seen over the node's edges, and a node takes its own grandparent, until no
    pointer changes: a number of rounds that grows with the logarithm of the longest chain. Rounds
    end in a checkpoint, so both sides of each join are plain shuffles and a hub's rows, however
    many, are split among tasks by Spark's skew join. Minima are taken in each task before rows are
    shuffled, so the task that holds a hub receives one row for it from each task at most.
    Without ``whole`` it ends after ``most_rounds``, converged or not: nodes with one label are in one component
    then, while those of one component may still have several labels.
    Each round lets go of what the one before left in the driver's memory.
    Edges with a null end are left out; loops and repeated edges change nothing; no edges, no rows.
    """
    clean = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    both = cut(clean.union(clean.select("v", "u")).distinct())
    loops = edges.where(F.col(a) == F.col(b)).select(F.col(a).alias("node"))
    nodes = both.select(F.col("u").alias("node")).union(loops).distinct()
    first = both.groupBy("u").agg(F.min("v").alias("least")).select(F.col("u").alias("node"), F.least("u", "least").alias("parent"))
    parents = cut(nodes.join(first, "node", "left").select("node", F.coalesce("parent", "node").alias("parent"), F.lit(True).alias("moved")))
    for _ in range(most_rounds):
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        state = cut(parents.select("node", "parent").join(up, "parent"))
        seen = both.join(state.select(F.col("node").alias("v"), "grand"), "v").groupBy("u").agg(F.min("grand").alias("offer"))
        offers = state.join(seen, state["node"] == seen["u"]).select("node", "parent", "offer")
        pointers = (
            state.select("node", F.col("parent").alias("old"), F.least("parent", "grand").alias("new"))
            .unionByName(offers.select("node", F.lit(None).cast(dict(both.dtypes)["u"]).alias("old"), F.col("offer").alias("new")))
            .unionByName(offers.select(F.col("parent").alias("node"), F.lit(None).cast(dict(both.dtypes)["u"]).alias("old"), F.col("offer").alias("new")))
        )
        parents = cut(pointers.groupBy("node").agg(F.min("new").alias("parent"), F.max("old").alias("old")).select("node", "parent", (F.col("parent") != F.col("old")).alias("moved")))
        del up, state, seen, offers, pointers
        release(edges.sparkSession)
        if whole and parents.where("moved").isEmpty():
            return parents.select("node", F.col("parent").alias("component"))
    if not whole:
        return parents.select("node", F.col("parent").alias("component"))
    raise RuntimeError(f"components still changed after {most_rounds} rounds")
