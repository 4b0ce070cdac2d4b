"""Connected components by alternating stars, as joins and grouped minima.

Each round hangs every node below the least node it knows: the large star links a node's
greater neighbours to its least one, the small star its lesser ones. Rounds are logarithmic
in the longest path. Minima combine before the shuffle, so a hub with very many neighbours is
one partial row a task; the joins that follow are plain equi-joins, which adaptive execution
splits where a hub's rows pile up. Nothing but two counters comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop, written


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the least node of its component) for every node of the edges ``u``, ``v`` (longs).

    Loops and repeated edges are allowed; a node that only loops is left out; no edges give no rows.
    """
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        seen = tuple(state)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        before, edges = edges, written(small.where("u <> v").distinct(), "edges")
        drop(before)
