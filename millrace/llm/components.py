"""Connected components of a graph given by its edges, by alternating stars.

Every round replaces edges by edges to smaller neighbours, first of the larger neighbours of
each node, then of the smaller ones, until each component is a star around its least node. Rounds
grow with the logarithm of the largest component. Each round is written to the shared folder, so
a lost executor costs no more than the round it was lost in. Nothing reaches the driver but
a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.workspace import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``: root is the least node it is connected to."""
    now = materialize(edges.select("a", "b").filter("a != b").distinct(), "edges")
    before, state = None, _state(now)
    while state != before and state[0]:
        now = materialize(_small_star(_large_star(now)), "stars")
        before, state = state, _state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
