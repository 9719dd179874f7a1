"""Connected components of a distributed edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import checkpointed


def _minima(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of every node ``a``; tasks send one row per node, however many links it has."""
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _minima(both).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = _minima(edges)
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the links ``a``-``b``; the root is the smallest node it reaches.

    Links to itself and repeated links do no harm; nulls are left out; nodes without a link to another
    node have no row.  Each round is cut off by a checkpoint; rounds grow with the logarithm of the
    longest chain.
    """
    clean = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state, before = checkpointed(clean), None
    while True:
        seen = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(seen) == before or not seen[0]:
            break
        before = tuple(seen)
        state = checkpointed(_small(_large(state)))
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
