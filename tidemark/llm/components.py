"""Connected components by alternating large and small stars, edges only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _with_minimum(arcs: DataFrame) -> DataFrame:
    """Arcs (u, v) with the least of u and its neighbours; a hub is combined before the exchange."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return arcs.join(least, "u")


def large_star(edges: DataFrame) -> DataFrame:
    arcs = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_minimum(arcs).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    arcs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    met = _with_minimum(arcs)
    return met.select("u", F.col("m").alias("v")).union(
        met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def component_minimum(edges: DataFrame) -> DataFrame:
    """``node`` and the least node it is connected to, ``component``, for each end of an edge.

    ``edges`` has two columns of one ordered type; loops and nulls are ignored, repeats do no
    harm, no edges give no rows. Rounds grow with the logarithm of the longest path, and each
    ends in a written table.
    """
    u, v = edges.columns
    edges = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v")
    edges = written(small_star(edges).distinct(), "stars")
    state = _state(edges)
    while state[0]:
        edges = written(small_star(large_star(edges).distinct()).distinct(), "stars")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v"), F.col("v")).distinct()
    )
