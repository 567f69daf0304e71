"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillview.llm.shared import stage


def _stars(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v), u > v: one large-star and one small-star step."""
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    rest = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(low.select("u", F.col("m").alias("v"))).distinct()


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Nodes (``u``) with the smallest node of their component (``v``); that smallest
    node itself is left out. Keys are joined, never gathered, so a component of any
    size is spread over tasks. Runs jobs: each round is written to the shared folder.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    pairs = stage(pairs, "edges")
    state = _state(pairs)
    while state[0]:
        pairs = stage(_stars(pairs), "stars")
        before, state = state, _state(pairs)
        if state == before:
            break
    return pairs
