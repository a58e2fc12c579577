"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import discard, staged


def _least(edges: DataFrame) -> DataFrame:
    """Per node its smallest neighbour or itself (map-side combined)."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for nodes with an edge.

    ``edges`` has columns a and b (long).  Each round links every node's larger
    neighbours, then its smaller ones, to its least neighbour; it ends when a
    round changes nothing, which takes about the logarithm of the largest
    component.  Each round is a table in the shared folder.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(_least(large), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        now, last = staged(small.where("u <> v").distinct(), "edges"), now
        discard(last)
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    pairs = now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    out = staged(pairs.union(roots).groupBy("node").agg(F.min("component").alias("component")), "components")
    discard(now)
    return out
