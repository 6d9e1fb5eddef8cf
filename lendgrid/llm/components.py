"""Connected components over an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import discard, written


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b longs) -> one row (node, root) per node of an edge, root the least node.

    Each round hangs every larger neighbour on the least one (large star), then the smaller
    ones (small star); a hub costs one partially aggregated minimum and a join whose skewed
    side Spark can split, never one task's list. The edge table is rewritten to the shared
    folder each round, the result is a written table. Nulls and loops are dropped; no edges give no rows.
    """
    e = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        new = written(small.select("e.u", "e.v").where("u <> v").distinct())
        discard(e)
        e, old, mark = new, mark, _mark(new)
        if old == mark:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    out = written(e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots))
    discard(e)
    return out


def _mark(e: DataFrame) -> tuple:
    """Row count and an order-free checksum: equal marks mean that a round changed nothing."""
    x = F.xxhash64("u", "v")
    return tuple(e.agg(F.count("*"), F.bit_xor(x), F.sum(x.bitwiseAND(F.lit(0xFFFFFFFF)))).first())
