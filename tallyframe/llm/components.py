"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; component is the smallest node reachable.

    Each step is two joins and aggregations on the node, so a node with a third
    of all links is a skewed join side that AQE splits, never one collected
    group.  Links that touch a null are ignored.  Each round is written to the
    shared scratch folder; the round before is deleted then.
    """
    spark = links.sparkSession
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, path = written(pairs, name)
    state = _state(pairs)
    while True:
        # large star: every neighbour above u goes to the smallest neighbour of u
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        big = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new, new_path = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), name)
        new_state = _state(new)
        discard(spark, path)
        pairs, path = new, new_path
        if new_state == state:
            break
        state = new_state
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))


def _state(pairs: DataFrame) -> tuple:
    """Number and order-free checksum of the links: two rounds with the same links have reached the end."""
    row = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return tuple(row)
