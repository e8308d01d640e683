"""Connected components of a link table by alternating large-star and small-star
steps: every step is a minimum per node and a join, checkpointed to the shared
folder.  Nothing but a row count and a checksum reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # A table of its own, so that the join can split the links of a hub.
    least = cut(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = cut(down.groupBy("u").agg(F.min("v").alias("m")))
    return down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v") \
        .unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame):
    # An order-free checksum: the hashes are folded to 31 bits, so their sum cannot overflow.
    return edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(2147483647)))).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) other than the roots; root is
    the smallest node of the component."""
    edges = cut(edges.where("u != v").select("u", "v").distinct())
    state = _state(edges)
    while state[0]:
        edges = cut(_small_star(_large_star(edges)))
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
