"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.session import stored


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(id, component) for every id of a table of links (a, b); a component is named by its smallest id.

    Each step links the larger neighbours of a node, then the smaller ones, to the smallest neighbour,
    until every node is linked to its component's name alone. A step is two sums by key and two joins;
    the links are written between steps, so that no step depends on executors of an earlier one.
    """
    now = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = None
    while (state := tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())) != seen:
        seen = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(lowest, "a").where("b > a AND b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.unionByName(lower.withColumnRenamed("m", "b")).distinct(), name)
    found = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return found.unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
