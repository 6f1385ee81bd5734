"""Connected components of links within groups, over the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sinks.shared import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("g", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).select("g", F.col("x.a").alias("u"), F.col("x.b").alias("v"))


def components(links: DataFrame) -> DataFrame:
    """g, node, component (its smallest node) of every node of the links (g, a, b).

    Links are turned into stars, in turns: a node's larger neighbours are linked to the
    smallest one around it, then its smaller ones are. Minima are grouped aggregates joined
    back, so a node with very many links is no single row. Every turn is a written table; it
    ends when a turn changes nothing, after about as many turns as the logarithm of the nodes.
    """
    now = stored(links.filter("a <> b").select("g", F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        around = _both_ways(now)
        least = around.groupBy("g", "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.join(least, ["g", "u"]).filter("v > u").select("g", F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("g", F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.withColumnRenamed("a", "u").join(lower, ["g", "u"])
        small = small.select("g", F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("g", "x.a", "x.b")
        after = stored(small.filter("a <> b").distinct(), "links")
        if after.join(now, ["g", "a", "b"], "left_anti").isEmpty() and now.join(after, ["g", "a", "b"], "left_anti").isEmpty():
            break
        now = after
    leaves = now.select("g", F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(now.select("g", F.col("b").alias("node"), F.col("b").alias("component")).distinct())
