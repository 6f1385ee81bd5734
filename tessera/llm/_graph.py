"""Connected components of a table of links, on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import discard, few, named, small, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node reachable, for every node of a link. No row if there is no link.

    Each round, a node takes the smallest label around it, then that label's own label, twice;
    each round's labels are a written table. Labels of long chains halve their distance.
    Labels are broadcast as long as they are few, else joined by shuffling.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    nodes = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")), F.struct("u", F.col("u").alias("v")), F.struct(F.col("v").alias("u"), "v"))).alias("x")
    near = stored(pairs.select(nodes).select("x.u", "x.v"), "links")
    links = near.count()
    labels = stored(few(near.groupBy("u").agg(F.min("v").alias("label")), links), "labels")
    rows = labels.count()
    while True:
        of = lambda u, label: small(labels.select(F.col("u").alias(u), F.col("label").alias(label)), rows)  # noqa: E731, B023
        own = F.max(F.when(F.col("u") == F.col("v"), F.col("at")))
        after = few(near.join(of("v", "at"), "v").groupBy("u").agg(F.min("at").alias("next"), own.alias("old")), links)
        after = after.join(of("next", "far"), "next").join(of("far", "label"), "far")
        after = stored(after.select("u", "label", "old"), "labels")
        discard(labels)
        labels = named(after.select("u", "label"), after)
        if after.filter("label < old").isEmpty():
            discard(near)
            return named(labels.select(F.col("u").alias("node"), F.col("label").alias("component")), after)
