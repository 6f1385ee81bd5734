"""Joins that have no operator of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: list[str], at: str, take: list[str]) -> DataFrame:
    """left with columns `take` of the last row of right whose time is not later, within equal `by`.

    Both sides are laid on one line and the last right row is carried along: one shuffle,
    no pairs. right: one row for each (by, at).
    """
    l = left.withColumns({"_side": F.lit(1), "_take": F.lit(None).cast(right.select(F.struct(*take).alias("s")).schema["s"].dataType)})
    r = right.select(*by, at, F.lit(0).alias("_side"), F.struct(*take).alias("_take"))
    w = Window.partitionBy(*by).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = l.unionByName(r, allowMissingColumns=True).withColumn("_last", F.last("_take", ignorenulls=True).over(w))
    return both.filter("_side = 1").select(*left.columns, *[F.col("_last")[c].alias(c) for c in take])


def range_join(left: DataFrame, right: DataFrame, x: str, y: str, width: float, on: list[tuple[str, str]]) -> DataFrame:
    """Rows with equal `on` and |x - y| <= width. Bands of that width turn it into an equi-join: a left row meets its own band and both neighbours."""
    l = left.withColumn("_band", F.explode(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda i: F.floor(F.col(x) / width) + i)))
    r = right.withColumn("_band_r", F.floor(F.col(y) / width))
    cond = F.col("_band") == F.col("_band_r")
    for a, b in on:
        cond = cond & (F.col(a) == F.col(b))
    return l.join(r, cond & F.col(y).between(F.col(x) - width, F.col(x) + width)).drop("_band", "_band_r")
