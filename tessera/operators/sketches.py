"""Profiles that are kept and merged: quantile and distinct sketches for each part of a table.

A part's profile is a few rows: for each column (and group) its rows, nulls, least and largest
value and sum, a KLL sketch of its numbers and a HyperLogLog sketch of its values. Profiles of
parts are merged to that of the whole, so appended data are profiled without reading the old
again. Counts, bounds and sums are exact. A quantile's rank is wrong by at most RANK_ERROR of
the rows with 99 % certainty, and a number of distinct values by about DISTINCT_ERROR (one
standard deviation); profile.numeric_profile, .cardinality and .distribution are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Size of the quantile sketches, and log2 of the registers of the distinct ones.
K, LG = 400, 14
RANK_ERROR, DISTINCT_ERROR = 0.009, 0.0065


def sketched(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """by, column_name, rows, nulls, low, high, total, quantiles, distinct of every other column; the last four but distinct are of numbers. A part without rows has no rows of a profile."""
    by = by or []
    numbers = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    columns = [c for c in df.columns if c not in by]
    aggregates: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        v, number = F.col(f"`{c}`"), F.col(f"`{c}`").cast("double") if c in numbers else None
        aggregates += [F.count(v).alias(f"n{i}"), F.hll_sketch_agg(v.cast("string"), LG).alias(f"d{i}")]
        if number is not None:
            aggregates += [F.min(number).alias(f"l{i}"), F.max(number).alias(f"h{i}"), F.sum(number).alias(f"s{i}"), F.kll_sketch_agg_double(number, K).alias(f"q{i}")]
    null = F.lit(None)
    of = lambda c, k, i, kind: (F.col(f"{k}{i}") if c in numbers else null).cast(kind)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.col("_rows").alias("rows"), (F.col("_rows") - F.col(f"n{i}")).alias("nulls"),
            of(c, "l", i, "double").alias("low"), of(c, "h", i, "double").alias("high"), of(c, "s", i, "double").alias("total"), of(c, "q", i, "binary").alias("quantiles"), F.col(f"d{i}").alias("distinct"),
        )
        for i, c in enumerate(columns)
    ]
    key = [F.col(f"`{c}`") for c in by]
    out = df.groupBy(*key).agg(*aggregates).filter("_rows > 0")
    return out.select(*key, F.explode(F.array(*rows)).alias("p")).select(*key, "p.*")


def merged(parts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The profile of several parts together, from their profiles alone."""
    key = [F.col(f"`{c}`") for c in by or []]
    sums = [F.sum(c).alias(c) for c in ("rows", "nulls")]
    return parts.groupBy(*key, "column_name").agg(*sums, F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"), F.kll_merge_agg_double("quantiles", K).alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"))


def profile(sketches: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """sketches read: rows, nulls, low, high, mean, n_unique (about), and q<per cent> (about) of columns of numbers."""
    known = F.col("rows") - F.col("nulls")
    some = F.col("low").isNotNull()  # else there is no number, and nothing in the sketch
    read = [F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(q))).alias(f"q{round(100 * q)}") for q in quantiles]
    keep = [c for c in sketches.columns if c not in ("quantiles", "distinct", "total")]
    return sketches.select(*keep, F.when(some, F.col("total") / known).alias("mean"), F.hll_sketch_estimate("distinct").alias("n_unique"), *read)
