"""Profiling, scrubbing and the aggregates behind charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import strings as S


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def null_profile(df: DataFrame) -> DataFrame:
    """column_name, null_count, null_pct of every column, in one pass; no rows give 0."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), (F.col("_rows") - F.col(f"_{i}")).alias("null_count")) for i, c in enumerate(df.columns)])
    out = one.select("_rows", F.explode(cells).alias("c")).select("c.*", "_rows")
    return out.select("column_name", "null_count", F.when(F.col("_rows") > 0, 100.0 * F.col("null_count") / F.col("_rows")).otherwise(0.0).alias("null_pct"))


def numeric_profile(df: DataFrame) -> DataFrame:
    """column_name, min, max, mean of the numeric columns; null where a column has no value."""
    names = _numeric(df)
    one = df.agg(*[f(F.col(f"`{c}`").cast("double")).alias(f"_{k}{i}") for i, c in enumerate(names) for k, f in (("a", F.min), ("b", F.max), ("c", F.avg))])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_a{i}").alias("min"), F.col(f"_b{i}").alias("max"), F.col(f"_c{i}").alias("mean")) for i, c in enumerate(names)])
    return one.select(F.explode(cells).alias("c")).select("c.*")


def cardinality(df: DataFrame, approximate: bool = False) -> DataFrame:
    """column_name, n_unique of the other columns; nulls don't count."""
    names = [c for c in df.columns if c not in _numeric(df)]
    count = F.approx_count_distinct if approximate else F.count_distinct
    one = df.agg(*[count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(names)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("n_unique")) for i, c in enumerate(names)])).alias("c")).select("c.*")


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def scrub(df: DataFrame) -> DataFrame:
    """Rows and then columns without any value go, headers become identifiers, text is trimmed."""
    df = df.dropna("all")
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if filled[c]])
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[(S.strip(F.col(f"`{c}`")) if c in text else F.col(f"`{c}`")).alias(S.clean_header(c)) for c in df.columns])


def group_sum(df: DataFrame, x: str, y: str) -> DataFrame:
    """x, total: null keys go, what isn't a number doesn't count, a group without numbers has 0."""
    n = S.to_number(F.col(y).cast("string"))
    return df.filter(F.col(x).isNotNull()).groupBy(x).agg(F.coalesce(F.sum(n), F.lit(0.0)).alias("total")).orderBy(x)


def distribution(df: DataFrame, x: str, y: str) -> DataFrame:
    """Five numbers of y for each x, quartiles by linear interpolation; groups without values go."""
    n = S.to_number(F.col(y).cast("string"))
    q = df.select(F.col(x), n.alias("_y")).filter(F.col(x).isNotNull() & F.col("_y").isNotNull())
    out = q.groupBy(x).agg(F.min("_y").alias("low"), F.percentile("_y", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.max("_y").alias("high"), F.count("_y").alias("n"))
    return out.select(x, "low", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "high", "n").orderBy(x)
