"""Vectors: embedding, exact nearest neighbours, a store without repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import strings as S
from tessera.operators.neighbours import nearest_to_each  # noqa: F401


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)


def hashed_embedding(text: Column, dimensions: int = 64) -> Column:
    """A vector without a model: words hashed to places, unit length. The same text has the same vector everywhere."""
    words = F.filter(F.split(F.lower(text), r"(?U)[^\w]+"), lambda w: w != "")
    places = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(dimensions)).cast("int"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda i: F.size(F.filter(places, lambda p: p == i)).cast("double"))
    norm = F.sqrt(F.aggregate(counts, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(counts, lambda x: F.when(norm > 0, x / norm).otherwise(0.0).cast("float"))


def nearest(store: DataFrame, query: list[float], k: int = 3, vector: str = "embedding", id: str = "id") -> DataFrame:
    """The k nearest rows to one vector, by squared distance, then id: one pass, k rows kept per task."""
    d = squared_distance(F.col(vector), F.array(*[F.lit(float(x)) for x in query]))
    return store.withColumn("distance", d).orderBy("distance", id).limit(k)


def vault_rows(tropes: DataFrame, title: str = "title", content: str = "content") -> DataFrame:
    """Rows with a title and content, by fingerprint; one row for each."""
    t = tropes.filter(~S.blank(F.col(title)) & ~S.blank(F.col(content))).withColumn("id", S.fingerprint(F.col(title), F.col(content)))
    return t.dropDuplicates(["id"])


def insert_absent(store: DataFrame, new: DataFrame) -> DataFrame:
    """New rows whose id the store doesn't have."""
    return new.dropDuplicates(["id"]).join(store.select("id"), "id", "left_anti")
