"""Nearest neighbours of many queries: exactly, block against block, or through inverted lists.

Rows are packed into blocks of at most BLOCK vectors; a task multiplies blocks of the store
with blocks of queries and keeps the k best of each query, so k rows for each query and task
are shuffled, whatever the store's size. Distances of the best are worked out again one by
one, so equal vectors have equal distances and ties go by id.

The index: coarse centres are fitted by k-means on at most SAMPLE rows, and every row of the
store goes to the list of its nearest centre, a partition of a table. A query probes its
nearest lists only. How many, is found on at most TRIALS rows taken as queries, so that of
their true neighbours a stated share lies in the probed lists. Vectors without clusters need
many probes; the exact way costs no more there, and is always right.

Rows with a null vector or id have no neighbours and are none. Vectors must be of one length.
An empty store or no queries give no rows; fewer than k rows give all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.sinks.shared import scratch, stored

BLOCK = 2048
#: Rows that centres are fitted on at most, lists at most, and queries that the number of probes is found with at most.
SAMPLE, LISTS, TRIALS = 50_000, 4096, 200
#: Bytes of queries, counted first, that are sent to all tasks; more are dealt by shuffling.
BROADCAST_BYTES = 32 << 20
#: Queries that are compared with a block at a time where every distance is given out.
SCORED = 16


def _packed(df: DataFrame, id: str, vector: str, by: list[str], prefix: str) -> DataFrame:
    """by, <prefix>ids, <prefix>vectors: blocks of the rows of each key."""
    rows = df.select(*by, F.col(id).alias("_i"), F.col(vector).cast("array<float>").alias("_v")).filter("_i is not null and _v is not null")
    counts = rows.groupBy(*by).agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("_blocks"))
    counts = F.broadcast(counts.withColumnsRenamed({b: f"_{b}" for b in by}))  # one row for each list, or one in all
    rows = rows.join(counts, reduce(lambda x, y: x & y, [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by])) if by else rows.crossJoin(counts)
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_i"), F.greatest("_blocks", F.lit(1))))
    return rows.groupBy(*by, "_block").agg(F.collect_list("_i").alias(f"{prefix}ids"), F.collect_list("_v").alias(f"{prefix}vectors")).drop("_block")


def _matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in vectors])


def best(ids: np.ndarray, store: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of queries, id, squared distance) of the k nearest rows of the store to each query, ties by id."""
    near = (queries**2).sum(1)[:, None] - 2 * queries @ store.T + (store**2).sum(1)
    n = min(k, len(store))
    bound = np.partition(near, n - 1, axis=1)[:, n - 1 : n]
    # Sums in another order differ by rounding: what may be among the best is measured again.
    q, s = np.nonzero(near <= bound + 1e-9 * (1 + np.abs(bound)))
    exact = ((store[s] - queries[q]) ** 2).sum(1)
    return _first(q, ids[s], exact, k)


def _first(q: np.ndarray, ids: np.ndarray, distance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((np.unique(ids, return_inverse=True)[1], distance, q))
    q, ids, distance = q[order], ids[order], distance[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < k
    return q[keep], ids[keep], distance[keep]


def _met(pairs: DataFrame, k: int, kinds: tuple[str, str], by: list[str] | None = None) -> DataFrame:
    """query_id, by, id, distance: the best k of each query and by in every task, from pairs of blocks (by, ids, vectors, q_ids, q_vectors)."""
    by = by or []
    of = {b: pairs.schema[b].dataType.simpleString() for b in by}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0
        for f in frames:
            for ids, vectors, q_ids, q_vectors, *key in zip(f["ids"], f["vectors"], f["q_ids"], f["q_vectors"], *(f[b] for b in by), strict=True):
                q, found, distance = best(np.array(ids), _matrix(vectors), _matrix(q_vectors), k)
                held.append(pd.DataFrame({"query_id": np.array(q_ids)[q], **dict(zip(by, key, strict=True)), "id": found, "distance": distance}))
                rows += len(q)
            if rows > 1_000_000:
                held = [_fewer(held, k, by)]
                rows = 0
        if held:
            yield _fewer(held, k, by)

    named = "".join(f"{b} {x}, " for b, x in of.items())
    return pairs.select("ids", "vectors", "q_ids", "q_vectors", *by).mapInPandas(run, f"query_id {kinds[1]}, {named}id {kinds[0]}, distance double")


def _fewer(held: list[pd.DataFrame], k: int, by: list[str]) -> pd.DataFrame:
    return pd.concat(held).sort_values(["query_id", "distance", "id"]).groupby(["query_id", *by], dropna=False).head(k)


def _ranked(found: DataFrame, k: int, by: list[str] | None = None) -> DataFrame:
    by = by or []
    w = Window.partitionBy("query_id", *by).orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", *by, "id", "distance", "rank")


def _bytes(queries: DataFrame, vector: str) -> int:
    return queries.agg(F.sum(4 * F.size(vector) + 16)).first()[0] or 0


def _kinds(store: DataFrame, id: str, queries: DataFrame, query_id: str) -> tuple[str, str]:
    return store.schema[id].dataType.simpleString(), queries.schema[query_id].dataType.simpleString()


def _pairs(s: DataFrame, q: DataFrame, size: int) -> DataFrame:
    """Every block of the store with every block of queries, which have `size` bytes."""
    if size <= BROADCAST_BYTES:
        return s.crossJoin(F.broadcast(q))
    # Each block of queries gets a number, and each block of the store goes to every number.
    q = stored(q.withColumn("n", F.monotonically_increasing_id()), "query-blocks")
    return s.crossJoin(F.broadcast(q.select("n"))).join(q.hint("shuffle_hash"), "n")


def nearest_to_each(store: DataFrame, queries: DataFrame, k: int = 3, vector: str = "embedding", id: str = "id", query_id: str = "query_id", by: str | None = None) -> DataFrame:
    """query_id, id, distance (squared), rank: the k nearest rows of the store for each of a stated set of queries, exactly. by: the k nearest of each value of that column, beside query_id."""
    keys = [by] if by else []
    s = _packed(store, id, vector, keys, "")
    q = _packed(queries, query_id, vector, [], "q_")
    found = _met(_pairs(s, q, _bytes(queries, vector)), k, _kinds(store, id, queries, query_id), keys)
    return _ranked(found, k, keys)


def scored(store: DataFrame, queries: DataFrame, score: Callable[[np.ndarray], np.ndarray], into: str = "score", vector: str = "embedding", id: str = "id", query_id: str = "query_id") -> DataFrame:
    """query_id, id, `into`: score(squared distance) for every query and row of the store; score works on arrays. Squares are added place by place, as SQL adds them."""
    pairs = _pairs(_packed(store, id, vector, [], ""), _packed(queries, query_id, vector, [], "q_"), _bytes(queries, vector))
    kinds = _kinds(store, id, queries, query_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = lambda x: x.values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(x), -1).T.copy()
        for batch in batches:
            for ids, vectors, q_ids, q_vectors in zip(*(batch.column(i) for i in range(4)), strict=True):
                rows, asked, ids, q_ids = flat(vectors), flat(q_vectors), ids.values, q_ids.values
                for at in range(0, len(q_ids), SCORED):
                    some = asked[:, at : at + SCORED]
                    total = np.zeros((some.shape[1], len(ids)))
                    gap = np.empty_like(total)
                    for x, y in zip(rows, some, strict=True):
                        np.subtract(x[None, :], y[:, None], out=gap)
                        np.multiply(gap, gap, out=gap)
                        total += gap
                    who = q_ids.take(pa.array(np.repeat(np.arange(at, at + len(total)), len(ids))))
                    yield pa.RecordBatch.from_arrays([who, ids.take(pa.array(np.tile(np.arange(len(ids)), len(total)))), pa.array(score(total.ravel()))], ["query_id", "id", into])

    return pairs.select("ids", "vectors", "q_ids", "q_vectors").mapInArrow(run, f"query_id {kinds[1]}, id {kinds[0]}, {into} double")


# --- inverted lists --------------------------------------------------------------------------


def centres_of(store: DataFrame, lists: int | None = None, vector: str = "embedding", id: str = "id", seed: int = 7) -> np.ndarray:
    """Centres of about as many lists as the square root of the store's rows, by k-means on the SAMPLE rows whose ids have the least hashes."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = store.select(F.col(id).alias("_i"), F.col(vector).cast("array<double>").alias("_v")).filter("_i is not null and _v is not null")
    total = rows.count()
    if not total:
        return np.empty((0, 0))
    lists = min(lists or max(1, round(total**0.5)), LISTS, total)
    sample = rows.orderBy(F.xxhash64("_i"), "_i").limit(SAMPLE).select(array_to_vector("_v").alias("features"))
    if lists == 1:
        return np.mean([r[0].toArray() for r in sample.collect()], axis=0)[None, :]
    model = KMeans(k=lists, seed=seed, maxIter=15, initMode="random").fit(sample)
    return np.array(model.clusterCenters())


def _probed(rows: DataFrame, centres: np.ndarray, probes: int, vector: str) -> DataFrame:
    """rows with the numbers of their nearest centres, the nearest first, as `lists`."""
    schema = f"{rows.schema.simpleString()[7:-1]}, lists: array<int>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = (centres**2).sum(1)
        for f in frames:
            if len(f):
                far = size - 2 * _matrix(f[vector]) @ centres.T
                f["lists"] = list(np.argsort(far, axis=1, kind="stable")[:, :probes].astype(np.int32))
                yield f

    return rows.mapInPandas(run, schema)


def build(store: DataFrame, centres: np.ndarray, vector: str = "embedding", id: str = "id") -> DataFrame:
    """The index: list, id, vector of every row with a vector, stored with a partition for each list."""
    rows = store.select(F.col(id).alias("id"), F.col(vector).cast("array<float>").alias("vector")).filter("id is not null and vector is not null")
    path = scratch(store.sparkSession, "inverted-lists")
    placed = _probed(rows, centres, 1, "vector").select("id", "vector", F.col("lists")[0].alias("list"))
    # A list of very many rows is written by several tasks.
    placed.repartition("list", F.pmod(F.xxhash64("id"), F.lit(4))).write.partitionBy("list").parquet(path)
    return store.sparkSession.read.schema(placed.schema).parquet(path)


def search(index: DataFrame, centres: np.ndarray, queries: DataFrame, k: int, probes: int, vector: str = "embedding", query_id: str = "query_id") -> DataFrame:
    """query_id, id, distance, rank: the k nearest rows in the lists that each query probes."""
    q = queries.select(F.col(query_id).alias("query_id"), F.col(vector).cast("array<float>").alias("vector")).filter("query_id is not null and vector is not null")
    q = _probed(q, centres, probes, "vector").select("query_id", "vector", F.explode("lists").alias("list"))
    pairs = _packed(index, "id", "vector", ["list"], "").join(_packed(q, "query_id", "vector", ["list"], "q_"), "list")
    return _ranked(_met(pairs, k, _kinds(index, "id", queries, query_id)), k)


def probes_for(index: DataFrame, centres: np.ndarray, k: int, recall: float = 0.97) -> int:
    """The least number of lists that hold the share `recall` of the k nearest rows of trial queries: the TRIALS rows whose ids have the least hashes of another seed."""
    trial = index.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(TRIALS).select(F.col("id").alias("query_id"), "vector")
    trial = stored(_probed(trial, centres, len(centres), "vector"), "trials")
    true = nearest_to_each(index, trial, k, "vector", "id", "query_id")
    at = true.join(index.select("id", "list"), "id").join(trial.select("query_id", "lists"), "query_id")
    places = at.groupBy(F.array_position("lists", F.col("list")).alias("place")).count().orderBy("place").collect()
    wanted, seen = recall * sum(r["count"] for r in places), 0
    for r in places:
        seen += r["count"]
        if seen >= wanted:
            return int(r["place"])
    return max(1, len(centres))


def recall(found: DataFrame, true: DataFrame) -> DataFrame:
    """queries, neighbours, found, recall: how many of the true neighbours (query_id, id) were found."""
    hit = true.join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    out = hit.agg(F.countDistinct("query_id").alias("queries"), F.count("*").alias("neighbours"), F.count("hit").alias("found"))
    return out.withColumn("recall", F.round(F.col("found") / F.col("neighbours"), 4))
