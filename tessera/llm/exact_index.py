"""Exact duplicates through an extendible-hash index on shared files.

The directory maps the leading bits of a text's 64-bit hash to a bucket. It starts with one
bucket; every bucket of more than `capacity` rows is split by its next bit, doubling the
directory where needed, until none is overfull. Directory and index are tables in the shared
folder. Every text goes to the owner task of its bucket, which sorts the bucket's texts by
hash and bytes: texts of one hash that differ form a chain of classes, never a false copy.
The owner gives each row its class's largest id and size, and the digest.

No split helps where a single hash has more rows than a bucket may hold. Rows of such a hash
are collapsed to one for each text before they are dealt (map-side, so a task sends a text
once), the owner resolves that one row, and the rows get its answer through hash and SHA-256.

Texts are equal when identical after lower-casing A-Z. Null counts as empty. The row
with the largest id of a class stays; of repeated rows with that id all have it as
keep_id and are kept. Rows with a null id join their class and are counted in it, but
are only kept when no row of the class has an id. An empty table gives no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import ascii_lower, discard, partitions, small, stored

#: Buckets for each partition of a shuffle if no capacity is given, and the leading bits a directory may use.
BUCKETS, MAX_DEPTH = 8, 20


def key_hash(text: Column) -> Column:
    return F.xxhash64(text)


def split_directory(counts: dict[int, int], depth: int, capacity: int) -> list[tuple[int, int]]:
    """(depth, prefix) of each bucket, from the number of rows by their first `depth` bits."""
    level, out = [(0, 0)], []
    below = [counts]
    for _ in range(depth):
        up: dict[int, int] = {}
        for prefix, n in below[0].items():
            up[prefix >> 1] = up.get(prefix >> 1, 0) + n
        below.insert(0, up)
    while level:
        d, prefix = level.pop()
        if d < depth and below[d].get(prefix, 0) > capacity:
            level += [(d + 1, prefix << 1 | 1), (d + 1, prefix << 1)]
        else:
            out.append((d, prefix))
    return sorted(out, key=lambda x: x[1] << (depth - x[0]))


def directory(keys: DataFrame, capacity: int | None) -> tuple[DataFrame, int, int, int]:
    """(prefix, bucket) for each entry of the doubled directory as a stored table, their number, its depth, the capacity; keys: h, n.

    Its size follows the number of buckets: by default the cluster's partitions, not the rows.
    """
    spark = keys.sparkSession
    total = keys.agg(F.sum("n")).first()[0] or 0
    capacity = capacity or max(1, total // (BUCKETS * partitions(spark)))
    # About four prefixes for each full bucket.
    depth = min(MAX_DEPTH, max(1, (4 * total // capacity).bit_length()))
    weight = F.when(F.col("n") > capacity, 1).otherwise(F.col("n"))
    counts = {int(p): int(n) for p, n in keys.groupBy(_prefix(depth)).agg(F.sum(weight)).collect()}
    entries = [{"first": p << depth - d, "last": (p + 1 << depth - d) - 1, "bucket": i} for i, (d, p) in enumerate(split_directory(counts, depth, capacity))]
    buckets = F.from_json(F.lit(json.dumps(entries)), "array<struct<first:int,last:int,bucket:int>>")
    doubled = spark.range(1).select(F.inline(buckets)).select(F.explode(F.sequence("first", "last")).alias("prefix"), "bucket")
    return stored(doubled, "exact-directory"), 1 << depth, depth, capacity


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("h", 64 - depth).cast("int").alias("prefix")


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int | None = None) -> DataFrame:
    """id, keep_id, group_size, kept, text_sha256, bucket of every row."""
    norm = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(id).alias("id"), norm.alias("t")).withColumn("h", key_hash(F.col("t")))
    keys = stored(rows.groupBy("h").agg(F.count("*").alias("n")), "exact-index-keys")
    where, entries, depth, capacity = directory(keys, capacity)
    crowded = stored(keys.filter(F.col("n") > capacity).select("h"), "exact-index-crowded")
    n_crowded = crowded.count()
    discard(keys)

    alone = rows.join(small(crowded, n_crowded), "h", "left_anti").select("id", "t", "h", F.lit(1).cast("long").alias("n"), F.lit(False).alias("many"))
    met = rows.join(small(crowded, n_crowded), "h", "left_semi") if n_crowded else None
    dealt = alone
    if met is not None:
        dealt = alone.unionByName(met.groupBy("h", "t").agg(F.max("id").alias("id"), F.count("*").alias("n")).withColumn("many", F.lit(True)))
    # A bucket's rows are with its owner: the window sorts them there and moves nothing.
    dealt = dealt.withColumn("prefix", _prefix(depth)).join(small(where, entries), "prefix").drop("prefix").repartition("bucket")
    chain = Window.partitionBy("bucket", "h", "t")
    owned = dealt.withColumn("keep_id", F.max("id").over(chain)).withColumn("size", F.sum("n").over(chain))
    index = stored(owned.select("id", "h", F.unhex(F.sha2("t", 256)).alias("sha"), "keep_id", "size", "bucket", "many"), "exact-index")

    columns = ["id", "keep_id", "size", "sha", "bucket"]
    out = index.filter("not many").select(*columns)
    if met is not None:
        answers = index.filter("many").select("h", "sha", "keep_id", "size", "bucket")
        asked = met.select("id", "h", F.unhex(F.sha2("t", 256)).alias("sha"))
        out = out.unionByName(asked.join(small(answers, answers.count()), ["h", "sha"]).select(*columns))
    kept = F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull())
    return out.select(F.col("id").alias(id), "keep_id", F.col("size").alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "bucket")


ORACLE = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, coalesce(doc_id = max(doc_id) OVER w, max(doc_id) OVER w IS NULL) AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
