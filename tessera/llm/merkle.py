"""Merkle manifest of a dataset: a digest for each row, a tree for each language, and one root.

A leaf is a row's digest. Per group, leaves ascend by id; while several nodes remain, every
FANOUT consecutive ones become the digest of their concatenation (the last run may be shorter,
even a single node). What remains is the group's subroot; the subroots, in the order of their
groups, are the leaves of one more tree, whose top is the root.

Nodes get their index by row_number within range partitions, plus the rows of their group in
earlier partitions, so a group that holds all rows is ranked by all tasks. Then the tree grows
by DataFrame steps: an index divided by FANOUT**LEVELS, rounded down, names a block of at most
so many nodes; a block's children, gathered and sorted, are hashed level by level in one
expression, and its top is a node of the next step. Every step is a table FANOUT**LEVELS times
shorter than the one before. On the way back a step's blocks are joined with the siblings that
their top has further up, and each child gets its own before them.

Null values are hashed as `-`, so a null differs from an empty text; a null group comes first
and is a group of its own. Rows with a null id come first in their group. Rows with equal ids
are ordered by leaf; where these are equal too, the rows and their results are the same but
for their place. A group of one row has its leaf as subroot, a single group its subroot as
root, and with nothing to put in, a proof is the digest of the empty text. An empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import partitions, small, stored

#: Children of a node.
FANOUT = 2
#: Levels of the tree that one step grows: a block has at most FANOUT**LEVELS children.
LEVELS = 6

#: For each level, the nodes of a run to the left and to the right of the node that is proven.
_SIBLINGS = "array<struct<l:string,r:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(*values: Column) -> Column:
    """Digest of values: each as its length in bytes, a colon and itself, or `-` if null."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(F.concat(*map(framed, values)))


def group_key(group: Column) -> Column:
    """A text that is never null and sorts as the group does, null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows (with g) and idx, their place from 0 within g by `order`, and total, the rows of g. No task sees more of a group than its range."""
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), "g", *order).withColumn("range", F.spark_partition_id())
    own = Window.partitionBy("range", "g").orderBy(*order)
    placed = stored(dealt.withColumn("at", F.row_number().over(own).cast("long")), name)
    counts = placed.groupBy("g", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.select("g", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy("g")).alias("total")), f"{name}-counts")
    return placed.join(small(counts, counts.count()), ["g", "range"]).withColumn("idx", F.col("before") + F.col("at") - 1).drop("range", "at", "before")


def height(total: Column) -> Column:
    """Levels from `total` leaves to a single node."""
    return F.size(F.filter(F.array(*[F.lit(FANOUT**k).cast("long") for k in range(62) if FANOUT**k < 1 << 62]), lambda least: total > least))


def _parents(nodes: Column) -> Column:
    runs = F.ceil(F.size(nodes) / F.lit(FANOUT)).cast("int")
    return F.transform(F.sequence(F.lit(0), runs - 1), lambda r: digest(F.array_join(F.slice(nodes, r * FANOUT + 1, F.lit(FANOUT)), "")))


def step(nodes: DataFrame, payload: list[str], name: str) -> DataFrame:
    """Blocks of nodes (g, idx, h, height): g, block, height, kids in order, and the digests of each level from the kids' own to the block's top."""
    kid = F.struct("idx", "h", *payload)
    blocks = nodes.groupBy("g", "height", F.floor(F.col("idx") / F.lit(FANOUT**LEVELS)).alias("block")).agg(F.array_sort(F.collect_list(kid)).alias("kids"))
    blocks = blocks.withColumn("h0", F.transform("kids", lambda x: x["h"]))
    for j in range(LEVELS):
        blocks = blocks.withColumn(f"h{j + 1}", F.when(F.col("height") > j, _parents(F.col(f"h{j}"))).otherwise(F.col(f"h{j}")))
    return stored(blocks.select("g", "block", "height", "kids", F.array(*[f"h{j}" for j in range(LEVELS + 1)]).alias("levels")), name)


def grow(nodes: DataFrame, payload: list[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """The stored steps of the trees of all groups, from the leaves up, and their tops (g, h). nodes: g, idx, total, h, payload."""
    nodes = nodes.withColumn("height", height(F.col("total")))
    steps, left = [], None
    while left is None or left > 0:
        steps.append(step(nodes, payload, f"{name}-{len(steps)}"))
        nodes = steps[-1].select("g", F.col("block").alias("idx"), F.element_at(F.element_at("levels", -1), 1).alias("h"), F.greatest(F.col("height") - LEVELS, F.lit(0)).alias("height"))
        payload, left = [], nodes.agg(F.max("height")).first()[0] or 0
    return steps, nodes.select("g", "h")


def _siblings(at: Column) -> Column:
    """The siblings of the node at place `at` in its block, from its own level up."""
    out = []
    for j in range(LEVELS):
        nodes, place = F.element_at("levels", j + 1), F.floor(at / F.lit(FANOUT**j)).cast("int")
        run = F.floor(place / F.lit(FANOUT)).cast("int") * FANOUT
        of = lambda first, n, nodes=nodes: F.array_join(F.slice(nodes, first, n), "")
        out.append(F.when(F.col("height") > j, F.struct(of(run + 1, place - run).alias("l"), of(place + 2, run + FANOUT - 1 - place).alias("r"))))
    return F.filter(F.array(*out), lambda s: s.isNotNull()).cast(_SIBLINGS)


def descend(steps: list[DataFrame], above: DataFrame) -> DataFrame:
    """Kids of the first step with their group and siblings up to the last top. above: g, siblings of the tops."""
    above = above.withColumn("idx", F.lit(0).cast("long"))
    for blocks in reversed(steps):
        known = blocks.join(above.withColumnRenamed("idx", "block"), ["g", "block"])
        kids = F.transform("kids", lambda x, i: F.struct(x.alias("kid"), F.concat(_siblings(i), F.col("siblings")).alias("siblings")))
        above = known.select("g", F.explode(kids).alias("x")).select("g", F.col("x.kid.idx").alias("idx"), F.col("x.kid").alias("kid"), "x.siblings")
    return above


def proof(siblings: Column) -> Column:
    return digest(F.array_join(F.transform(siblings, lambda s: F.concat(s["l"], s["r"])), ""))


def fold(start: Column, siblings: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(siblings, start, lambda node, s: digest(F.concat(s["l"], node, s["r"])))


def manifest(docs: DataFrame, id: str = "doc_id", group: str = "lang", values: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), counter: str = "n_chars", tampered: Column | None = None) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    folded_root is worked out from the siblings and the row's leaf, where `tampered` holds
    (default: 7 divides the crc32 of the id's decimals) from its leaf with counter + 1.
    """
    spark = docs.sparkSession
    hit = F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 7 == 0 if tampered is None else tampered, F.lit(False))
    false_leaf = leaf(*[F.col(c) + 1 if c == counter else F.col(c) for c in values])
    leaves = stored(docs.select(F.col(id).alias("id"), group_key(F.col(group)).alias("g"), leaf(*map(F.col, values)).alias("h"), F.when(hit, false_leaf).alias("found")), "merkle-leaves")

    steps, tops = grow(numbered(leaves, ["id", "h"], "merkle-placed"), ["id", "found"], "merkle-step")
    ends = numbered(tops.select(F.lit("").alias("g"), F.col("g").alias("of"), "h"), ["of"], "merkle-ends")
    upper, root = grow(ends, ["of"], "merkle-upper")
    none = F.array().cast(_SIBLINGS)
    known = descend(upper, root.select("g", none.alias("siblings")))
    known = stored(known.select(F.col("kid.of").alias("g"), F.col("kid.h").alias("subroot"), "siblings"), "merkle-subroots")
    whole = root.first()
    root_hash = F.lit(whole["h"] if whole else "")

    subroots = small(known.select("g", "subroot"), known.count())
    proven = descend(steps, known.select("g", "siblings")).join(subroots, "g")
    folded = fold(F.coalesce("kid.found", "kid.h"), F.col("siblings"))
    out = proven.select(F.col("kid.id").alias(id), F.col("kid.h").alias("leaf"), "subroot", root_hash.alias("root"), proof(F.col("siblings")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_FRAMED = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_FRAMED.format(x) for x in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_PAIRED = "[sha256(h[2 * i + 1] || coalesce(h[2 * i + 2], '')) for i in range((len(h) + 1) // 2)]"

#: 3988292384 is the fixed polynomial of CRC-32. `up` holds the levels of each tree, `way` the siblings of each leaf: [left, right] by level.
ORACLE = f"""
WITH RECURSIVE c AS (SELECT [list_reduce(list_prepend(n, range(8)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) for n in range(256)] AS t),
d AS (SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, {_leaf_sql("(n_chars + 1)")} AS wrong,
        xor(list_reduce(list_prepend(4294967295, [ascii(z)::BIGINT for z in string_split(doc_id::VARCHAR, '')]), lambda x, y: xor(x >> 8, t[xor(x & 255, y) + 1])), 4294967295) % 7 = 0 AS hit FROM documents, c),
n AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM d),
up AS (
  SELECT lang, 0 AS l, list(leaf ORDER BY idx) AS h FROM n GROUP BY lang
  UNION ALL SELECT lang, l + 1, {_PAIRED} FROM up WHERE len(h) > 1),
ends AS (SELECT lang, h[1] AS subroot, row_number() OVER (ORDER BY lang IS NOT NULL, lang) - 1 AS idx FROM up WHERE len(h) = 1),
top AS (
  SELECT 0 AS l, list(subroot ORDER BY idx) AS h FROM ends
  UNION ALL SELECT l + 1, {_PAIRED} FROM top WHERE len(h) > 1),
root AS (SELECT h[1] AS root FROM top WHERE len(h) = 1),
low AS (SELECT lang, list(h ORDER BY l) AS hs FROM up WHERE len(h) > 1 GROUP BY lang),
high AS (SELECT list(h ORDER BY l) AS hs FROM top WHERE len(h) > 1),
way AS (
  SELECT n.doc_id, n.leaf, subroot, root, CASE WHEN hit THEN coalesce(wrong, leaf) ELSE leaf END AS start,
    list_concat(coalesce([CASE WHEN (n.idx >> j) & 1 = 1 THEN [low.hs[j + 1][n.idx >> j], ''] ELSE ['', coalesce(low.hs[j + 1][(n.idx >> j) + 2], '')] END for j in range(len(low.hs))], []),
      coalesce([CASE WHEN (ends.idx >> j) & 1 = 1 THEN [high.hs[j + 1][ends.idx >> j], ''] ELSE ['', coalesce(high.hs[j + 1][(ends.idx >> j) + 2], '')] END for j in range(len(high.hs))], [])) AS s
  FROM n JOIN ends ON n.lang IS NOT DISTINCT FROM ends.lang LEFT JOIN low ON n.lang IS NOT DISTINCT FROM low.lang, root, high),
fold AS (SELECT *, list_reduce(list_prepend(['', start, ''], [[z[1], '', z[2]] for z in s]), lambda x, y: ['', sha256(y[1] || x[2] || y[3]), ''])[2] AS folded_root FROM way)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string([z[1] || z[2] for z in s], '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM fold
"""
