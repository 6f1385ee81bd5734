"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

A source's documents, in seeded order, are cut into blocks of equal numbers of words in
each shard. The blocks that the mix takes are given to sources, and within a source to
its shards, one by one to the highest quotient target / (2 * seats + 1); so quotas are
whole and sum up. A shard takes each of its blocks quota div blocks times, and a seeded
choice of quota mod blocks of them once more. No block is taken more than twice.

Size: words of the text; null text has none. A null source is one more source, the
last. Sources with no words have target and quota 0. Rows with a null id are ordered by
their text's hash; repeated rows are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import WORD, fresh, stored

WEIGHTS, SHARE, CAP, SEED = (5, 2, 1), 1.5, 2.0, 20240229
#: Words in a block, and in a shard about.
BLOCK, SHARD = 64, 4_000_000


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """sources: source, source_size. Adds target: proportional to weight, none above cap * size, what is cut off shared by weight again.

    The level L with sum(min(cap * size, L * weight)) = share * total is found in one pass:
    sources are full in the order of cap * size / weight, up to the first that L leaves below.
    The table has a row for each source.
    """
    code = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    turn = (F.row_number().over(code) - 1) % len(weights)
    s = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    s = s.withColumn("full", cap * F.col("source_size"))
    by = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").cast("binary").asc_nulls_last())
    everything = Window.partitionBy()
    s = s.withColumn("before", F.coalesce(F.sum("full").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("weights_left", F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("want", share * F.sum("source_size").over(everything))
    s = s.withColumn("level", (F.col("want") - F.col("before")) / F.col("weights_left"))
    s = s.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("full"), F.col("level"))).over(everything))
    return s.withColumn("target", F.least("full", F.coalesce(F.col("level") * F.col("weight"), F.col("full")))).select("source", "source_size", "target")


def apportion(parties: DataFrame, groups: list[str], votes: str, seats: Column, tie: list[Column]) -> DataFrame:
    """parties with their seats of each group: the `seats` highest of votes / 1, votes / 3, votes / 5, ...

    With divisor votes / (seats - parties / 2) every party surely has its rounded share,
    so only the last few quotients of each party are set side by side. Ties go by `tie`.
    """
    w = Window.partitionBy(*groups)
    p = parties.withColumn("_seats", seats).withColumn("_votes", F.sum(votes).over(w)).withColumn("_n", F.count(F.lit(1)).over(w))
    share = F.when(F.col("_votes") > 0, F.col(votes) / F.col("_votes")).otherwise(0.0)
    sure = F.floor(share * F.greatest(F.col("_seats") - F.col("_n") / 2.0, F.lit(0.0)) + 0.5)
    p = p.withColumn("_sure", F.when(F.col(votes) > 0, sure).otherwise(0))
    p = p.withColumn("_open", F.col("_seats") - F.sum("_sure").over(w))
    most = F.when(F.col(votes) > 0, F.least(F.ceil(share * (F.col("_n") + 1)) + 1, F.greatest("_open", F.lit(0)))).otherwise(0)
    q = p.withColumn("_k", F.explode(F.when(most > 0, F.sequence(F.lit(0).cast("long"), most.cast("long") - 1)).otherwise(F.array().cast("array<bigint>"))))
    q = q.withColumn("_quotient", F.col(votes) / (2.0 * (F.col("_sure") + F.col("_k")) + 1))
    order = Window.partitionBy(*groups).orderBy(F.col("_quotient").desc(), *tie, "_k")
    won = q.withColumn("_rank", F.row_number().over(order)).filter("_rank <= _open")
    keys = [c for c in parties.columns if c not in ("_seats",)]
    won = won.groupBy(*[F.col(k).alias(f"_w_{k}") for k in keys]).agg(F.count("*").alias("_won"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_w_{k}"))
    return p.join(won, on, "left").select(*keys, (F.col("_sure") + F.coalesce("_won", F.lit(0))).cast("long").alias("quota"))


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED, block: int = BLOCK, shard_words: int = SHARD) -> DataFrame:
    """id, size, source_size, target and taken of every row."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    turn = F.xxhash64(F.lit(seed), F.coalesce(F.col(id).cast("string"), F.lit("")), F.when(F.col(id).isNull(), F.xxhash64(F.col(text))))
    rows = stored(docs.select(F.col(id).alias("id"), F.col(source).alias("source"), size.alias("size"), turn.alias("turn")), "mixing-sizes")

    totals = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "mixing-targets")
    shards = F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))
    # One row for each source: joined by the name, the rows of a large source are split.
    placed = rows.join(totals, rows["source"].eqNullSafe(totals["source"])).select("id", rows["source"], "size", "turn", "source_size", "target", F.pmod(F.xxhash64("turn"), shards).alias("shard"))
    line = Window.partitionBy("source", "shard").orderBy("turn", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lined = stored(placed.withColumn("end", F.sum("size").over(line)), "mixing-lines")

    kept = totals.filter("source_size > 0")
    quota = apportion(kept.withColumn("all", F.lit(1)), ["all"], "target", F.round(F.sum("target").over(Window.partitionBy()) / block), [F.col("source").cast("binary").asc_nulls_last()])
    parts = lined.groupBy("source", "shard").agg(F.max("end").alias("words")).filter("words > 0").join(quota.select(F.col("source").alias("s"), F.col("quota").alias("blocks")), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    shares = apportion(parts, ["source"], "words", F.col("blocks"), [F.col("shard")])
    n = F.greatest(F.floor(F.col("words") / block), F.lit(1))
    # Blocks of a shard are equal: its words over their number, so none is short.
    shares = stored(shares.select("source", "shard", "quota", n.alias("n"), (F.col("words") / n).alias("each")), "mixing-shards")

    d = lined.join(shares.select(F.col("source").alias("s"), F.col("shard").alias("p"), "quota", "n", "each"), F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("p")), "left")
    # The seeded choice: documents already lie in seeded order; of the blocks, counted from a seeded start, every n / rest-th is taken once more.
    start = F.pmod(F.xxhash64(F.lit(seed), F.coalesce("source", F.lit("")), "shard"), F.col("n"))
    whole, rest = F.floor(F.col("quota") / F.col("n")), F.pmod("quota", "n")
    chosen = lambda k: F.floor((F.pmod(k + start, F.col("n")) + 1) * rest / F.col("n")) - F.floor(F.pmod(k + start, F.col("n")) * rest / F.col("n"))
    edge = lambda k: F.round(k * F.col("each"))
    first = F.floor((F.col("end") - F.col("size")) / F.col("each"))
    last = F.least(F.floor((F.col("end") - 1) / F.col("each")) + 1, F.col("n") - 1)
    begin = F.col("end") - F.col("size")
    part = lambda k: F.greatest(F.least(F.col("end"), edge(k + 1)) - F.greatest(begin, edge(k)), F.lit(0))
    over = F.aggregate(F.sequence(F.greatest(first - 1, F.lit(0)), F.greatest(last, F.lit(0))), F.lit(0).cast("double"), lambda a, k: a + part(k) * F.least(whole + chosen(k), F.lit(2)).cast("double"))
    taken = F.when((F.col("size") > 0) & F.col("n").isNotNull(), over).otherwise(0.0)
    return d.select(F.col("id").alias(id), "size", "source_size", "target", F.least(taken, 2.0 * F.col("size")).cast("long").alias("taken"))


def sample(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """The mix as rows: each document as often as taken / size rounds to, by a seeded draw for the part over a whole.

    Rows with one id are drawn alike; rows with a null id stay once.
    """
    t = mix(docs, id, text, source, seed).filter(F.col(id).isNotNull()).groupBy(F.col(id).alias("_id")).agg(F.sum("taken").alias("_taken"), F.sum("size").alias("_size"))
    share = F.col("_taken") / F.col("_size")
    draw = F.pmod(F.xxhash64(F.lit(seed), "_id"), F.lit(1 << 20)) / float(1 << 20)
    times = F.floor(share).cast("int") + (draw < share - F.floor(share)).cast("int")
    t = stored(t.filter("_size > 0").select("_id", times.alias("_times")), "mixing-times")
    own, often, copy = (fresh(docs, c) for c in ("_id", "_times", "_copy"))
    # One shuffle, whatever the size: no size changes the plan, and the driver gathers nothing.
    out = docs.join(t.toDF(own, often).hint("merge"), F.col(id) == F.col(own), "left")
    n = F.when(F.col(id).isNull(), 1).otherwise(F.coalesce(often, F.lit(0)))
    return out.filter(n > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), n))).select(*docs.columns)
