"""Texts that share a frequent key, met without pairing all of them.

A key's texts are told apart by what they don't share. What all of them begin and end with
is taken off, which changes no distance; the rest is the core. Cores of more than SHORT
characters are cut into three (tau 2) or two (tau 1) segments, and a text goes on under the
key and each of its segments; an inner segment is taken out of the core and a mark stays in
its place. tau edits leave one segment whole, and what is left of the core has all edits, so
nothing is lost however often this is done. A key of at most `most` texts gives its pairs.

Short cores meet in stars: a core without one or two of its characters (marks stay) names a
star, as does such a rest with the places of what was taken out. Two cores within tau edits
are in one star, or in two of one centre, and a star gives a row for each text and no pairs.

Each round shortens cores by a segment and splits keys, so rows grow by a factor that
depends on the length of cores, not on the number of texts. Keys with the same texts count once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import discard, small, stored

#: Longest core that surely meets in stars; cores up to two longer do so as well.
SHORT = 5
#: Stands where an inner segment was; no line has it.
MARK = "\n"


def _shared_start(x: Column, y: Column) -> Column:
    """Number of characters that x and y both begin with."""
    equal = F.zip_with(F.split(x, ""), F.split(y, ""), lambda a, b: a.eqNullSafe(b))
    at = F.array_position(equal, False).cast("int")
    return F.when(at > 0, at - 1).otherwise(F.length(x))


def _groups(rows: DataFrame) -> DataFrame:
    """key, m (texts), head and tail (characters that all of a key's texts begin and end with), short (length of its shortest core); keys of several classes, one for each set of texts."""
    r = F.col("r")
    g = rows.groupBy("key", "tau").agg(
        F.count("*").alias("m"), F.min("class").alias("p"), F.max("class").alias("q"), F.min(F.length(r)).alias("short"),
        F.min(r).alias("lo"), F.max(r).alias("hi"), F.min(F.reverse(r)).alias("lo_end"), F.max(F.reverse(r)).alias("hi_end"),
        F.bit_xor(F.xxhash64("line", "r")).alias("s1"), F.bit_xor(F.xxhash64(F.lit("second"), F.col("line"), r)).alias("s2"),
    )
    g = g.filter("p < q").dropDuplicates(["tau", "m", "s1", "s2"])
    g = g.select("key", "tau", "m", "short", _shared_start(F.col("lo"), F.col("hi")).alias("head"), _shared_start(F.col("lo_end"), F.col("hi_end")).alias("tail"))
    head = F.least("head", "short")
    return g.select("key", "tau", "m", head.alias("head"), F.least("tail", F.col("short") - head).alias("tail"), "short").withColumn("short", F.col("short") - F.col("head") - F.col("tail"))


def _segments(rows: DataFrame, keep: list[str]) -> DataFrame:
    """rows (key, tau, line, r and keep; short: length of the key's shortest core) under the keys of their segments."""
    n, tau = F.length("r"), F.col("tau")
    # Long cores only, so segments have two characters at least.
    least = F.greatest("short", F.lit(SHORT + 1))
    rows = rows.withColumn("p", F.call_function("div", least, tau + 1).cast("int")).withColumn("size", (least - 2 * F.col("p")).cast("int"))
    p, size, r = F.col("p"), F.col("size"), F.col("r")
    inner = lambda at: F.struct(F.lit("inner").alias("kind"), F.substring(r, p + at, size).alias("segment"), F.concat(F.substring(r, F.lit(1), p + (at - 1)), F.lit(MARK), F.substring(r, p + at + size, n)).alias("left"))
    half = F.when(tau == 2, p).otherwise(least - p)
    outer = [F.struct(F.lit("head").alias("kind"), F.substring(r, F.lit(1), p).alias("segment"), r.alias("left")), F.struct(F.lit("tail").alias("kind"), F.substring(r, n - half + 1, half).alias("segment"), r.alias("left"))]
    cut = F.when(tau == 2, F.array(*outer, *[inner(at) for at in (1, 0, 2)])).otherwise(F.array(*outer))
    out = rows.select("key", "tau", "line", *keep, F.explode(cut).alias("s"))
    return out.select(F.xxhash64("key", "s.kind", "s.segment").alias("key"), "tau", "line", *keep, F.col("s.left").alias("r")).dropDuplicates(["key", "line", "r"])


def stars(rows: DataFrame) -> DataFrame:
    """a, b: each text of a star and its centre, of different classes. rows: key, tau, line, class, r."""
    n = F.length("r")
    places = F.when(n > 0, F.filter(F.sequence(F.lit(1), n), lambda i: F.substring("r", i, 1) != MARK)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("places", places)
    none = F.lit(0)
    pair = lambda i, j: F.struct(i.alias("x"), j.alias("y"))
    two = F.flatten(F.transform("places", lambda i: F.transform(F.filter("places", lambda j: j > i), lambda j: pair(i, j))))
    cuts = F.concat(F.array(pair(none, none)), F.transform("places", lambda i: pair(i, none)), F.when(F.col("tau") == 2, two).otherwise(F.array().cast("array<struct<x:int,y:int>>")))
    rows = rows.select("key", "tau", "line", "class", "r", F.explode(cuts).alias("c")).select("key", "tau", "line", "class", "r", "c.*")
    x, y, r = F.col("x"), F.col("y"), F.col("r")
    without = lambda t, i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t)))
    rest = F.when(x == 0, r).when(y == 0, without(r, x)).otherwise(without(without(r, y), x))
    # kind, places and whether the text may be the centre: of "whole" the core that is the rest itself, of "one" those that lack one character there.
    star = lambda kind, i, j, leads: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), F.lit(leads).alias("leads"))
    whole, one = F.array(star("whole", none, none, True)), [star("whole", none, none, False), star("one", x, none, True)]
    named = F.when(x == 0, whole).when(y > 0, F.array(star("whole", none, none, False), star("one", x, none, False), star("one", y - 1, none, False), star("two", x, y, True)))
    named = named.when(F.col("tau") == 2, F.array(*one, star("any", none, none, True))).otherwise(F.array(*one))
    at = ["key", "tau", "v", "kind", "i", "j"]
    rows = rows.select("key", "tau", "line", "class", rest.alias("v"), F.explode(named).alias("s")).select("key", "tau", "line", "class", "v", "s.*")
    centre = F.min(F.when(F.col("leads"), F.struct("line", "class")))
    centres = rows.groupBy(*at).agg(centre.alias("o"), F.min("class").alias("p"), F.max("class").alias("q")).filter("p < q and o is not null").select(*at, F.col("o.line").alias("o_line"), F.col("o.class").alias("o_class"))
    met = rows.select(*at, "line", "class").join(centres, at).filter(F.col("class") != F.col("o_class"))
    return met.select(F.least("line", "o_line").alias("a"), F.greatest("line", "o_line").alias("b"))


def meetings(rows: DataFrame, most: int, pairs: Callable[[DataFrame], DataFrame]) -> list[DataFrame]:
    """Stored tables (a, b) of texts to compare, so that all classes within tau edits are connected.

    rows: a stored table of key, tau, line, class, r (the text) and what `pairs` needs, which makes the pairs (a, b) of keys of at most `most` texts.
    """
    keep = [c for c in rows.columns if c not in ("key", "tau", "line", "r")]
    found = []
    while True:
        groups = stored(_groups(rows), "core-groups")
        n = groups.count()
        here = rows.join(small(groups, n), ["key", "tau"])
        core = F.substring("r", F.col("head") + 1, F.length("r") - F.col("head") - F.col("tail"))
        often = here.filter(F.col("m") > most).withColumn("r", core)
        meet = pairs(here.filter(F.col("m") <= most)).unionByName(stars(often.filter(F.length("r") <= SHORT + 2)))
        found.append(stored(meet.distinct(), "core-pairs"))
        after = None
        if not groups.filter(F.col("m") > most).isEmpty():
            after = stored(_segments(often.filter(F.length("r") > SHORT), keep), "core-rows")
        discard(groups)
        discard(rows)
        if after is None:
            return found
        if after.isEmpty():
            discard(after)
            return found
        rows = after
