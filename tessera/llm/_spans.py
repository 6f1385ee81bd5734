"""Matches of a pattern with their places, as expressions."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,start:int,end:int,text:string,before:string,after:string>>"
#: Elements of an array that are gathered before they are added to a longer one.
CHUNK = 64


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _chunks(items: Column) -> Column:
    return let(items, lambda a: F.transform(F.sequence(F.lit(0), F.floor(F.size(a) / CHUNK).cast("int")), lambda k: F.slice(a, k * CHUNK + 1, CHUNK)))


def fold(items: Column, state: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """What step(state, item), which gives the next state and an array of `kind`, puts out over all items.

    Arrays are added to short ones first, so the time is about linear in the items.
    """
    empty = F.array().cast(kind)
    both = lambda s, out: F.struct(s.alias("s"), out.alias("out"))

    def one(acc: Column, x: Column) -> Column:
        after, out = step(acc["s"], x)
        return both(after, F.concat(acc["out"], out))

    def nested(inner: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
        return lambda acc, part: F.aggregate(part, both(acc["s"], empty), inner, lambda r: both(r["s"], F.concat(acc["out"], r["out"])))

    return F.aggregate(_chunks(_chunks(items)), both(state, empty), nested(nested(one)), lambda r: r["out"])


def matches(text: Column, pattern: str, kind: str, before: int = 0, after: int = 0) -> Column:
    """Leftmost matches that don't overlap: kind, start and end (code points), text, and up to so many characters before and after, from the match before to the one after at most."""
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("gap"))

    def placed(x: Column) -> Column:
        m, gap = x["m"], x["gap"]
        near = lambda a, i: F.coalesce(F.get(a, i), F.lit(""))
        left = lambda i: F.right(F.concat(near(m, i - 1), near(gap, i)), F.lit(before)) if before else F.lit("")
        right = lambda i: F.left(F.concat(near(gap, i + 1), near(m, i + 1)), F.lit(after)) if after else F.lit("")
        return F.transform(m, lambda t, i: F.struct(F.length(F.get(gap, i)).alias("gap"), t.alias("text"), left(i).alias("before"), right(i).alias("after")))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + x["gap"]
        end = start + F.length(x["text"])
        return end, F.array(F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["text"].alias("text"), x["before"].alias("before"), x["after"].alias("after")))

    return fold(let(found, placed), F.lit(0), SPAN, step)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True if the digits' check sum is right."""
    d = F.split(F.reverse(number), "")
    total = F.aggregate(
        F.zip_with(d, F.sequence(F.lit(0), F.length(number) - 1), lambda c, i: F.struct(F.expr("0").alias("z"), c.cast("int").alias("c"), i.alias("i"))),
        F.lit(0),
        lambda a, x: a + F.when(x["i"] % 2 == 0, x["c"]).otherwise(F.floor(x["c"] * 2 / 10).cast("int") + (x["c"] * 2) % 10),
    )
    return total % 10 == 0


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def by_place(spans: Column, kinds: list[str]) -> Column:
    """Spans by start, then in the order of kinds."""
    rank = lambda k: F.array_position(F.array(*[F.lit(x) for x in kinds]), k)
    keyed = F.transform(spans, lambda x: F.struct(x["start"].alias("s"), rank(x["kind"]).alias("r"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda x: x["x"])


def first_ones(spans: Column) -> Column:
    """Of spans by start, those that don't touch one kept before."""
    none = F.array().cast(SPAN)
    return fold(spans, F.lit(0), SPAN, lambda end, x: (F.when(x["start"] < end, end).otherwise(x["end"]), F.when(x["start"] < end, none).otherwise(F.array(x))))


def without_overlaps(spans: Column, taken: Column, kinds: list[str]) -> Column:
    """Of spans, those that touch neither a taken span nor one kept before, by start.

    A span touches a taken one if, of those that start before its end, the furthest end lies behind its start.
    """
    none = F.array().cast(SPAN)
    event = lambda x, at, last: F.struct(at.alias("at"), F.lit(last).alias("last"), x["start"].alias("start"), x["end"].alias("end"), x.alias("x"))
    events = F.array_sort(F.concat(F.transform(taken, lambda t: event(t, t["start"], 1)), F.transform(spans, lambda x: event(x, x["end"], 0))))

    def step(furthest: Column, e: Column) -> tuple[Column, Column]:
        return F.when(e["last"] == 1, F.greatest(furthest, e["end"])).otherwise(furthest), F.when((e["last"] == 0) & (furthest <= e["start"]), F.array(e["x"])).otherwise(none)

    return first_ones(by_place(fold(events, F.lit(0), SPAN, step), kinds))


def small_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of a few rows, made in the JVM from one literal."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))
