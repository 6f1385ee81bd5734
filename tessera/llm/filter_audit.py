"""What filters take from each other: all orders of five filters, exactly, from one pass.

A text's failures of A to D depend on the text alone. E fails for a row whose text is also
that of a row with a smaller id, which only the owner of the text can know: rows are routed
as an RDD partitioned by the texts' xxhash. An owner keeps, for each hash, a chain of full
texts with the smallest id seen; a hash met again compares the texts themselves, so texts
that collide stay apart. Rows above the smallest id fail E.

Before they are routed, rows meet in their own task the same way: a row above the smallest
id of its task is settled there and leaves its text behind, so of a text that a third of
all rows share, each task sends one copy per HELD bytes of texts. combineByKey merges, for
each part, a vector of counts by the 32 sets of failures; every figure of every order is a
sum over that vector.

Null texts are empty, and equal to other empty texts; a null part is the empty string's.
Rows with a null id never fail E and make none fail. Rows with the same id and text fail E
together or not at all. A document counts as good (toxic) if any of its rows in the labels
says so; labels without a document count for nothing. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import partitions, small

FILTERS = "ABCDE"
#: Bytes of texts that a task keeps before it routes them, and that an owner's partition may have on average.
HELD, OWNED = 32 << 20, 48 << 20

_SETS = 1 << len(FILTERS)
_OTHERS = bytes(set(range(256)) - set(range(ord("A"), ord("Z") + 1)))
_MARKS = b"#$%&*|"
_NOT_MARKS = bytes(set(range(256)) - set(_MARKS))
_LATER_BYTES = bytes(range(0x80, 0xC0))

SCHEMA = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failures(text: bytes) -> int:
    """The set of A to D that a text (UTF-8) fails, as bits."""
    words = text.split()
    capitals = len(text.translate(None, _OTHERS))
    characters = len(text.translate(None, _LATER_BYTES))
    failed = (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * capitals > 5 * characters, bool(text.translate(None, _NOT_MARKS)))
    return sum(1 << k for k, bad in enumerate(failed) if bad)


class Chains:
    """Texts by hash, with the smallest id of each and the rows that have it. Rows above it come out of add(); the others out of waiting()."""

    def __init__(self) -> None:
        self.by_hash: dict[int, list[list]] = {}
        self.size = 0

    def add(self, key: int, text: bytes, mask: int, id: int, rows: dict[str, int]) -> Iterator[tuple[int, str, int, int]]:
        """Rows that now are known to fail E: id, part, mask, count."""
        chain = self.by_hash.setdefault(key, [])
        entry = next((x for x in chain if x[0] == text), None)
        if entry is None:
            chain.append([text, mask, id, dict(rows)])
            self.size += len(text)
        elif id == entry[2]:
            for part, n in rows.items():
                entry[3][part] = entry[3].get(part, 0) + n
        else:
            above = (id, rows) if id > entry[2] else (entry[2], entry[3])
            if id < entry[2]:
                entry[2:] = [id, dict(rows)]
            for part, n in above[1].items():
                yield above[0], part, mask | _SETS >> 1, n

    def waiting(self) -> Iterator[tuple[int, bytes, int, int, dict[str, int]]]:
        for key, chain in self.by_hash.items():
            for text, mask, id, rows in chain:
                yield key, text, mask, id, rows
        self.by_hash, self.size = {}, 0


Routed = tuple[int, tuple[bytes | None, int, int | None, dict[str, int]]]


def _settle(rows: Iterable) -> Iterator[Routed]:
    """By hash: texts with their smallest id here; and, without text, by id, rows that nothing can change any more."""
    here = Chains()
    for id, part, key, text in rows:
        text = bytes(text)
        mask = failures(text)
        if id is None:
            yield key, (None, mask, None, {part: 1})
            continue
        for i, p, m, n in here.add(key, text, mask, id, {part: 1}):
            yield i, (None, m, i, {p: n})
        if here.size >= HELD:
            yield from ((k, x) for k, *x in here.waiting())
    yield from ((k, x) for k, *x in here.waiting())


def _own(items: Iterable[Routed]) -> Iterator[tuple[int | None, str, int, int]]:
    """id, part, set of failures, rows of all that was routed here."""
    chains = Chains()
    for key, (text, mask, id, rows) in items:
        if text is None:
            yield from ((id, part, mask, n) for part, n in rows.items())
        else:
            yield from chains.add(key, text, mask, id, rows)
    for _, _, mask, id, rows in chains.waiting():
        yield from ((id, part, mask, n) for part, n in rows.items())


def failing(docs: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source", owners: int | None = None) -> DataFrame:
    """id, part, mask, n: how many rows of an id and part fail which filters; bit k of mask is filter k."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).cast("long"), F.coalesce(F.col(part), F.lit("")), F.xxhash64(t), t.cast("binary"))
    if owners is None:
        owners = max(partitions(docs.sparkSession), -(-(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) // OWNED))
    routed = rows.rdd.mapPartitions(_settle).partitionBy(owners, lambda key: key)
    return docs.sparkSession.createDataFrame(routed.mapPartitions(_own), "id long, part string, mask int, n long", verifySchema=False)


def _vector() -> list[int]:
    return [0] * (3 * _SETS)


def _counted(vector: list[int], row: tuple[int, int, bool, bool]) -> list[int]:
    mask, n, good, toxic = row
    vector[mask] += n
    vector[_SETS + mask] += n * good
    vector[2 * _SETS + mask] += n * toxic
    return vector


def _merged(a: list[int], b: list[int]) -> list[int]:
    return [x + y for x, y in zip(a, b, strict=True)]


def vectors(failed: DataFrame, labels: DataFrame, id: str = "doc_id") -> RDD:
    """(part, counts of rows, good and toxic ones by set of failures)."""
    known = labels.filter(F.col(id).isNotNull()).groupBy(F.col(id).cast("long").alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    known = known.filter(F.col("good") | F.col("toxic"))
    of = lambda c: F.coalesce(F.col(c), F.lit(False))
    rows = failed.join(small(known, known.count()), "id", "left").select("part", "mask", "n", of("good"), of("toxic"))
    return rows.rdd.map(lambda r: (r[0], tuple(r[1:]))).combineByKey(lambda row: _counted(_vector(), row), _counted, _merged)


def orders(part: str, vector: list[int]) -> Iterator[tuple]:
    """One row for each order and step."""
    sets = range(_SETS)
    rows, total = [], [0] * len(FILTERS)
    for order in itertools.permutations(range(len(FILTERS))):
        gone = 0
        for step, k in enumerate(order, 1):
            bit = 1 << k
            here = [m for m in sets if m & bit and not m & gone]
            n, good, toxic = (sum(vector[base + m] for m in here) for base in (0, _SETS, 2 * _SETS))
            redundant = sum(vector[m] for m in sets if m & bit and m & gone)
            gone |= bit
            total[k] += n
            rows.append((k, "".join(FILTERS[x] for x in order), step, sum(vector[m] for m in sets if not m & gone), n, redundant, vector[bit], good, toxic))
    for k, *row in rows:
        yield part, *row, total[k]


def audit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source", owners: int | None = None) -> DataFrame:
    """Per part, order of the five filters and step: what is kept, removed, redundant, failed alone, lost, and the filter's share over all orders."""
    counts = vectors(failing(docs, id, text, part, owners), labels, id)
    return docs.sparkSession.createDataFrame(counts.flatMap(lambda x: orders(*x)), SCHEMA, verifySchema=False)


ORACLE = """
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (len(words) < 50)::INT + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
    + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(min(w.doc_id) OVER (PARTITION BY t) < w.doc_id, false)::INT AS m
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
c AS (SELECT part, m, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY 1, 2),
k AS (SELECT unnest([0, 1, 2, 3, 4]) AS k),
p AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM k a, k b, k c, k d, k e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT o, i AS step, 1 << o[i] AS bit, coalesce(list_sum([1 << x for x in o[1:i - 1]]), 0)::INT AS gone FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS i)),
r AS (
  SELECT part, array_to_string(['ABCDE'[x + 1] for x in o], '') AS filter_order, step, bit,
    coalesce(sum(n) FILTER ((m & (gone | bit)) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER ((m & bit) <> 0 AND (m & gone) = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER ((m & bit) <> 0 AND (m & gone) <> 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (m = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER ((m & bit) <> 0 AND (m & gone) = 0), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER ((m & bit) <> 0 AND (m & gone) = 0), 0)::BIGINT AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""
