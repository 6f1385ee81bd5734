"""Similarity join of documents on sets of word shingles, by universe partition and pigeonhole.

Sizes fall into bands. A band hashes the universe of shingles into m segments, so each
set falls into m parts. Two sets with the wanted Jaccard similarity differ in at most H
shingles, H fixed by the band; each difference spoils one part. A set with more than H
non-empty parts therefore shares an equal non-empty part with every partner. The index
holds a key for every non-empty part, and for the first few parts also the keys of
their one-deletion neighbourhoods, which are worth two differences each.

Allocation by cost: keys that many documents share get no pairs. They are left out as
long as a document's other parts still outweigh H. Documents that lean on shared keys are
given the finest parts, one shingle each, and joined among themselves (see lean_links):
first each proposes the nearest leader of another component, then only keys count that
still lie in several components, and components are compared through their leaders.
m is chosen per band so that the non-empty parts outweigh H by a margin; should a set
ever fall short, the join is made anew with one shingle to a part, which always holds.

Pairs that share as many keys as their sizes call for are compared exactly, by set. Sets
are those of 64-bit hashes of shingles; equal sets are told by size and a 128-bit digest.
The result is classes: of a class, links are found until all of it is connected, no more.

Words are lower-cased (A-Z only). A document with fewer words than a shingle has its
whole sequence as its one shingle; without words or with null text its set is empty and
links with nothing. Equal sets link through one table of set digests. Repeated rows
with one id count as one node; rows with a null id have no component and link nothing.
Ids are whole numbers; others are cast to long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._blocks import n_buckets, pack, unpack
from ._graph import components
from ._shared import arrow_batches, discard, few, small, stored
from ._words import Batch, chunks, mix, release

U64 = np.uint64
#: Documents to a key up to which all their pairs are taken at once.
FEW = 16
#: By so many of its least hashes a document that leans on frequent keys looks for leaders, so many times.
LEADING, ROUNDS = 16, 4
#: A round must link this part of what it compares for another to follow.
PAYS = 0.02
#: What can't be in a link is taken out of these before the rest is joined: again while a step takes out so large a part, but not more often than that.
WORTH, STEPS = 0.1, 3
#: Bytes and documents in a block.
BLOCK, BLOCK_DOCS = 3 << 20, 1 << 16
#: Shingles for each bucket of keys: a bucket is one task's group, so there are more of them where there is more text.
BUCKET_SHINGLES = 500_000
#: Bytes of texts or sets that a Python task gets at once.
BATCH = 8 << 20
#: Ids that may be broadcast; beyond that, documents are joined by shuffling.
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Plan:
    """Bands of set sizes for similarity num/den: of band i, sizes low[i] to high[i], at most differ[i] differences, parts[i] parts, the first double[i] with deletions."""

    num: int
    den: int
    low: np.ndarray
    high: np.ndarray
    differ: np.ndarray
    parts: np.ndarray
    double: np.ndarray

    @staticmethod
    def of(num: int, den: int, largest: int, single: bool = False) -> Plan:
        low, high = [], []
        at = 1
        while at <= largest:
            low.append(at)
            high.append(max(at, at * den // num - 1))
            at = high[-1] + 1
        low, high = np.array(low or [1], np.int64), np.array(high or [1], np.int64)
        differ = high * (den - num) // num
        parts, double = [], []
        for a, h in zip(low.tolist(), differ.tolist(), strict=True):
            parts.append(0 if single or a < 25 else _parts(a, h + 1))
            double.append(0 if not parts[-1] else 2 + parts[-1] // 64)
        return Plan(num, den, low, high, differ, np.array(parts), np.array(double))

    def band(self, size: np.ndarray | int) -> np.ndarray:
        return np.searchsorted(self.low, size, "right") - 1

    def smallest(self, size: np.ndarray) -> np.ndarray:
        return -(-size * self.num // self.den)


def _parts(size: int, need: int) -> int:
    """The fewest parts of which `size` shingles leave `need` non-empty, with a margin of seven deviations; 0 (each shingle its own) if that takes too many."""
    for m in range(need, 6 * size):
        a = size / m
        full = m * (1 - math.exp(-a))
        if full - 7 * math.sqrt(m * math.exp(-a) * (1 - (1 + a) * math.exp(-a))) >= need:
            return m
    return 0


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first of each text and the end): the distinct shingles of each text, sorted by hash."""
    b = Batch(texts, fold=True)
    first, h = b.windows(width)
    doc = b.doc[first]
    short = np.flatnonzero((b.n_words > 0) & (b.n_words < width))
    if len(short):
        words, n = b.word_hash(), b.n_words
        whole = np.array([_sequence(words[b.first_word[i] : b.first_word[i] + n[i]]) for i in short.tolist()], np.uint64)
        doc, h = np.concatenate([doc, short]), np.concatenate([h, whole])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    doc, h = doc[new], h[new]
    return h, np.searchsorted(doc, np.arange(len(texts) + 1))


def _sequence(words: np.ndarray) -> np.uint64:
    out = 0x1234567 + len(words)
    for w in words.tolist():
        out = (out * 0xD6E8FEB86659FD93 + w) & 0xFFFFFFFFFFFFFFFF
    return np.uint64(out)


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[cuts[1:]] - total[cuts[:-1]]


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """id, n_shingles, d1, d2 (a digest of the set; 128 bits) of every row of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch.column(1)):
                h, cuts = shingle_sets(texts, width)
                d1, d2 = _sums(mix(h ^ U64(0x5851F42D4C957F2D)), cuts), _sums(mix(mix(h) + U64(0x14057B7EF767814F)), cuts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(np.diff(cuts)), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))], ["id", "n_shingles", "d1", "d2"])

    return docs.mapInArrow(run, "id long, n_shingles long, d1 long, d2 long")


def part_keys(h: np.ndarray, cuts: np.ndarray, plan: Plan) -> tuple[np.ndarray, ...]:
    """Keys of sets: (key, set, own band or a lower one, worth), and for each (set, bands below) the non-empty parts and what all parts are worth."""
    size = np.diff(cuts)
    band = plan.band(size)
    lowest = plan.band(plan.smallest(size))
    out: list[list[np.ndarray]] = [[], [], [], []]
    full, worth = np.zeros((len(size), 3), np.int64), np.zeros((len(size), 3), np.int64)
    for b in np.unique(np.concatenate([band[size > 0] - k for k in range(3)])).tolist():
        mine = np.flatnonzero((size > 0) & (band >= b) & (lowest <= b))
        if b < 0 or not len(mine):
            continue
        n = size[mine]
        doc = np.repeat(np.arange(len(mine)), n)
        at = np.repeat(cuts[mine] - (np.cumsum(n) - n), n) + np.arange(len(doc))
        salt = U64((b + 1) * 0x9FB21C651E98DF25 & 0xFFFFFFFFFFFFFFFF)
        token = mix(h[at] ^ salt)
        parts = int(plan.parts[b])
        if not parts:
            keys, of, ws = token, doc, np.ones(len(token), np.int64)
            full[mine, band[mine] - b] = n
            worth[mine, band[mine] - b] = n
        else:
            part = (token >> U64(20)) % U64(parts)
            order = np.argsort(doc * parts + part.astype(np.int64), kind="stable")
            cell = (doc * parts + part.astype(np.int64))[order]
            new = np.ones(len(cell), bool)
            new[1:] = cell[1:] != cell[:-1]
            start = np.flatnonzero(new)
            value = mix(token ^ U64(0xA0761D6478BD642F))[order]
            total, length = _sums(value, np.append(start, len(value))), np.diff(np.append(start, len(value)))
            of, where = cell[start] // parts, (cell[start] % parts).astype(np.uint64)
            name = mix(salt + where)
            two = where < U64(int(plan.double[b]))
            keys, ws = mix(total ^ name), 1 + (two & (length > 1)).astype(np.int64)
            full[mine, band[mine] - b] = np.bincount(of, minlength=len(mine))
            worth[mine, band[mine] - b] = np.bincount(of, ws, len(mine)).astype(np.int64)
            group = np.cumsum(new) - 1
            left = two[group] & (length[group] > 1)
            less = mix((total[group] - value)[left] ^ name[group][left])
            keys, of, ws = np.concatenate([keys, less]), np.concatenate([of, of[group][left]]), np.concatenate([ws, np.full(len(less), 2)])
        for x, y in zip(out, (keys, mine[of], band[mine[of]] == b, ws), strict=True):
            x.append(y)
    keys, of, own, ws = (np.concatenate(x) if x else np.empty(0, np.int64) for x in out)
    return keys.astype(np.uint64), of.astype(np.int64), own.astype(bool), ws.astype(np.int64), full, worth


_KEYS = "bucket int, code long, docs binary, keys binary"


def index_keys(docs: DataFrame, plan: Plan, width: int, buckets: int) -> DataFrame:
    """docs: id, text. A row for each block and bucket of keys, and rows of bucket -1 with the block's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, block = TaskContext.get().partitionId() << 36, 0
        hold: list[tuple] = []
        n = size = 0

        def out() -> pa.RecordBatch:
            ids, sizes, fulls, worths, keys, entries = [], [], [], [], [], []
            count = 0
            for part_ids, texts in hold:
                h, cuts = shingle_sets(texts, width)
                key, of, own, ws, full, worth = part_keys(h, cuts, plan)
                ids += part_ids
                sizes.append(np.diff(cuts))
                fulls.append(full)
                worths.append(worth)
                keys.append(key)
                entries.append(((of + count) << 2 | own.astype(np.int64) << 1 | (ws == 2)).astype(np.uint32))
                count += len(texts)
            key, entry = np.concatenate(keys), np.concatenate(entries)
            full, worth = np.concatenate(fulls), np.concatenate(worths)
            first = base | block << 16
            rows = [(-1, first, pack(np.array(ids, np.int64), np.concatenate(sizes), *full.T.copy(), *worth.T.copy()), None)]
            bucket = (key & U64(0xFFFFFFFF)) % U64(buckets)
            short = key >> U64(16)
            order = np.lexsort((short, bucket))
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            for b in np.flatnonzero(np.diff(cut)).tolist():
                at = order[cut[b] : cut[b + 1]]
                rows.append((b, first, None, pack(np.diff(short[at], prepend=U64(0)), entry[at])))
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["bucket", "code", "docs", "keys"])

        for batch in batches:
            all_ids = batch.column(0).to_pylist()
            for first, texts in chunks(batch.column(1)):
                for at in range(0, len(texts), BLOCK_DOCS):
                    some = texts[at : at + BLOCK_DOCS]
                    if n and (n + len(some) > BLOCK_DOCS or size >= BLOCK):
                        yield out()
                        hold, n, size, block = [], 0, 0, block + 1
                        release()
                    lo = first + at
                    hold.append((all_ids[lo : lo + len(some)], some))
                    n, size = n + len(some), size + sum(map(len, some))
        if hold:
            yield out()
        hold = []
        release()

    return docs.select("id", "text").mapInArrow(run, _KEYS)


def _entries(group: pa.Table, parts: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, entries and codes of a bucket, by key and code; a document has a key once."""
    key = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in parts])
    entry = np.concatenate([x[1] for x in parts]).astype(np.int64)
    code = np.repeat(np.array(group.column("code").to_pylist(), np.int64), [len(x[1]) for x in parts]) | entry >> 2
    order = np.lexsort((code, key))
    key, entry, code = key[order], entry[order], code[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (code[1:] != code[:-1])
    return key[new], entry[new], code[new]


def _distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    start = np.flatnonzero(new)
    return a[start], b[start], np.diff(np.append(start, len(a)))


_FOUND = "kind int, a long, b long, n long"


def match_keys(rows: DataFrame) -> DataFrame:
    """Documents that share keys. kind 0: a pair and how many keys it shares; 2 and 3: what a document's frequent keys are worth, of its own band and of those below."""

    def run(group: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in group.column("keys").to_pylist()]
        key, entry, code = _entries(group, parts)
        own, two = entry & 2 > 0, entry & 1
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(key)))
        group_of = np.cumsum(new) - 1
        found: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        if len(key):
            few = size[group_of] <= FEW
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for step in range(1, FEW):
                at = np.flatnonzero((group_of[step:] == group_of[:-step]) & few[:-step]) if len(key) > step else np.empty(0, np.int64)
                if not len(at):
                    break
                at = at[own[at] | own[at + step]]
                a.append(code[at])
                b.append(code[at + step])
            found.append((0, *_distinct_pairs(np.concatenate(a), np.concatenate(b))))
            at = np.flatnonzero(~few)
            if len(at):
                for kind, mine in ((2, at[own[at]]), (3, at[~own[at]])):
                    who, where = np.unique(code[mine], return_inverse=True)
                    found.append((kind, who, np.full(len(who), -1), np.bincount(where, 1 + two[mine], len(who)).astype(np.int64)))
        del parts, key, entry, code
        release()
        cols = [np.concatenate([np.full(len(x[1]), x[0], np.int32) for x in found]), *(np.concatenate([x[i] for x in found]) for i in (1, 2, 3))] if found else [np.empty(0, np.int64)] * 4
        return pa.table({"kind": pa.array(cols[0], pa.int32()), "a": pa.array(cols[1], pa.int64()), "b": pa.array(cols[2], pa.int64()), "n": pa.array(cols[3], pa.int64())})

    return rows.filter("bucket >= 0").select("bucket", "code", "keys").groupBy("bucket").applyInArrow(run, _FOUND)


def indexed_documents(rows: DataFrame) -> DataFrame:
    """code, id, n, band facts of every document that index_keys saw: full (non-empty parts) and worth, for the own band and two below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, size, *facts = unpack(x)
                code = first | np.arange(len(ids))
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(ids), pa.array(size), *map(pa.array, facts)], ["code", "id", "n", "f0", "f1", "f2", "w0", "w1", "w2"])

    return rows.filter("bucket < 0").select("code", "docs").mapInArrow(run, "code long, id long, n long, f0 long, f1 long, f2 long, w0 long, w1 long, w2 long")


def _some(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """docs (id, text) whose id is (or is not) among ids; ids are broadcast only if they are few."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "id", how)


def sets(docs: DataFrame, width: int) -> DataFrame:
    """id, members (the set as sorted 64-bit hashes, packed) of every row of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch.column(1)):
                h, cuts = shingle_sets(texts, width)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array([h[cuts[i] : cuts[i + 1]].tobytes() for i in range(len(texts))], pa.binary())], ["id", "members"])

    return docs.select("id", "text").mapInArrow(run, "id long, members binary")


def _beside(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (a, b; a stored table) with the sets x and y of either."""
    side = lambda i, x: members.select(F.col("id").alias(i), F.col("members").alias(x))
    return side("a", "x").join(small(pairs, pairs.count()), "a").join(side("b", "y"), "b")


def similar(members: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Of pairs (a, b) of ids, those whose sets have the similarity; members: id, members, one row an id."""
    both = _beside(members, pairs)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                same = len(x) + len(y) - len(np.union1d(x, y))
                good.append(den * same >= num * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))
        release()

    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def exact(docs: DataFrame, pairs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Of pairs (a, b) of ids, those whose sets have the similarity, as a stored table; docs: id, text, one row an id."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    members = stored(sets(_some(docs, ids, "left_semi"), width), "members")
    out = stored(similar(members, pairs, num, den), "linked")
    discard(members)
    return out


def _candidates(found: DataFrame, documents: DataFrame, plan: Plan) -> DataFrame:
    """Pairs of ids that share as many keys as two sets of their sizes must."""
    lows = F.array(*[F.lit(int(x)) for x in plan.low])
    d = documents.withColumn("band", F.size(F.filter(lows, lambda x: x <= F.col("n"))))
    shared = found.filter("kind = 0").groupBy("a", "b").agg(F.sum("n").alias("shared"))
    d = d.join(_frequent(found), "code", "left").fillna(0, ["lost", "lost_below"])
    side = lambda s: d.select(*[F.col(x).alias(s if x == "code" else f"{s}_{x}") for x in d.columns])
    x = shared.join(side("a"), "a").join(side("b"), "b")
    x = x.filter(plan.den * F.least("a_n", "b_n") >= plan.num * F.greatest("a_n", "b_n"))
    least = F.least("a_band", "b_band")
    differ = F.floor((plan.den - plan.num) * (F.col("a_n") + F.col("b_n")) / F.lit(plan.den + plan.num))
    full = lambda s: F.element_at(F.array(*[F.col(f"{s}_f{i}") for i in range(3)]), (F.col(f"{s}_band") - least + 1).cast("int"))
    lost = lambda s: F.when(F.col(f"{s}_band") == least, F.col(f"{s}_lost")).otherwise(F.col(f"{s}_lost_below"))
    need = lambda s: full(s) - differ - lost(s)
    enough = F.col("shared") >= F.greatest(need("a"), need("b"))
    return x.filter(enough).select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).filter("a <> b").distinct()


def _frequent(found: DataFrame) -> DataFrame:
    """code, lost, lost_below: what frequent keys are worth, of the own band and of those below."""
    part = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0))
    return found.filter("kind > 1").groupBy(F.col("a").alias("code")).agg(part(2).alias("lost"), part(3).alias("lost_below"))


def _differ(plan: Plan, below: int = 0):
    """Most differences between a set of n and any partner of its own band or above, or of the band so many below."""
    n = F.col("n")
    if below:
        highs = F.array(*[F.lit(int(x)) for x in plan.high])
        largest = F.least(n, F.element_at(highs, F.greatest(_bands(plan)[0] - below, F.lit(1)).cast("int")))
    else:
        largest = F.floor(n * plan.den / F.lit(plan.num))
    return F.floor((plan.den - plan.num) * (n + largest) / F.lit(plan.den + plan.num))


def _bands(plan: Plan):
    """(band of n from 1, lowest band of its partners)"""
    lows = F.array(*[F.lit(int(x)) for x in plan.low])
    return F.size(F.filter(lows, lambda x: x <= F.col("n"))), F.size(F.filter(lows, lambda x: x * plan.den <= F.col("n") * plan.num + plan.den - 1))


def _short(documents: DataFrame, found: DataFrame, plan: Plan) -> DataFrame:
    """Ids whose keys, without the frequent ones, are not worth more than the differences in one of their bands."""
    d = documents.join(_frequent(found), "code")
    band, lowest = _bands(plan)
    bad = F.lit(False)
    for i in range(3):
        bad = bad | ((band - i >= F.greatest(lowest, F.lit(1))) & (F.col(f"w{i}") - F.col("lost" if i == 0 else "lost_below") <= _differ(plan, i)))
    return d.filter(bad).select("id")


def tokens(members: DataFrame) -> DataFrame:
    """id, n, k (a shingle's hash), lead (one of the LEADING least) for every shingle of sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                h = np.frombuffer(x.as_buffer(), np.int64)
                size = len(h)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, i)), pa.array(np.full(size, size)), pa.array(h), pa.array(np.arange(size) < LEADING)], ["id", "n", "k", "lead"])

    return members.mapInArrow(run, "id long, n long, k long, lead boolean")


def _labelled(documents: DataFrame, rows: int, links: DataFrame) -> DataFrame:
    """documents with the component that the links give them, their own id if none."""
    found = components(links)
    parts = found.withColumnRenamed("node", "id").join(small(documents.select("id"), rows), "id", "left_semi")
    out = stored(documents.join(small(parts, rows), "id", "left").withColumn("component", F.coalesce("component", "id")), "lean-labelled")
    discard(found)
    return out


def _proposals(leading: DataFrame, documents: DataFrame, rows: int) -> DataFrame:
    """Pairs (a, b): each document and the leader of another component that most of its keys name.

    The leader of a key is its document with the most frequent shingles: of near copies, the one nearest to all.
    """
    t = leading.join(small(documents.select("id", (F.col("heat") / F.col("n")).alias("rank"), "component"), rows), "id")
    # Of each component of a key the best one, then the best two of these.
    best = t.groupBy("k", "component").agg(F.max(F.struct("rank", "id")).alias("x")).select("k", F.struct("x.rank", "x.id", "component").alias("x"))
    best = few(best, LEADING * rows)
    first = few(best.groupBy("k").agg(F.max("x").alias("first"), F.count("*").alias("several")).filter("several > 1"), LEADING * rows)
    second = best.join(small(first, LEADING * rows), "k").filter("x.component <> first.component").groupBy("k").agg(F.first("first").alias("first"), F.max("x").alias("second"))
    second = few(second, LEADING * rows)
    t = t.join(small(second, LEADING * rows), "k")
    aim = F.when(F.col("component") != F.col("first.component"), F.col("first")).otherwise(F.col("second"))
    votes = t.select("id", aim.alias("aim")).groupBy("id", F.col("aim.id").alias("b")).agg(F.count("*").alias("votes"), F.max("aim.rank").alias("rank"))
    best = few(few(votes, LEADING * rows).groupBy("id").agg(F.max(F.struct("votes", "rank", "b")).alias("best")), rows)
    return few(best.select(F.least("id", "best.b").alias("a"), F.greatest("id", "best.b").alias("b")).distinct(), rows)


def _common(n, m, num: int, den: int):
    """How many shingles two linked sets of n and m have in common at least."""
    return F.ceil((n + m) * num / F.lit(num + den))


def _reachable(shared: DataFrame, documents: DataFrame, rows: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(documents, shared) without what can't be in a link between two components.

    documents: id, n, high, h, component. What a row stands for (itself, or all documents of a component) has n to `high`
    shingles; h at most are shared with any partner in another component, so a partner's size is at most `reach`.
    A key counts for a document if it lies in several components and its smallest document is within reach; what doesn't
    count lowers h, and the smallest documents of what counts give `least`, the size that a partner has at least: num / den
    of n to begin with. Steps repeat while that pays; whatever is left is right to keep.
    """
    before, keys_before = rows, shared.count()
    documents = documents.withColumn("least", F.ceil(F.col("n") * num / F.lit(den)))
    for _ in range(STEPS):
        reach = F.floor(F.col("h") * (num + den) / F.lit(num)) - F.col("n")
        documents = documents.withColumn("reach", reach).filter((F.col("h") >= _common(F.col("n"), F.col("least"), num, den)) & (F.col("reach") >= F.col("least")))
        shared = shared.select("id", "k").join(small(documents.select("id", "n", "component", "reach"), before), "id")
        keys = shared.groupBy("k").agg(F.min("component").alias("p"), F.max("component").alias("q"), F.min("n").alias("m"), F.count("*").alias("df")).filter("p < q")
        keys = small(few(keys, keys_before), keys_before)
        shared = stored(shared.join(keys, "k").filter("m <= reach").select("id", "k", "df", "m"), "lean-counting")
        keys_before = shared.count()
        held = few(shared.groupBy("id").agg(F.count("*").alias("h"), F.min("m").alias("m")), keys_before)
        documents = held.join(small(documents.select("id", "n", "high", "component", "least"), before), "id")
        documents = stored(documents.select("id", "n", "high", "component", "h", F.greatest("least", "m").alias("least")), "lean-documents")
        after = documents.count()
        if before - after <= WORTH * before:
            break
        before = after
    return documents, shared


def _rarest(documents: DataFrame, shared: DataFrame, rows: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of different components that have one of either's rarest keys in common.

    Of a document's h keys a linked one has _common() in common. So one of the first h - _common() + 1 is shared, in
    any order that is the same for all. The first key that two documents share has all others after it, so what either
    has from there on must suffice.
    """
    mine = Window.partitionBy("id").orderBy("df", "k")
    t = shared.select("id", "k", "df").withColumn("before", F.row_number().over(mine) - 1)
    t = few(t, shared.count()).join(small(documents, rows), "id").filter(F.col("before") <= F.col("h") - _common(F.col("n"), F.col("least"), num, den))
    t = t.withColumn("h", F.col("h") - F.col("before"))
    side = lambda s: t.select("k", *[F.col(c).alias(f"{s}_{c}") for c in ("id", *_SIDE)])
    return side("a").join(side("b"), "k").filter((F.col("a_id") < F.col("b_id")) & _may_link(num, den)).select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()


_SIDE = ["n", "high", "h", "component"]


def _may_link(num: int, den: int):
    """By component, least and largest size (n, high) and at most h common shingles of two sides."""
    sizes = (F.col("a_n") + F.col("b_n")) * num <= F.least("a_h", "b_h") * (num + den)
    alike = (F.col("a_high") * den >= F.col("b_n") * num) & (F.col("b_high") * den >= F.col("a_n") * num)
    return (F.col("a_component") != F.col("b_component")) & sizes & alike


def common(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (a, b) with the number of shingles that both have; members: id, members."""
    both = _beside(members, pairs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), assume_unique=True)) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["a", "b", "common"])

    return both.select("a", "b", "x", "y").mapInArrow(count, "a long, b long, common long")


def _across(members: DataFrame, shared: DataFrame, labelled: DataFrame, rows: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of documents in different components that may link.

    A component is seen through its leader, the document nearest to all others. What two linked documents have in
    common either holds a shingle that one of the leaders lacks, and such shingles are rare in a component; or both
    leaders have all of it, so they have as many in common as two documents of these sizes need. The first are joined by
    such shingles, the second by pairs of leaders, with the components' smallest sizes for theirs.
    """
    left, counting = _reachable(shared, labelled.select("id", "n", F.col("n").alias("high"), "h", "component"), rows, num, den)
    first = labelled.groupBy("component").agg(F.max(F.struct((F.col("heat") / F.col("n")).alias("rank"), "id")).alias("x")).select("component", F.col("x.id").alias("leader"))
    leaders = stored(few(first, rows).join(small(few(left.groupBy("component").agg(F.min("n").alias("n"), F.max("n").alias("high")), rows), rows), "component").select(F.col("leader").alias("id"), "n", "high", "component"), "lean-leaders")
    frame = stored(shared.select("id", "k").join(small(leaders.select("id", "component"), rows), "id"), "lean-frames")

    t = counting.select("id", "k").join(small(left.select("id", *_SIDE), rows), "id").join(frame.select("component", "k", F.lit(True).alias("framed")), ["component", "k"], "left")
    t = stored(t, "lean-framed")
    side = lambda t, s: t.select("k", *[F.col(c).alias(f"{s}_{c}") for c in ("id", *_SIDE)])
    beyond = side(t.filter("framed is null"), "a").join(side(t, "b"), "k").filter(_may_link(num, den)).select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).distinct()

    held = few(frame.groupBy("id").agg(F.count("*").alias("h")), rows)
    some, keys = _reachable(frame.select("id", "k"), held.join(small(leaders, rows), "id"), rows, num, den)
    meet = stored(_rarest(some, keys, rows, num, den), "lean-meet")
    meet = stored(common(members, meet), "lean-common")
    of = lambda s: small(leaders.select(F.col("id").alias(s), F.col("component").alias(f"{s}_component")), rows)
    mine = lambda s: left.select(F.col("component").alias(f"{s}_component"), F.col("n").alias(f"{s}_n"), F.col("id").alias(f"{s}_id"))
    room = F.col("common") * (num + den)
    sizes = (F.col("a_n") + F.col("b_n")) * num <= room
    alike = F.least("a_n", "b_n") * den >= F.greatest("a_n", "b_n") * num
    meet = meet.join(of("a"), "a").join(of("b"), "b").select("common", "a_component", "b_component").join(mine("a"), "a_component").filter(F.col("a_n") * num < room).join(mine("b"), "b_component").filter(sizes & alike)
    within = meet.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"))
    return stored(beyond.unionByName(within).distinct(), "lean-pairs")


def lean_links(docs: DataFrame, links: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Links (a, b) among docs (id, text; those that lean on frequent keys), enough to connect with `links` what is linked."""
    members = stored(sets(docs, width), "lean-sets")
    every = stored(tokens(members), "lean-tokens")
    held = every.count()
    often = stored(few(every.groupBy("k").agg(F.count("*").alias("df")).filter("df > 1"), held), "lean-often")
    shared = stored(every.join(small(often, often.count()), "k"), "lean-shared")
    discard(every)
    discard(often)
    documents = few(shared.groupBy("id", "n").agg(F.count("*").alias("h"), F.sum("df").alias("heat")), shared.count())
    documents = stored(documents.filter(F.col("h") * den >= F.col("n") * num), "lean-heat")
    rows = documents.count()
    leading = shared.filter("lead").select("id", "k")
    found, tried = links, None
    labelled = _labelled(documents, rows, found)
    for _ in range(ROUNDS):
        pairs = _proposals(leading, labelled, rows)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "lean-proposed")
        good = stored(similar(members, pairs, num, den), "lean-linked")
        tried = pairs if tried is None else tried.unionByName(pairs)
        some, of = good.count(), pairs.count()
        found = found.unionByName(good) if some else found
        if some <= PAYS * of:
            break  # labels that lack the last few links are right too: they leave more to compare
        discard(labelled)
        labelled = _labelled(documents, rows, found)
    pairs = _across(members, shared, labelled, rows, num, den)
    found = stored(found.unionByName(similar(members, pairs, num, den)), "linked")
    for x in (members, shared, documents, labelled, pairs):
        discard(x)
    return found


def link_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """id, n_shingles, component_id, set_id (smallest id with an equal set) of every row; linked: Jaccard similarity num/den or more."""
    with arrow_batches(docs.sparkSession, BATCH):
        return _link_documents(docs, id, text, width, num, den)


def _link_documents(docs: DataFrame, id: str, text: str, width: int, num: int, den: int) -> DataFrame:
    docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    signed = stored(signatures(docs, width), "signatures")
    real = signed.filter("n_shingles > 0 and id is not null")
    every = signed.count()
    classes = stored(few(real.groupBy("n_shingles", "d1", "d2").agg(F.min("id").alias("set_id"), F.count("*").alias("rows")), every), "sets")
    largest, repeated, shingles = classes.agg(F.max("n_shingles"), F.count_if(F.col("rows") > 1), F.sum("n_shingles")).first()
    largest = largest or 0
    buckets = max(n_buckets(docs.sparkSession), -(-(shingles or 0) // BUCKET_SHINGLES))
    several = small(classes.filter("rows > 1"), repeated)
    copies = stored(real.join(several, ["n_shingles", "d1", "d2"]).filter("id <> set_id").select("id"), "copies")
    distinct = _some(docs.filter("id is not null"), copies, "left_anti")

    plan = Plan.of(num, den, largest)
    rows = stored(index_keys(distinct, plan, width, buckets), "keys")
    seen = stored(indexed_documents(rows), "indexed")
    if not seen.filter(_too_weak(plan)).isEmpty():  # no margin suffices for all sets at hand
        plan = Plan.of(num, den, largest, single=True)
        discard(rows)
        rows = stored(index_keys(distinct, plan, width, buckets), "keys")
        seen = stored(indexed_documents(rows), "indexed")
    found = stored(match_keys(rows), "found")
    discard(rows)
    matched = found.count()
    pairs = stored(few(_candidates(found, seen, plan), matched), "pairs")
    links = exact(distinct, pairs, width, num, den)
    discard(pairs)
    short = stored(few(_short(seen, found, plan).distinct(), every), "short")
    discard(found)
    discard(seen)
    if not short.isEmpty():
        links = lean_links(_some(distinct, short, "left_semi"), links, width, num, den)
    discard(short)

    same = real.join(several, ["n_shingles", "d1", "d2"]).select(F.col("id").alias("a"), F.col("set_id").alias("b"))
    parts = components(links.unionByName(same.filter("a <> b")))
    out = signed.join(classes.select("n_shingles", "d1", "d2", "set_id"), ["n_shingles", "d1", "d2"], "left")
    out = out.join(parts.withColumnRenamed("node", "id"), "id", "left")
    own = F.when(F.col("id").isNotNull(), F.col("id"))
    return out.select(F.col("id").alias(id), "n_shingles", F.coalesce("component", own).alias("component_id"), F.when(F.col("id").isNotNull(), F.coalesce("set_id", own)).alias("set_id"))


def _too_weak(plan: Plan):
    """True for a set whose parts can't outweigh the differences in one of its bands."""
    band, lowest = _bands(plan)
    bad = F.lit(False)
    for i in range(3):
        bad = bad | ((F.col("n") > 0) & (band - i >= F.greatest(lowest, F.lit(1))) & (F.col(f"w{i}") <= _differ(plan, i)))
    return bad


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that have the smallest id of their component; rows with a null id stay."""
    parts = link_documents(docs, id, text).filter(F.col("component_id") < F.col(id)).select(id).distinct()
    return docs.join(stored(parts, "dropped"), id, "left_anti").select(*docs.columns)
