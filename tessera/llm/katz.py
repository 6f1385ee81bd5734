"""Scoring texts by a Katz backoff model of word n-grams.

Counts are Good-Turing discounted for up to K occurrences, for each order by itself. What
the discounts free for a history goes to the words never seen after it, in proportion to
their probability after the history without its first word, by a backoff weight that
makes the sum exactly one; unseen words share one class that holds what the discounts free
among single words. A token is scored recursively: its longest n-gram if seen, else the
history's weight times the n-gram without its first word, down to the class of unseen words.

fit() makes a Model. It holds a table for each order, partitioned by the hash of the
history (a word's own hash for single words), of each n-gram seen in training texts with
its count and of what the weights are made of: the count of the n-gram without its first
word, and that history's total. Model.score() scores any texts by these tables, fit_score()
fits and scores in one go. Blocks of documents ask the tables' buckets for their own
distinct words and n-grams (see _blocks), order after order. Frequent histories are spread
over more buckets, in proportion to their count; parts of a history are added up by who asks.

A text is its words and one end; ends stand before the first word. Null text counts as
empty: one token. A null id counts as a training text. With no training texts every token
has the probability of the unseen class, one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._blocks import gather, n_buckets, pack, pack_words, stored_blocks, to_blocks, unpack, unpack_words, with_answers, word_requests
from ._shared import stored
from ._words import by_number, distinct, mix, release

#: Counts above this are not discounted.
K = 5


def held_out(id: str, modulus: int = 5, rest: int = 1) -> Column:
    """True where crc32 of the id as text leaves the remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % modulus == rest, F.lit(False))


def discounts(n: list[int] | np.ndarray) -> np.ndarray:
    """Factor for counts 0 to K from n[r], the number of types seen r times (r up to K + 1), each over 0 and below 1.

    Katz's form of Good-Turing; where it leaves that range, an absolute discount instead.
    """
    n = np.asarray(n, float)
    d = np.ones(K + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.arange(1, K + 1)
        cut = (K + 1) * n[K + 1] / n[1]
        good = ((r + 1) * n[2 : K + 2] / n[1 : K + 1] / r - cut) / (1 - cut)
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    for i, x in zip(r, good, strict=True):
        d[i] = x if np.isfinite(x) and 0 < x < 1 else 1 - absolute / i
    return d


@dataclass(frozen=True)
class Unigrams:
    """tokens and types of the training texts, discounts, and the probability of the unseen class."""

    tokens: int
    types: int
    discount: tuple[float, ...]
    unseen: float

    @staticmethod
    def of(tokens: int, types: int, n: list[int]) -> Unigrams:
        if not tokens:
            return Unigrams(0, 0, tuple(np.ones(K + 1)), 1.0)
        d = discounts(n)
        freed = sum((1 - d[r]) * r * n[r] for r in range(1, K + 1)) / tokens
        if freed <= 0:  # no count is small: a half count is set aside, all others shrink
            freed = 0.5 / (tokens + 0.5)
            return Unigrams(tokens, types, tuple(np.ones(K + 1)), freed)
        return Unigrams(tokens, types, tuple(d), float(freed))

    def probability(self, count: np.ndarray) -> np.ndarray:
        count = count.astype(np.int64)
        d = np.asarray(self.discount)[np.where(count <= K, count, 0)]
        d = np.where(count <= K, d, 1.0)
        seen = d * count / max(self.tokens, 1)
        if all(x == 1.0 for x in self.discount):
            seen = seen * (1 - self.unseen)
        return np.where(count > 0, seen, self.unseen)


@dataclass(frozen=True)
class Level:
    """What a block knows about its distinct n-grams of one order; histories are n-grams of the order below, the last one being ends alone.

    words: columns of each n-gram's words. where: each token's n-gram. history, suffix: of
    each n-gram, without its last and first word. count: in training texts. For each
    history: total, and its weight where an n-gram of the block may need it, else NaN.
    """

    words: np.ndarray | None
    where: np.ndarray | None
    history: np.ndarray
    suffix: np.ndarray
    count: np.ndarray
    total: np.ndarray
    weight: np.ndarray


class Grams:
    """A block's n-grams, order after order, and where each is counted."""

    def __init__(self, row: pa.Table, found: pa.Table, model: Model):
        self.id, self.known, self.held, self.n_words, tokens, bucket = unpack(row.column("tokens")[0].as_py())
        self.tokens, self.model = tokens, model
        self.ends = np.cumsum(self.n_words.astype(np.int64))
        self.firsts = self.ends - self.n_words
        self.end = int(self.tokens[-1])
        self.answers: dict[int, dict[int, bytes]] = {}
        for b, order, x in zip(*(found.column(c).to_pylist() for c in ("bucket", "kind", "answer")), strict=True):
            self.answers.setdefault(order, {})[b] = x
        words = {b: unpack(x) for b, x in self.answers.pop(1).items()}
        self.counts = gather(bucket, {b: x[0] for b, x in words.items()}, np.int64)
        self.gid = gather(bucket, {b: x[1] for b, x in words.items()}, np.uint64)
        n = len(self.counts)
        none = np.empty(0)
        self.levels = [Level(np.arange(n, dtype=np.int32)[:, None], self.tokens, none, none, self.counts, none, none)]
        for order in range(2, len(model.discounts) + 2):
            self._learn(order, model.discounts[order - 2])

    def lay(self, order: int) -> None:
        """The distinct n-grams of an order, and the buckets of those that may have been seen."""
        low, n = self.levels[-1], len(self.counts)
        history = np.empty(len(self.tokens), np.int32)
        history[1:] = low.where[:-1]
        history[self.firsts] = len(low.words)  # ends alone
        self.where, first = distinct(history, self.tokens)
        self.h, self.w = history[first], self.tokens[first]
        self.suffix = np.empty(len(first), np.int32)
        self.suffix[self.where] = low.where
        self.h_words = np.vstack([low.words, np.full((1, order - 1), self.end, np.int32)])
        self.h_count = np.append(low.count, self.counts[self.end])
        if order == 2:
            self.h_low = np.zeros(n + 1, np.int32)
        else:
            self.h_low = np.append(low.suffix, np.int32(len(self.levels[-2].count)))
        gid, model = self.gid, self.model
        self.trained = np.bincount(self.where[np.repeat(self.held == 0, self.n_words)], minlength=len(first))
        self.open = np.zeros(len(self.h_words), bool)
        self.open[self.h[self.trained == 0]] = True  # all others' n-grams were seen, so no weight is used
        hashed = np.zeros(len(self.h_words), np.uint64)
        for column in self.h_words.T:
            hashed = mix(hashed * np.uint64(0x9E3779B97F4A7C15) + gid[column])
        spread = np.minimum(1 + self.h_count * model.buckets // max(model.unigrams.tokens, 1), model.buckets)
        self.asked = np.flatnonzero((self.h_count[self.h] > 0) & (low.count[self.suffix] > 0))
        h, w = self.h[self.asked], self.w[self.asked]
        self.to = (hashed[h] + mix(gid[w]) % spread[h].astype(np.uint64)) % np.uint64(model.buckets)
        used = np.zeros(len(self.h_words), bool)
        used[self.h] = True
        histories = np.flatnonzero(used & (self.h_count > 0))  # those before unknown words too
        s = spread[histories]
        self.h_all = np.repeat(histories, s)
        step = np.arange(len(self.h_all)) - np.repeat(np.cumsum(s) - s, s)
        self.h_to = (hashed[self.h_all] + step.astype(np.uint64)) % np.uint64(model.buckets)

    def requests(self, order: int, part: int, parts: int) -> Iterator[tuple[int, bytes]]:
        """(bucket, request) for the buckets of one of the parts: the history's words, how many n-grams are asked for, the total of the history below, whether its weight may be used; of each n-gram its word, the count of its suffix, its count here."""
        self.lay(order)
        low = self.levels[-1]
        trained = self.trained[self.asked]
        h, w, suffix = self.h[self.asked], self.w[self.asked], self.suffix[self.asked]
        for b, at, h_at in _by_bucket(self.to, self.h_to, self.model.buckets):
            if b % parts != part:
                continue
            mine = self.h_all[h_at]
            n = np.bincount(np.searchsorted(mine, h[at]), minlength=len(mine))
            total = low.total[self.h_low[mine]] if order > 2 else np.zeros(len(mine), np.int64)
            yield b, pack(*self.gid[self.h_words[mine]].T, n.astype(np.uint32), total, self.open[mine].astype(np.uint8), self.gid[w[at]], low.count[suffix[at]], trained[at].astype(np.uint32))

    def _learn(self, order: int, d: np.ndarray) -> None:
        """The next level, from the answers of its buckets."""
        self.lay(order)
        low, answers = self.levels[-1], self.answers.pop(order, {})
        count = np.zeros(len(self.h), np.int64)
        m = len(self.h_words)
        mass, used, seen, rare = np.zeros(m), np.zeros(m), np.zeros(m, np.int64), np.zeros(m, bool)
        for b, at, h_at in _by_bucket(self.to, self.h_to, self.model.buckets):
            c, n, few, part, *many = unpack(answers.pop(b))
            count[self.asked[at]] = c
            mine = self.h_all[h_at]  # each once in a bucket
            seen[mine] += n.astype(np.int64)
            rare[mine] |= few.astype(bool)
            mine = mine[self.open[mine]]
            mass[mine] += part
            used[mine] += sum(d[r] * r * many[r - 1].astype(float) for r in range(1, K + 1)) + many[K].astype(float)
        total = seen + ~rare  # where words are all frequent and free nothing, one count is set aside
        weight = np.where(seen > 0, (1 - used / total.clip(1)) / np.maximum(1 - mass, TINY), 1.0)
        weight[~self.open] = np.nan
        words = np.column_stack([self.h_words[self.h], self.w])
        self.levels[-1] = replace(low, words=None, where=None)  # only the highest level's are read again
        self.levels.append(Level(words, self.where, self.h, self.suffix, count, total, weight))

    def log_p(self) -> np.ndarray:
        """log10 probability of each token, by recursion from single words up."""
        p = self.model.unigrams.probability(self.counts)
        for level, d in zip(self.levels[1:], self.model.discounts, strict=True):
            p = np.where(level.count > 0, _direct(level.count, level.total[level.history], d), level.weight[level.history] * p[level.suffix])
        return np.log10(p)[self.levels[-1].where]


def _direct(count: np.ndarray, total: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(count <= K, d[np.minimum(count, K)], 1.0) * count / np.maximum(total, 1)


def _table(columns: dict[str, list], schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.table({k: pa.array(columns[k], t) for k, t in schema})


#: Answers to blocks; those to block MODEL are a model's table. kind: the order.
ANSWERS = "block long, bucket int, kind int, answer binary, sums array<long>"
_ANSWER_TYPES = [("block", pa.int64()), ("bucket", pa.int32()), ("kind", pa.int32()), ("answer", pa.binary()), ("sums", pa.list_(pa.int64()))]
_REQUEST_TYPES = [("bucket", pa.int32()), ("block", pa.int64()), ("grams", pa.binary())]
_SCORE_TYPES = [("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
MODEL = -1
#: Rounding of a mass near one must not make the rest zero.
TINY = 1e-12
#: The longest n-grams of the production query.
ORDER = 3
#: Passes over the buckets for n-grams of more than two words, so that not all requests for these are on disk at once.
PARTS = 2


def _answers(requests: pa.Table, order: int, blocks: list[int], answers: list[bytes], table: bytes, sums: list[int], fitted: bool) -> pa.Table:
    """Rows for all blocks that asked, and while fitting one for the model: its sums, and its table if that is kept."""
    b = requests.column("bucket")[0].as_py()
    rows = [(x, b, order, a, None) for x, a in zip(blocks, answers, strict=True)] + ([] if fitted else [(MODEL, b, order, table, sums)])
    return _table(dict(zip((k for k, _ in _ANSWER_TYPES), zip(*rows, strict=True) if rows else [[]] * 5, strict=True)), _ANSWER_TYPES)


def _narrow(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint32) if a.max(initial=0) < 1 << 32 else a


def _tally(count: np.ndarray) -> list[int]:
    """How many types were seen 1 to K + 1 times."""
    return np.bincount(np.minimum(count, K + 2), minlength=K + 3)[1 : K + 2].tolist()


def _parts(requests: pa.Table, column: str) -> list[tuple[int, dict]]:
    """(block, request) by block: the model's table, if any, comes first."""
    return sorted(zip(requests.column("block").to_pylist(), requests.select([column] if column == "grams" else ["words", "tokens"]).to_pylist(), strict=True), key=lambda x: x[0])


def count_words(requests: pa.Table, buckets: int, fitted: bool, keep: bool = True) -> pa.Table:
    """Counts and global numbers of the words of a bucket. Where a model is given, only its table is counted."""
    number: dict[bytes, int] = {}
    asked, parts = [], _parts(requests, "words")
    for _, x in parts:
        words = unpack_words(x["words"])
        for w in words:
            number.setdefault(w, len(number))
        asked.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    counts = np.zeros(len(number), np.int64)
    for at, (block, x) in zip(asked, parts, strict=True):
        if not fitted or block == MODEL:
            all_of, held_of = unpack(x["tokens"])
            np.add.at(counts, at, all_of.astype(np.int64) - held_of)
    order = np.lexsort((np.arange(len(counts)), -counts))
    place = np.empty(len(order), np.uint64)
    place[order] = np.arange(len(order), dtype=np.uint64)
    gid = place * np.uint64(buckets) + np.uint64(requests.column("bucket")[0].as_py())
    every, seen = list(number), order[counts[order] > 0]
    table = pack(np.frombuffer(pack_words([every[i] for i in seen.tolist()]), np.uint8), counts[seen]) if keep else b""
    mine = [(block, pack(counts[at], gid[at])) for at, (block, _) in zip(asked, parts, strict=True) if block != MODEL]
    return _answers(requests, 1, [b for b, _ in mine], [a for _, a in mine], table, [int(counts.sum()), int((counts > 0).sum()), *_tally(counts)], fitted)


def count_grams(requests: pa.Table, order: int, lower: Callable[[np.ndarray, np.ndarray], np.ndarray], fitted: bool, keep: bool = True) -> pa.Table:
    """Counts of the n-grams of a bucket; of each history its total and whether a word was seen up to K times after it; where its weight may be used, the mass of what was seen by the order below, how many words were seen 1 to K times, and how often the others.

    lower: probabilities by the order below, of counts and totals. Where a model is given, only its table is counted.
    """
    parts = [(block, unpack(x["grams"])) for block, x in _parts(requests, "grams")]
    k = order - 1
    column = lambda i: np.concatenate([x[i] for _, x in parts])
    words = [column(i) for i in range(k)]
    history, first = distinct(*words)
    m = len(first)
    below = column(k + 1)[first]
    h, w = np.repeat(history, column(k)), column(k + 3)
    type_of, a_type = distinct(h, w)
    counted = np.concatenate([x[k + 5].astype(np.int64) * (not fitted or block == MODEL) for block, x in parts])
    count = np.zeros(len(a_type), np.int64)
    np.add.at(count, type_of, counted)
    th, tw, suffix = h[a_type], w[a_type], column(k + 4)[a_type]
    seen = count > 0
    mass = np.bincount(th[seen], lower(suffix[seen], below[th[seen]]), m)
    many = [np.bincount(th[count == r], minlength=m) for r in range(1, K + 1)] + [np.bincount(th[count > K], count[count > K], m).astype(np.int64)]
    total, rare = np.bincount(th, count, m).astype(np.int64), np.any([a > 0 for a in many[:K]], axis=0)
    blocks, answers, at, h_at = [], [], 0, 0
    for block, x in parts:
        n, h_n = len(x[k + 3]), len(x[0])
        if block != MODEL:
            own = history[h_at : h_at + h_n]
            blocks.append(block)
            some = own[x[k + 2] == 1]
            answers.append(pack(_narrow(count[type_of[at : at + n]]), _narrow(total[own]), rare[own].astype(np.uint8), mass[some], *[_narrow(a[some]) for a in many]))
        at, h_at = at + n, h_at + h_n
    n_kept = np.bincount(th[seen], minlength=m)
    kept = np.flatnonzero(n_kept)
    n_kept = n_kept[kept]
    table = b"" if fitted or not keep else pack(*[w[first][kept] for w in words], n_kept.astype(np.uint32), below[kept], np.zeros(len(kept), np.uint8), tw[seen], suffix[seen], count[seen])
    return _answers(requests, order, blocks, answers, table, _tally(count), fitted)


@dataclass(frozen=True)
class Model:
    """Discounts from order 2 on, and a stored table for each order; buckets: of all tables."""

    buckets: int
    unigrams: Unigrams
    discounts: tuple[np.ndarray, ...] = ()
    tables: tuple[DataFrame, ...] = ()

    def bare(self) -> Model:
        """Without its tables, to be sent to tasks: a few numbers."""
        return replace(self, tables=())

    def lower(self) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """Probabilities of seen n-grams of the highest order so far."""
        if not self.discounts:
            return lambda count, total: self.unigrams.probability(count)
        return lambda count, total: _direct(count, total, self.discounts[-1])

    def score(self, docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
        """As fit_score(), for any texts, by the tables of this model; held_out is true."""
        blocks = stored(to_blocks(docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.lit(True).alias("flag")), self.buckets, True, True), "katz-blocks")
        found, _ = _rounds(blocks, self, len(self.tables))
        return _rated(blocks, found, self).withColumnRenamed("id", id)


def _asking(order: int, so_far: Model, part: int, parts: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What makes a block's requests for n-grams to the buckets of a part, from its answers for shorter ones."""

    def ask(row: pa.Table, found: pa.Table) -> pa.Table:
        rows = [(b, row.column("block")[0].as_py(), x) for b, x in Grams(row, found, so_far).requests(order, part, parts)] if row.num_rows else []
        return _table(dict(zip((k for k, _ in _REQUEST_TYPES), zip(*rows, strict=True) if rows else [[]] * 3, strict=True)), _REQUEST_TYPES)

    return ask


def _counting(order: int, so_far: Model, fitted: bool, keep: bool) -> Callable[[pa.Table], pa.Table]:
    def count(requests: pa.Table) -> pa.Table:
        out = count_grams(requests, order, so_far.lower(), fitted, keep)
        release()
        return out

    return count


def _rounds(blocks: DataFrame, model: Model, order: int, keep: bool = True) -> tuple[DataFrame, Model]:
    """Answers for all blocks, order after order, and the model: the given one if it has tables, else one fitted on the way; its tables are for other texts, and only written if `keep` is true."""
    fitted, buckets = bool(model.tables), model.buckets
    asked = word_requests(blocks)
    if fitted:
        asked = asked.unionByName(model.tables[0].select("block", "bucket", F.lit(0).cast("long").alias("stamp"), "words", "tokens"))
    at = stored(asked.groupBy("bucket").applyInArrow(lambda x: count_words(x, buckets, fitted, keep), ANSWERS), "katz-1")
    tables = [at.filter(F.col("block") == MODEL)]
    if not fitted:
        total = _sums(tables[0], K + 3)
        model = replace(model, unigrams=Unigrams.of(total[0], total[1], [0, *total[2:]]))
    found = at.filter(F.col("block") != MODEL)
    so_far = replace(model.bare(), discounts=())
    for n in range(2, order + 1):
        parts, at = 1 if n == 2 else PARTS, None
        for part in range(parts):
            asked = with_answers(blocks, found, _asking(n, so_far, part, parts), "bucket int, block long, grams binary")
            if fitted:
                asked = asked.unionByName(model.tables[n - 1].filter(F.col("bucket") % parts == part).select("bucket", "block", F.col("answer").alias("grams")))
            mine = stored(asked.groupBy("bucket").applyInArrow(_counting(n, so_far, fitted, keep), ANSWERS), f"katz-{n}")
            at = mine if at is None else at.unionByName(mine)
        tables.append(at.filter(F.col("block") == MODEL))
        found = found.unionByName(at.filter(F.col("block") != MODEL))
        d = model.discounts[n - 2] if fitted else discounts([0, *_sums(tables[-1], K + 1)])
        so_far = replace(so_far, discounts=(*so_far.discounts, d))
    return found, model if fitted else replace(so_far, tables=tuple(tables) if keep else ())


def _rated(blocks: DataFrame, found: DataFrame, model: Model) -> DataFrame:
    bare = model.bare()

    def rate(row: pa.Table, found: pa.Table) -> pa.Table:
        if not row.num_rows:
            return _table({k: [] for k, _ in _SCORE_TYPES}, _SCORE_TYPES)
        g = Grams(row, found, bare)
        u = bare.unigrams
        base = np.log10((g.counts + 0.5) / (u.tokens + 0.5 * (u.types + 1)))
        add = lambda x: np.add.reduceat(x, g.firsts)  # noqa: E731  every document has a token
        out = (pa.array(g.id, mask=g.known == 0), g.held == 1, g.n_words.astype(np.int64), add((g.counts[g.tokens] > 0).astype(np.int64)), np.full(len(g.id), u.tokens, np.int64), add(base[g.tokens]), add(g.log_p()))
        return _table(dict(zip((k for k, _ in _SCORE_TYPES), out, strict=True)), _SCORE_TYPES)

    return with_answers(blocks, found, rate, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _fit(docs: DataFrame, held: Column | None, id: str, text: str, order: int, keep: bool) -> tuple[DataFrame, DataFrame, Model]:
    held = held_out(id) if held is None else held
    blocks = stored_blocks(docs.select(F.col(id).alias("id"), F.col(text).alias("text"), held.alias("flag")), "katz-blocks", fold=True, end=True)
    found, model = _rounds(blocks, Model(n_buckets(docs.sparkSession), Unigrams.of(0, 0, [])), order, keep)
    return blocks, found, model


def fit(docs: DataFrame, held: Column | None = None, id: str = "doc_id", text: str = "text", order: int = ORDER) -> Model:
    """A model of n-grams up to `order` from the texts for which `held` is false; its tables are in the shared folder."""
    blocks, found, model = _fit(docs, held, id, text, order, keep=True)
    first = model.tables[0]
    split = F.udf(_word_table, "struct<words: binary, tokens: binary>", useArrow=False)
    words = stored(first.select("block", "bucket", split("answer").alias("x")).select("block", "bucket", "x.*"), "katz-words")
    return replace(model, tables=(words, *model.tables[1:]))


def _word_table(packed: bytes) -> tuple[bytes, bytes]:
    """A bucket's words as a request for them: words, counts, none held out."""
    words, counts = unpack(packed)
    return words.tobytes(), pack(counts, np.zeros(len(counts), np.uint32))


def fit_score(docs: DataFrame, held: Column | None = None, id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document; `held` is true where a text is not learned from."""
    return _rated(*_fit(docs, held, id, text, order, keep=False)).withColumnRenamed("id", id)


def _by_bucket(to: np.ndarray, h_to: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(bucket, places of its pairs, places of its histories) for buckets that get any; pairs stay in their order, by history."""
    edges = np.arange(buckets + 1, dtype=np.uint64)
    by, h_by = by_number(to, buckets), by_number(h_to, buckets)
    cut, h_cut = np.searchsorted(to[by], edges), np.searchsorted(h_to[h_by], edges)
    for b in range(buckets):
        if cut[b + 1] > cut[b] or h_cut[b + 1] > h_cut[b]:
            yield b, by[cut[b] : cut[b + 1]], h_by[h_cut[b] : h_cut[b + 1]]


def _sums(answers: DataFrame, n: int) -> list[int]:
    """Totals over buckets: a handful of numbers."""
    row = answers.filter("sums is not null").agg(*[F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)).alias(f"s{i}") for i in range(n)]).first()
    return [int(x) for x in row]
