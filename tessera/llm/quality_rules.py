"""Quality rules: a learned decision list over statistics of whole texts.

Sequential covering: a rule is grown, one threshold at a time, on two thirds of the
labelled rows, then pruned on the last third; the rows it covers leave, and the next
rule is learned from the rest. The list becomes one ordered conditional expression.

Null text counts as empty. An empty text has zero for every statistic, so base_failed
is true. Rows with a null id are rated like all others. Labels with a null class or id
don't take part; of repeated labels for one id the lowest class counts. Without labels
the list is empty and the base rule alone decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import fresh
from ._words import Batch, chunks, per_doc

#: At most so many labelled rows are used to learn from, by the order of their id's hash.
MAX_LABELLED = 20_000
WINDOW = 8
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_upper", "n_digits", "n_marks", "n_bars", "n_distinct_words")
_STRUCT = T.StructType([T.StructField(x, T.LongType()) for x in STATISTICS])


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(members)] = 1
    return out


_SYMBOLS, _UPPER, _DIGITS = _table(b"[#*$%&|<>]".strip(b"[]")), _table(bytes(range(65, 91))), _table(bytes(range(48, 58)))
_MARKS, _BARS = _table(b"!?"), _table(b"|")
_POINT = np.array([0 if 0x80 <= b < 0xC0 else 1 for b in range(256)], np.int64)


def _repeats(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True where the same (doc, hash) is found more than once."""
    key = h ^ (doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, where, count = np.unique(key, return_inverse=True, return_counts=True)
    return count[where] > 1


def statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    b = Batch(texts)
    n = len(texts)
    out = {"n_words": b.n_words, "word_chars": per_doc(_POINT[b.buffer] * ~b.separator, b), "n_chars": per_doc(_POINT[b.buffer], b)}
    for name, of in (("n_symbols", _SYMBOLS), ("n_upper", _UPPER), ("n_digits", _DIGITS), ("n_marks", _MARKS), ("n_bars", _BARS)):
        out[name] = per_doc(of[b.buffer], b)
    ends = np.flatnonzero(b.buffer == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    words_before = np.searchsorted(b.start, np.append(starts, len(b.buffer)))
    full = np.diff(words_before) > 0
    starts, ends = starts[full], ends[full]
    doc = np.searchsorted(b.doc_end, starts)
    key = b.range_hash(starts, ends) ^ (doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, first = np.unique(key, return_index=True)
    out["n_lines"] = np.bincount(doc, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(doc[first], minlength=n)
    word = b.word_hash()
    _, first = np.unique(word ^ (b.doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), return_index=True)
    out["n_distinct_words"] = np.bincount(b.doc[first], minlength=n)
    at, h = b.windows(WINDOW)
    at = at[_repeats(b.doc[at], h)]
    cover = np.zeros(len(word) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(b.doc[np.cumsum(cover)[:-1] > 0], minlength=n)
    return out


def with_statistics(docs: DataFrame, text: str = "text", into: str = "_statistics") -> DataFrame:
    """docs with a struct of STATISTICS of each text, in a column named `into`; all rows and columns stay."""
    schema = T.StructType([*docs.schema.fields, T.StructField(into, _STRUCT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [statistics(texts) for _, texts in chunks(batch.column(batch.schema.get_field_index(text)))]
            fields = [pa.array(np.concatenate([p[x] for p in parts]).astype(np.int64)) for x in STATISTICS]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.StructArray.from_arrays(fields, list(STATISTICS))], [*batch.schema.names, into])

    return docs.mapInArrow(run, schema)


def features(s: str) -> dict[str, Column]:
    """What rules put thresholds on, from the struct column s."""
    c = {x: F.col(f"{s}.{x}").cast("double") for x in STATISTICS}
    words, chars, lines = (F.greatest(c[x], F.lit(1.0)) for x in ("n_words", "n_chars", "n_lines"))
    return {
        "words": c["n_words"],
        "word_length": c["word_chars"] / words,
        "symbols_per_word": c["n_symbols"] / words,
        "dup_line_share": c["n_dup_lines"] / lines,
        "repeat_share": c["n_repeat_words"] / words,
        "upper_share": c["n_upper"] / chars,
        "digit_share": c["n_digits"] / chars,
        "marks_per_word": c["n_marks"] / words,
        "bars_per_word": c["n_bars"] / words,
        "distinct_share": c["n_distinct_words"] / words,
        "words_per_line": c["n_words"] / lines,
    }


def base_failed(s: str) -> Column:
    return (F.col(f"{s}.n_words") < 20) | (100 * F.col(f"{s}.n_repeat_words") > 30 * F.col(f"{s}.n_words"))


@dataclass(frozen=True)
class Rule:
    """Rejects a text that meets all tests: (feature, above or not, threshold)."""

    tests: tuple[tuple[str, bool, float], ...]
    precision: float
    covered: int

    def holds(self, x: dict[str, np.ndarray], n: int) -> np.ndarray:
        out = np.ones(n, bool)
        for name, above, at in self.tests:
            out &= (x[name] > at) if above else (x[name] <= at)
        return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most_tests: int) -> list[tuple[str, bool, float]]:
    """Adds the threshold with the highest information gain until no good row is covered."""
    tests: list[tuple[str, bool, float]] = []
    inside = np.ones(len(bad), bool)
    while len(tests) < most_tests and (~bad[inside]).any():
        p0, n0 = bad[inside].sum(), inside.sum()
        if not p0:
            break
        best = (1e-9, None)
        for name, values in x.items():
            v, y = values[inside], bad[inside]
            order = np.argsort(v, kind="stable")
            v, y = v[order], y[order]
            cut = np.flatnonzero(v[1:] > v[:-1])
            if not len(cut):
                continue
            below_p, below_n = np.cumsum(y)[cut], cut + 1
            for above, p, n in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / n) - np.log2(p0 / n0)), -1.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (name, above, float((v[cut[k]] + v[cut[k] + 1]) / 2)))
        if best[1] is None:
            break
        tests.append(best[1])
        name, above, at = best[1]
        inside &= (x[name] > at) if above else (x[name] <= at)
    return tests


def learn(x: dict[str, np.ndarray], bad: np.ndarray, min_precision: float = 0.9, min_covered: int = 5, most_rules: int = 24, most_tests: int = 5, seed: int = 7) -> list[Rule]:
    """Ordered rules from labelled rows: x has each feature's values, bad is true where the text is to go."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    shuffle = np.random.Generator(np.random.PCG64(seed))
    misses = 0
    while len(rules) < most_rules and bad[left].any() and misses < 3:
        at = shuffle.permutation(np.flatnonzero(left))
        grow, prune = at[: 2 * len(at) // 3], at[2 * len(at) // 3 :]
        tests = _grow({k: v[grow] for k, v in x.items()}, bad[grow], most_tests)
        worth, kept = -np.inf, []
        for k in range(1, len(tests) + 1):
            held = Rule(tuple(tests[:k]), 0, 0).holds({n: v[prune] for n, v in x.items()}, len(prune))
            p, n = bad[prune][held].sum(), (~bad[prune])[held].sum()
            if p + n and (p - n) / (p + n) > worth:
                worth, kept = (p - n) / (p + n), tests[:k]
        held = Rule(tuple(kept), 0, 0).holds(x, len(bad)) & left if kept else np.zeros(len(bad), bool)
        precision = bad[held].mean() if held.any() else 0.0
        if not kept or precision < min_precision or held.sum() < min_covered:
            misses += 1
            continue
        rules.append(Rule(tuple(kept), float(precision), int(held.sum())))
        left &= ~held
        misses = 0
    return rules


def labelled(docs: DataFrame, labels: DataFrame, id: str = "doc_id", label: str = "quality", most: int = MAX_LABELLED) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Features and classes of at most `most` labelled documents; bounded, so they may go to the driver."""
    some = labels.select(F.col(id).alias("_id"), F.col(label).alias("_class")).dropna().groupBy("_id").agg(F.min("_class").alias("_class"))
    some = some.orderBy(F.xxhash64("_id"), "_id").limit(most)
    mine = docs.select(F.col(id).alias("_id"), F.col("text").alias("text")).join(F.broadcast(some), "_id")
    rows = with_statistics(mine).select((F.col("_class") == 0).alias("_bad"), base_failed("_statistics").alias("_base"), *[c.alias(k) for k, c in features("_statistics").items()]).toPandas()
    rows = rows[~rows["_base"].astype(bool)].sort_values(list(rows.columns)).reset_index(drop=True)
    return {k: rows[k].to_numpy(float) for k in features("_statistics")}, rows["_bad"].to_numpy(bool)


def rejected(rules: list[Rule], s: str) -> Column:
    """The list as one ordered conditional: number of the first rule that holds, 0 if none does."""
    f, out = features(s), None
    for k, rule in enumerate(rules, 1):
        cond = F.lit(True)
        for name, above, at in rule.tests:
            cond = cond & ((f[name] > F.lit(at)) if above else (f[name] <= F.lit(at)))
        out = F.when(cond, k) if out is None else out.when(cond, k)
    return F.lit(0) if out is None else out.otherwise(0)


def rate(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", into: str = "_statistics") -> DataFrame:
    """docs with the struct `into` of statistics, and within it base_failed, rule (0: none) and kept."""
    x, bad = labelled(docs.select(F.col(id).alias(id), F.col(text).alias("text")), labels, id)
    rules = learn(x, bad) if len(bad) and bad.any() and not bad.all() else []
    rated = with_statistics(docs, text, into)
    failed, rule = base_failed(into), rejected(rules, into)
    return rated.withColumn(into, F.struct(f"{into}.*", failed.alias("base_failed"), rule.alias("rule"), (~failed & (rule == 0)).alias("kept")))


def keep(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that the base rule and the learned list keep, with the columns they had."""
    into = fresh(docs, "_statistics")
    return rate(docs, labels, id, text, into).filter(f"{into}.kept").select(*docs.columns)
