"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A letter n-gram is the product of its
letters' vectors, each rotated by its place; a text is the sum (bundle) of its n-grams'
vectors at unit length; a language's prototype is the sum of its training texts. A text
has the language whose prototype is nearest by cosine, all taken from the mean prototype.

Letters are lower-cased; all else between letters counts as one gap. Null text, or text
without a letter, is "und" with score 0, as is every text when nothing was learned from.
Ties go to the first language by name. Null languages and null texts aren't learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._words import chunks

DIMENSIONS, GRAM, SEED = 512, 3, 20240229
#: Letters up to this code point have a vector each; others share the rest by their code.
DIRECT, SYMBOLS = 0x250, 1024
#: Prototypes are sums of whole numbers, so their order does not matter.
SCALE = 4096
UNKNOWN = "und"
_state: dict[str, np.ndarray] = {}


def held_out(id: str, modulus: int = 4, rest: int = 2) -> Column:
    """True where crc32 of the id as text leaves the remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % modulus == rest, F.lit(False))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(symbol of each code point of the first plane, 0 for no letter; vectors of the symbols)."""
    if not _state:
        symbol = np.zeros(1 << 16, np.int32)
        for c in range(1 << 16):
            if chr(c).isalpha():
                symbol[c] = c + 1 if c < DIRECT else DIRECT + 1 + c % (SYMBOLS - DIRECT - 1)
        _state["symbol"] = symbol
        _state["vector"] = np.random.Generator(np.random.PCG64(SEED)).choice(np.array([-1, 1], np.float32), (SYMBOLS, DIMENSIONS))
    return _state["symbol"], _state["vector"]


def _symbols(text: str) -> np.ndarray:
    """Letters of a text as symbols, one 0 for each gap, and at both ends."""
    table, _ = _tables()
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    high = code >= 1 << 16
    s = table[np.where(high, 0, code)]
    if high.any():
        s[high] = [DIRECT + 1 + c % (SYMBOLS - DIRECT - 1) if chr(c).isalpha() else 0 for c in code[high].tolist()]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    s = s[keep]
    return np.concatenate([[0] if len(s) and s[0] else [], s, [0] if len(s) and s[-1] else []]).astype(np.int32)


def bundles(texts: list[bytes]) -> np.ndarray:
    """Unit vectors of texts; zeros for a text without a letter."""
    _, vector = _tables()
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    parts = [_symbols(t.decode("utf-8", "replace")) for t in texts]
    n = np.array([max(0, len(p) - GRAM + 1) if p.any() else 0 for p in parts], np.int64)
    flat = np.concatenate(parts)
    if not n.any():
        return out
    used = np.unique(flat)
    small = np.searchsorted(used, flat)
    first = np.cumsum([0] + [len(p) for p in parts[:-1]])
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    gram = np.zeros(len(at), np.int64)
    for k in range(GRAM):
        gram = gram * len(used) + small[at + k]
    space = len(used) ** GRAM
    if space <= 1 << 24:
        place = np.zeros(space, bool)
        place[gram] = True
        grams = np.flatnonzero(place)
        where = (np.cumsum(place) - 1)[gram]
    else:
        grams, where = np.unique(gram, return_inverse=True)
    v = np.ones((len(grams), DIMENSIONS), np.float32)
    rest = grams.copy()
    for k in reversed(range(GRAM)):
        v *= np.roll(vector[used[rest % len(used)]], GRAM - 1 - k, axis=1)
        rest //= len(used)
    ends = np.cumsum(n)
    step = max(1, (4 << 20) // len(grams))
    for a in range(0, len(texts), step):
        b = min(len(texts), a + step)
        lo, hi = ends[a] - n[a], ends[b - 1]
        doc = np.repeat(np.arange(b - a), n[a:b])
        counts = np.bincount(doc * len(grams) + where[lo:hi], minlength=(b - a) * len(grams)).reshape(b - a, -1).astype(np.float32)
        out[a:b] = counts @ v
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, length, out=np.zeros_like(out), where=length > 0)


def prototypes(docs: DataFrame, text: str, lang: str) -> dict[str, np.ndarray]:
    """Each language's bundle over all rows; as many numbers as languages times DIMENSIONS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for first, texts in chunks(batch.column(0)):
                whole = np.rint(bundles(texts) * SCALE).astype(np.int64)
                mine = langs[first : first + len(texts)]
                for name in set(mine.tolist()):
                    sums[name] = sums.get(name, 0) + whole[mine == name].sum(axis=0)
        names = sorted(sums)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([sums[x] for x in names], pa.list_(pa.int64()))], ["lang", "sums"])

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna().mapInArrow(run, "lang string, sums array<long>")
    total = rows.select("lang", F.posexplode("sums")).groupBy("lang", "pos").agg(F.sum("col").alias("n")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("pos", "n"))).alias("v"))
    return {r["lang"]: np.array([x["n"] for x in r["v"]], float) for r in total.orderBy("lang").collect()}


def identify(docs: DataFrame, held: Column | None = None, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """id, held_out, lang_pred, score of every row; learned from the text and language of rows that aren't held out."""
    held = held_out(id) if held is None else held
    learned = prototypes(docs.filter(~held).select(text, lang), text, lang)
    learned = {k: v / np.linalg.norm(v) for k, v in learned.items() if v.any()}
    names = list(learned)
    matrix = np.array([learned[k] for k in names], np.float32).reshape(len(names), DIMENSIONS)
    mean = matrix.mean(axis=0) if len(names) > 1 else np.zeros(DIMENSIONS, np.float32)
    centred = matrix - mean
    centred /= np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)
    model = docs.sparkSession.sparkContext.broadcast((names, mean, centred))  # languages times DIMENSIONS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, mean, centred = model.value
        for batch in batches:
            for first, texts in chunks(batch.column(2)):
                x = bundles(texts)
                some = x.any(axis=1) & bool(names)
                x = x - mean
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                cos = x @ centred.T if names else np.zeros((len(texts), 1), np.float32)
                best = cos.argmax(axis=1)
                score = np.where(some, np.clip(cos.max(axis=1), 0, 1), 0).astype(float)
                pred = [names[k] if s else UNKNOWN for k, s in zip(best.tolist(), some.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)), pa.array(pred, pa.string()), pa.array(score)], ["id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id).cast("long").alias("id"), held.alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id)
