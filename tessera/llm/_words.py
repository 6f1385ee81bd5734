"""Words of many texts at once, as numpy arrays.

A batch of texts becomes one byte buffer. Words, lines and windows are ranges of
it; their 64-bit hashes come from one prefix sum of byte values times powers, so
no Python object is made for a word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE, _WINDOW_BASE = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_MASK = (1 << 64) - 1
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_random = np.random.Generator(np.random.PCG64(20240229))
_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_VALUE_FOLDED = _VALUE.copy()
_VALUE_FOLDED[65:91] = _VALUE[97:123]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: Bytes of text that one call works on, unless a single text is longer; with it, the tables of powers stay small.
CHUNK = (2 << 20) - (64 << 10)


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser for 64-bit hashes (the splitmix64 steps)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows of columns of whole numbers from zero on: each row's number among the distinct rows, which are in ascending order, and one row of each of these.

    Where a row and its place fit 64 bits together, such numbers are sorted themselves, which takes a third of the time of sorting places by them.
    """
    n, size = len(columns[0]), 1
    key = np.zeros(n, np.uint64)
    for c in columns:
        size *= (top := int(c.max(initial=0)) + 1)
        if size <= 1 << 64:
            key *= U64(top % (1 << 64))
            key += c.astype(np.uint64)
    new, bits = np.ones(n, bool), n.bit_length()
    if size <= 1 << (64 - bits):
        key <<= U64(bits)
        key |= np.arange(n, dtype=np.uint64)
        key.sort()
        at = (key & U64((1 << bits) - 1)).astype(np.int32 if n < 1 << 31 else np.int64)
        key >>= U64(bits)
        np.not_equal(key[1:], key[:-1], out=new[1:])
    elif size <= 1 << 64:
        at = np.argsort(key)
        key = key[at]
        np.not_equal(key[1:], key[:-1], out=new[1:])
    else:
        at = np.lexsort(columns[::-1])
        new[1:] = np.any([c[at][1:] != c[at][:-1] for c in columns], axis=0)
    number = np.empty(n, at.dtype)
    number[at] = np.cumsum(new, dtype=at.dtype) - 1
    return number, at[new]


def by_number(a: np.ndarray, top: int) -> np.ndarray:
    """Places of numbers below `top` in ascending order, equal ones in their order; in time by their count where numbers have 16 bits."""
    return np.argsort(a.astype(np.uint16) if top <= 1 << 16 else a, kind="stable")


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, n or more of each."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = -(-n // (1 << 18)) << 18
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            a = np.empty(size, np.uint64)
            a[0], done, step = 1, 1, b
            while done < size:
                more = min(done, size - done)
                a[done : done + more] = a[:more] * U64(step)
                step, done = step * step & _MASK, done + more
            out.append(a)
        have = _powers[base] = (out[0], out[1])
    return have


class Batch:
    """Words of some texts.

    buffer: the texts' bytes, a newline after each. doc_start, doc_end: a text's range.
    start, end, doc: of each word; first_word: index of each text's first word (one more at the end).
    """

    def __init__(self, texts: list[bytes], fold: bool = False):
        joined = b"\n".join(texts) + b"\n"
        self.buffer = np.frombuffer(joined, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.doc_end = np.cumsum(lengths + 1) - 1
        self.doc_start = self.doc_end - lengths
        separator = _SEPARATOR[self.buffer]
        self.separator = separator
        edge = np.empty(len(separator), bool)
        edge[0] = not separator[0]
        np.not_equal(separator[1:], separator[:-1], out=edge[1:])
        at = np.flatnonzero(edge)
        self.start, self.end = at[0::2], at[1::2]
        self.first_word = np.searchsorted(self.start, np.append(self.doc_start, len(self.buffer)))
        self.n_words = np.diff(self.first_word)
        self.doc = np.repeat(np.arange(len(texts)), self.n_words)
        self._fold = fold
        self._prefix: np.ndarray | None = None

    def _sums(self) -> np.ndarray:
        if self._prefix is None:
            up, _ = powers(len(self.buffer) + 1, _BASE)
            self._prefix = np.zeros(len(self.buffer) + 1, np.uint64)
            np.cumsum((_VALUE_FOLDED if self._fold else _VALUE)[self.buffer] * up[: len(self.buffer)], out=self._prefix[1:])
        return self._prefix

    def range_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums, (_, down) = self._sums(), powers(len(self.buffer) + 1, _BASE)
        return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))

    def word_hash(self) -> np.ndarray:
        return self.range_hash(self.start, self.end)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of n words within one text."""
        h = self.word_hash()
        if len(h) < n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        up, down = powers(len(h) + 1, _WINDOW_BASE)
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * up[: len(h)], out=sums[1:])
        first = np.flatnonzero(self.doc[: len(h) - n + 1] == self.doc[n - 1 :])
        return first, mix((sums[first + n] - sums[first]) * down[first] + U64(n))


def per_doc(values: np.ndarray, batch: Batch) -> np.ndarray:
    """Sum of a value per byte over each text."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[batch.doc_end] - sums[batch.doc_start]


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts as bytes, null as empty) in groups of about `size` bytes, whole texts always."""
    out: list[bytes] = []
    first = total = 0
    few = (texts.slice(at, 256) for at in range(0, len(texts), 256))  # not all of a batch as Python objects beside the batch
    for i, value in enumerate(value for part in few for value in part.cast(pa.large_binary()).to_pylist()):
        value = value or b""
        if out and total + len(value) > size:
            yield first, out
            out, first, total = [], i, 0
        out.append(value)
        total += len(value)
    if out:
        yield first, out


def by_column(batches: Iterable[pa.RecordBatch], name: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, batch.column(batch.schema.get_field_index(name))


def release() -> None:
    """Hand freed memory back: a worker is used again, often for other work, and others wait beside it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
