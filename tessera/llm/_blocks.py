"""Blocks of documents that look words up in tables too large to broadcast.

A block is about BLOCK bytes of text from one partition. It numbers its own distinct
words by falling frequency, keeps its tokens as such numbers, and asks for each
distinct word once: a request goes to the bucket of the word's hash, whose task sees
every block's requests for its words, and an answer comes back in the same order.
So a word that all documents share costs one entry per block, never one per document.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import partitions, stored
from ._words import by_number, release

#: Bytes of text in a block, unless one text is longer.
BLOCK = 16 << 20
SCHEMA = "block long, bucket int, stamp long, words binary, tokens binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Integer or float arrays as one compressed value; bytes of equal weight lie together."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head = f"{a.dtype.str},{len(a)};".encode()
        planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T if len(a) else np.empty(0, np.uint8)
        out.append(len(head).to_bytes(2, "little") + head + np.ascontiguousarray(planes).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 0
    while at < len(raw):
        n = int.from_bytes(raw[at : at + 2], "little")
        kind, count = raw[at + 2 : at + 2 + n].decode().rstrip(";").split(",")
        dtype, at = np.dtype(kind), at + 2 + n
        size = int(count) * dtype.itemsize
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(dtype.itemsize, int(count))
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype) if size else np.empty(0, dtype))
        at += size
    return out


def pack_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(words))


def unpack_words(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b"\n")


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Block:
    """Documents of one block: ids (with `known`, false for a null id), flag, words per document, tokens, and the words' buckets."""

    def __init__(self, n_buckets: int, fold: bool, end: bool):
        self.n_buckets, self.fold, self.end = n_buckets, fold, end
        self.numbers, self.tokens, self.lengths, self.ids, self.flags, self.size = _Numbers(), [], [], [], [], 0

    def add(self, doc_id: int | None, text: bytes, flag: bool) -> None:
        words = (text.lower() if self.fold else text).split()
        if self.end:
            words.append(b"")  # no word is empty
        self.tokens.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.lengths.append(len(words))
        self.ids.append(doc_id)
        self.flags.append(flag)
        self.size += len(text)

    def rows(self, number: int, only: str = "") -> Iterator[tuple[int, int, int, bytes | None, bytes | None]]:
        tokens = np.concatenate(self.tokens) if self.tokens else np.empty(0, np.int32)
        lengths, flags = np.array(self.lengths, np.int32), np.array(self.flags, bool)
        counts = np.bincount(tokens, minlength=len(self.numbers))
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        tokens = rank[tokens]
        flagged = np.bincount(tokens[np.repeat(flags, lengths)], minlength=len(order)).astype(np.uint32)
        words = list(self.numbers)
        words = [words[i] for i in order.tolist()]
        bucket = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(self.n_buckets)
        ids = np.array([0 if x is None else x for x in self.ids], np.int64)
        known = np.array([x is not None for x in self.ids], np.uint8)
        stamp = zlib.crc32(tokens.tobytes()) << 30 | zlib.crc32(ids.tobytes()) >> 2
        if only != "words":
            yield number, -1, stamp, None, pack(ids, known, flags.astype(np.uint8), lengths, tokens, bucket)
        if only == "documents":
            return
        by = by_number(bucket, self.n_buckets)
        cuts = np.searchsorted(bucket[by], np.arange(self.n_buckets + 1))
        for b in range(self.n_buckets):
            at = by[cuts[b] : cuts[b + 1]]
            if len(at):
                yield number, b, stamp, pack_words([words[i] for i in at.tolist()]), pack(counts[order[at]].astype(np.uint32), flagged[at])


#: Rows of a batch that are Python objects at once.
SLICE = 256


def to_blocks(docs: DataFrame, n_buckets: int, fold: bool, end: bool, only: str = "", size: int | None = None) -> DataFrame:
    """docs: columns id, text, flag. size: bytes of text in a block, BLOCK if none. only: "words" or "documents" rows, all if empty. Rows of bucket -1 hold a block's documents; the others its words of a bucket, with their counts in all and in flagged documents."""

    size = BLOCK if size is None else size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 24, Block(n_buckets, fold, end)

        def out() -> pa.RecordBatch:
            cols = list(zip(*block.rows(number, only), strict=True)) or [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["block", "bucket", "stamp", "words", "tokens"])

        for part in (batch.slice(at, SLICE) for batch in batches for at in range(0, batch.num_rows, SLICE)):
            for doc_id, text, flag in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                block.add(doc_id, text or b"", bool(flag))
                if block.size >= size:
                    yield out()
                    release()
                    number, block = number + 1, Block(n_buckets, fold, end)
        if block.ids:
            yield out()
        del block
        release()

    return docs.select(F.col("id").cast("long"), F.col("text").cast("binary"), F.col("flag")).mapInArrow(run, SCHEMA)


def n_buckets(spark: SparkSession) -> int:
    """More buckets than shuffle partitions, so that these fill evenly."""
    return 4 * partitions(spark)


def stored_blocks(docs: DataFrame, name: str, fold: bool, end: bool) -> DataFrame:
    return stored(to_blocks(docs, n_buckets(docs.sparkSession), fold, end), name)


def word_requests(blocks: DataFrame) -> DataFrame:
    return blocks.filter("bucket >= 0")


def block_documents(blocks: DataFrame) -> DataFrame:
    return blocks.filter("bucket < 0").select("block", "stamp", "tokens")


def with_answers(blocks: DataFrame, answers: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """run(a block's row, its answers) for every block."""

    def one(row: pa.Table, found: pa.Table) -> pa.Table:
        out = run(row, found)
        release()
        return out

    return block_documents(blocks).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(one, schema)


def same_block(row: pa.Table, found: pa.Table) -> None:
    """Raises where a block read twice isn't the same: its answers would be those of other words."""
    if row.num_rows and found.num_rows and {row.column("stamp")[0].as_py()} != set(found.column("stamp").to_pylist()):
        raise RuntimeError("a partition of the documents was read twice with other rows; store the documents first")


def gather(bucket_of: np.ndarray, answers: dict[int, np.ndarray], dtype: np.dtype | str) -> np.ndarray:
    """Answers by bucket, each in the order of the request, as one array in the order of the block's words."""
    out = np.zeros(len(bucket_of), dtype)
    by = np.argsort(bucket_of, kind="stable")
    cut = np.flatnonzero(np.diff(bucket_of[by])) + 1
    for at in np.split(by, cut) if len(by) else []:
        out[at] = answers[int(bucket_of[at[0]])]
    return out
