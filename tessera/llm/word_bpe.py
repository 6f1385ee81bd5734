"""BPE encoding and decoding through a table of distinct words.

The tokenizer's own rules drop white space, so a text's ids are those of its words in
turn. Words are split once, every distinct word is encoded once, in the task of its
bucket, and the ids are joined back by position. Decoding joins ids to pieces.

Null text counts as empty: no ids, an empty decoded text. Null ids of documents stay
null. Repeated rows are encoded each. Words of which nothing remains give no ids.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._blocks import gather, n_buckets, pack, same_block, to_blocks, unpack, unpack_words, with_answers, word_requests

#: Ids in a batch of results.
OUT_IDS = 500_000
#: Words that are encoded at once: each is some objects of the tokenizer until its ids are read.
WORDS = 5_000


@lru_cache(maxsize=1)
def _tokenizer(definition: str):
    """Made once for all buckets that a worker gets: to make and drop it for each leaves memory behind, and takes longer than a bucket's words."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(definition)
    t.no_truncation()
    t.no_padding()
    return t


def encode(docs: DataFrame, tokenizer_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (id, ids array<int>) for each document.

    docs are read twice, for their words and for their positions, and must be the same
    both times, as files are; other rows the second time raise an error.
    """
    return _encoded(docs, tokenizer_path, id, text, lambda batch: batch, [("id", pa.int64()), ("ids", pa.list_(pa.int32()))], "id long, ids array<int>")


def digests(docs: DataFrame, tokenizer_path: str, id: str = "doc_id", text: str = "text", block: int | None = None) -> DataFrame:
    """id, n_tokens, ids_sha256 of the decimal ids with a space between two, decoded_sha256 of the decoded text: encode() and decode() in one pass.

    block: bytes of text that a task works on; fewer take less memory and more requests.
    """
    table = docs.sparkSession.sparkContext.broadcast(pieces(tokenizer_path))  # of fixed size

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = pa.array(table.value)
        numbers = pa.array([str(i) for i in range(len(words))])
        sha = lambda column: [hashlib.sha256(x.as_buffer()).hexdigest() for x in column]
        ids, decoded = [], []
        for at in range(0, batch.num_rows, 256):
            lists = batch.column(1).slice(at, 256)
            ids += sha(_text_of(lists, numbers))
            decoded += sha(_text_of(lists, words))
        n = pc.cast(pc.list_value_length(batch.column(1)), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), n, pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    fields = [("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    return _encoded(docs, tokenizer_path, id, text, finish, fields, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string", block)


def _encoded(docs: DataFrame, tokenizer_path: str, id: str, text: str, finish: Callable[[pa.RecordBatch], pa.RecordBatch], fields: list, schema: str, block: int | None = None) -> DataFrame:
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())  # a file of fixed size
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.lit(False).alias("flag"))
    blocks = lambda only: to_blocks(docs, n_buckets(spark), fold=False, end=False, only=only, size=block)

    def encode_words(requests: pa.Table) -> pa.Table:
        asked = [unpack_words(x) for x in requests.column("words").to_pylist()]
        place: dict[bytes, int] = {}
        for words in asked:
            for w in words:
                place.setdefault(w, len(place))
        t = _tokenizer(definition.value)
        distinct, lengths, parts = list(place), [], []
        for at in range(0, len(distinct), WORDS):
            found = [e.ids for e in t.encode_batch([w.decode("utf-8", "replace") for w in distinct[at : at + WORDS]], add_special_tokens=False)]
            lengths += map(len, found)
            parts.append(np.fromiter((i for ids in found for i in ids), np.int32))
        ids, lengths = np.concatenate(parts), np.array(lengths, np.int64)
        start = np.cumsum(lengths) - lengths
        answers = []
        for words in asked:
            at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
            n = lengths[at]
            answers.append(pack(n.astype(np.uint32), ids[_ranges(start[at], n)].astype(np.uint32)))
        return pa.table({"block": requests.column("block"), "bucket": requests.column("bucket"), "stamp": requests.column("stamp"), "answer": pa.array(answers, pa.binary())})

    asked = word_requests(blocks("words")).select("block", "bucket", "stamp", "words")
    answers = asked.groupBy("bucket").applyInArrow(encode_words, "block long, bucket int, stamp long, answer binary")

    def join(block: pa.Table, found: pa.Table) -> Iterator[pa.RecordBatch]:
        doc_id, known, _, n_words, tokens, bucket = unpack(block.column("tokens")[0].as_py())
        lengths, parts = {}, {}
        for b, x in zip(found.column("bucket").to_pylist(), found.column("answer").to_pylist(), strict=True):
            lengths[b], parts[b] = unpack(x)
        length = gather(bucket, lengths, np.int64)
        order = sorted(parts)
        ids = np.concatenate([parts[b] for b in order]).astype(np.int32) if order else np.empty(0, np.int32)
        by = np.argsort(bucket, kind="stable")
        start = np.empty(len(bucket), np.int64)
        start[by] = np.cumsum(length[by]) - length[by]
        ends = np.cumsum(n_words.astype(np.int64))
        firsts = ends - n_words
        first = 0
        sizes = np.concatenate([[0], np.cumsum(length[tokens])])
        while first < len(doc_id):
            last = max(first + 1, int(np.searchsorted(sizes[ends], sizes[firsts[first]] + OUT_IDS, "right")))
            mine = tokens[firsts[first] : ends[last - 1]]
            flat = ids[_ranges(start[mine], length[mine])]
            offsets = sizes[np.append(firsts[first:last], ends[last - 1])] - sizes[firsts[first]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_id[first:last], mask=known[first:last] == 0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))],
                ["id", "ids"],
            )
            first = last

    def joined(block: pa.Table, found: pa.Table) -> pa.Table:
        out = pa.schema(fields)
        same_block(block, found)
        return pa.Table.from_batches([finish(x).cast(out) for x in join(block, found)], out) if block.num_rows else out.empty_table()

    return with_answers(blocks("documents"), answers, joined, schema).withColumnRenamed("id", id)


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for length[0] numbers, and so on."""
    length = length.astype(np.int64)
    out = np.repeat(start - (np.cumsum(length) - length), length)
    out += np.arange(len(out))
    return out


def pieces(tokenizer_path: str) -> list[str]:
    """The piece of each id; a gap has none."""
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = json.load(f)
    by_id = {i: p for p, i in definition["model"]["vocab"].items()} | {x["id"]: x["content"] for x in definition["added_tokens"]}
    return [by_id.get(i, "") for i in range(max(by_id, default=-1) + 1)]


def _text_of(lists: pa.ListArray, pieces: pa.Array) -> pa.Array:
    """Each list's pieces, one space between two; an id without a piece is left out."""
    flat, n = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ids = flat.to_numpy(zero_copy_only=False)
    good = (ids >= 0) & (ids < len(pieces))
    if not good.all():
        kept = np.concatenate([[0], np.cumsum(good)])
        ends = np.cumsum(n)
        n, flat = kept[ends] - kept[ends - n], flat.filter(pa.array(good))
    offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, pieces.take(flat)), " ")


def decode(encoded: DataFrame, tokenizer_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """encoded with the text of its ids, joined to the table of pieces."""
    table = encoded.sparkSession.sparkContext.broadcast(pieces(tokenizer_path))  # of fixed size
    schema = T.StructType([*encoded.schema.fields, T.StructField(into, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(table.value)
        for batch in batches:
            text = _text_of(batch.column(batch.schema.get_field_index(ids)), words)
            yield pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, into])

    return encoded.mapInArrow(run, schema)
