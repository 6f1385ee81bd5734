"""Documents to tokens: quality rules, line dedup, near duplicates, mixing, encoding.

Every stage works on all that the stage before kept; each but the last returns the
columns of documents. Copies that the mix takes twice are two rows.

A stage's rows are written before the next stage is called, so what a stage left in the
shared folder is deleted when the next one begins. Null and empty texts have no words and
fall at the first stage, as do those it rejects; an empty table stays empty throughout.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import line_dedup, mixing, quality_rules, shingle_join, word_bpe
from tessera.llm._shared import arrow_batches, discard, gather, stored
from tessera.llm.queries import table, tokenizer_path


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[DataFrame] = []
#: Bytes of text in a batch and in a block of the last stage: by then the executors' own memory has grown, so its Python tasks get little at once.
BATCH, BLOCK = 2 << 20, 4 << 20


def stage(work: Stage) -> Stage:
    """work, which deletes the tables of the stage before it."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left:
            discard(_left.pop())
        gather(_left)
        try:
            return work(spark, docs, sf_dir)
        finally:
            gather(None)

    return run_stage


@stage
def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned list rejects go."""
    return quality_rules.keep(docs, table(spark, sf_dir, "labels"))


@stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines go; a document with no other lines goes with them."""
    return line_dedup.dedup(docs)


@stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id stays."""
    return shingle_join.keep_one(docs)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes a word, as often as it takes them, in whole."""
    return mixing.sample(docs)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and the digests of ids and decoded text; a stored table, which stays, as it is the result."""
    with arrow_batches(spark, BATCH):
        out = stored(word_bpe.digests(docs, tokenizer_path(), block=BLOCK), "encoded")
    _left[:] = [x for x in _left if x is not out]
    return out


STAGES = [("quality rules", rules), ("line dedup", lines), ("n-gram Jaccard join", near), ("mixing", mix), ("BPE encoding", encode)]

#: Learned rules, edit distances and tokenizers have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, work) in enumerate(STAGES):
        before, docs = docs, work(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{k}")
            if k:
                discard(before)
    return docs.select(*[F.col(c) for c in docs.columns])
