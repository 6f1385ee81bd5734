"""The query of each operator with production parameters, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_index, filter_audit, hyper_lang, katz, line_dedup, main_text, merkle, mixing, private_data, quality_rules, secret_scan, shingle_join, word_bpe
from ._shared import documents

WORD_BPE = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = "_statistics"
    rated = quality_rules.rate(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return rated.select("doc_id", *[f"{s}.{x}" for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")])


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.fit_score(documents(spark, sf_dir))


def op4_hyper_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyper_lang.identify(documents(spark, sf_dir))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(documents(spark, sf_dir))


def op6_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    return word_bpe.digests(documents(spark, sf_dir), path)


def op7_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.link_documents(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "set_id")


def op3_exact_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_index.classes(documents(spark, sf_dir)).drop("bucket")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(documents(spark, sf_dir))


def op9_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.report(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_katz": op2_katz,
    "op3_exact_index": op3_exact_index,
    "op4_hyper_lang": op4_hyper_lang,
    "op5_secret_scan": op5_secret_scan,
    "op6_word_bpe": op6_word_bpe,
    "op7_shingle_join": op7_shingle_join,
    "op8_line_dedup": op8_line_dedup,
    "op9_private_data": op9_private_data,
    "op10_mixing": op10_mixing,
    "op11_main_text": op11_main_text,
    "op12_filter_audit": op12_filter_audit,
    "op13_merkle": op13_merkle,
}

ORACLES: dict[str, str] = {"op3_exact_index": exact_index.ORACLE, "op12_filter_audit": filter_audit.ORACLE, "op13_merkle": merkle.ORACLE}
