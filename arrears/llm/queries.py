"""Registered queries of the training-data operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, importance, lexical, minhash, mixing, neighbours, ngram_join, quality, secrets, suffix_array, suffix_tree, token_shards, warc
from .common import python_ready, table
from .oracle import SQL  # noqa: F401  the registered statements


def _python(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query whose tasks run Python."""

    @wraps(f)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        python_ready(spark)
        return f(spark, sf_dir)

    return query


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizers' files are installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@_python
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_python
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups_report(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.document_secrets(table(spark, sf_dir, "documents"))


@_python
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


@_python
def op6_substring_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.windows_report(table(spark, sf_dir, "documents"))


@_python
def op7_substring_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.bytes_report(table(spark, sf_dir, "documents"))


@_python
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbours_report(table(spark, sf_dir, "embeddings"))


@_python
def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.token_report(table(spark, sf_dir, "documents"), tokenizer_path())


@_python
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_python
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_python
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampling_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_python
def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_decontamination,
        op3_ngram_join,
        op4_secrets,
        op5_warc,
        op6_substring_words,
        op7_substring_bytes,
        op8_neighbours,
        op9_token_shards,
        op10_quality,
        op11_lexical_search,
        op12_importance_resampling,
        op13_minhash,
    )
}
