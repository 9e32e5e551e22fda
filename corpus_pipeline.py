"""The training-corpus pipeline: quality, near duplicates, benchmark passages, mix, token shards.

Every stage takes all that the stage before kept, and its result is written as
Parquet and read again for the next.  All but the last return the columns of
``documents``; the last returns a row per document of the mix with its place in
the token shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arrears.llm import decontamination, mixing, ngram_join, quality, token_shards
from arrears.llm.common import python_ready, scratch, table, tidy
from arrears.llm.queries import tokenizer_path

#: Near duplicates: five-word shingles, similarity 0.8 or more.
NEAR = ngram_join.Jaccard(n=5, num=80, den=100)


def _begin(spark: SparkSession) -> None:
    """Before a stage: Python tasks can run, and what the stage before left on the driver is freed."""
    python_ready(spark)
    tidy(spark)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    _begin(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    _begin(spark)
    return ngram_join.keep_first(docs, NEAR)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    _begin(spark)
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: documents as often as they were drawn."""
    _begin(spark)
    return mixing.mix_documents(docs)


def write_token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of the mix, from the shards read back."""
    _begin(spark)
    return token_shards.token_report(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", keep_quality),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("mix_sources", mix_sources),
    ("token_shards", write_token_shards),
]

#: The stages fit a classifier, align texts and run a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
