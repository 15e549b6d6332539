"""A corpus from raw documents to token files, as stages whose results are tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from badgeflow.llm import decontaminate, mixing, simhash, token_files, toxicity
from badgeflow.llm.common import written
from badgeflow.llm.queries import MAX_REPEATS, table, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; empty and null texts are scored like any other."""
    return toxicity.clean_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of three-word shingles within two bits stays: the one with the
    smallest id (null last), and one of repeated rows."""
    return simhash.one_of_each(docs, max_bits=simhash.MAX_BITS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go; rows are judged by id and text, so others of the same id stay."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document is used; documents of smaller sources (a null source is one) are repeated to their source's weight."""
    return mixing.mixed(docs, mixing.Target(max_repeats=MAX_REPEATS))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: doc_id, start, n_tokens, ids_crc32 of each document's ids."""
    return token_files.written_and_read(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

#: Learned scores, XXH64 fingerprints and subword ids have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
