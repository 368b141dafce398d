"""Corpus preparation in four stages, each written as Parquet and read again by the next.

Language ID keeps documents in a learned language; near-duplicate detection keeps one document of each class;
decontamination keeps documents that leak no benchmark item; packing cuts what is left into windows of token
ids, in which lexically close documents meet. No stage can be said in SQL (a trained model, signatures, tiles, a
tokenizer), so ORACLE_SQL is None and the tests hold the rows against plain versions. Empty tables, repeated rows and
ids, very long texts and extra columns of any name pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playmart.functions.session import find_package, frugal_workers
from playmart.llm import decontam, langid, minhash, packing
from playmart.llm.common import read_table, vocabulary, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; null texts, and texts without a letter, go. Rows are judged by text alone, all columns stay."""
    find_package(spark)
    with frugal_workers(spark):
        return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies, that of the smallest doc_id; rows without a text all stay. All columns stay."""
    find_package(spark)
    with frugal_workers(spark):
        return minhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item; rows are judged by text alone, null and empty texts stay. All columns stay."""
    find_package(spark)
    with frugal_workers(spark):
        return decontam.remove_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document in windows of 4096 token ids; a null text is its end id alone. Other columns are left out."""
    find_package(spark)
    with frugal_workers(spark):
        return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("packing", pack)]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
