"""The corpus pipeline: from raw documents to packed training sequences.

Stages, in order: documents rejected for toxicity go; of exact copies one
stays; of near copies one stays; personal data is sanitised in place; what is
left is packed into sequences. Every stage but the last returns the columns of
``documents``; each result is written as Parquet and read again for the next.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm import exact_dedup, ngram_jaccard, packing, pii, toxicity
from pagemill.llm.common import bounded_batches, cut_lineage, read_table
from pagemill.llm.registry import CATEGORIES, public_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chain = toxicity.fit_chain(docs, read_table(spark, sf_dir, "labels"), CATEGORIES)
    return toxicity.drop_toxic(docs, chain)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_jaccard.drop_near_duplicates(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_file("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


def _bounded(stage):
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [("toxicity", _bounded(drop_toxic)), ("exact_dedup", _bounded(drop_copies)),
          ("ngram_jaccard", _bounded(drop_near_copies)), ("pii", _bounded(sanitise)), ("packing", _bounded(pack))]

#: The toxicity stage is a trained model, so SQL cannot express the pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
