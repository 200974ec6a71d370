"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, tokens.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns the documents it
keeps with their columns, the last one the token digests of op9. Every stage's rows are
written as Parquet in the shared folder and reread as the next one's documents.

Rejected documents go, common lines go from the texts that stay, one document of each
near-duplicate group stays (the one of the smallest doc_id), and documents with a benchmark
passage go. Empty documents tables give an empty result; rows with a null doc_id stay through
near-dedup, where they cannot be told apart by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaver.llm import bpe, decontam, linededup, quality, simhash
from quaver.session import materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.query(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level bpe", tokens),
]

#: The fitted model of the first stage cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{k}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
