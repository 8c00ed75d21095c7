"""The corpus pipeline: stages that each read what the one before kept.

Quality rules and the quality classifier take documents out, one document of each near-duplicate group
stays, documents that hold a benchmark item go, and what is left is packed into token sequences. Every stage
but the last returns rows of ``documents`` as they were, with all their columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import rule_ensemble
from millrace.llm.decontamination import clean
from millrace.llm.packing import Packing, pack
from millrace.llm.part_enum import Join, one_of_each
from millrace.llm.quality_rules import good
from millrace.llm.queries import QUERIES as OPERATOR_QUERIES
from millrace.queries.registry import Query, table
from millrace.session import work_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~rule_ensemble.held_out())
    fitted = rule_ensemble.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    return rule_ensemble.good(docs, fitted)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, Join(shingle=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, Packing(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality rules", quality),
    ("quality classifier", classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: The classifier and the groups of the join are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared folder and read again."""
    folder = work_path(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {**OPERATOR_QUERIES, "pipeline": Query(run, ORACLE_SQL)}
