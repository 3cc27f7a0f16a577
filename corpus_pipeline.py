"""The corpus pipeline: language, quality, near-duplicates, source mix, packing.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next
one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wattloom.llm import language, mixing, packing, quality, simhash
from wattloom.llm.common import table
from wattloom.session import shared_folder


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those no language explains better than chance."""
    return language.accepted(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose lines are mostly bad."""
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group."""
    return simhash.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents as often as the sources' target weights ask."""
    return mixing.repeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences."""
    return packing.pack(docs, packing.public_vocabulary())


STAGES = [
    ("language_id", known_language),
    ("quality", good_quality),
    ("near_duplicates", distinct),
    ("source_mix", source_mix),
    ("packing", packed),
]
#: Fitted models, random draws and a tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/wattloom/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
