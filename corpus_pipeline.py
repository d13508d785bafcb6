"""The corpus pipeline: five of the operators, each on all that the one before it kept.

quality rules -> exact dedup -> n-gram Jaccard join -> mixing to target weights -> best-fit packing. All stages but the
last return the columns of ``documents``; the last returns a row per packed piece.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evenfield.llm.common import drop_folder, read_table, shared_folder
from evenfield.llm.exact_dedup import keep_first
from evenfield.llm.jaccard_join import keep_one
from evenfield.llm.mixing import mix
from evenfield.llm.packing import pack
from evenfield.llm.quality import filter_quality, fit_quality
from evenfield.session import ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go."""
    ship_package(spark)
    return filter_quality(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    ship_package(spark)
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, dealt to files in the order of the schedule, so that each file holds the sources in their target weights."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences and offsets; sequences follow the order that mixing gave the files."""
    ship_package(spark)
    return pack(docs, in_order=True)


STAGES: list[tuple[str, Stage]] = [("quality_rules", quality), ("exact_dedup", dedup), ("ngram_jaccard_join", near), ("source_mixing", mixing), ("best_fit_packing", packing)]
#: Tokenisation and the language-model-like scores are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage applied to documents; each result but the last is written to the shared folder and read again.

    A stage's table is deleted once the next one's is whole; that of the last but one stays, as the result may be read from it.
    """
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
            if k:
                drop_folder(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
