"""From raw documents to packed training sequences.

Each stage takes what its predecessor kept and, but for the last, returns rows with the columns of
``documents``: toxic documents go, then exact copies (the largest doc_id stays), then near copies
(the smallest doc_id of a group stays), then every document is repeated or left out by the rate
that brings the domains to their shares, and the rest is packed. Classifiers learn from labelled
rows of the documents table; the rows whose labels are held out are never used.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deskloom.llm.exact_dedup import drop_exact_duplicates
from deskloom.llm.mixing import mix
from deskloom.llm.ngram_join import drop_near
from deskloom.llm.packing import pack_documents
from deskloom.llm.queries import MIX, TOKENIZER, domain_model, toxicity_scorer
from deskloom.llm.toxicity import drop_toxic
from deskloom.session import checkpoint_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, toxicity_scorer(spark, sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs, domain_model(spark, sf_dir), MIX)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: A classifier, an iterative join and an optimisation are no SQL; tests hold the stages one by one
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as a table and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{checkpoint_dir(spark)}/pipeline/{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
