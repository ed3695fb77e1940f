"""Evaluation tables: evidence benchmark and agent predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.operators.retrieval import retrieve, with_cases
from deskloom.operators.tfidf import TfidfIndex

BLANK = ("relevant", "actionable", "safe_to_ground", "annotation_notes")


def evidence_benchmark(
    gold: DataFrame, index: TfidfIndex, cases: DataFrame, k: int = 3, blank: Sequence[str] = BLANK
) -> DataFrame:
    """Retrieved evidence for gold cases (``case_id, customer_text, final_intent``), routed by
    the gold label, one row per rank, with blank columns for the annotators."""
    asked = gold.select(
        F.col("case_id").alias("query_id"), "customer_text", F.col("final_intent").alias("gold_intent")
    )
    hits = with_cases(retrieve(asked, index, k, "query_id", "customer_text", "gold_intent"), cases)
    return (
        hits.drop("case_id")
        .join(asked, "query_id")
        .select(
            F.col("query_id").alias("case_id"),
            "gold_intent",
            "customer_text",
            F.col("rank_no").alias("rank"),
            F.round("similarity", 4).alias("similarity"),
            "historical_customer",
            "historical_reply",
            "response_type",
        )
        .withColumns({c: F.lit("") for c in blank})
    )
