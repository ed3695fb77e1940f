"""Profiles of a message table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.operators.skew import median_of, running_levels


def message_profile(messages: DataFrame) -> DataFrame:
    """Total, inbound and outbound counts: one partial aggregate per task."""
    return messages.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("inbound")).alias("inbound"),
        F.count_if(~F.col("inbound")).alias("outbound"),
    )


def top_authors(messages: DataFrame, n: int = 30, author: str = "author_id") -> DataFrame:
    return (
        messages.groupBy(author)
        .agg(F.count(F.lit(1)).alias("messages"))
        .orderBy(F.col("messages").desc(), F.col(author))
        .limit(n)
    )


def brand_stats(messages: DataFrame, brands: Sequence[str] | None = None) -> DataFrame:
    """Per brand: totals, directions, messages with a parent, messages that got a reply, and
    the number of different customers the brand wrote to."""
    mine = messages if brands is None else messages.filter(F.col("author_id").isin(*brands))
    replied = messages.filter(F.col("parent_id").isNotNull()).select(
        F.col("parent_id").alias("message_id")
    ).distinct().withColumn("__replied", F.lit(True))
    parents = messages.select(F.col("message_id").alias("parent_id"), F.col("author_id").alias("__to"))
    counts = (
        mine.join(replied, "message_id", "left")
        .groupBy("author_id")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("inbound")).alias("inbound"),
            F.count_if(~F.col("inbound")).alias("outbound"),
            F.count("parent_id").alias("with_parent"),
            F.count("__replied").alias("with_response"),
        )
    )
    # distinct pairs first: an author with a third of all rows is reduced in every task
    customers = (
        mine.filter(F.col("parent_id").isNotNull())
        .select("author_id", "parent_id")
        .distinct()
        .join(parents, "parent_id")
        .filter(F.col("__to") != F.col("author_id"))
        .select("author_id", "__to")
        .distinct()
        .groupBy("author_id")
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    return counts.join(customers, "author_id", "left").withColumn(
        "customers", F.coalesce(F.col("customers"), F.lit(0)).cast("long")
    )


def chain_stats(chains: DataFrame, multi_turn: int = 4, long_chain: int = 6) -> DataFrame:
    """Per brand: number of chains, mean and upper-median length, share of long ones."""
    levels = chains.groupBy("author_id", "length").agg(F.count(F.lit(1)).alias("n"))
    many = F.sum(F.when(F.col("length") >= multi_turn, F.col("n")).otherwise(0))
    longest = F.sum(F.when(F.col("length") >= long_chain, F.col("n")).otherwise(0))
    return running_levels(levels, "length", ["author_id"]).groupBy("author_id").agg(
        F.sum("n").alias("chains"),
        (F.sum(F.col("length") * F.col("n")) / F.sum("n")).alias("mean_length"),
        median_of("length", "upper").alias("median_length"),
        (many / F.sum("n")).alias("multi_turn_share"),
        (longest / F.sum("n")).alias("long_share"),
    )


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows")).orderBy(label)
