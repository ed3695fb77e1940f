"""Schemas, scans and adapters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.functions import text as tx

# Message table. created_at is text as delivered ("Thu Nov 23 23:20:17 +0000 2017").
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("tweet_id", T.StringType()),
        T.StructField("author_id", T.StringType()),
        T.StructField("inbound", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("response_tweet_id", T.StringType()),
        T.StructField("in_response_to_tweet_id", T.StringType()),
    ]
)
GOLDEN_SCHEMA = "case_id string, customer_text string, prelabel_intent string, support_reply string, final_intent string, intent_confidence string, annotation_status string"
EVIDENCE_SCHEMA = "case_id string, gold_intent string, customer_text string, rank int, similarity double, historical_customer string, historical_reply string, response_type string, relevant string, actionable string, safe_to_ground string, annotation_notes string"
PREDICTION_SCHEMA = "case_id string, customer_text string, gold_intent string, predicted_intent string, intent_correct boolean, should_escalate boolean, escalation_reason string, reply string, evidence_available boolean, evidence_selected boolean, selected_similarity double, selected_response_type string"
SCORE_SCHEMA = "case_id string, relevance double, helpfulness double, grounding double, non_hallucination double, tone double, overall_acceptable string, escalation_appropriate string, reason string"


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV (header, quoted text may span lines, a leading BOM is ignored) or parquet, by suffix."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    if schema is None:
        raise ValueError("a CSV scan needs an explicit schema")
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )


#: The tables that people and judges fill in, by kind.
SHEETS = {"golden": GOLDEN_SCHEMA, "evidence": EVIDENCE_SCHEMA, "predictions": PREDICTION_SCHEMA, "scores": SCORE_SCHEMA}


def sheet(df: DataFrame, kind: str) -> DataFrame:
    """``df`` in the columns of a kind of sheet, in their order; a column it lacks is left blank."""
    fields = T.StructType.fromDDL(SHEETS[kind])
    held = {c: F.col(c) for c in df.columns}
    return df.select(*[held.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def read_sheet(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A golden, evidence, prediction or score table, as CSV or parquet. Columns of a CSV are taken
    by name, whatever their order, and all must be there."""
    if path.rstrip("/").endswith(".parquet"):
        return sheet(require_columns(read_table(spark, path), T.StructType.fromDDL(SHEETS[kind]).names), kind)
    names = spark.read.option("header", True).csv(path).columns  # the header alone
    text = T.StructType([T.StructField(n.lstrip("\ufeff"), T.StringType()) for n in names])
    return sheet(require_columns(read_table(spark, path, text), T.StructType.fromDDL(SHEETS[kind]).names), kind)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return typed_messages(read_table(spark, path, MESSAGE_SCHEMA))


def parse_created_at(created: F.Column) -> F.Column:
    """Weekday-first timestamps; the weekday name is skipped because it is redundant."""
    return F.try_to_timestamp(F.substring(created, 5, 40), F.lit("MMM dd HH:mm:ss Z yyyy"))


def typed_messages(raw: DataFrame) -> DataFrame:
    """Delivered columns to the engine's message table."""
    return raw.select(
        tx.normalize_id(F.col("tweet_id")).alias("message_id"),
        F.col("author_id").cast("string").alias("author_id"),
        (F.lower(F.col("inbound").cast("string")) == "true").alias("inbound"),
        parse_created_at(F.col("created_at")).alias("created_at"),
        F.col("text"),
        F.nullif(tx.normalize_id(F.col("response_tweet_id")), F.lit("")).alias("response_id"),
        F.nullif(tx.normalize_id(F.col("in_response_to_tweet_id")), F.lit("")).alias("parent_id"),
    )


def messages_from_turns(turns: DataFrame) -> DataFrame:
    """Conversation turns as messages: a turn answers the turn before it and the role is the
    author. One narrow projection, no shuffle."""
    turn_id = F.concat_ws("-", F.col("conv_id"), F.col("turn"))
    return turns.select(
        turn_id.alias("message_id"),
        F.col("role").alias("author_id"),
        (F.col("role") != "assistant").alias("inbound"),
        F.timestamp_seconds(F.col("turn").cast("long")).alias("created_at"),
        F.col("text"),
        F.when(F.col("turn") > 0, F.concat_ws("-", F.col("conv_id"), F.col("turn") - 1)).alias("parent_id"),
    )


SMALL_SPLITS = 16


def spread(df: DataFrame) -> DataFrame:
    """Rows over a few cores when the scan has fewer splits than that (one small file). At most
    ``SMALL_SPLITS`` splits are ever dealt anew; a larger table is left as it is."""
    cores = min(SMALL_SPLITS, df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fail on the driver, before any job runs, when a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; present: {df.columns}")
    return df


def first_present(df: DataFrame, candidates: Sequence[str]) -> str:
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"none of {list(candidates)} among {df.columns}")
