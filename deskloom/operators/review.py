"""Golden labels and review tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.functions import lexicon as lex

MAX_OVERRIDES = 100_000
STATUS = "human_approved_model_assisted"


def apply_overrides(
    df: DataFrame,
    overrides: DataFrame,
    medium_confidence: Sequence[str] = (),
    id_col: str = "case_id",
    prelabel: str = "prelabel_intent",
    status: str = STATUS,
) -> DataFrame:
    """``final_intent`` is the reviewer's label where there is one, else the prelabel.

    ``overrides`` (id, label) is joined by id; Spark broadcasts it when it is small.
    """
    labels = overrides.select(F.col(id_col), F.col("label").alias("__label"))
    out = df.join(labels, id_col, "left").withColumn("final_intent", F.coalesce("__label", prelabel)).drop("__label")
    medium = F.col(id_col).isin(*medium_confidence) if medium_confidence else F.lit(False)
    return out.withColumn("intent_confidence", F.when(medium, "medium").otherwise("high")).withColumn(
        "annotation_status", F.lit(status)
    )


def overrides_table(spark, labels: Mapping[str, str], id_col: str = "case_id") -> DataFrame:
    if len(labels) > MAX_OVERRIDES:
        raise ValueError("pass a large set of overrides as a DataFrame")
    return spark.createDataFrame(list(labels.items()), f"{id_col} string, label string")


def label_changes(df: DataFrame, before: str = "prelabel_intent", after: str = "final_intent") -> DataFrame:
    return df.filter(~F.col(before).eqNullSafe(F.col(after)))


HUMAN_COLUMNS = [f"human_{d}" for d in lex.SCORE_DIMENSIONS] + [
    "human_overall_acceptable",
    "human_escalation_appropriate",
    "human_reason",
]


def human_review(cases: DataFrame, judged: DataFrame, keep: Sequence[str], id_col: str = "case_id") -> DataFrame:
    """Cases the judge could score, with blank columns for a person's scores."""
    scored = judged.filter(F.col("relevance").isNotNull()).select(id_col)
    return cases.join(scored, id_col, "left_semi").withColumns({c: F.lit("") for c in HUMAN_COLUMNS}).select(
        *keep, *HUMAN_COLUMNS
    )
