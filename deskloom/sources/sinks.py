"""Writers and review tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REVIEW_COLUMNS = [
    "final_intent",
    "intent_confidence",
    "should_escalate",
    "escalation_reason_final",
    "expected_resolution_final",
    "review_notes_final",
]


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder of CSV parts in UTF-8. Quotes are doubled so text with newlines reads back."""
    df.write.mode(mode).option("header", True).option("escape", '"').option("encoding", "UTF-8").csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def review_queue(
    df: DataFrame, first: Sequence[str], blank: Sequence[str] = REVIEW_COLUMNS, last: Sequence[str] = ()
) -> DataFrame:
    """Columns for a reviewer to fill, placed between the ones to read and the ones to keep."""
    blanks = {c: F.lit("") for c in blank}
    return df.withColumns(blanks).select(*first, *blank, *last)
