"""Exact duplicates with the heavy hitters split off.

Misra-Gries summaries of the text digests, one per task and merged, name every digest that may
hold more than 2/(counters + 1) of the rows. These few are counted exactly, their winners are
broadcast and their rows are settled where they were read. The other digests are shuffled; none
of them can hold more than that share of the rows.

Defined results: a null text counts as empty; a null doc_id ranks below every other id; rows that
repeat a doc_id and a text are copies of each other and exactly one stays; an empty table gives an
empty result; other columns are never looked at, and ``drop_exact_duplicates`` hands them on.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskloom.llm.common import fresh, pick
from deskloom.session import cut_lineage

COUNTERS = 1024


def _shrink(counters: dict[bytes, int], most: int) -> dict[bytes, int]:
    """Back to ``most`` counters: the next largest count is taken from all of them."""
    if len(counters) <= most:
        return counters
    cut = sorted(counters.values(), reverse=True)[most]
    return {k: v - cut for k, v in counters.items() if v > cut}


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them each with over 2/(counters + 1) of the rows."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        for batch in batches:
            for entry in pc.value_counts(batch.column(0)):
                key = entry["values"].as_py()
                kept[key] = kept.get(key, 0) + entry["counts"].as_py()
            kept = _shrink(kept, counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(kept), pa.binary()), pa.array(list(kept.values()), pa.int64())], ["sha", "n"]
        )

    merged = digests.select("sha").mapInArrow(summary, "sha binary, n bigint").groupBy("sha").agg(F.sum("n").alias("n"))
    return merged.orderBy(F.col("n").desc(), "sha").limit(counters).select("sha")


def _settle(digests: DataFrame, counters: int) -> DataFrame:
    """(row_id, doc_id, sha, keep_id, group_size, kept) for (row_id, doc_id, sha)."""
    best = F.max(F.struct("doc_id", "row_id"))
    candidates = cut_lineage(frequent_digests(digests, counters))
    winners = cut_lineage(
        digests.join(F.broadcast(candidates), "sha", "left_semi")
        .groupBy("sha")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    )
    tagged = digests.join(F.broadcast(winners), "sha", "left")
    same = Window.partitionBy("sha")
    rest = (
        tagged.filter(F.col("group_size").isNull())
        .withColumn("group_size", F.count(F.lit(1)).over(same))
        .withColumn("best", best.over(same))
    )
    settled = tagged.filter(F.col("group_size").isNotNull()).unionByName(rest)
    return settled.select(
        "row_id",
        "doc_id",
        "sha",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("best.row_id") == F.col("row_id")).alias("kept"),
    )


def _digest(text: str) -> F.Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256. The row with the
    largest id of each group of equal texts is kept. The text is read once; the digests are
    written, so that every row keeps its number."""
    digests = cut_lineage(
        pick(docs, doc_id=id_col, text=text_col).select(
            F.monotonically_increasing_id().alias("row_id"), "doc_id", _digest("text").alias("sha")
        )
    )
    return _settle(digests, counters).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """The kept rows of ``docs`` with all their columns."""
    row = fresh(docs, "__row")
    numbered = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
    digests = cut_lineage(
        pick(numbered, row_id=row, doc_id=id_col, text=text_col).select("row_id", "doc_id", _digest("text").alias("sha"))
    )
    gone = _settle(digests, counters).filter(~F.col("kept")).select(F.col("row_id").alias(row))
    return numbered.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
