"""The batch operators on arriving files."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from deskloom.functions.policy import Policy
from deskloom.operators.tfidf import TfidfIndex
from deskloom.plans.triage import triage
from deskloom.session import scratch_scope
from deskloom.streaming.count_table import COMPACT_EVERY, CountTable


def arriving_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 100, fmt: str = "parquet", name_glob: str | None = None
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(path)


def running_counts(stream: DataFrame, author: str) -> DataFrame:
    """Rows per author so far; the state is one counter per author."""
    return stream.groupBy(author).agg(F.count(F.lit(1)).alias("messages"))


#: Work through what is there, then stop. Others run on: {"processingTime": "1 minute"}.
ONCE = MappingProxyType({"availableNow": True})


def start_counts(
    counts: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] = ONCE,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Keep the counts as a ``CountTable``: every micro-batch appends the changed counters, replays
    count once; ``latest_counts`` reads the newest per key."""
    keys = [c for c in counts.columns if c != "messages"]

    def save(batch: DataFrame, batch_id: int) -> None:
        CountTable(batch.sparkSession, path, keys, compact_every=compact_every).append(batch, batch_id)

    return (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(save)
        .trigger(**trigger)
        .start()
    )


def latest_counts(spark: SparkSession, path: str, keys: list[str], only: dict | None = None) -> DataFrame:
    return CountTable(spark, path, keys).read(only)


def without_repeats(stream: DataFrame, id_col: str, time_col: str, delay: str) -> DataFrame:
    """Messages delivered more than once within ``delay`` of event time pass once; the state holds
    the ids of that span only."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])


def start_batches(
    stream: DataFrame,
    make: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    after: Callable[[DataFrame, int], None] | None = None,
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """``make`` of each micro-batch as a table of its own. A batch overwrites its own folder, so one
    that is run again, because the stream stopped between its write and its commit, leaves one copy.
    ``after`` gets the written rows; it may see a batch twice."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            make(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if after is not None:
            after(batch.sparkSession.read.parquet(f"{path}/batch={batch_id}"), batch_id)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle).trigger(**trigger).start()


def start_triage(
    stream: DataFrame,
    index: TfidfIndex,
    cases: DataFrame,
    policy: Policy,
    path: str,
    checkpoint: str,
    after: Callable[[DataFrame, int], None] | None = None,
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Triage each micro-batch of (query_id, customer_text) against a fixed index."""
    return start_batches(stream, lambda batch: triage(batch, index, cases, policy), path, checkpoint, after, trigger)
