"""Message files into a message table and the pairs of replies and parents, as they arrive.

Files come in any order, so a reply may come before the message that it answers. Every micro-batch
writes three folders of its own: its messages, the pairs that it completes, and the replies that
still wait for a parent. Pairs come from the new replies with all messages known so far, and from
the waiting replies with the new messages; so each pair is found once, in the batch that brings the
later of the two. A batch that is run again overwrites its folders and reads the waiting replies of
the one before it, so it does the same work: messages and pairs are there exactly once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from deskloom.functions import text as tx
from deskloom.session import child_folders, delete_folder
from deskloom.sources.tables import MESSAGE_SCHEMA, typed_messages
from deskloom.streaming.streams import ONCE

REPLY = "reply_id string, parent_id string, support_reply string"
PAIR = "reply_id string, message_id string, customer_id string, customer_text string, support_reply string"


def arriving_messages(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Typed messages from the CSV files of a folder, at most so many files a batch."""
    raw = (
        spark.readStream.schema(MESSAGE_SCHEMA)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    return typed_messages(raw)


class MessageTable:
    """messages, pairs and waiting replies of one brand under ``path``, a folder per batch."""

    def __init__(self, spark: SparkSession, path: str, brand: str):
        self.spark, self.path, self.brand = spark, path, brand

    def _batches(self, kind: str, before: int | None = None) -> list[int]:
        held = child_folders(self.spark, f"{self.path}/{kind}", "_SUCCESS")
        numbers = sorted(int(name.split("=")[1]) for name in held if name.startswith("batch="))
        return [n for n in numbers if before is None or n < before]

    def _read(self, kind: str, batches: list[int]) -> DataFrame | None:
        folders = [f"{self.path}/{kind}/batch={n}" for n in batches]
        return self.spark.read.parquet(*folders) if folders else None

    def _write(self, df: DataFrame, kind: str, batch_id: int) -> DataFrame:
        folder = f"{self.path}/{kind}/batch={batch_id}"
        df.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        new = self._write(batch, "messages", batch_id)
        replies = new.filter((F.col("author_id") == self.brand) & F.col("parent_id").isNotNull()).select(
            F.col("message_id").alias("reply_id"), "parent_id", F.col("text").alias("support_reply")
        )
        older = self._read("messages", self._batches("messages", batch_id))
        waited = self._read("waiting", self._batches("waiting", batch_id)[-1:])
        known = new if older is None else older.unionByName(new)
        waited = self.spark.createDataFrame([], REPLY) if waited is None else waited
        found = replies.join(self._parents(known), "parent_id").unionByName(waited.join(self._parents(new), "parent_id"))
        kept = found.filter(
            (F.col("customer_id") != self.brand) & F.col("customer_text").isNotNull() & F.col("support_reply").isNotNull()
        )
        self._write(
            kept.select(
                "reply_id",
                F.col("parent_id").alias("message_id"),
                "customer_id",
                tx.strip(F.col("customer_text")).alias("customer_text"),
                tx.strip(F.col("support_reply")).alias("support_reply"),
            ),
            "pairs",
            batch_id,
        )
        there = known.select(F.col("message_id").alias("parent_id"))
        still = replies.join(there, "parent_id", "left_anti").unionByName(
            waited.join(new.select(F.col("message_id").alias("parent_id")), "parent_id", "left_anti")
        )
        self._write(still.select("reply_id", "parent_id", "support_reply"), "waiting", batch_id)
        # the batch before this one may be read by a retry of this one; those before it never again
        for n in self._batches("waiting", batch_id)[:-1]:
            delete_folder(self.spark, f"{self.path}/waiting/batch={n}")

    @staticmethod
    def _parents(messages: DataFrame) -> DataFrame:
        return messages.select(
            F.col("message_id").alias("parent_id"),
            F.col("author_id").alias("customer_id"),
            F.col("text").alias("customer_text"),
        )

    def messages(self) -> DataFrame | None:
        return self._read("messages", self._batches("messages"))

    def pairs(self) -> DataFrame:
        """What ``threads.pair_replies`` finds in all messages that have arrived."""
        found = self._read("pairs", self._batches("pairs"))
        return self.spark.createDataFrame([], PAIR) if found is None else found

    def waiting(self) -> DataFrame:
        """Replies whose parent has not arrived."""
        found = self._read("waiting", self._batches("waiting")[-1:])
        return self.spark.createDataFrame([], REPLY) if found is None else found


def start_ingest(
    stream: DataFrame, path: str, checkpoint: str, brand: str, trigger: Mapping[str, object] = ONCE
) -> StreamingQuery:
    def handle(batch: DataFrame, batch_id: int) -> None:
        MessageTable(batch.sparkSession, path, brand).add(batch, batch_id)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle).trigger(**trigger).start()
