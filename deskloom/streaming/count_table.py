"""Running counts kept as a table of generations.

Every micro-batch writes the counters that it changed to a folder of its own, overwritten on a
retry. From time to time the newest generation and the batches after it are merged into the next
generation, one row per key in buckets of keys, and what the one before it needed is deleted. A
generation counts once its writer has committed it, so a reader never sees half of one. Reading
takes the newest generation and the batches after it: its cost hangs on the keys and on
``compact_every``, not on the number of batches that ever ran.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskloom.session import child_folders, delete_folder

BUCKETS = 16
COMPACT_EVERY = 10


class CountTable:
    """The newest counters of ``value`` by ``keys`` under ``path``. A counter never falls."""

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], value: str = "messages", compact_every: int = COMPACT_EVERY, buckets: int = BUCKETS
    ):
        self.spark, self.path, self.keys, self.value = spark, path, list(keys), value
        self.compact_every, self.buckets = compact_every, buckets

    def _numbers(self, kind: str) -> list[int]:
        """Committed folders of a kind, by number."""
        return sorted(int(name.split("=")[1]) for name in child_folders(self.spark, self.path, "_SUCCESS") if name.startswith(f"{kind}="))

    def generation(self) -> int:
        """The last batch that the newest generation holds; -1 before the first."""
        return max(self._numbers("upto"), default=-1)

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Store the changed counters of a batch. A batch that a generation already holds is a replay
        and changes nothing."""
        if batch_id <= self.generation():
            return
        batch.select(*self.keys, self.value).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        if len([n for n in self._numbers("batch") if n > self.generation()]) >= self.compact_every:
            self.compact(batch_id)

    def compact(self, upto: int) -> None:
        """Write the generation that holds all batches up to ``upto``, then delete what only the
        generation before the last one needed; readers of the last one go on undisturbed."""
        last = self.generation()
        rows = self.read().withColumn("bucket", self._bucket()).repartition(self.buckets, "bucket")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/upto={upto}")
        for kind in ("batch", "upto"):
            for name in child_folders(self.spark, self.path):
                if name.startswith(f"{kind}=") and int(name.split("=")[1]) < last + (kind == "batch"):
                    delete_folder(self.spark, f"{self.path}/{name}")

    def read(self, only: dict | None = None) -> DataFrame:
        """One row per key. ``only`` names one key's values; of the generation just its bucket is read."""
        last = self.generation()
        folders = [f"{self.path}/batch={n}" for n in self._numbers("batch") if n > last]
        found = None
        if last >= 0:
            found = self.spark.read.parquet(f"{self.path}/upto={last}")
            if only:
                place = self.spark.range(1).select(*[F.lit(only[k]).cast(found.schema[k].dataType).alias(k) for k in self.keys])
                found = found.filter(F.col("bucket") == place.select(self._bucket()).first()[0])
            found = found.drop("bucket")
        if folders:
            changed = self.spark.read.parquet(*folders)
            found = changed if found is None else found.unionByName(changed)
        if found is None:
            raise ValueError(f"no counts under {self.path} yet")
        for k in self.keys if only else ():
            found = found.filter(F.col(k).eqNullSafe(F.lit(only[k])))
        return found.groupBy(*self.keys).agg(F.max(self.value).alias(self.value))
