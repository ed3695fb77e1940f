"""Helpers that several of these operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


ARROW_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that other columns of the
    input can carry any name."""
    return df.select(*[df[f"`{source}`"].alias(name) for name, source in columns.items()])


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a finished action go at once, and Arrow batches are small
    enough for rows that hold whole sets. For operators that write their intermediate tables, so
    that nothing later reads an earlier action's shuffle."""
    wanted = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(ARROW_ROWS),
    }
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def gapless_rank(
    df: DataFrame,
    groups: Sequence[str],
    key: Column,
    order: Sequence[str],
    out: str,
    rows_per_bucket: int = 50_000,
    least: int = 64,
) -> DataFrame:
    """Add ``out``: 0, 1, 2 … within each group, without one task per group.

    A row's bucket is the hash ``key`` modulo a number that grows with the table. Rows are
    numbered inside (group, bucket) by ``order`` and shifted by the rows in the group's
    buckets before it; that table has one row per group and bucket.
    """
    rows = df.count()
    buckets = max(least, -(-rows // rows_per_bucket))
    bucket, inside, before = (fresh(df, f"__{x}") for x in ("bucket", "inside", "before"))
    keyed = df.withColumn(bucket, F.pmod(key, F.lit(buckets)).cast("int"))
    keys = [*groups, bucket]
    ahead = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        keyed.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(inside))
        .withColumn(before, F.coalesce(F.sum(inside).over(ahead), F.lit(0)))
        .drop(inside)
    )
    numbered = keyed.withColumn(inside, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    joined = numbered.join(sizes, keys)
    return joined.withColumn(out, (F.col(inside) + F.col(before)).cast("long")).drop(bucket, inside, before)
