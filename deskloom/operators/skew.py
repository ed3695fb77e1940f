"""Building blocks that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_HOT_KEYS = 10_000
ROWS_PER_TASK = 1_000_000


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, rows: int | None = None) -> list[tuple]:
    """(key, pieces) of the keys with more than ``rows_per_task`` rows, or, in a very large table,
    with more than 1/MAX_HOT_KEYS of the rows: so every such key is on the list, and at most
    MAX_HOT_KEYS rows go to the driver. One count, unless the caller knows ``rows``, and one
    aggregate over the key column alone, unless the whole table fits a task."""
    rows = df.count() if rows is None else rows
    if rows <= rows_per_task:
        return []
    rows_per_task = max(rows_per_task, rows // MAX_HOT_KEYS)
    heavy = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > rows_per_task)
    )
    return [(r[key], -(-r["n"] // rows_per_task)) for r in heavy.collect()]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    spread_by: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
    rows: int | None = None,
) -> DataFrame:
    """Join many rows of ``left``, of which there are ``rows``, to the one row of ``right`` with the
    same ``key``.

    The rows of a hot key are split into salted pieces by ``spread_by`` (a row's identity),
    and the one matching right row is repeated per piece. Without hot keys it is a plain join.
    """
    hot = hot_keys(left, key, rows_per_task, rows)
    if not hot:
        return left.join(right, key, how)
    kind = left.schema[key].dataType.simpleString()
    pieces = left.sparkSession.createDataFrame(hot, f"{key} {kind}, __pieces int")
    spread = F.pmod(F.xxhash64(*spread_by), F.col("__pieces")).cast("int")
    salted_left = (
        left.join(F.broadcast(pieces), key, "left")
        .withColumn("__salt", F.when(F.col("__pieces").isNull(), F.lit(0)).otherwise(spread))
        .drop("__pieces")
    )
    salted_right = (
        right.join(F.broadcast(pieces), key, "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__pieces"), F.lit(1)) - 1)))
        .drop("__pieces")
    )
    return salted_left.join(salted_right, [key, "__salt"], how).drop("__salt")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one with the smallest ``order`` columns (unique within a key).

    One aggregate whose minimum carries the other columns: the input is read once, and each
    task passes on a single row of a key, even of one that holds a third of all rows.
    Rows with a null key column form one group, as in SQL.
    """
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("__best"))
    return best.select(*[F.col(c) if c in keys else F.col("__best")[c].alias(c) for c in df.columns])


def hash_rank_key(ids: Sequence[str], seed: int) -> Column:
    """A reproducible pseudo-random sort key: the same on any partitioning and engine."""
    parts = [F.col(c).cast("string") for c in ids]
    return F.md5(F.concat_ws(":", *parts, F.lit(str(seed))))


def rank_within(
    df: DataFrame, groups: Sequence[str], sort_key: str, out: str = "rank_no", digits: int = 3
) -> DataFrame:
    """Rank rows of each group by a hexadecimal hash column, without one task per group.

    The first ``digits`` hex characters split a group into 16**digits buckets in sort order.
    Rows are numbered inside their bucket and shifted by the number of rows in the buckets
    before it; that table has at most 16**digits rows per group.
    """
    bucketed = df.withColumn("__bucket", F.substring(sort_key, 1, digits))
    sizes = bucketed.groupBy(*groups, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    order = Window.partitionBy(*groups).orderBy("__bucket")
    before = sizes.withColumn(
        "__before",
        F.coalesce(F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).withColumn("__total", F.sum("__n").over(Window.partitionBy(*groups)))
    inside = Window.partitionBy(*groups, "__bucket").orderBy(sort_key)
    keys = [*groups, "__bucket"]
    return (
        bucketed.withColumn("__inside", F.row_number().over(inside))
        .join(before.drop("__n"), keys)
        .withColumn(out, (F.col("__before") + F.col("__inside")).cast("long"))
        .withColumnRenamed("__total", "group_rows")
        .drop("__bucket", "__inside", "__before")
    )


def top_within(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int, out: str | None = None
) -> DataFrame:
    """First ``n`` rows per group. For n up to 1000 Spark cuts each map task's group to n rows
    before the shuffle; beyond that the cut is made here on a salted first pass."""
    name = out or "__rank"
    if n > 1000:
        salted = df.withColumn("__salt", F.pmod(F.xxhash64(F.struct("*")), F.lit(64)))
        first = Window.partitionBy(*groups, "__salt").orderBy(*order)
        df = salted.withColumn("__pre", F.row_number().over(first)).filter(F.col("__pre") <= n).drop(
            "__pre", "__salt"
        )
    window = Window.partitionBy(*groups).orderBy(*order)
    ranked = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return ranked if out else ranked.drop(name)


def running_levels(levels: DataFrame, value: str, groups: Sequence[str] = (), n: str = "n") -> DataFrame:
    """Add ``upto`` and ``total`` to a table of counts per distinct value.

    The window sees one row per level, never a group's raw rows, so it suits values with a
    bounded number of levels: lengths, or scores rounded to six decimals.
    """
    running = Window.partitionBy(*groups).orderBy(value)
    total = Window.partitionBy(*groups)
    return levels.withColumn("upto", F.sum(n).over(running)).withColumn("total", F.sum(n).over(total))


def median_of(value: str, mode: str = "mean") -> Column:
    """Exact median as an aggregate over ``running_levels``: the mean of the two middle rows,
    or with ``mode="upper"`` the row at position n // 2."""

    def at(position: Column) -> Column:
        return F.min(F.when(F.col("upto") >= position, F.col(value)))

    upper = at(F.floor(F.col("total") / 2) + 1)
    if mode == "upper":
        return upper
    return (at(F.floor((F.col("total") + 1) / 2)) + upper) / 2
