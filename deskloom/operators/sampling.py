"""Reproducible samples: rows are ordered by a hash of id and seed, never by a random draw,
so a result does not depend on partitioning, retries or row order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskloom.operators.skew import hash_rank_key, rank_within, top_within

KEY = "__hash"


def random_sample(df: DataFrame, ids: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows; Spark keeps n rows per task and merges them, without a full sort."""
    return df.withColumn(KEY, hash_rank_key(ids, seed)).orderBy(KEY).limit(n).drop(KEY)


def shuffled(df: DataFrame, ids: Sequence[str], seed: int = 42) -> DataFrame:
    return df.withColumn(KEY, hash_rank_key(ids, seed)).orderBy(KEY).drop(KEY)


def quota_of(stratum: Column, quotas: Mapping[str, int] | int) -> Column:
    if isinstance(quotas, int):
        return F.lit(quotas)
    chain = None
    for name, n in quotas.items():
        hit = stratum == name
        chain = F.when(hit, F.lit(n)) if chain is None else chain.when(hit, F.lit(n))
    return F.lit(0) if chain is None else chain.otherwise(F.lit(0))


def stratified_sample(
    df: DataFrame, stratum: str, ids: Sequence[str], quotas: Mapping[str, int] | int, seed: int = 42
) -> DataFrame:
    """Up to the quota of rows per stratum; a stratum that is too small is taken whole.

    The largest quota is a constant of the plan, so every task cuts each stratum to that many
    rows before anything is shuffled.
    """
    most = quotas if isinstance(quotas, int) else max(quotas.values(), default=0)
    cut = top_within(df.withColumn(KEY, hash_rank_key(ids, seed)), [stratum], [F.col(KEY)], most, out="__place")
    return cut.filter(F.col("__place") <= quota_of(F.col(stratum), quotas)).drop("__place", KEY)


def top_up(
    selected: DataFrame, pool: DataFrame, ids: Sequence[str], target: int, have: int, seed: int = 123
) -> DataFrame:
    """Fill ``selected`` (``have`` rows) from the rest of ``pool`` up to ``target`` rows."""
    if have >= target:
        return selected
    rest = pool.join(selected.select(*ids), list(ids), "left_anti")
    return selected.unionByName(random_sample(rest, ids, target - have, seed))


def numbered(df: DataFrame, order: Sequence[Column], prefix: str = "CASE", out: str = "case_id", width: int = 3) -> DataFrame:
    """``CASE-001`` ids in a fixed order. For samples: one task numbers all rows."""
    place = F.row_number().over(Window.orderBy(*order))
    return df.withColumn(out, F.format_string(f"{prefix}-%0{width}d", place))


def stratum_report(
    pool: DataFrame, selected: DataFrame, stratum: str, quotas: Mapping[str, int]
) -> DataFrame:
    """Available, requested and selected rows for every stratum that has a quota."""
    spark = pool.sparkSession
    asked = spark.createDataFrame(list(quotas.items()), f"{stratum} string, requested long")
    available = pool.groupBy(stratum).agg(F.count(F.lit(1)).alias("available"))
    taken = selected.groupBy(stratum).agg(F.count(F.lit(1)).alias("selected"))
    return (
        asked.join(available, stratum, "left")
        .join(taken, stratum, "left")
        .na.fill(0, ["available", "selected"])
        .select(stratum, "available", "requested", "selected")
    )


def stratified_split(
    df: DataFrame, stratum: str, ids: Sequence[str], test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: within every class the first ``test_share`` of the hash order. Classes
    are ranked bucket by bucket, so a class with a third of all rows is not one task."""
    ranked = rank_within(df.withColumn(KEY, hash_rank_key(ids, seed)), [stratum], KEY, out="__place")
    limit = F.floor(F.col("group_rows") * F.lit(test_share) + F.lit(0.5))
    return ranked.withColumn("is_test", F.col("__place") <= limit).drop("__place", "group_rows", KEY)


def calibration_mix(
    predictions: DataFrame, per_slice: int = 10, total: int = 30, id_col: str = "case_id", seed: int = 42
) -> DataFrame:
    """Some automatic, some escalated and some wrongly classified cases, each once, topped up
    from the rest to ``total``. ``slice`` says where a case came from."""
    slices = [
        (1, "auto", ~F.col("should_escalate")),
        (2, "escalated", F.col("should_escalate")),
        (3, "wrong", ~F.col("intent_correct")),
    ]
    picked = None
    for place, name, condition in slices:
        part = (
            predictions.filter(condition)
            .orderBy(id_col)
            .limit(per_slice)
            .withColumn("slice_no", F.lit(place))
            .withColumn("slice", F.lit(name))
        )
        picked = part if picked is None else picked.unionByName(part)
    # at most 3 * per_slice rows from here on
    first = Window.partitionBy(id_col).orderBy("slice_no")
    picked = picked.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")
    rest = (
        predictions.join(picked.select(id_col), id_col, "left_anti")
        .withColumn(KEY, hash_rank_key([id_col], seed))
        .orderBy(KEY)
        .limit(total)
        .drop(KEY)
        .withColumn("slice_no", F.lit(4))
        .withColumn("slice", F.lit("extra"))
    )
    both = picked.unionByName(rest).withColumn(KEY, hash_rank_key([id_col], seed))
    order = Window.orderBy("slice_no", F.when(F.col("slice_no") < 4, F.col(id_col).cast("string")).otherwise(F.col(KEY)))
    return (
        both.withColumn("__n", F.row_number().over(order))
        .filter(F.col("__n") <= total)
        .drop("__n", KEY, "slice_no")
    )
