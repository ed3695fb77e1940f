"""Connected components of a table of links by iterative joins."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.session import cut_lineage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that occurs in a link; the component is the smallest
    node reachable. Each round hooks every node to its smallest neighbour, shortens these hooks
    once and contracts the links, so that what is joined shrinks from round to round. Links that
    touch a null are ignored."""
    links = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = cut_lineage(links.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")).distinct())
    every = links.select(F.col(a).alias("node")).unionByName(links.select(F.col(b).alias("node")))
    labels = cut_lineage(every.distinct().withColumn("component", F.col("node")))
    while not edges.isEmpty():
        # a node that is nowhere the larger end keeps its place
        hooks = cut_lineage(edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("to")))
        onward = hooks.select(F.col("node").alias("to"), F.col("to").alias("further"))
        hooks = cut_lineage(hooks.join(onward, "to", "left").select("node", F.coalesce("further", "to").alias("to")))

        def moved(frame: DataFrame, column: str, hooks: DataFrame = hooks) -> DataFrame:
            named = hooks.withColumnRenamed("node", column)
            return frame.join(named, column, "left").withColumn(column, F.coalesce("to", column)).drop("to")

        labels = cut_lineage(moved(labels, "component"))
        ends = moved(moved(edges, "low"), "high").filter("low <> high")
        edges = cut_lineage(ends.select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high")).distinct())
    return labels


def spanning(pairs: Iterable[tuple[int, int]], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """The pairs without those that close a circle; it forgets after ``most`` nodes."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        if x != y:
            parent[x] = y
            yield a, b
        if len(parent) > most:
            parent.clear()
