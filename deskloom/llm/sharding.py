"""Shards by balanced label propagation, in DataFrame operations only.

Documents with equal texts are linked. A label is a shard; it starts as a hash of the row. In
each round a group looks up how many of its rows each shard holds, and its rows elsewhere ask to
move to the shard that holds most. Requests from shard s to shard t are granted up to what t would
send to s in return; those beyond go into t's free capacity. Requests with the largest gain in
neighbours go first. Rows without links carry no cut edges and fill what remains, so that
the row counts of any two shards differ by one at most.

A group is a table of at most ``shards * CELLS`` cells (rows with the same first label), so a
group with a third of all rows is no heavier than others, and links are never listed.

Law ``rows``. A group larger than a shard is spread over as few shards as the quotas allow.

Defined results: a null text counts as an empty one, with size 8; a null doc_id is a row like
others; rows that repeat a doc_id are placed one by one; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskloom.llm.common import gapless_rank, pick
from deskloom.session import cut_lineage

CELLS = 8
ROUNDS = 8
#: A shard is asked for while it can take this part of its capacity.
ROOMY = 8
GRANT_BUCKETS = 256


def _capacity(rows: int, shards: int) -> Column:
    """Rows that a shard takes: the first ``rows % shards`` shards take one more."""
    return F.lit(rows // shards) + (F.col("shard") < rows % shards).cast("long")


def _spare(state: DataFrame, rows: int, shards: int) -> DataFrame:
    """(shard, spare): rows that linked documents may still add; one row per shard."""
    load = state.groupBy("shard").agg(F.sum("n").alias("load"))
    every = state.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    free = _capacity(rows, shards) - F.coalesce("load", F.lit(0))
    return every.join(load, "shard", "left").select("shard", F.greatest(free, F.lit(0)).alias("spare"))


def _requests(state: DataFrame, spare: DataFrame, least: int) -> DataFrame:
    """(digest, cell, n, source, shard, gain): cells that would rather be where their group has
    most rows, among the shards with at least ``least`` free rows (any, where none has them); of
    equal counts a hash of group and shard decides."""
    roomy = spare.select("shard", (F.col("spare") >= least).alias("roomy"))
    held = state.groupBy("digest", "shard").agg(F.sum("n").alias("held")).join(roomy, "shard")
    held = held.withColumn("lot", F.xxhash64("digest", "shard"))
    rank = F.struct("held", "roomy", "lot", F.col("shard").alias("to"))
    best = held.filter("roomy").groupBy("digest").agg(F.max(rank).alias("best"))
    return (
        state.join(held, ["digest", "shard"])
        .join(best, "digest")
        .filter(F.col("best") > rank)
        .select(
            "digest",
            "cell",
            "n",
            F.col("shard").alias("source"),
            F.col("best.to").alias("shard"),
            (F.col("best.held") - F.col("held") + F.col("n")).alias("gain"),
        )
    )


def _granted(requests: DataFrame, spare: DataFrame) -> DataFrame:
    """The requests that the quotas allow."""
    flows = requests.groupBy("source", "shard").agg(F.sum("n").alias("wanted"))
    back = flows.select(F.col("shard").alias("source"), F.col("source").alias("shard"), F.col("wanted").alias("back"))
    level = F.floor(F.log2(F.col("gain") + 1)).cast("int")
    lined = requests.withColumn("level", level).withColumn("part", F.pmod(F.xxhash64("digest", "cell"), F.lit(GRANT_BUCKETS)))
    keys = ["source", "shard", "level", "part"]
    first, order = Window.unboundedPreceding, [F.col("level").desc(), "part"]
    swaps = Window.partitionBy("source", "shard").orderBy(*order).rowsBetween(first, Window.currentRow)
    fills = Window.partitionBy("shard", "swapped").orderBy(*order, "source").rowsBetween(first, Window.currentRow)
    open_buckets = (
        lined.groupBy(*keys)
        .agg(F.sum("n").alias("asked"))
        .join(back, ["source", "shard"], "left")
        .withColumn("swapped", F.sum("asked").over(swaps) <= F.coalesce("back", F.lit(0)))
        .join(spare, "shard")
        .withColumn("filled", F.sum("asked").over(fills) <= F.col("spare"))
        .filter(F.col("swapped") | F.col("filled"))
        .select(*keys)
    )
    return lined.join(open_buckets, keys, "left_semi").select("digest", "cell", F.col("shard").alias("to"))


def shard_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 24,
    rounds: int = ROUNDS,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per row."""
    text = F.coalesce("text", F.lit(""))
    base = cut_lineage(
        pick(docs, doc_id=id_col, text=text_col).select(
            F.monotonically_increasing_id().alias("row_id"),
            "doc_id",
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        )
    )
    base = base.withColumn("cell", F.pmod(F.xxhash64("row_id", "doc_id"), F.lit(shards * CELLS)).cast("int"))
    rows = base.count()

    cells = cut_lineage(base.groupBy("digest", "cell").agg(F.count(F.lit(1)).alias("n")))
    linked = cells.groupBy("digest").agg(F.sum("n").alias("rows")).filter(F.col("rows") > 1).select("digest")
    state = cut_lineage(
        cells.join(linked, "digest").select("digest", "cell", "n", (F.col("cell") % shards).alias("shard"))
    )
    for _ in range(rounds):
        spare = cut_lineage(_spare(state, rows, shards))
        most = spare.agg(F.max("spare")).first()[0] or 0
        requests = cut_lineage(_requests(state, spare, min(most, max(1, rows // shards // ROOMY))))
        granted = cut_lineage(_granted(requests, spare))
        if granted.isEmpty():
            break
        state = cut_lineage(
            state.join(granted, ["digest", "cell"], "left").select(
                "digest", "cell", "n", F.coalesce("to", "shard").alias("shard")
            )
        )

    placed = base.join(state.drop("n"), ["digest", "cell"], "left").drop("digest", "cell")
    placed = cut_lineage(placed)
    settled = cut_lineage(
        gapless_rank(
            placed.filter(F.col("shard").isNotNull()), ["shard"], F.xxhash64("row_id"), ["row_id"], "rank"
        ).withColumn("stays", F.col("rank") < _capacity(rows, shards))
    )
    kept = settled.filter("stays").drop("rank", "stays")
    over = settled.filter("NOT stays").drop("rank", "stays")
    free = placed.filter(F.col("shard").isNull()).unionByName(over).drop("shard")
    taken = {r["shard"]: r["count"] for r in kept.groupBy("shard").count().collect()}
    ends, end = [], 0
    for shard in range(shards):
        end += rows // shards + (shard < rows % shards) - taken.get(shard, 0)
        ends.append(end)
    filled = gapless_rank(free, [], F.xxhash64("row_id"), ["row_id"], "rank")
    full = F.array(*[F.lit(e).cast("long") for e in ends])
    filled = filled.withColumn("shard", F.size(F.filter(full, lambda e: e <= F.col("rank"))).cast("int")).drop("rank")
    whole = cut_lineage(kept.unionByName(filled))
    return gapless_rank(whole, ["shard"], F.xxhash64("row_id"), ["row_id"], "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
