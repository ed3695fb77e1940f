"""Hard negatives by a secondary-sort shuffle.

Anchors meet all rows in blocks: a block of anchors is multiplied with a block of rows, and a pair
that may matter becomes one packed key of 29 bytes (anchor, descending score, kind, id) whose byte
order is the order wanted. ``repartitionAndSortWithinPartitions`` deals the keys by anchor and
sorts them, and one iterator per partition streams over them: a positive opens a window of scores,
each negative that arrives is emitted for every open window it falls into, and a window closes when
it is full. The iterator holds the open windows of one anchor, never an anchor's rows.

Blocks pre-aggregate. A first pass over the blocks finds each anchor's positives; the second knows
every window and passes on the first ``n_negatives`` of each window per block, which hold whatever
of the block can be among the first of all. So the shuffle carries a bounded number of keys per
(anchor, block), however many rows share a label.

Defined results: rows with a null id, label or vector or a null or non-finite component take no
part; shorter vectors count as padded with zeros; a repeated row counts once; an anchor's own id is
neither its positive nor its negative; rows of one id with different labels or vectors are anchors
of their own, told apart by a number inside the key; ties go to the smaller id; anchors without a positive, and
positives without a negative in their window, have no row; empty tables give an empty result; other
columns are ignored. A positive comes before negatives of equal score, so a window that holds its
own positive's score misses nothing. Components beyond the exact range are refused.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskloom.llm.common import pick
from deskloom.llm.vectors import floored, matrix, measure, usable
from deskloom.operators.skew import top_within
from deskloom.session import cut_lineage

ROWS_PER_BLOCK = 8192
ANCHORS_PER_BLOCK = 2048
BIAS = 1 << 63
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


@dataclass(frozen=True)
class Windows:
    """A negative fits a positive if low * positive <= 100 * negative <= high * positive."""

    n_positives: int = 5
    n_negatives: int = 10
    low: int = 30
    high: int = 90


def pack(anchor: int, variant: int, score: int, negative: bool, other: int) -> bytes:
    """A key whose byte order is anchor, descending score, positives first, id."""
    return struct.pack(">QIQBQ", anchor + BIAS, variant, BIAS - 1 - score, negative, other + BIAS)


def unpack_key(key: bytes) -> tuple[int, int, int, bool, int]:
    anchor, variant, score, negative, other = struct.unpack(">QIQBQ", key)
    return anchor - BIAS, variant, BIAS - 1 - score, bool(negative), other - BIAS


def stream_windows(keys: Iterator[bytes], spec: Windows) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Rows of the result from keys in order; holds the open windows of the current anchor."""
    current, opened = None, []
    seen = 0
    for key in keys:
        anchor, variant, score, negative, other = unpack_key(key)
        if (anchor, variant) != current:
            current, opened, seen = (anchor, variant), [], 0
        if not negative:
            if seen < spec.n_positives:
                seen += 1
                opened.append([other, score, 0])
            continue
        for window in opened:
            positive_id, positive, found = window
            if found < spec.n_negatives and spec.low * positive <= 100 * score <= spec.high * positive:
                window[2] = found + 1
                yield anchor, positive_id, found + 1, other, positive, score
        # scores only fall: a full window, or one whose lower end is passed, is closed
        opened = [w for w in opened if w[2] < spec.n_negatives and 100 * score >= spec.low * w[1]]


def _first(scores: np.ndarray, ids: np.ndarray, picks: np.ndarray, n: int) -> np.ndarray:
    """The n places among ``picks`` with the highest scores, ties to smaller ids."""
    if len(picks) > 4 * n:
        cut = np.partition(scores[picks], len(picks) - n)[len(picks) - n]
        picks = picks[scores[picks] >= cut]
    return picks[np.lexsort((ids[picks], -scores[picks]))[:n]]


def _blocked(rows: DataFrame, anchors: DataFrame, per_block: int, per_anchors: int):
    """Rows and anchors grouped so that each block of anchors meets each block of rows once. Blocks
    are dealt by a hash, so their sizes do not hang on labels or ids."""
    blocks = max(1, -(-rows.count() // per_block))
    shares = max(1, -(-anchors.count() // per_anchors))

    def spread(df: DataFrame, own: str, n: int, other: str, m: int):
        placed = df.withColumn(own, F.pmod(F.xxhash64("vec_id", "vec"), F.lit(n)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).groupBy("block", "share")

    return spread(rows, "block", blocks, "share", shares).cogroup(spread(anchors, "share", shares, "block", blocks))


def _positives(rows: DataFrame, anchors: DataFrame, dims: int, spec: Windows, per_block: int, per_anchors: int) -> DataFrame:
    """(anchor_id, variant, positive_id, positive_score): the first rows of the anchor's label."""

    def score(held: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if held.num_rows and asked.num_rows:
            ids, labels = np.asarray(held["vec_id"]), np.asarray(held["label"])
            by_label = {label: np.flatnonzero(labels == label) for label in np.unique(labels).tolist()}
            scores = matrix(asked["vec"].combine_chunks(), dims) @ matrix(held["vec"].combine_chunks(), dims).T
            columns = (asked[c].to_pylist() for c in ("vec_id", "variant", "label"))
            for i, (anchor, variant, label) in enumerate(zip(*columns)):
                same = by_label.get(label)
                if same is not None:
                    same = same[ids[same] != anchor]
                    best = _first(scores[i], ids, same, spec.n_positives)
                    out += [(anchor, variant, int(ids[j]), int(scores[i, j])) for j in best]
        names = ["anchor_id", "variant", "positive_id", "positive_score"]
        return pa.table({c: pa.array([x[n] for x in out], pa.int64()) for n, c in enumerate(names)})

    found = _blocked(rows, anchors, per_block, per_anchors).applyInArrow(
        score, "anchor_id bigint, variant bigint, positive_id bigint, positive_score bigint"
    )
    return top_within(found, ["anchor_id", "variant"], [F.col("positive_score").desc(), F.col("positive_id")], spec.n_positives)


def _candidates(rows: DataFrame, anchors: DataFrame, dims: int, spec: Windows, per_block: int, per_anchors: int) -> DataFrame:
    """(key): packed pairs of an anchor and each row of another label that is, within its block,
    among the first of one of the anchor's windows. ``anchors`` carry ``positives``, their scores."""

    def score(held: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[bytes] = []
        if held.num_rows and asked.num_rows:
            ids, labels = np.asarray(held["vec_id"]), np.asarray(held["label"])
            scores = matrix(asked["vec"].combine_chunks(), dims) @ matrix(held["vec"].combine_chunks(), dims).T
            columns = (asked[c].to_pylist() for c in ("vec_id", "variant", "label", "positives"))
            for i, (anchor, variant, label, positives) in enumerate(zip(*columns)):
                own = scores[i]
                other = (labels != label) & (ids != anchor)
                chosen: set[int] = set()
                for positive in set(positives):
                    fits = other & (100 * own >= spec.low * positive) & (100 * own <= spec.high * positive)
                    chosen.update(_first(own, ids, np.flatnonzero(fits), spec.n_negatives).tolist())
                out += [pack(anchor, variant, int(own[j]), True, int(ids[j])) for j in chosen]
        return pa.table({"key": pa.array(out, pa.binary())})

    return _blocked(rows, anchors, per_block, per_anchors).applyInArrow(score, "key binary")


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    scale: int = 256,
    spec: Windows = Windows(),
    id_col: str = "vec_id",
    label_col: str = "label",
    vec_col: str = "embedding",
    per_block: int = ROWS_PER_BLOCK,
    per_anchors: int = ANCHORS_PER_BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that
    ``is_anchor`` (over the column ``vec_id``) marks."""
    spark = df.sparkSession
    source = pick(df, vec_id=id_col, label=label_col, vec=vec_col)
    source = source.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vec")))
    rows = source.select(F.col("vec_id").cast("long").alias("vec_id"), "label", floored(F.col("vec"), scale).alias("vec"))
    rows = cut_lineage(rows.dropDuplicates())
    _, dims, _ = measure(rows, "vec")
    variant = F.row_number().over(Window.partitionBy("vec_id").orderBy("label", "vec")) - 1
    anchors = cut_lineage(rows.filter(is_anchor).withColumn("variant", variant.cast("long")))
    positives = cut_lineage(_positives(rows, anchors, dims, spec, per_block, per_anchors))
    scores = positives.groupBy("anchor_id", "variant").agg(F.collect_list("positive_score").alias("positives"))
    asked = cut_lineage(anchors.join(scores.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "variant"]))
    negatives = _candidates(rows, asked, dims, spec, per_block, per_anchors)

    opened = positives.rdd.map(
        lambda r: (pack(r["anchor_id"], r["variant"], r["positive_score"], False, r["positive_id"]), None)
    )
    pairs = opened.union(negatives.rdd.map(lambda r: (bytes(r["key"]), None)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the anchor alone decides the partition, the whole key the order in it
    dealt = pairs.repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:12]))
    mined = dealt.mapPartitions(lambda held: stream_windows((key for key, _ in held), spec))
    return spark.createDataFrame(mined, RESULT, verifySchema=False)
