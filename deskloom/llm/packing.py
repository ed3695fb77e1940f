"""Best-fit packing of tokenised documents by linear grouping.

Only the number of pieces of each length matters for the plan, so the plan is made on a histogram
of at most ``capacity`` rows. Lengths above ``capacity * LARGE_SHARE`` are split into groups of
equal cardinality and rounded up to the largest length of their group. The packing of the few
remaining sizes is optimised as a linear programme over configurations (column generation: the
dual prices feed a knapsack that proposes the next configuration). Whole multiples of its
solution are used, the actual lengths are substituted for the rounded ones, rounding leftovers
and finally the small lengths go best-fit, largest first, into the sequence with the least room
that takes them. Each step handles runs of like sequences at once, so its cost does not depend on
the number of documents. In Spark, the pieces of a length are numbered and each run of numbers is
looked up in the plan.

Defined results: a null text counts as empty, so its only token is the separator; a null doc_id
is handed on; rows that repeat a doc_id are packed one by one; an empty table gives an empty
result; other columns are ignored; a text of any length is cut into pieces of ``capacity``, of
which the first may be shorter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.llm.common import gapless_rank, pick, shuffles_released
from deskloom.llm.tokens import Encoder
from deskloom.session import cut_lineage

CAPACITY = 2048
SEPARATOR = 0
LARGE_SHARE = 0.45
GROUPS = 64
ROUNDS = 400


# --- the plan, on counts per length ------------------------------------------------------------


@dataclass
class Run:
    """``count`` sequences that hold the same lengths."""

    lengths: list[int]
    count: int

    def room(self, capacity: int) -> int:
        return capacity - sum(self.lengths)


def linear_groups(counts: dict[int, int], groups: int) -> list[tuple[int, dict[int, int]]]:
    """(rounded size, {length: count}) from the largest size down, of equal cardinality."""
    total = sum(counts.values())
    share = -(-total // groups)
    out: list[tuple[int, dict[int, int]]] = []
    left = 0
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            if not left:
                out.append((length, {}))
                left = share
            take = min(n, left)
            out[-1][1][length] = out[-1][1].get(length, 0) + take
            n -= take
            left -= take
    merged: dict[int, dict[int, int]] = {}
    for size, members in out:
        into = merged.setdefault(size, {})
        for length, n in members.items():
            into[length] = into.get(length, 0) + n
    return sorted(merged.items(), reverse=True)


def best_configuration(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the capacity (unbounded knapsack)."""
    value = np.zeros(capacity + 1)
    pick_of = np.full(capacity + 1, -1)
    for at in range(1, capacity + 1):
        fits = np.flatnonzero(sizes <= at)
        if len(fits):
            options = value[at - sizes[fits]] + prices[fits]
            best = int(np.argmax(options))
            if options[best] > value[at - 1] + 1e-12:
                value[at], pick_of[at] = options[best], fits[best]
                continue
        value[at] = value[at - 1]
    uses = np.zeros(len(sizes))
    at = capacity
    while at > 0:
        if pick_of[at] < 0:
            at -= 1
        else:
            uses[pick_of[at]] += 1
            at -= sizes[pick_of[at]]
    return float(value[capacity]), uses


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """(uses per size, whole number of sequences) from the optimum of the linear programme."""
    width, need = np.array(sizes), np.array(demand, float)
    basis = np.diag([capacity // s for s in sizes]).astype(float)
    for _ in range(ROUNDS):
        amounts = np.linalg.solve(basis, need)
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        value, uses = best_configuration(width, prices, capacity)
        if value <= 1 + 1e-9:
            break
        change = np.linalg.solve(basis, uses)
        ratios = np.where(change > 1e-9, amounts / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(np.argmin(ratios))] = uses
    amounts = np.linalg.solve(basis, need)
    return [(basis[:, i], int(a + 1e-6)) for i, a in enumerate(amounts) if a + 1e-6 >= 1]


class _Rooms:
    """Runs by the room they have left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: list[list[Run]] = [[] for _ in range(capacity + 1)]

    def add(self, run: Run) -> None:
        if run.count:
            self.by_room[run.room(self.capacity)].append(run)

    def best_fit(self, length: int, count: int) -> None:
        """Put ``count`` pieces into the fullest sequences that take them, then into new ones."""
        room = length
        while count and room <= self.capacity:
            if not self.by_room[room]:
                room += 1
                continue
            run = self.by_room[room].pop()
            each = min(room // length, count)
            used = min(run.count, count // each)
            self.add(Run(run.lengths + [length] * each, used))
            self.add(Run(run.lengths, run.count - used))
            count -= used * each
        if count:
            each = self.capacity // length
            self.add(Run([length] * each, count // each))
            if count % each:
                self.add(Run([length] * (count % each), 1))

    def runs(self) -> list[Run]:
        return [run for runs in self.by_room for run in runs]


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Run]:
    """Runs of sequences that hold every length as often as ``counts`` says."""
    large = {s: n for s, n in counts.items() if capacity * LARGE_SHARE < s < capacity}
    small = {s: n for s, n in counts.items() if s <= capacity * LARGE_SHARE}
    rooms = _Rooms(capacity)
    rooms.add(Run([capacity], counts.get(capacity, 0)))
    grouped = linear_groups(large, groups) if large else []
    supply = [sorted(members.items(), reverse=True) for _, members in grouped]
    sizes = [size for size, _ in grouped]
    chosen = configurations(sizes, [sum(m.values()) for _, m in grouped], capacity) if grouped else []
    for uses, count in chosen:
        slots = [g for g, k in enumerate(uses) for _ in range(int(round(k)))]
        while count:
            # the longest run in which every slot keeps its actual length
            taken: dict[tuple[int, int], int] = {}
            lengths = []
            for g in slots:
                if not supply[g]:
                    continue
                length, _ = supply[g][-1]
                taken[g, length] = taken.get((g, length), 0) + 1
                lengths.append(length)
            if not lengths:
                break
            used = min([count, *[supply[g][-1][1] // k for (g, _), k in taken.items()]])
            if not used:  # fewer pieces of this length than slots for it: one mixed sequence
                used, lengths, taken = 1, [], {}
                for g in slots:
                    if supply[g]:
                        length, n = supply[g].pop()
                        lengths.append(length)
                        if n > 1:
                            supply[g].append((length, n - 1))
            for (g, length), k in taken.items():
                _, n = supply[g].pop()
                if n > used * k:
                    supply[g].append((length, n - used * k))
            rooms.add(Run(lengths, used))
            count -= used
    rest: dict[int, int] = dict(small)
    for members in supply:
        for length, n in members:
            rest[length] = rest.get(length, 0) + n
    for length in sorted(rest, reverse=True):
        rooms.best_fit(length, rest[length])
    return rooms.runs()


def placements(runs: list[Run]) -> dict[int, np.ndarray]:
    """Per length the rows (first number, first sequence, stride, offset): the pieces of a length
    numbered from ``first number`` on go to consecutive sequences of a run, at that offset."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for run in runs:
        offset = 0
        for length in run.lengths:
            out.setdefault(length, []).append((used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + run.count
            offset += length
        sequence += run.count
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


# --- in Spark ------------------------------------------------------------------------------------


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, separator: int = SEPARATOR,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 per piece; a document's ids end with the separator."""
    source = pick(docs, doc_id=id_col, text=text_col)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        small = (batch.slice(i, 256) for batch in batches for i in range(0, batch.num_rows, 256))
        for batch in small:
            rows: list[tuple[int, int, int, int, int]] = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encoder.ids(text or ""), np.uint32(separator)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                rows += [
                    (row, piece, s, e - s, zlib.crc32(ids[s:e].tobytes()))
                    for piece, (s, e) in enumerate(zip(cuts, cuts[1:]))
                ]
            at, piece, start, length, crc = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *[pa.array(c, pa.int64()) for c in (start, length, crc)],
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(encode, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, separator: int = SEPARATOR,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The pieces with sequence_id and offset. Any sequence has at most ``capacity`` tokens."""
    with shuffles_released(docs.sparkSession):
        pieces = cut_lineage(
            token_pieces(docs, tokenizer, capacity, separator, id_col, text_col).withColumn(
                "row_id", F.monotonically_increasing_id()
            )
        )
        # at most ``capacity`` rows
        counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
        shared = docs.sparkSession.sparkContext.broadcast(placements(plan(counts, capacity)))
        numbered = gapless_rank(pieces, ["length"], F.xxhash64("row_id"), ["row_id"], "number").drop("row_id")
    names = [c for c in numbered.columns if c != "number"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for size in np.unique(length):
                rows = np.flatnonzero(length == size)
                first, run, at = shared.value[int(size)].T
                found = np.searchsorted(first, number[rows], side="right") - 1
                sequence[rows] = run[found] + number[rows] - first[found]
                offset[rows] = at[found]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema if f.name != "number")
    return numbered.mapInArrow(place, f"{kinds}, sequence_id bigint, offset bigint")
