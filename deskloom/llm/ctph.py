"""Document fingerprints by context-triggered piecewise hashing.

A hash rolls over seven bytes. Where it ends in at least L zero bits, a chunk of block size 2**L
ends; a chunk's hash gives one of 64 letters, and the letters of all chunks are the signature. L is
the smallest level with at most 63 boundaries, so that a signature has at most 64 letters whatever
the length of the text. A fingerprint holds the signatures of two levels, ``L:signature:next``,
since a boundary of level L + 1 is one of level L as well. Fingerprints are compared by the edit
distance of signatures of equal level; levels that differ by more than one are not compatible.

Whole texts are hashed, as UTF-8. Defined results: a null text counts as empty; the fingerprint of
an empty text is ``0::``; two empty signatures are alike (1), an empty and another one are not (0).
``neighbour_fingerprints`` orders rows by id, nulls first, and then a digest of the text, so ties and
rows that repeat an id have an order and no text is sampled for the ranges; the last row is followed by the first, also by itself in a table of
one row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskloom.llm.common import pick, shuffles_released
from deskloom.session import cut_lineage

# fixed values: the letters of a signature, the bytes that the rolling hash sees, letters at most
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
WINDOW = 7
MOST = 64
LEVELS = 48
#: Bytes that are hashed at once; a signature does not depend on it.
STRIP = 1 << 20

_draw = np.random.default_rng(20240307)
_VALUE = _draw.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_draw.integers(1, 2**62)) * 4 + 1
_ROLL = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(WINDOW)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS, _INVERSES = _powers(_BASE, STRIP), _powers(_INVERSE, STRIP)


def boundaries(data: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ends, levels, content, fewer): the places after which a chunk of level ``least`` may end, the
    highest level at which it does, and the hash of all bytes up to each end; and for every level
    below ``least`` the number of places before the last one."""
    ends, levels, content = [], [], []
    fewer = np.zeros(least, np.int64)
    carried = np.uint64(0)
    scale = np.uint64(1)
    for start in range(0, len(data), STRIP):
        head = min(start, WINDOW - 1)
        values = _VALUE[data[start - head : start + STRIP]]
        n = len(values) - head
        rolled = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            skip = max(0, k - head)
            if skip >= n:
                break
            rolled[skip:] += values[head - k + skip : len(values) - k] * _ROLL[k]
        rolled = _mix(rolled)
        inside = rolled[: len(data) - 1 - start]
        for k in range(least):
            fewer[k] += np.count_nonzero((inside & np.uint64((1 << k) - 1)) == 0)
        at = np.flatnonzero((rolled & np.uint64((1 << least) - 1)) == 0)
        hit = rolled[at]
        low = hit & (~hit + np.uint64(1))
        sums = np.cumsum(values[head:] * _POWERS[:n]) * scale + carried
        ends.append(at + start + 1)
        levels.append(np.where(hit == 0, LEVELS, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64))).astype(np.int64))
        content.append(sums[at])
        carried = sums[-1]
        scale = scale * _POWERS[-1] * np.uint64(_BASE)
    if not ends:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.uint64), fewer
    return np.concatenate(ends), np.concatenate(levels), np.append(np.concatenate(content), carried), fewer


def _signature(ends, levels, content, size: int, level: int) -> str:
    chosen = np.flatnonzero(levels >= level)
    upto = content[:-1][chosen]
    last = ends[chosen]
    if not len(last) or last[-1] < size:
        upto, last = np.append(upto, content[-1]), np.append(last, size)
    before = np.append(np.uint64(0), upto[:-1])
    start = np.append(0, last[:-1])
    # a chunk's hash must not depend on where it stands: take out the power of its start
    return _letters((upto - before) * _inverse_powers(start))


def _letters(hashes: np.ndarray) -> str:
    return LETTERS[(_mix(hashes) >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def _inverse_powers(at: np.ndarray) -> np.ndarray:
    strips = at // STRIP
    out = _INVERSES[at % STRIP]
    if strips.any():
        out = out * np.array([pow(_INVERSE, int(k) * STRIP, 1 << 64) for k in strips], np.uint64)
    return out


def fingerprint(text: str) -> str:
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return "0::"
    with np.errstate(over="ignore"):
        # in nearly every long text the lowest levels have too many places to keep
        least = 0 if len(data) < 512 else 3
        ends, levels, content, fewer = boundaries(data, least)
        if (fewer < MOST).any():
            least = int(np.flatnonzero(fewer < MOST)[0])
            ends, levels, content, _ = boundaries(data, least)
        inner = levels[ends < len(data)]
        counts = np.bincount(np.minimum(inner, LEVELS), minlength=LEVELS + 1)[::-1].cumsum()[::-1]
        level = max(least, int(np.flatnonzero(counts < MOST)[0]))
        return f"{level}:" + ":".join(_signature(ends, levels, content, len(data), k) for k in (level, level + 1))


# --- comparison ----------------------------------------------------------------------------------


def edit_distances(left: list[str], right: list[str]) -> np.ndarray:
    """Levenshtein distances of pairs of strings of at most 64 letters, all pairs at once with the
    columns of the table in the bits of one word."""
    n = len(left)
    m = np.array([len(x) for x in left], np.int64)
    width = np.array([len(x) for x in right], np.int64)
    a = np.zeros((n, MOST), np.uint8)
    b = np.zeros((n, MOST), np.uint8)
    for row, (x, y) in enumerate(zip(left, right)):
        a[row, : len(x)] = np.frombuffer(x.encode(), np.uint8)
        b[row, : len(y)] = np.frombuffer(y.encode(), np.uint8)
    one = np.uint64(1)
    up, down = np.full(n, ~np.uint64(0)), np.zeros(n, np.uint64)
    last = np.left_shift(one, np.maximum(m - 1, 0).astype(np.uint64))
    score = m.copy()
    for j in range(int(width.max(initial=0))):
        live = j < width
        same = np.packbits(a == b[:, j : j + 1], axis=1, bitorder="little").view(np.uint64).ravel()
        zero = (((same & up) + up) ^ up) | same | down
        plus = down | ~(zero | up)
        minus = up & zero
        score += live & ((plus & last) != 0)
        score -= live & ((minus & last) != 0)
        plus = (plus << one) | one
        minus = minus << one
        up = np.where(live, minus | ~(zero | plus), up)
        down = np.where(live, plus & zero, down)
    return np.where(m == 0, width, score)


def likeness(left: list[str | None], right: list[str | None]) -> np.ndarray:
    """0 to 1 per pair of fingerprints: 1 minus the edit distance of signatures of one level over
    the longer one's length; the better of the compatible levels counts."""
    pairs: list[tuple[int, str, str]] = []
    for row, (x, y) in enumerate(zip(left, right)):
        if x is None or y is None:
            continue
        (i, *xs), (j, *ys) = x.split(":"), y.split(":")
        by_level = dict(zip((int(j), int(j) + 1), ys))
        pairs += [(row, sig, by_level[k]) for k, sig in zip((int(i), int(i) + 1), xs) if k in by_level]
    out = np.zeros(len(left))
    if pairs:
        rows, one, two = zip(*pairs)
        size = np.array([max(len(x), len(y)) for x, y in zip(one, two)])
        close = 1 - edit_distances(list(one), list(two)) / np.maximum(size, 1)
        np.maximum.at(out, np.array(rows), close)
    return out


# --- in Spark ------------------------------------------------------------------------------------


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint per row; rows stay where they are."""
    source = pick(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The rows are dealt by ranges of the id and sorted, so that a row's successor follows it in its
    task; no table-wide window is needed. Each task also hands out its first and its last text, and
    these few rows (two per task) are joined to close the gaps between tasks.
    """
    source = pick(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, part int, edge string, text string"
    )
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def rows_of(ids: pa.Array, texts: list[str], prints: list[str], part: int, edges: list[str | None], kept: list[str | None]):
        """Each text but the last with the one after it; a row with an edge is unfinished."""
        done = [e is None for e in edges]
        new = [edited(t, n) if d else "" for t, n, d in zip(texts, texts[1:] + [""], done)]
        new_prints = [fingerprint(x) if d else None for x, d in zip(new, done)]
        following = [p if d else None for p, d in zip(prints[1:] + [None], done)]
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() if d else None for x, d in zip(new, done)], pa.string()),
                pa.array(prints, pa.string()),
                pa.array(new_prints, pa.string()),
                pa.array(likeness(prints, new_prints)),
                pa.array(likeness(prints, following)),
                pa.array([part] * len(texts), pa.int32()),
                pa.array(edges, pa.string()),
                pa.array(kept, pa.string()),
            ],
            names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids = texts = prints = None
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                piece = batch.slice(start, 256)
                more = [t or "" for t in piece.column(1).to_pylist()]
                more_prints = [fingerprint(t) for t in more]
                if ids is None:
                    first = piece.slice(0, 1)
                    yield rows_of(first.column(0), more[:1], more_prints[:1], part, ["first"], more[:1])
                    ids, texts, prints = piece.column(0), more, more_prints
                else:
                    ids, texts, prints = pa.concat_arrays([ids, piece.column(0)]), texts + more, prints + more_prints
                if len(texts) > 1:
                    ready = rows_of(ids, texts, prints, part, [None] * (len(texts) - 1) + ["open"], [None] * len(texts))
                    yield ready.slice(0, len(texts) - 1)
                ids, texts, prints = ids[-1:], texts[-1:], prints[-1:]
        if ids is not None:
            yield rows_of(ids, texts, prints, part, ["last"], texts)

    with shuffles_released(docs.sparkSession):
        keyed = source.withColumn("tie", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
        dealt = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
        found = cut_lineage(dealt.select("doc_id", "text").mapInArrow(run, schema))
        # two rows per task: which task follows, then the two texts side by side
        firsts = found.filter("edge = 'first'").select("part", "text", "fingerprint")
        order = Window.orderBy("part")
        follows = firsts.select(
            "part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("next_part")
        )
        after = firsts.toDF("next_part", "next_text", "next_print")
        lasts = found.filter("edge = 'last'").join(follows, "part").join(after, "next_part")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, *columns = (batch.column(i) for i in range(batch.num_columns))
            texts, prints, next_texts, next_prints = (c.to_pylist() for c in columns)
            new = [edited(t, n) for t, n in zip(texts, next_texts)]
            new_prints = [fingerprint(x) for x in new]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in new], pa.string()),
                    pa.array(prints, pa.string()),
                    pa.array(new_prints, pa.string()),
                    pa.array(likeness(prints, new_prints)),
                    pa.array(likeness(prints, next_prints)),
                ],
                names[:7],
            )

    closed = lasts.select("doc_id", "text", "fingerprint", "next_text", "next_print").mapInArrow(
        close, ", ".join(schema.split(", ")[:7])
    )
    return found.filter("edge IS NULL").select(*names[:7]).unionByName(closed)
