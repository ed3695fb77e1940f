"""Terms and vectors as bytes, for what is shuffled and written.

A count of terms goes to a task as one text of sorted terms with its numbers; a vector is the places of
its terms in the sorted vocabulary and how often each occurs, as numbers of one to five bytes. Weights
follow from these and the vocabulary, so they are neither moved nor kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

VEC = "array<struct<term:string,weight:double,df:bigint,salts:int>>"
UNPACKED_AT_ONCE = 1 << 20  # bytes of packed entries: some half a million of them
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def hashes(texts: pa.Array) -> np.ndarray:
    """A number of 64 bits for each text, the same in every process."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    lengths = np.diff(offsets)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    starts = (offsets[:-1] - offsets[0]).astype(np.int64)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(lengths)
    if len(full):
        longest = int(lengths.max())
        factors = np.full(longest, _MULTIPLIER, np.uint64)
        factors[0] = 1
        factors = np.cumprod(factors)  # odd, and different at each place
        at = np.arange(len(data)) - np.repeat(starts[full], lengths[full])
        out[full] = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * factors[at], starts[full])
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def buckets_of(texts: pa.Array, n: int) -> np.ndarray:
    return (hashes(texts) % np.uint64(n)).astype(np.int64)


def squeezed(data: bytes | pa.Buffer) -> bytes:
    """Compressed, its length before it."""
    return len(memoryview(data)).to_bytes(8, "little") + pa.Codec("zstd").compress(data, asbytes=True)


def whole(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def text_of(terms: pa.Array) -> bytes:
    """The terms as one text; they hold no line break."""
    terms = terms.cast(pa.string())
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms), "\n")
    return joined[0].as_buffer().to_pybytes()


def terms_of(text: bytes, n: int) -> pa.Array:
    if not n:
        return pa.array([], pa.string())
    data = np.frombuffer(text, np.uint8)
    breaks = np.flatnonzero(data == 10)
    ends = np.append(breaks, len(data))
    lengths = np.diff(np.concatenate([[-1], ends])) - 1
    kept = np.delete(data, breaks)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(kept))


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2**35 as bytes, seven bits in each and the last below 128; and how many each takes."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28):
        sizes += values >= np.uint64(1 << bits)
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    starts = ends - sizes
    for i in range(int(sizes.max()) if len(sizes) else 0):
        there = sizes > i
        more = (sizes[there] > i + 1).astype(np.uint64) << np.uint64(7)
        out[starts[there] + i] = ((values[there] >> np.uint64(7 * i)) & np.uint64(127)) | more
    return out, sizes


def numbers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of ``varints``, and where each ends."""
    ends = np.flatnonzero(data < 128) + 1
    if not len(ends):
        return np.zeros(0, np.int64), ends
    starts = np.concatenate([[0], ends[:-1]])
    at = np.arange(len(data)) - np.repeat(starts, ends - starts)
    parts = (data & np.uint8(127)).astype(np.int64) << (7 * at)
    return np.add.reduceat(parts, starts), ends


def pack_entries(doc: np.ndarray, place: np.ndarray, tf: np.ndarray, rows: int) -> pa.Array:
    """One binary value for each of ``rows`` rows from (doc, place, tf) in order of doc and place."""
    first = np.diff(doc, prepend=-1) != 0
    steps = np.where(first, place, np.diff(place, prepend=0))
    data, sizes = varints(np.column_stack([steps, tf]).ravel())
    bounds = np.concatenate([[0], np.cumsum(sizes.reshape(-1, 2).sum(axis=1))])
    offsets = bounds[np.searchsorted(doc, np.arange(rows + 1))].astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpack_entries(packed: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, place, tf) of the rows of ``packed``."""
    offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1].astype(np.int64)
    held = packed.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None and held.size else np.zeros(0, np.uint8)
    values, ends = numbers(data)
    steps, tf = values[0::2], values[1::2]
    counts = np.diff(np.searchsorted(ends, offsets - offsets[0], side="right")) // 2
    doc = np.repeat(np.arange(len(packed)), counts)
    sums = np.cumsum(steps)
    starts = np.cumsum(counts) - counts
    base = np.where(starts > 0, np.append(0, sums)[starts], 0)
    return doc, sums - np.repeat(base, counts), tf


def sorted_terms(terms: pa.Array, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the positions of its terms in their order."""
    order = np.asarray(pc.array_sort_indices(terms)).astype(np.int64)
    order = order[np.argsort(bucket[order], kind="stable")]
    found = bucket[order]
    cuts = np.flatnonzero(np.diff(found, prepend=-1))
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(found)]):
        yield int(found[lo]), order[lo:hi]


class Codebook:
    """The vocabulary as every task gets it: vectors are packed as places in it and unpacked again.
    ``spec`` is the ``TfidfSpec`` that they are weighed by."""

    def __init__(self, vocab: DataFrame, spec: object):
        known = vocab.select("part", "term", "df", "idf", "salts").toArrow().sort_by([("part", "ascending"), ("term", "ascending")])
        self.spec = spec
        self.sent = vocab.sparkSession.sparkContext.broadcast(known)

    def spans(self) -> dict[object, pa.Table]:
        """The vocabulary of each part."""
        held = self.sent.value.combine_chunks()
        if not held.num_rows:
            return {}
        coded = held["part"].chunk(0).dictionary_encode()
        edges = np.searchsorted(np.asarray(coded.indices), np.arange(len(coded.dictionary) + 1))
        return {part: held.slice(edges[i], edges[i + 1] - edges[i]) for i, part in enumerate(coded.dictionary.to_pylist())}


def weights_of(entries: pa.Array, vocab: pa.Table, sublinear: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, place, weight) of packed vectors, scaled to unit length."""
    doc, place, tf = unpack_entries(entries)
    raw = (1.0 + np.log(tf) if sublinear else tf.astype(float)) * np.asarray(vocab["idf"])[place]
    if len(doc):
        _, starts = np.unique(doc, return_index=True)
        norms = np.sqrt(np.add.reduceat(raw * raw, starts))
        raw = raw / np.repeat(norms, np.diff(np.append(starts, len(doc))))
    return doc, place, raw


def unpack(rows: DataFrame, book: Codebook) -> DataFrame:
    """Rows with a ``part`` and packed ``entries``, with ``vec`` in their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = book.spans()
        for batch in batches:
            codes = batch.column("part").dictionary_encode()
            for code, part in enumerate(codes.dictionary.to_pylist()):
                if part in spans:
                    own = batch.filter(pc.equal(codes.indices, code))
                    sizes = np.asarray(pc.binary_length(own.column("entries")), dtype=np.int64)
                    piece = (np.cumsum(sizes) - sizes) // UNPACKED_AT_ONCE
                    starts = np.flatnonzero(np.diff(piece, prepend=-1)).tolist()
                    for lo, hi in zip(starts, [*starts[1:], len(sizes)]):
                        yield unpacked(own.slice(lo, hi - lo), spans[part])

    def unpacked(own: pa.RecordBatch, vocab: pa.Table) -> pa.RecordBatch:
        doc, place, weight = weights_of(own.column("entries"), vocab, book.spec.sublinear)
        picked = vocab.take(pa.array(place))
        names = ["term", "weight", "df", "salts"]
        vec = pa.StructArray.from_arrays([picked[c].combine_chunks() if c != "weight" else pa.array(weight) for c in names], names)
        ends = pa.array(np.searchsorted(doc, np.arange(own.num_rows + 1)).astype(np.int32))
        return own.drop_columns(["entries"]).append_column("vec", pa.ListArray.from_arrays(ends, vec))

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "entries"]
    return rows.mapInArrow(run, ", ".join([*kinds, f"vec {VEC}"]))
