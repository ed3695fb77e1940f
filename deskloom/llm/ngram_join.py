"""Similarity join on word shingles as a blocked sparse product of the document by n-gram matrix.

The product of the incidence matrix with its transpose holds the overlap of every pair of
documents. Sizes bound what is needed: a pair links only if the smaller set has ``num/den`` of
the larger one's size, and only if their overlap reaches ``num / (num + den)`` of the joint size.
So the columns are put in one order, rare n-grams first, and cut in two blocks per document. The
first block holds a document's first ``n - ceil(n * num / den) + 1`` n-grams. A linking pair has
a product there, or it cannot reach its bound; it also is discarded when the position of its
product leaves too few n-grams. Only the surviving pairs go on to the remaining block, whose
overlap is accumulated from the two documents' rows.

What keeps the product small:

* Column order. Frequencies near the first blocks are counted in Spark (of ``COUNTED`` times the
  block of every document); the order is (level, hash), the level being the binary logarithm of a
  frequent n-gram's count, kept in an array of ``SLOTS`` bytes: at most ``SLOTS / 2`` n-grams can
  pass the count limit. Any order gives the same links; what is not counted costs speed only.
* A column's entries travel as packed arrays in parts by hash. Columns with more than
  ``SMALL_COLUMN`` documents, in one task's share or in all, first make a star (one document, by a
  hash of document and column, with the others) and keep their entries. Components of the verified
  links are then attached, and only pairs of documents in different components are multiplied out,
  in blocks of ``BLOCK_ROWS`` documents: a group of near copies takes part with its stars only, no
  task holds a whole hot column, and no link that could join two components is left out.
* Large groups of equal sets are represented by one document (at most ``HOT_SETS`` such groups); an
  id of the group that has another text too is linked to it.
* Bit sketches bound a pair's overlap from above, inside the product of a block, so that pairs
  below the bound are never written; the full rows of the few others are then compared.

Defined results: null and empty texts have an empty set and link with nothing; texts with fewer
words than a shingle are one shingle; a null doc_id takes part in no link and has a null
component; rows that repeat a doc_id are one node whose links are those of all its rows; an empty
table gives an empty result; other columns are ignored by the join and handed on by ``drop_near``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.llm.common import fresh, pick, shuffles_released
from deskloom.llm.components import connected_components, spanning
from deskloom.llm.shingles import WORDS, mix, shingle_sets, signature
from deskloom.session import cut_lineage

SIMILARITY = (75, 100)
SMALL_COLUMN = 8
FREQUENT = 8
COUNTED = 2
SLOTS = 1 << 22
BLOCK_ROWS = 4096
FIRST_COLUMNS = 32
PART_ROWS = 1 << 17
HOT_SETS = 10_000
ID_BITS = 1 << 24
FLUSH_ROWS = 1 << 18


def block_size(n: int, num: int, den: int) -> int:
    """Columns of a set of ``n`` that must hold a product with any linking set."""
    return n - -(-num * n // den) + 1 if n else 0


def slot_of(shingles: np.ndarray) -> np.ndarray:
    return ((shingles >> np.uint64(6)) & np.uint64(SLOTS - 1)).astype(np.int64)


def in_order(shingles: np.ndarray, levels: np.ndarray | None) -> np.ndarray:
    """Sorted hashes in column order."""
    if levels is None:
        return shingles
    level = levels[slot_of(shingles)]
    return shingles[np.argsort(level, kind="stable")] if level.any() else shingles


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def document_sizes(source: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, s1, s2): set size and signature per document row."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(s), *signature(s)) for s in shingle_sets(batch.column(1), words)]
            n, s1, s2 = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in (n, s1, s2)]], ["doc_id", "n", "s1", "s2"]
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(sizes, f"doc_id {kind}, n bigint, s1 bigint, s2 bigint")


def part_bits(entries: int) -> int:
    """Parts of about PART_ROWS entries, 1024 of them at least."""
    return min(20, max(10, (entries // PART_ROWS).bit_length()))


def _part_slices(sorted_hashes: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(part, start, end): a part has the hashes with the same first ``bits`` bits."""
    parts = (sorted_hashes >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]]) if len(parts) else np.zeros(0, np.int64)
    yield from zip(parts[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(parts)])


def _dealt(packed: DataFrame) -> DataFrame:
    return packed.repartition("part").sortWithinPartitions("part")


def column_levels(source: DataFrame, words: int, bounds: tuple[int, int], entries: int) -> np.ndarray:
    """The level of every slot; ``entries`` is the size of all first blocks together."""
    limit = max(FREQUENT, 2 * COUNTED * entries // SLOTS)
    bits = part_bits(COUNTED * entries)

    def pack(batches):
        held, rows = [], 0
        for batch in batches:
            for s in shingle_sets(batch.column(0), words):
                held.append(s[: COUNTED * block_size(len(s), *bounds)])
                rows += len(held[-1])
                if rows > FLUSH_ROWS:
                    yield flush(held)
                    held, rows = [], 0
        if rows:
            yield flush(held)

    def flush(held):
        h = np.sort(np.concatenate(held))
        low = (h >> np.uint64(6)) & np.uint64((1 << 48) - 1)
        six = low.view(np.uint8).reshape(-1, 8)[:, :6]
        found = [(part, six[i:j].tobytes()) for part, i, j in _part_slices(h, bits)]
        return pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.binary())], ["part", "packed"]
        )

    def count(batches):
        for _, blobs in _parts(batches):
            six = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
            wide = np.zeros((len(six), 8), np.uint8)
            wide[:, :6] = six
            h = np.sort(wide.view(np.uint64).ravel())
            start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            n = np.diff(np.r_[start, len(h)])
            slot = (h[start[n > limit]] & np.uint64(SLOTS - 1)).astype(np.int64)
            level = np.log2(n[n > limit]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(level)], ["slot", "level"])

    packed = source.select("text").mapInArrow(pack, "part int, packed binary")
    frequent = _dealt(packed).mapInArrow(count, "slot bigint, level int").groupBy("slot").agg(F.max("level").alias("level"))
    rows = frequent.toPandas()
    levels = np.zeros(SLOTS, np.uint8)
    levels[rows["slot"].to_numpy().astype(np.int64)] = rows["level"].to_numpy().astype(np.uint8)
    return levels


def _parts(batches) -> Iterator[tuple[int, list[bytes]]]:
    """(part, its blobs) from batches sorted by part."""
    part, blobs = None, []
    for batch in batches:
        for p, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if p != part:
                if blobs:
                    yield part, blobs
                part, blobs = p, []
            blobs.append(blob)
    if blobs:
        yield part, blobs


ENTRY = np.dtype([("h", "<u8"), ("doc", "<i8"), ("n", "<i4"), ("pos", "<i4")])
PRODUCTS = "h bigint, a bigint, b bigint, pos int"


def pack_entries(entries: np.ndarray) -> bytes:
    """Field by field and compressed; six bytes of each hash suffice beside the part, since a
    column that holds two n-grams only makes more pairs to verify."""
    low = (entries["h"] >> np.uint64(6)) & np.uint64((1 << 48) - 1)
    fields = [low.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()]
    fields += [entries[f].tobytes() for f in ("doc", "n", "pos")]
    return len(entries).to_bytes(4, "little") + zstandard.compress(b"".join(fields), 1)


def unpack_entries(blob: bytes) -> np.ndarray:
    rows = int.from_bytes(blob[:4], "little")
    data = np.frombuffer(zstandard.decompress(blob[4:]), np.uint8)
    out = np.zeros(rows, ENTRY)
    wide = np.zeros((rows, 8), np.uint8)
    wide[:, :6] = data[: 6 * rows].reshape(-1, 6)
    out["h"] = wide.view(np.uint64).ravel()
    at = 6 * rows
    for field, kind in (("doc", "<i8"), ("n", "<i4"), ("pos", "<i4")):
        size = rows * np.dtype(kind).itemsize
        out[field] = data[at : at + size].view(kind)
        at += size
    return out


def _runs(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of sorted columns: the first row of its column and the column's size."""
    start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    size = np.diff(np.r_[start, len(h)])
    return np.repeat(start, size), np.repeat(size, size)


def _by_column(entries: np.ndarray) -> np.ndarray:
    """Sorted by column, then by set size; a mark on the position does not matter."""
    return entries[np.lexsort((entries["doc"], entries["n"], entries["h"]))]


def _pivots(entries: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Per row of sorted columns: the row whose document is the centre of its column's star."""
    if not len(entries):
        return np.zeros(0, np.int64)
    lot = mix(entries["h"] * np.uint64(0x9E3779B97F4A7C15) ^ entries["doc"].view(np.uint64))
    first = np.flatnonzero(start == np.arange(len(entries)))
    return np.repeat(np.lexsort((lot, start))[first], size[first])


def _product_batch(i, j, entries, kept, bounds) -> pa.RecordBatch:
    """Pairs of the rows ``i`` and ``j`` of ``entries`` that can link, and the ``kept`` entries."""
    n, pos = entries["n"].astype(np.int64), unmarked(entries["pos"]).astype(np.int64)
    ok = _may_link(n[i], n[j], pos[i], pos[j], bounds)
    a, b = _distinct_pairs(entries["doc"][i[ok]], entries["doc"][j[ok]])
    no_column = np.r_[np.ones(len(a), bool), np.zeros(len(kept), bool)]
    columns = [
        pa.array(np.r_[np.zeros(len(a), np.int64), _signed(kept["h"].copy())], mask=no_column),
        pa.array(np.r_[a, kept["doc"]]),
        pa.array(np.r_[b, kept["n"].astype(np.int64)]),
        pa.array(np.r_[np.zeros(len(a), np.int32), unmarked(kept["pos"])]),
    ]
    return pa.RecordBatch.from_arrays(columns, ["h", "a", "b", "pos"])


def unmarked(pos: np.ndarray) -> np.ndarray:
    """A position below zero marks an entry that stands for others of its column."""
    return np.where(pos < 0, -pos - 1, pos).astype(np.int32)


def _column_key(h: np.ndarray) -> np.ndarray:
    """What a column is called in the products: the same before and after packing."""
    return (h >> np.uint64(6)) & np.uint64((1 << 48) - 1)


def first_products(source: DataFrame, words: int, bounds, levels, hot, bits: int) -> DataFrame:
    """Rows (h null, a, b) are candidate pairs: all of small columns, one star of larger ones.
    Rows (h, a = doc, b = n, pos) are the entries of the larger columns. ``hot`` maps the signature
    of a large group of equal sets to the document that stands for it."""

    def entries_of(batches):
        order, stands = levels.value, hot.value
        held, rows = [], 0
        for batch in batches:
            for doc, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), words)):
                if not len(s) or stands and stands.get(signature(s), doc) != doc:
                    continue
                block = in_order(s, order)[: block_size(len(s), *bounds)]
                held.append((doc, len(s), block))
                rows += len(block)
                if rows > FLUSH_ROWS:
                    yield gather(held)
                    held, rows = [], 0
        if rows:
            yield gather(held)

    def gather(held) -> np.ndarray:
        size = np.array([len(x[2]) for x in held])
        out = np.zeros(size.sum(), ENTRY)
        out["h"] = np.concatenate([x[2] for x in held])
        out["doc"] = np.repeat(np.array([x[0] for x in held], np.int64), size)
        out["n"] = np.repeat(np.array([x[1] for x in held], np.int32), size)
        out["pos"] = np.arange(len(out)) - np.repeat(np.cumsum(size) - size, size)
        return out

    def deal(batches):
        for entries in entries_of(batches):
            entries = _by_column(entries)
            first, width = _runs(entries["h"])
            at = np.arange(len(entries))
            centre = _pivots(entries, first, width)
            member = (width > SMALL_COLUMN) & (at != centre)
            entries["pos"][centre[member]] = -unmarked(entries["pos"][centre[member]]) - 1
            kept = entries[member]
            kept["h"] = _column_key(kept["h"])
            ready = _product_batch(centre[member], at[member], entries, kept, bounds)
            rest = entries[~member]
            packed = [(part, pack_entries(rest[i:j])) for part, i, j in _part_slices(rest["h"], bits)]
            yield _tagged(ready, pa.array(np.arange(ready.num_rows) % (1 << bits), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in packed], pa.int32()),
                    pa.array([x[1] for x in packed], pa.binary()),
                    *[pa.nulls(len(packed), pa.int64()) for _ in range(3)],
                    pa.nulls(len(packed), pa.int32()),
                ],
                ["part", "packed", "h", "a", "b", "pos"],
            )

    def _tagged(ready, part):
        return pa.RecordBatch.from_arrays(
            [part, pa.nulls(ready.num_rows, pa.binary()), *ready.columns], ["part", "packed", "h", "a", "b", "pos"]
        )

    def multiply(batches):
        ready = []

        def blobs():
            for batch in batches:
                packed = batch.column(1).is_valid()
                done = batch.filter(pc.invert(packed))
                if done.num_rows:
                    ready.append(done.select(["h", "a", "b", "pos"]))
                yield batch.filter(packed)

        for _, found in _parts(blobs()):
            yield from ready
            ready.clear()
            entries = _by_column(np.concatenate([unpack_entries(x) for x in found]))
            first, width = _runs(entries["h"])
            marked = np.zeros(len(entries), bool)
            marked[first[entries["pos"] < 0]] = True
            large = (width > SMALL_COLUMN) | marked[first]
            at = np.arange(len(entries))
            left, right = [], []
            for step in range(1, SMALL_COLUMN):
                j = at[(at - first >= step) & (width <= SMALL_COLUMN)]
                left.append(j - step)
                right.append(j)
            centre = _pivots(entries, first, width)
            star = at[(at != centre) & (width > SMALL_COLUMN)]
            left.append(centre[star])
            right.append(star)
            yield _product_batch(np.concatenate(left), np.concatenate(right), entries, entries[large], bounds)
        yield from ready

    dealt = _dealt(source.mapInArrow(deal, f"part int, packed binary, {PRODUCTS}"))
    return dealt.mapInArrow(multiply, PRODUCTS)


def _columns(batches, names: list[str], keys: int) -> Iterator[list[np.ndarray]]:
    """Arrays of whole groups from batches sorted by their first ``keys`` fields; the last,
    perhaps unfinished group is carried on."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        part = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(names))]
        if rest is not None:
            part = [np.concatenate(x) for x in zip(rest, part)]
        if not len(part[0]):
            continue
        last = np.ones(len(part[0]), bool)
        for k in range(keys):
            last &= part[k] == part[k][-1]
        cut = int(np.argmax(last))
        if cut:
            yield [x[:cut] for x in part]
        rest = [x[cut:] for x in part]
    if rest is not None and len(rest[0]):
        yield rest


def _may_link(na, nb, pa_, pb, bounds) -> np.ndarray:
    """The size bounds of a pair with a product at these positions; it is their first one, or
    the first one has passed already."""
    num, den = bounds
    most = 1 + np.minimum(na - pa_ - 1, nb - pb - 1)
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    return (den * small >= num * large) & ((num + den) * most >= num * (na + nb))


def _distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low, high = np.minimum(a, b), np.maximum(a, b)
    keep = low != high
    low, high = low[keep], high[keep]
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    first = np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])] if len(low) else np.zeros(0, bool)
    return low[first], high[first]


def large_products(entries: DataFrame, sketches: DataFrame, bounds) -> DataFrame:
    """(a, b) of the larger columns whose documents are in different components and whose sketches
    do not rule a link out. ``entries`` has h, doc, n, pos, component. Columns of one component are
    left out before any shuffle of their entries; the others are cut into blocks of documents, and
    a group is a pair of blocks. A pair is made in the first column that it shares, as far as the
    ``FIRST_COLUMNS`` first of each document tell: it can only link if it passes there."""
    mixed = (
        entries.groupBy("h")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high")
        .select("h", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("blocks"))
    )
    blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    entries = cut_lineage(entries.join(mixed, "h"))
    listed = F.slice(F.array_sort(F.collect_list(F.struct("pos", "h"))), 1, FIRST_COLUMNS)["h"]
    firsts = entries.groupBy("doc", "n").agg(listed.alias("firsts"))
    strips = (
        entries.join(sketches.select("doc", "n", "bits"), ["doc", "n"])
        .join(firsts, ["doc", "n"])
        .withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(blocks))
        .select(
            "h",
            F.least("own", "other").alias("one"),
            F.greatest("own", "other").alias("two"),
            "n",
            "doc",
            "pos",
            "component",
            "own",
            "bits",
            "firsts",
        )
    )
    names = strips.columns

    def multiply(batches):
        num, den = bounds
        for h, one, two, n, doc, pos, component, own, bits, firsts in _columns(batches, names, 3):
            n, pos = n.astype(np.int64), pos.astype(np.int64)
            turn = np.r_[True, (h[1:] != h[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])]
            start = np.flatnonzero(turn)
            found: list[list[np.ndarray]] = [[], []]
            held = 0
            for s, e in zip(start, np.r_[start[1:], len(h)]):
                across = one[s] != two[s]
                by_size = _stacked(bits[s:e])
                lists = _padded(firsts[s:e])
                for i in range(s, e):
                    until = s + int(np.searchsorted(n[s:e], den * n[i] // num, side="right"))
                    j = np.arange(i + 1, until)
                    j = j[component[j] != component[i]]
                    if across:
                        j = j[own[j] != own[i]]
                    j = j[_may_link(n[i], n[j], pos[i], pos[j], bounds)]
                    if len(j):
                        j = j[_reachable(by_size, i - s, j - s, n[i], n[j], bounds)]
                        place = np.flatnonzero(lists[i - s] == h[s])
                        before = lists[i - s, : place[0] if len(place) else len(firsts[i])]
                        j = j[~np.isin(lists[j - s], before).any(axis=1)]
                        found[0].append(np.full(len(j), doc[i]))
                        found[1].append(doc[j])
                        held += len(j)
                if held > FLUSH_ROWS:
                    yield _pair_batch(found)
                    held = 0
            if held:
                yield _pair_batch(found)

    dealt = strips.repartition("h", "one", "two").sortWithinPartitions("h", "one", "two", "n", "doc")
    return dealt.mapInArrow(multiply, "a bigint, b bigint").distinct()


def _padded(lists: np.ndarray) -> np.ndarray:
    """Lists of columns as rows of one array; the padding is no column."""
    out = np.full((len(lists), FIRST_COLUMNS), -1, np.int64)
    for row, x in enumerate(lists):
        out[row, : len(x)] = x
    return out


def _stacked(sketches: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray], np.ndarray]:
    """Sketches by their size in words: (size per row, {size: array}, row in that array)."""
    size = np.array([len(x) // 8 for x in sketches])
    place = np.zeros(len(size), np.int64)
    arrays = {}
    for words in np.unique(size):
        rows = np.flatnonzero(size == words)
        place[rows] = np.arange(len(rows))
        arrays[int(words)] = np.frombuffer(b"".join(sketches[rows]), np.uint64).reshape(-1, words)
    return size, arrays, place


def _reachable(stacked, i: int, j: np.ndarray, n_i: int, n_j: np.ndarray, bounds) -> np.ndarray:
    """Which of the rows ``j`` the sketches allow to link with row ``i``."""
    num, den = bounds
    size, arrays, place = stacked
    one = arrays[int(size[i])][place[i]]
    out = np.zeros(len(j), bool)
    for words in np.unique(size[j]):
        at = np.flatnonzero(size[j] == words)
        two = arrays[int(words)][place[j[at]]]
        left = one
        while len(left) > two.shape[1]:
            left = left[: len(left) // 2] | left[len(left) // 2 :]
        while two.shape[1] > len(left):
            two = two[:, : two.shape[1] // 2] | two[:, two.shape[1] // 2 :]
        both = np.minimum(
            n_i - np.bitwise_count(left & ~two).sum(axis=1, dtype=np.int64),
            n_j[at] - np.bitwise_count(two & ~left).sum(axis=1, dtype=np.int64),
        )
        out[at] = (num + den) * both >= num * (n_i + n_j[at])
    return out


def _pair_batch(found: list[list[np.ndarray]]) -> pa.RecordBatch:
    a, b = _distinct_pairs(*(np.concatenate(x) for x in found))
    for x in found:
        x.clear()
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def id_bits(ids: DataFrame) -> np.ndarray:
    """A bitmap of ID_BITS bits with a bit for every value of ``doc``: a cheap first test."""

    def bits(batches):
        words = np.zeros(ID_BITS // 64, np.uint64)
        for batch in batches:
            at = mix(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)) & np.uint64(ID_BITS - 1)
            np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(_signed(words[used]))], ["word", "value"])

    rows = ids.mapInArrow(bits, "word bigint, value bigint").groupBy("word").agg(F.bit_or("value").alias("value")).toPandas()
    words = np.zeros(ID_BITS // 64, np.uint64)
    words[rows["word"].to_numpy().astype(np.int64)] = rows["value"].to_numpy().astype(np.int64).view(np.uint64)
    return words


def sketch(shingles: np.ndarray) -> bytes:
    """A bitmap with at least four bits per n-gram and a power of two bits."""
    bits = max(64, 1 << int(4 * len(shingles) - 1).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[((shingles >> np.uint64(20)) & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def most_overlap(one: bytes, two: bytes, n_one: int) -> int:
    """An upper bound of the overlap: bits of ``one`` that ``two`` lacks are n-grams it lacks."""
    x, y = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return n_one - int(np.bitwise_count(x & ~y).sum())


def document_rows(source: DataFrame, ids: DataFrame, words: int, value: str) -> DataFrame:
    """(doc, n, ``value``) of the documents in ``ids``, and of few others; the value is the sketch
    (``bits``) or the whole row of hashes (``shingles``)."""
    wanted = source.sparkSession.sparkContext.broadcast(id_bits(ids))

    def rows(batches):
        for batch in batches:
            bits = wanted.value
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            at = mix(ids.view(np.uint64)) & np.uint64(ID_BITS - 1)
            hit = ((bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)
            batch = batch.filter(pa.array(hit))
            for start in range(0, batch.num_rows, 512):
                piece = batch.slice(start, 512)
                sets = list(shingle_sets(piece.column(1), words))
                values = [(sketch(s) if len(s) else b"") if value == "bits" else s.tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([len(s) for s in sets], pa.int32()), pa.array(values, pa.binary())],
                    ["doc", "n", value],
                )

    return source.mapInArrow(rows, f"doc bigint, n int, {value} binary").filter(F.col("n") > 0)


def _compared(pairs: DataFrame, rows: DataFrame, value: str, test) -> DataFrame:
    """The pairs that pass ``test(na, nb, value a, value b)``."""
    for side in ("a", "b"):
        pairs = pairs.join(rows.select(F.col("doc").alias(side), F.col("n").alias(f"n{side}"), F.col(value).alias(f"v{side}")), side)

    def check(batches):
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(2, 6)]
            passed = batch.filter(pa.array([test(*row) for row in zip(*columns)], pa.bool_()))
            kept = list(spanning(zip(passed.column(0).to_pylist(), passed.column(1).to_pylist()))) if value == "shingles" else None
            if kept is None:
                yield passed.select(["a", "b"])
            else:
                a, b = zip(*kept) if kept else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return pairs.select("a", "b", "na", "nb", "va", "vb").mapInArrow(check, "a bigint, b bigint").distinct()


def sketched(pairs: DataFrame, sketches: DataFrame, bounds) -> DataFrame:
    """The pairs that the sketches allow to link."""
    num, den = bounds

    def reachable(na, nb, va, vb) -> bool:
        need = num * (na + nb)
        return (num + den) * most_overlap(va, vb, na) >= need and (num + den) * most_overlap(vb, va, nb) >= need

    return _compared(pairs, sketches, "bits", reachable)


def verified(pairs: DataFrame, source: DataFrame, words: int, bounds) -> DataFrame:
    """Of the pairs that link, by their overlap over all columns, as many as connect the same
    documents: links that close a circle within a batch are left out."""
    num, den = bounds
    pairs = cut_lineage(pairs)
    ends = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc")))
    rows = cut_lineage(document_rows(source, ends, words, "shingles"))

    def links(na, nb, va, vb) -> bool:
        both = np.intersect1d(np.frombuffer(va, np.uint64), np.frombuffer(vb, np.uint64), assume_unique=True)
        return den * len(both) >= num * (na + nb - len(both))

    return _compared(pairs, rows, "shingles", links)


def represented(sizes: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b): links to the document that stands for a large group, from the ids of the group that
    have another set, or an empty one, as well. Only through them does the group reach its links."""
    marked = sizes.filter(F.col("doc_id").isNotNull()).join(F.broadcast(groups), ["n", "s1", "s2"], "left")
    sets = F.struct("n", "s1", "s2")
    several = marked.groupBy("doc_id").agg(
        F.min(sets).alias("low"), F.max(sets).alias("high"), F.collect_set("stands").alias("stands")
    ).filter(F.col("low") != F.col("high"))
    return several.select(F.col("doc_id").alias("a"), F.explode("stands").alias("b")).filter("a <> b")


def ngram_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """doc_id, n_shingles, component_id per document row: the component is the smallest doc_id
    reachable over links of at least the similarity ``num / den``. Ids are integers."""
    with shuffles_released(docs.sparkSession):
        return _components(docs, id_col, text_col, words, similarity)


def _components(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: tuple[int, int]) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    source = pick(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    source = source.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sizes = cut_lineage(document_sizes(source, words))
    source = source.filter(F.col("doc_id").isNotNull())

    num, den = similarity
    totals = sizes.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("n") - F.ceil(F.col("n") * num / den) + 1).alias("first")
    ).first()
    many = max(SMALL_COLUMN, totals["rows"] // HOT_SETS)
    # fewer than HOT_SETS groups can have more than this share of the rows
    groups = cut_lineage(
        sizes.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
        .groupBy("n", "s1", "s2")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("stands"))
        .filter(F.col("rows") > many)
        .drop("rows")
    )
    hot = sc.broadcast({(r["s1"], r["s2"]): r["stands"] for r in groups.collect()})
    tied = represented(sizes, groups) if hot.value else None
    entries = int(totals["first"] or 0)
    levels = sc.broadcast(column_levels(source, words, similarity, entries))

    products = cut_lineage(first_products(source, words, similarity, levels, hot, part_bits(entries)))
    stars = products.filter(F.col("h").isNull()).select("a", "b").distinct()
    large = products.filter(F.col("h").isNotNull()).select(
        "h", F.col("a").alias("doc"), F.col("b").cast("int").alias("n"), "pos"
    )
    ids = products.select(F.col("a").alias("doc")).unionByName(stars.select(F.col("b").alias("doc")))
    sketches = cut_lineage(document_rows(source, ids, words, "bits"))
    links = verified(sketched(stars, sketches, similarity), source, words, similarity)
    links = cut_lineage(links if tied is None else links.select("a", "b").unionByName(tied))
    components = connected_components(links)

    labelled = large.join(components.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "component", F.coalesce("component", "doc")
    )
    more = cut_lineage(verified(large_products(labelled, sketches, similarity), source, words, similarity))
    components = connected_components(links.unionByName(more))

    reps = groups.join(components, groups["stands"] == components["node"], "left").select(
        "n", "s1", "s2", F.coalesce("component", "stands").alias("of_group")
    )
    return (
        sizes.join(F.broadcast(reps), ["n", "s1", "s2"], "left")
        .join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select(
            F.col("doc_id").cast(kind).alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.coalesce("of_group", "component", "doc_id").cast(kind).alias("component_id"),
        )
    )


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents whose id is the smallest of their component, with all their columns. Rows
    that repeat such an id stay; rows with a null id stay."""
    found = ngram_components(docs, id_col, text_col, **options)
    name = fresh(docs, "__gone")
    gone = found.filter(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs[f"`{id_col}`"] == F.col(name), "left_anti")
