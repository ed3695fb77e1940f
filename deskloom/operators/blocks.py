"""Exact top-k over shards of an index whose postings lie in blocks by falling weight.

Every part of the index is dealt into shards of vectors. A shard holds its postings by term, the
heaviest first, in blocks; the first weight of a block is the most that any posting in it or behind
it weighs. Queries meet every shard of their part: a task holds a pile of shards and a share of the
queries, both bounded, so a frequent term or a part that a third of the queries asks is never one
task. A pile returns its k best vectors per query.

Within a shard a query with few postings adds all of them up. Otherwise it reads the first block of
each term; the k-th best partial sum is a floor for the k-th best score, as is the k-th score that
the shards before it have found. Reading every term down to weights that contribute at most ``cut``, with
the sum of what the unread rests can add at most the floor, leaves no unseen vector that could be
among the first k; those seen whose sum and rest reach the floor are scored exactly from their own
entries.

The search is numpy in tasks: it stops by thresholds that depend on what a query has read so far,
which no join expresses.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.operators.packed import Codebook, weights_of

BLOCK = 64
VECTORS_PER_SHARD = 4_096
POSTINGS_PER_SHARD = 500_000
SHARDS_PER_TASK = 16  # some 100 MB of postings
PACKED_SHARDS_PER_TASK = 64  # some 80 MB of packed vectors, of which one shard at a time is laid out
QUERIES_PER_TASK = 16_384
ENTRIES_PER_TASK = 4_000_000  # of queries
READ_ALL = 100_000  # a query with at most so many postings in a shard adds all of them up
EPS = 2e-9  # scores are compared at nine decimals


def deal(
    vectors: DataFrame, size: Column | str, per_shard: int = VECTORS_PER_SHARD, postings: int = POSTINGS_PER_SHARD
) -> DataFrame:
    """The vectors with the number of ``shards`` of their part and their own ``shard``; ``size`` is the
    number of a vector's entries."""
    sized = vectors.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("entries"))
    wanted = F.greatest(F.ceil(F.col("n") / per_shard), F.ceil(F.col("entries") / postings)).cast("int")
    sized = sized.select("part", wanted.alias("shards"))  # a row per part of the index
    return vectors.join(F.broadcast(sized), "part").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"))


def shards_of(vectors: DataFrame, per_shard: int = VECTORS_PER_SHARD, postings: int = POSTINGS_PER_SHARD) -> DataFrame:
    """(part, shard, shards, ids, copies, terms, starts, places, weights): one row per shard. ``places``
    are positions in ``ids``, which are sorted; the postings of term i lie at starts[i]:starts[i+1]."""
    dealt = deal(vectors, F.size("vec"), per_shard, postings)
    kinds = {c: dealt.schema[c].dataType.simpleString() for c in ("part", "vec_id")}

    def load(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("vec_id").combine_chunks()
        vec = rows["vec"].chunk(0)
        entries = vec.flatten()
        coded = pc.struct_field(entries, "term").dictionary_encode()
        terms = coded.dictionary
        by_term = np.asarray(pc.array_sort_indices(terms))
        rank = np.empty(len(terms), np.int64)
        rank[by_term] = np.arange(len(terms))
        term = rank[np.asarray(coded.indices)]
        weight = np.asarray(pc.struct_field(entries, "weight"))
        place = np.repeat(np.arange(rows.num_rows), np.asarray(vec.value_lengths()))
        order, starts = _lists(term, weight, place, len(terms))
        lists = {
            "ids": rows["vec_id"].chunk(0),
            "copies": rows["copies"].chunk(0),
            "terms": terms.take(pa.array(by_term)),
            "starts": pa.array(starts.astype(np.int32)),
            "places": pa.array(place[order].astype(np.int32)),
            "weights": pa.array(weight[order]),
        }
        whole = {c: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for c, v in lists.items()}
        return pa.table({c: rows[c][:1] for c in ("part", "shard", "shards")} | whole)

    schema = (
        f"part {kinds['part']}, shard int, shards int, ids array<{kinds['vec_id']}>, copies array<bigint>, "
        "terms array<string>, starts array<int>, places array<int>, weights array<double>"
    )
    return dealt.select("part", "shard", "shards", "vec_id", "copies", "vec").groupBy("part", "shard").applyInArrow(load, schema)


def _lists(term: np.ndarray, weight: np.ndarray, place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the postings by term, the heaviest first, and where the list of each term starts."""
    order = np.lexsort((place, -weight, term))
    return order, np.searchsorted(term[order], np.arange(n + 1))


@dataclass
class Shard:
    ids: pa.Array
    copies: pa.Array
    terms: pa.Array | np.ndarray  # names, or places in the vocabulary
    starts: np.ndarray
    places: np.ndarray
    weights: np.ndarray

    def __post_init__(self):
        self.n = len(self.ids)
        self.lengths = np.diff(self.starts)
        self.heaviest = np.where(self.lengths > 0, np.append(self.weights, 0.0)[self.starts[:-1]], 0.0)
        self._own: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        self.read = 0

    @classmethod
    def of(cls, rows: pa.Table) -> Shard:
        row = {c: rows[c].combine_chunks() for c in ("ids", "copies", "terms", "starts", "places", "weights")}
        flat = {c: (v.chunk(0) if isinstance(v, pa.ChunkedArray) else v).flatten() for c, v in row.items()}
        return cls(flat["ids"], flat["copies"], flat["terms"], *(np.asarray(flat[c]) for c in ("starts", "places", "weights")))

    @classmethod
    def packed(cls, rows: pa.Table, vocab: pa.Table, sublinear: bool) -> Shard:
        """The shard of packed vectors (vec_id, copies, entries)."""
        rows = rows.sort_by("vec_id").combine_chunks()
        place, at, weight = weights_of(rows["entries"].chunk(0), vocab, sublinear)
        terms, term = np.unique(at, return_inverse=True)
        order, starts = _lists(term, weight, place, len(terms))
        return cls(rows["vec_id"].chunk(0), rows["copies"].chunk(0), terms, starts, place[order], weight[order])

    def _gather(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Positions of the first ``counts`` postings of each term."""
        ends = np.cumsum(counts)
        return np.repeat(self.starts[terms] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)

    def _sums(self, terms: np.ndarray, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
        at = self._gather(terms, counts)
        self.read += len(at)
        return np.bincount(self.places[at], self.weights[at] * np.repeat(weights, counts), self.n)

    def _exact(self, places: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of some vectors from their own entries."""
        if self._own is None:
            order = np.argsort(self.places, kind="stable")
            term = np.repeat(np.arange(len(self.lengths)), self.lengths)[order]
            begin = np.searchsorted(self.places[order], np.arange(self.n + 1))
            self._own = begin, term, self.weights[order]
        begin, term, weight = self._own
        asked = np.zeros(len(self.lengths))
        asked[terms] = weights
        counts = begin[places + 1] - begin[places]
        ends = np.cumsum(counts)
        at = np.repeat(begin[places] - (ends - counts), counts) + np.arange(ends[-1])
        return np.add.reduceat(asked[term[at]] * weight[at], ends - counts)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the k best vectors that share a term and score at least ``floor``."""
        lengths = self.lengths[terms]
        if lengths.sum() <= READ_ALL:
            scores = self._sums(terms, weights, lengths)
            places = np.flatnonzero(scores > 0)
            return _first(places, scores[places], k, floor)
        tops = weights * self.heaviest[terms]
        probe = self._sums(terms, weights, np.minimum(lengths, BLOCK))
        floor = max(floor, _kth(probe, k))
        if floor <= 0:  # the first blocks hold fewer than k vectors, so nothing bounds the rest
            scores = self._sums(terms, weights, lengths)
            places = np.flatnonzero(scores > 0)
            return _first(places, scores[places], k, floor)
        cut = _cut(tops, floor - EPS)
        counts, rests = np.zeros(len(terms), np.int64), np.zeros(len(terms))
        for i, (t, w) in enumerate(zip(terms.tolist(), weights.tolist())):
            blocks = self.weights[self.starts[t] : self.starts[t + 1] : BLOCK] * w
            wanted = int(np.searchsorted(-blocks, -cut, side="left"))  # blocks that begin above the cut
            counts[i] = min(wanted * BLOCK, lengths[i])
            rests[i] = blocks[wanted] if wanted < len(blocks) else 0.0
        partial = self._sums(terms, weights, counts)
        rest = float(rests.sum())
        floor = max(floor, _kth(partial, k))
        places = np.flatnonzero((partial > 0) & (partial + rest >= floor - EPS))
        if not len(places):
            return places, np.zeros(0)
        return _first(places, self._exact(places, terms, weights), k, floor)


def _kth(sums: np.ndarray, k: int) -> float:
    return float(np.partition(sums, len(sums) - k)[len(sums) - k]) if len(sums) >= k else 0.0


def _cut(tops: np.ndarray, limit: float) -> float:
    """The largest c with sum(min(tops, c)) <= limit: what every term may leave unread."""
    rising = np.sort(tops)
    below = np.concatenate([[0.0], np.cumsum(rising)[:-1]])
    spread = (limit - below) / np.arange(len(rising), 0, -1)
    over = np.flatnonzero(spread < rising)
    return float(spread[over[0]]) if len(over) else np.inf


def _first(places: np.ndarray, scores: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """The k best at nine decimals, ties to the smaller place."""
    scores = np.round(scores, 9)
    near = scores >= max(floor - EPS, _kth(scores, k))
    places, scores = places[near], scores[near]
    order = np.lexsort((places, -scores))[:k]
    return places[order], scores[order]


def _compact(asked: DataFrame) -> DataFrame:
    """(part, q_key, terms, weights) of (part, q_key, vec): the terms as one text, and nothing that the
    search does not read. A vector is passed on once by a task, so one that a third of the queries share
    is no large group behind the shuffle."""
    return _once(asked.select("part", "q_key", F.concat_ws("\n", "vec.term").alias("terms"), F.col("vec.weight").alias("weights")))


def _once(slim: DataFrame) -> DataFrame:
    """A task passes each (part, q_key) on once."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            keys = list(zip(batch.column("part").to_pylist(), batch.column("q_key").to_pylist()))
            fresh = [i for i, key in enumerate(keys) if key not in seen and not seen.add(key)]
            yield batch if len(fresh) == len(keys) else batch.take(pa.array(fresh, pa.int64()))

    return slim.mapInArrow(once, slim.schema)


def _search(asked: DataFrame, shards: DataFrame, k: int, book: Codebook | None = None) -> DataFrame:
    """(part, q_key, vec_id, score, copies) for queries (part, pile, share, q_key, terms, weights), a
    query once or more often. A task reads the shards of its pile one after another; the k-th score so
    far is a query's floor for the next. Ties with the k-th score are all kept. With ``book`` queries
    (.., q_key, entries) and vectors (.., shard, vec_id, copies, entries) are packed."""
    id_kind = shards.schema["ids"].dataType.elementType if book is None else shards.schema["vec_id"].dataType
    kinds = {"part": shards.schema["part"].dataType.simpleString(), "ids": id_kind.simpleString()}
    place = ["part", "pile", "share"]

    def held_shards(held: pa.Table, part: object) -> Iterator[Shard]:
        if book is None:
            yield from (Shard.of(held.slice(row, 1)) for row in range(held.num_rows))
        else:
            vocab, numbers = book.spans()[part], np.asarray(held["shard"].combine_chunks())
            for number in np.unique(numbers):
                yield Shard.packed(held.filter(pa.array(numbers == number)), vocab, book.spec.sublinear)

    def asked_entries(queries: pa.Table, part: object) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array | np.ndarray]:
        """How many entries each query has, their weights, their terms as codes, and the terms."""
        if book is None:
            lengths = np.concatenate([np.asarray(c.value_lengths()) for c in queries["weights"].chunks])
            return lengths, _flat(queries["weights"]), *_coded(queries["terms"])
        doc, at, weights = weights_of(queries["entries"].combine_chunks(), book.spans()[part], book.spec.sublinear)
        terms, codes = np.unique(at, return_inverse=True)
        return np.bincount(doc, minlength=queries.num_rows), weights, codes, terms

    def meet(key: tuple, queries: pa.Table, held: pa.Table) -> pa.Table:
        ids, copies = [], []
        owners, found = [np.zeros(0, np.int64)], [np.zeros(0)]
        names = pa.array([], pa.string())
        floors = np.zeros(0)
        if queries.num_rows and held.num_rows:
            _, first = np.unique(np.asarray(queries["q_key"].combine_chunks().dictionary_encode().indices), return_index=True)
            if len(first) < queries.num_rows:
                queries = queries.take(pa.array(np.sort(first)))
            part = key[0].as_py() if hasattr(key[0], "as_py") else key[0]
            names = pa.array(queries["q_key"].to_pylist(), pa.string())
            lengths, weights, codes, asked_terms = asked_entries(queries, part)
            ends = np.cumsum(lengths).tolist()
            floors = np.zeros(len(names))
            tops = [np.zeros(0)] * len(names)
            for shard in held_shards(held, part):
                known = _places(asked_terms, shard.terms)[codes]
                begin, at = 0, []
                for q, end in enumerate(ends):
                    own = known[begin:end]
                    there = own >= 0
                    if there.any():
                        places, scores = shard.best(own[there], weights[begin:end][there], k, floors[q])
                        if len(places):
                            at.append(places)
                            found.append(scores)
                            owners.append(np.full(len(places), q))
                            best = np.concatenate([tops[q], scores])
                            if len(best) >= k:
                                best = np.partition(best, len(best) - k)[len(best) - k :]
                                floors[q] = best[0]
                            tops[q] = best
                    begin = end
                at = pa.array(np.concatenate(at) if at else np.zeros(0, np.int64))
                ids.append(shard.ids.take(at))
                copies.append(shard.copies.take(at))
        owner, score = np.concatenate(owners), np.concatenate(found)
        near = np.flatnonzero(score >= floors[owner]) if len(owner) else owner
        kept = pa.array(near)
        return pa.table(
            {
                "part": pa.array([key[0].as_py() if hasattr(key[0], "as_py") else key[0]] * len(near), queries["part"].type),
                "q_key": names.take(pa.array(owner[near])),
                "vec_id": pa.concat_arrays(ids or [pa.array([], held["vec_id"].type if book else held["ids"].type.value_type)]).take(kept),
                "score": pa.array(score[near]),
                "copies": pa.concat_arrays(copies or [pa.array([], pa.int64())]).take(kept),
            }
        )

    schema = f"part {kinds['part']}, q_key string, vec_id {kinds['ids']}, score double, copies bigint"
    return asked.groupBy(*place).cogroup(shards.groupBy(*place)).applyInArrow(meet, schema)


def _places(asked: pa.Array | np.ndarray, held: pa.Array | np.ndarray) -> np.ndarray:
    """Where the terms that are asked lie among those that a shard holds, or -1."""
    if not isinstance(held, np.ndarray):
        return np.asarray(pc.index_in(asked, value_set=held).fill_null(-1), dtype=np.int64)
    if not len(held):
        return np.full(len(asked), -1)
    at = np.minimum(np.searchsorted(held, asked), len(held) - 1)
    return np.where(held[at] == asked, at, -1)


def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.asarray(c.flatten()) for c in lists.chunks])


def _coded(texts: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """The terms of all texts as codes, and the distinct terms."""
    coded = pa.chunked_array([pc.split_pattern(c, "\n").flatten() for c in texts.chunks]).dictionary_encode().unify_dictionaries()
    return np.concatenate([np.asarray(c.indices) for c in coded.chunks]), coded.chunk(0).dictionary


def best_vectors(
    asked: DataFrame, shards: DataFrame, k: int, per_task: int = QUERIES_PER_TASK, book: Codebook | None = None
) -> DataFrame:
    """(part, q_key, vec_id, score, copies): of every pile of shards the k best vectors for each of the
    queries (part, q_key, vec), which may repeat; the k best of them all are among these.

    A query goes to every pile of its part and a shard to every share of the queries. So what is
    shuffled is the queries times the piles and the index times the shares, and both are as large as a
    task can hold. With ``book`` the queries are (part, q_key, n, entries) and in place of shards come
    the packed vectors with theirs (``deal``); a task lays out one shard at a time.
    """
    size = F.size("vec") if book is None else F.col("n")
    sized = asked.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("entries"))
    shares = F.greatest(F.ceil(F.col("n") / per_task), F.ceil(F.col("entries") / ENTRIES_PER_TASK)).cast("int")
    # queries that are one share are moved for little, so there more tasks share the index
    per_pile = F.lit(SHARDS_PER_TASK) if book is None else F.when(shares > 1, PACKED_SHARDS_PER_TASK).otherwise(SHARDS_PER_TASK)
    piles = F.ceil(F.col("shards") / per_pile).cast("int")
    wanted = shards.select("part", "shards").distinct().join(sized, "part")
    rows = wanted.select("part", shares.alias("shares"), piles.alias("piles")).collect()  # a row per part that is asked
    part_type = shards.schema["part"].dataType.simpleString()
    plan = shards.sparkSession.createDataFrame(rows, f"part {part_type}, shares int, piles int")
    slim = _compact(asked.select("part", "q_key", "vec")) if book is None else _once(asked.select("part", "q_key", "entries"))
    queries = (
        slim.join(F.broadcast(plan), "part")
        .withColumn("share", F.pmod(F.xxhash64("q_key"), F.col("shares")).cast("int"))
        .withColumn("pile", F.explode(F.sequence(F.lit(0), F.col("piles") - 1)))
    )
    spread = (
        shards.join(F.broadcast(plan), "part")
        .withColumn("pile", F.col("shard") % F.col("piles"))
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    )
    place = ["part", "pile", "share"]
    texts = ["terms", "weights"] if book is None else ["entries"]
    held = ["ids", "copies", "terms", "starts", "places", "weights"] if book is None else ["shard", "vec_id", "copies", "entries"]
    return _search(queries.select(*place, "q_key", *texts), spread.select(*place, *held), k, book)
