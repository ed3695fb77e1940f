"""Exact top-k search by inner product in an M-tree kept as tables of pages.

Inner product is no metric, so every vector gets one more component, sqrt(M - |v|^2) with M the
largest squared norm, and a query gets zero there. All vectors then have the squared norm M, the
Euclidean distance is a metric, and d^2 = |q|^2 + M - 2 <q, v> falls as the inner product rises.

Index. Equal vectors are one object. Pivots, objects drawn by their digest, form the root page;
every object goes to the nearest pivot's cell, and every cell is bulk-loaded as one or several
subtrees of pages. A page holds a routing object and entries; an entry of an inner page is a child
page with its covering radius, and every entry stores its distance to the page's routing object.

Search. A query visits pages best first, by the least distance that a covering radius leaves
possible, and stops when that exceeds its k-th best. Inside a page the stored parent distances
rule out entries by the triangle inequality before their distance is computed. Each query first
searches a subtree of its nearest cell; the k-th distance found there is carried to every other
cell whose ring of distances it reaches, in blocks of queries, so no task holds all queries or
all pages. Scores are integers and ties are never pruned: the answer is that of a full scan.

Defined results: rows with a null id, a null vector or a null or non-finite component take no
part; shorter vectors count as padded with zeros; ties go to the smaller id; a row that is
repeated counts once, and rows of one id with different vectors are rows, and queries, of their
own; fewer than k other rows give a shorter list; empty tables give an empty result; other columns
are ignored. Components beyond the exact range are refused.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.llm.common import pick
from deskloom.llm.vectors import floored, matrix, measure, unpack, usable
from deskloom.operators.skew import lookup_join, top_within
from deskloom.session import cut_lineage

CAPACITY = 64  # entries of a page
PER_CELL = 512  # objects of a cell, as long as the root page has room
ROOT_ENTRIES = 1024  # the bound of the root page, which is broadcast
PER_TREE = 4096  # objects of a subtree; a larger cell gets several
QUERY_BLOCK = 512  # queries that travel together
QUERIES_PER_TASK = 65_536
HIT = "q_key binary, o_key binary, least_id bigint, score bigint"


@dataclass(frozen=True)
class MTree:
    """members(vec_id, vec, key) of every row · objects(key, vec_id, vec) once per distinct vector, with
    its smallest id · cells, the root page: pivots and rings of distances · pages(cell, tree, body)."""

    members: DataFrame
    objects: DataFrame
    pages: DataFrame
    pivots: np.ndarray
    lifts: np.ndarray
    rings: np.ndarray  # least and largest distance of a cell's objects to its pivot
    trees: list[int]  # subtrees of each cell
    dims: int
    top: int  # the largest squared norm


def _distances(points: np.ndarray, lifts: np.ndarray, point: np.ndarray, lift: float, top: int) -> np.ndarray:
    """Between indexed objects: all have the squared norm ``top`` once they are lifted."""
    return np.sqrt(np.maximum(2.0 * (top - points @ point - lifts * lift), 0.0))


def _slack(top: int) -> float:
    """More than the rounding of a distance near zero, which cancellation makes relative to the norm."""
    return 1e-6 * (top**0.5 + 1.0)


def _lifts(points: np.ndarray, top: int) -> np.ndarray:
    return np.sqrt(np.maximum(top - (points * points).sum(axis=1), 0.0))


def _bodies(points: np.ndarray, keys: list[bytes], ids: np.ndarray, top: int) -> list[bytes]:
    """The pages of one subtree, the root first; a page names its children by their places.

    Top-down bulk load: seeds, spread by farthest-first choice, split the objects of a page that
    overflows. The objects are distinct, so each seed keeps itself and the split always advances.
    """
    points = np.asarray(points, np.float64)
    lifts = _lifts(points, top)
    bodies: list[bytes] = []
    # place of the page, its objects, its routing object
    waiting = [(0, np.arange(len(points)), 0)]
    places = 1
    while waiting:
        place, own, router = waiting.pop()
        far = _distances(points[own], lifts[own], points[router], lifts[router], top)
        if len(own) <= CAPACITY:
            order = np.argsort(far, kind="stable")
            own, far = own[order], far[order]
            entries, radii, children = own, np.zeros(len(own)), np.full(len(own), -1, np.int32)
        else:
            wanted = min(CAPACITY, -(-len(own) // (CAPACITY // 2)))
            seeds, owner = [router], np.zeros(len(own), np.int64)
            nearest = far.copy()
            while len(seeds) < wanted:
                farthest = int(nearest.argmax())
                if nearest[farthest] <= 0.0:  # told apart by their components, not by rounded distances
                    farthest = int(np.flatnonzero(~np.isin(own, seeds))[0])
                seeds.append(int(own[farthest]))
                to_seed = _distances(points[own], lifts[own], points[seeds[-1]], lifts[seeds[-1]], top)
                closer = to_seed < nearest
                closer[farthest] = True
                owner[closer] = len(seeds) - 1
                nearest[closer] = to_seed[closer]
                nearest[farthest] = 0.0
            entries = np.array(seeds)
            radii = np.zeros(len(seeds))
            children = np.zeros(len(seeds), np.int32)
            for i, seed in enumerate(seeds):
                held = own[owner == i]
                radii[i] = _distances(points[held], lifts[held], points[seed], lifts[seed], top).max()
                children[i] = places
                waiting.append((places, held, seed))
                places += 1
            far = _distances(points[entries], lifts[entries], points[router], lifts[router], top)
        head = struct.pack("<iid", place, len(entries), float(lifts[router]))
        parts = [
            points[router].astype(np.int32), points[entries].astype(np.int32), far, radii, children,
            ids[entries].astype(np.int64),
        ]
        bodies.append(head + b"".join(p.tobytes() for p in parts) + b"".join(keys[i] for i in entries))
    return bodies


@dataclass
class _Page:
    router: np.ndarray
    points: np.ndarray
    parent: np.ndarray
    radii: np.ndarray
    children: np.ndarray
    ids: np.ndarray
    keys: bytes

    @classmethod
    def read(cls, body: bytes, dims: int) -> tuple[int, _Page]:
        place, n, _ = struct.unpack_from("<iid", body)
        at = 16

        def take(kind: type, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(body, kind, count, at)
            at += out.nbytes
            return out

        router, points = take(np.int32, dims).astype(float), take(np.int32, n * dims).reshape(n, dims).astype(float)
        page = cls(
            router, points, take(np.float64, n), take(np.float64, n), take(np.int32, n), take(np.int64, n), body[at:]
        )
        return place, page


class Searcher:
    """Best-first search of one subtree. ``computed`` counts distances, ``spared`` those that the
    stored parent distances made needless."""

    def __init__(self, bodies: list[bytes], dims: int, top: int):
        self.pages = dict(_Page.read(b, dims) for b in bodies)
        self.top, self.slack = top, _slack(top)
        self.computed = self.spared = 0

    def nearest(self, query: np.ndarray, k: int, least: float = -np.inf) -> list[tuple[int, int, bytes]]:
        """(-score, id, key), best first, of the k best objects with at least the score ``least``."""
        squared = float(query @ query) + self.top

        def away(scores: np.ndarray | float) -> np.ndarray:
            return np.sqrt(np.maximum(squared - 2.0 * scores, 0.0))

        best: list[tuple[int, int, bytes]] = []
        reach = float(away(least)) + self.slack if least > -np.inf else np.inf
        root = self.pages[0]
        self.computed += 1
        heap = [(0.0, 0, float(away(float(root.router @ query))))]
        while heap:
            bound, place, to_router = heapq.heappop(heap)
            if bound > reach:
                break
            page = self.pages[place]
            near = np.flatnonzero(np.abs(to_router - page.parent) - page.radii <= reach)
            self.computed += len(near)
            self.spared += len(page.ids) - len(near)
            scores = page.points[near] @ query
            if page.children[0] >= 0:
                distances = away(scores)
                bounds = np.maximum(distances - page.radii[near], bound)
                for b, c, d in zip(bounds.tolist(), page.children[near].tolist(), distances.tolist()):
                    if b <= reach:
                        heapq.heappush(heap, (b, c, d))
                continue
            good = scores >= least
            if good.any():
                for s, i in zip(scores[good].tolist(), near[good].tolist()):
                    best.append((-int(s), int(page.ids[i]), page.keys[16 * i : 16 * i + 16]))
                best = heapq.nsmallest(k, best)
                if len(best) == k:
                    least = max(least, float(-best[-1][0]))
                    reach = float(away(least)) + self.slack
        return best


def integer_rows(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, vec, key): usable rows with their integer vectors and a 128-bit digest of them."""
    source = pick(df, vec_id=id_col, vec=vec_col).filter(F.col("vec_id").isNotNull() & usable(F.col("vec")))
    source = source.select(F.col("vec_id").cast("long").alias("vec_id"), floored(F.col("vec"), scale).alias("vec"))
    # trailing zeros are padding, so they are no part of a vector's identity
    size = F.coalesce(F.array_max(F.transform("vec", lambda x, i: F.when(x != 0, i + 1).otherwise(0))), F.lit(0))
    text = F.array_join(F.transform(F.slice("vec", F.lit(1), size), lambda x: x.cast("string")), ",")
    return source.select("vec_id", "vec", F.unhex(F.md5(text)).alias("key"))


def build_mtree(
    rows: DataFrame, per_cell: int = PER_CELL, root_entries: int = ROOT_ENTRIES, per_tree: int = PER_TREE
) -> MTree:
    """Index (vec_id, vec, key). Every row is a member of an object and every object is in a leaf;
    only the choice of pivots rests on a sample, of at most ``root_entries`` objects."""
    rows = cut_lineage(rows)
    objects = cut_lineage(rows.groupBy("key").agg(F.min("vec_id").alias("vec_id"), F.first("vec").alias("vec")))
    n, dims, top = measure(objects, "vec")
    wanted = min(root_entries, -(-n // per_cell))
    chosen = objects.orderBy("key").limit(wanted).toPandas() if wanted else None
    pivots = np.zeros((max(wanted, 0), dims))
    for i in range(wanted):
        pivots[i, : len(chosen["vec"][i])] = chosen["vec"][i]
    lifts = _lifts(pivots, top)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch.column("vec"), dims)
            own = _lifts(points, top)
            apart = 2.0 * (top - points @ pivots.T - np.outer(own, lifts))
            cell = apart.argmin(axis=1)
            far = np.sqrt(np.maximum(apart[np.arange(len(cell)), cell], 0.0))
            packed = [p.tobytes() for p in points.astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), pa.array(far), batch.column("key"), batch.column("vec_id"), pa.array(packed, pa.binary())],
                ["cell", "far", "key", "vec_id", "packed"],
            )

    assigned = cut_lineage(
        objects.select("key", "vec_id", "vec").mapInArrow(assign, "cell int, far double, key binary, vec_id bigint, packed binary")
    )
    # one row per cell, and a cell per entry of the root page
    found = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("far").alias("least"), F.max("far").alias("most"))
    rings, trees = np.zeros((wanted, 2)), [0] * wanted
    for r in found.collect():
        rings[r["cell"]] = r["least"], r["most"]
        trees[r["cell"]] = -(-r["n"] // per_tree)
    slices = F.element_at(F.array(*[F.lit(t) for t in trees or [1]]), F.col("cell") + 1)
    dealt = assigned.withColumn("tree", F.pmod(F.xxhash64("key"), F.greatest(slices, F.lit(1))).cast("int"))

    def load(table: pa.Table) -> pa.Table:
        points = unpack(table["packed"].to_pylist(), dims) if dims else np.zeros((table.num_rows, 0))
        bodies = _bodies(points, table["key"].to_pylist(), np.asarray(table["vec_id"]), top)
        place = [table[c][0].as_py() for c in ("cell", "tree")]
        return pa.table(
            {"cell": pa.array([place[0]] * len(bodies), pa.int32()), "tree": pa.array([place[1]] * len(bodies), pa.int32()),
             "body": pa.array(bodies, pa.binary())}
        )

    pages = cut_lineage(dealt.groupBy("cell", "tree").applyInArrow(load, "cell int, tree int, body binary"))
    return MTree(rows, objects, pages, pivots, lifts, rings, trees, dims, top)


def _blocks(queries: DataFrame, index: MTree, first: bool) -> DataFrame:
    """(cell, keys, vecs, leasts): blocks of queries for every cell that may hold an answer. With
    ``first`` every query goes to its nearest cell only; otherwise ``least``, the k-th score that it
    has found there, rules out cells by their rings of distances to the pivot."""
    pivots, rings, top, dims, slack = index.pivots, index.rings, index.top, index.dims, _slack(index.top)
    live = np.array(index.trees) > 0

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, QUERY_BLOCK):
                batch = whole.slice(at, QUERY_BLOCK)
                points = matrix(batch.column("vec"), dims)
                keys = batch.column("key").to_pylist()
                squared = (points * points).sum(axis=1) + top
                apart = np.sqrt(np.maximum(squared[:, None] - 2.0 * points @ pivots.T, 0.0))
                if first:
                    least = np.full(len(keys), -np.inf)
                    nearest = np.where(live, apart, np.inf).argmin(axis=1)
                    goes = nearest[:, None] == np.arange(len(pivots))
                else:
                    least = np.asarray(batch.column("least").fill_null(-np.inf))
                    with np.errstate(invalid="ignore"):
                        reach = np.where(np.isinf(least), np.inf, np.sqrt(np.maximum(squared - 2.0 * least, 0.0)) + slack)[:, None]
                    goes = (apart - rings[:, 1] <= reach) & (rings[:, 0] - apart <= reach) & live
                cells = np.flatnonzero(goes.any(axis=0))
                packed = points.astype(np.int32)
                picks = [np.flatnonzero(goes[:, c]) for c in cells]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cells, pa.int32()),
                        pa.array([b"".join(keys[i] for i in p) for p in picks], pa.binary()),
                        pa.array([packed[p].tobytes() for p in picks], pa.binary()),
                        pa.array([least[p].tobytes() for p in picks], pa.binary()),
                    ],
                    ["cell", "keys", "vecs", "leasts"],
                )

    columns = ["key", "vec"] if first else ["key", "vec", "least"]
    return queries.select(*columns).mapInArrow(route, "cell int, keys binary, vecs binary, leasts binary")


def _search(blocks: DataFrame, index: MTree, k: int, parts: int, first: bool) -> DataFrame:
    """(q_key, o_key, least_id, score): the k best objects of each subtree for each query of its blocks. The
    pages of a subtree meet one of ``parts`` shares of the queries at a time; ``first`` asks a single
    subtree of each cell."""
    dims, top = index.dims, index.top
    many = F.element_at(F.array(*[F.lit(1 if first else max(t, 1)) for t in index.trees or [1]]), F.col("cell") + 1)
    asked = blocks.withColumn("part", F.pmod(F.xxhash64("keys"), F.lit(parts)).cast("int")).withColumn(
        "tree", F.explode(F.sequence(F.lit(0), many - 1))
    )
    pages = index.pages.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    if first:
        pages = pages.filter("tree = 0")

    def meet(key: tuple, block: pa.Table, held: pa.Table) -> pa.Table:
        out: list[tuple[bytes, bytes, int, int]] = []
        if block.num_rows and held.num_rows:
            searcher = Searcher(held["body"].to_pylist(), dims, top)
            for keys, vecs, leasts in zip(*(block[c].to_pylist() for c in ("keys", "vecs", "leasts"))):
                points = unpack([vecs], dims) if dims else np.zeros((len(keys) // 16, 0))
                for i, least in enumerate(np.frombuffer(leasts)):
                    for minus, least_id, o_key in searcher.nearest(points[i], k, float(least)):
                        out.append((keys[16 * i : 16 * i + 16], o_key, least_id, -minus))
        kinds = {"q_key": pa.binary(), "o_key": pa.binary(), "least_id": pa.int64(), "score": pa.int64()}
        return pa.table({c: pa.array([x[i] for x in out], t) for i, (c, t) in enumerate(kinds.items())})

    place = ["cell", "tree", "part"]
    return asked.groupBy(*place).cogroup(pages.groupBy(*place)).applyInArrow(meet, HIT)


def nearest_objects(queries: DataFrame, index: MTree, k: int, per_task: int = QUERIES_PER_TASK) -> DataFrame:
    """(q_key, o_key, least_id, score): the k best objects per distinct query vector (key, vec), ties
    by the smallest id that an object has."""
    asked = queries.count()
    if not index.trees or not asked:
        return index.objects.sparkSession.createDataFrame([], HIT)
    parts = -(-asked // per_task)
    tried = cut_lineage(_search(_blocks(queries, index, True), index, k, parts, True))
    # a full list of k bounds the k-th score from below; a shorter one bounds nothing
    bounds = tried.groupBy("q_key").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).cast("double").alias("least"))
    bounded = queries.join(bounds.withColumnRenamed("q_key", "key"), "key", "left")
    found = _search(_blocks(bounded, index, False), index, k, parts, False)
    return top_within(found, ["q_key"], [F.col("score").desc(), F.col("least_id")], k)


def top_k(
    df: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding",
    **shape: int,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``is_query`` (over the column ``vec_id``)
    marks, the k rows of other ids with the largest inner products.

    The best k + 1 objects hold the best k rows beside the query's own; of each object's members the
    k + 1 smallest ids can matter, and a query drops its own id at the end.
    """
    index = build_mtree(integer_rows(df, id_col, vec_col, scale), **shape)
    marked = index.members.filter(is_query)
    owners = marked.select(F.col("vec_id").alias("query_id"), F.col("key").alias("q_key")).distinct()
    asked = cut_lineage(marked.groupBy("key").agg(F.first("vec").alias("vec")))
    best = cut_lineage(nearest_objects(asked, index, k + 1))
    hit = best.select(F.col("o_key").alias("key")).distinct()
    known = index.members.select("vec_id", "key").join(hit, "key", "left_semi").distinct()
    heads = top_within(known, ["key"], [F.col("vec_id")], k + 1)
    own = (F.col("o_key") == F.col("q_key")).alias("own")
    listed = best.join(heads.withColumnRenamed("key", "o_key"), "o_key").select("q_key", "vec_id", "score", own)
    order = [F.col("score").desc(), F.col("vec_id")]
    # a row for each distinct query vector, so that one which many queries share is an ordinary lookup
    lists = (
        top_within(listed, ["q_key"], order, k + 1, out="place")
        .groupBy("q_key")
        .agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score", "own"))).alias("found"))
    )
    joined = lookup_join(cut_lineage(owners), lists, "q_key", "inner", ["query_id"])
    others = F.slice(F.filter("found", lambda x: ~(x["own"] & (x["vec_id"] == F.col("query_id")))), 1, k)
    ranked = joined.select("query_id", F.posexplode(others).alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")
