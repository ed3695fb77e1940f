"""URL rules answered by cascades of Bloom filters.

A rule is a host and a start of the path. Every page url yields its keys: each host suffix at a
label boundary, joined with each path start, of the lengths that occur in the rule list. Level 0
of a cascade encodes the listed keys, level 1 the keys of the corpus that level 0 lets through by
mistake, level 2 the listed keys that level 1 lets through, and so on until a level makes no
mistake over the complete set of keys. Membership of any key of the corpus is then exact, without
a join at look-up. A filter takes at most ``max_bytes``; with more keys it errs more often and the
cascade gets more levels, not less exact ones.

Defined results: a null url or one without ``://`` has empty host and path and no rule; a null
page_id is handed on; repeated rows are judged one by one; an empty table or rule list works;
other columns are ignored. Of two fitting rules of one length, the one with the longer host wins. A
key that is listed with both verdicts is allowed, in whatever order it comes. Hosts of urls are in
lower case, so a rule host with capitals fits nothing; rules of any other verdict say nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskloom.llm.common import pick
from deskloom.session import cut_lineage

BITS_PER_KEY = 12
HASHES = 4
MAX_BYTES = 16 << 20


@dataclass
class Level:
    """One Bloom filter: ``words`` holds its bits, ``salt`` makes its hashes its own."""

    salt: int
    bits: int
    words: np.ndarray

    def holds(self, keys: Sequence[str]) -> np.ndarray:
        at = bit_positions(keys, self.salt, self.bits)
        found = (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)
        return found.all(axis=1)


def bit_positions(keys: Sequence[str], salt: int, bits: int) -> np.ndarray:
    raw = b"".join(xxhash.xxh3_128_digest(k, seed=salt) for k in keys)
    halves = np.frombuffer(raw, dtype="<u8").reshape(-1, 2)
    steps = np.arange(HASHES, dtype=np.uint64)
    return (halves[:, :1] + steps * (halves[:, 1:] | np.uint64(1))) % np.uint64(bits)


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def holds(self, keys: Sequence[str]) -> np.ndarray:
        """Exact for every key that was in the universe when the cascade was built."""
        member = np.zeros(len(keys), bool)
        asked = np.arange(len(keys))
        for number, level in enumerate(self.levels):
            passed = level.holds([keys[i] for i in asked]) if len(asked) else np.zeros(0, bool)
            member[asked[~passed]] = number % 2 == 1
            asked = asked[passed]
        member[asked] = len(self.levels) % 2 == 1
        return member


def _build_level(keys: DataFrame, salt: int, max_bytes: int) -> Level | None:
    """A filter over the column ``key``: its words are made per task and joined by bit_or."""
    n = keys.count()
    if not n:
        return None
    bits = min(max_bytes * 8, max(64, -(-n * BITS_PER_KEY // 64) * 64))

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            at = bit_positions(batch.column(0).to_pylist(), salt, bits).ravel()
            np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used].view(np.int64))], ["word", "value"])

    rows = (
        keys.select("key").mapInArrow(set_bits, "word bigint, value bigint").groupBy("word").agg(F.bit_or("value").alias("value"))
    ).toPandas()
    words = np.zeros(bits // 64, np.uint64)
    words[rows["word"].to_numpy()] = rows["value"].to_numpy().astype(np.int64).view(np.uint64)
    return Level(salt, bits, words)


def build_cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> Cascade:
    """``listed`` and ``universe`` have one distinct column ``key``."""
    cascade = Cascade()
    mine, others = listed, universe.join(listed, "key", "left_anti")
    while (level := _build_level(mine, len(cascade.levels), max_bytes)) is not None:
        cascade.levels.append(level)
        shared = universe.sparkSession.sparkContext.broadcast(level)

        def passing(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield batch.filter(pa.array(shared.value.holds(batch.column(0).to_pylist())))

        mistakes = cut_lineage(others.select("key").mapInArrow(passing, "key string"))
        mine, others = mistakes, mine
    return cascade


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def url_keys(host: str, path: str, shapes: dict[int, list[int]]) -> list[tuple[int, int, str]]:
    """(host length, path length, key) of a url, for the lengths in ``shapes``."""
    keys = []
    start = 0
    while host:
        for size in shapes.get(len(host) - start, ()):
            if size <= len(path):
                keys.append((len(host) - start, size, host[start:] + path[:size]))
        start = host.find(".", start) + 1
        if not start:
            break
    return keys


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """page_id, host, path, rule, verdict per page. ``rules`` has host, path, verdict (allow or
    block); the verdict of the longest rule that fits counts, else ``default``, which says that
    no cascade holds a key of the url. The lengths of the rules' hosts and paths go to every
    task: hosts have at most 253 characters, so this is a few thousand pairs at most."""
    spark: SparkSession = pages.sparkSession
    host, path = host_and_path("url")
    urls = pick(pages, page_id=id_col, url=url_col).select("page_id", host.alias("host"), path.alias("path"))
    listed = cut_lineage(
        pick(rules, host="host", path="path", verdict="verdict")
        .filter(F.col("host").isNotNull())
        .select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .distinct()
    )
    shapes: dict[int, list[int]] = {}
    for row in listed.select(F.length("host").alias("h"), F.length("path").alias("p")).distinct().collect():
        shapes.setdefault(row["h"], []).append(row["p"])

    def all_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {k for h, p in zip(*(c.to_pylist() for c in batch.columns)) for _, _, k in url_keys(h, p, shapes)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["key"])

    universe = cut_lineage(urls.select("host", "path").mapInArrow(all_keys, "key string").distinct())
    keyed = listed.select(F.concat("host", "path").alias("key"), "verdict")
    cascades = {
        verdict: build_cascade(keyed.filter(F.col("verdict") == verdict).select("key").distinct(), universe, max_bytes)
        for verdict in ("allow", "block")
    }
    shared = spark.sparkContext.broadcast(cascades)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [
                (row, h + p, h, key)
                for row, (host, path) in enumerate(zip(*(batch.column(i).to_pylist() for i in (1, 2))))
                for h, p, key in url_keys(host, path, shapes)
            ]
            rule: list[str | None] = [None] * batch.num_rows
            verdict = [default] * batch.num_rows
            rank = [(-1, -1)] * batch.num_rows
            for name in ("allow", "block") if keys else ():
                for (row, size, h, key), hit in zip(keys, shared.value[name].holds([k[3] for k in keys])):
                    if hit and (size, h) > rank[row]:
                        rank[row], rule[row], verdict[row] = (size, h), key, name
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                [*batch.schema.names, "rule", "verdict"],
            )

    kind = urls.schema["page_id"].dataType.simpleString()
    return urls.mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string")
