"""Texts that occur inside other texts: evaluation queries in a corpus.

A corpus text leaks a query if the query's words occur in it one after another, or, for queries of
fewer than ``words`` words, if both are equal. Both sides are cleaned like index texts.

Found by rare anchors, without comparing all pairs. Every run of ``words`` words is a shingle. The
corpus is read once and only shingles that a query has are kept. A query of which any shingle is
missing occurs nowhere; any other is looked up by its rarest shingle alone, and what that finds is
verified on the texts. Texts are told apart by a 128-bit digest, so copies are settled once, rows
without an id are treated like all others, and no text is ever a shuffle key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.functions import text as tx
from deskloom.operators.skew import lookup_join
from deskloom.session import cut_lineage

WORDS = 5
# shingles of queries, 8 bytes each, that are sent to every task; beyond, the join shuffles
BROADCAST_SHINGLES = 2_000_000


def shingles(cleaned: Column, words: int) -> Column:
    """Distinct 64-bit hashes of the runs of ``words`` words of a cleaned text. The words are bound to a
    lambda's name, so that a text is split once, and a run is hashed word by word without being joined."""

    def runs(parts: Column) -> Column:
        last = F.size(parts) - words
        hashes = F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(parts, i + j) for j in range(words)])
        )
        return F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))

    return F.array_distinct(F.get(F.transform(F.array(F.split(cleaned, " ")), runs), F.lit(0)))


def _cleaned(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with ``__text``, the cleaned text, and ``__key``, its digest; null where nothing is kept."""
    kept = F.nullif(tx.clean(F.col(text_col), "index"), F.lit(""))
    return df.withColumn("__text", kept).withColumn("__key", F.unhex(F.md5("__text")))


def _occurrences(queries: DataFrame, corpus: DataFrame, words: int) -> DataFrame:
    """(q_key, __key): distinct cleaned query texts and the distinct corpus texts that hold them."""
    asked = cut_lineage(queries.groupBy(F.col("__key").alias("q_key")).agg(F.first("__text").alias("q_text")))
    long = tx.word_count(F.col("q_text")) >= words
    short = asked.filter(~long).select("q_key")
    equal = corpus.select("__key").join(short, F.col("q_key") == F.col("__key")).select("q_key", "__key").distinct()

    wanted = cut_lineage(asked.filter(long).select("q_key", F.explode(shingles(F.col("q_text"), words)).alias("h")))
    distinct = wanted.select("h").distinct()
    if wanted.count() <= BROADCAST_SHINGLES:  # a footer count: wanted is a written table
        distinct = F.broadcast(distinct)
    found = corpus.select("__key", F.explode(shingles(F.col("__text"), words)).alias("h"))
    hits = cut_lineage(found.join(distinct, "h", "left_semi").distinct())
    texts_with = hits.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    anchors = (
        wanted.join(texts_with, "h", "left")
        .groupBy("q_key")
        .agg(F.min(F.struct("df", "h")).alias("rarest"), F.count(F.lit(1)).alias("n"), F.count("df").alias("there"))
        .filter(F.col("n") == F.col("there"))
        .select("q_key", F.col("rarest.h").alias("h"))
    )
    candidates = cut_lineage(hits.join(anchors, "h").select("q_key", "__key"))
    texts = (
        corpus.select("__key", "__text")
        .join(candidates.select("__key").distinct(), "__key", "left_semi")
        .groupBy("__key")
        .agg(F.first("__text").alias("__text"))
    )
    blank = F.lit(" ")
    inside = F.contains(F.concat(blank, F.col("__text"), blank), F.concat(blank, F.col("q_text"), blank))
    held = candidates.join(asked, "q_key").join(texts, "__key").filter(inside).select("q_key", "__key")
    return cut_lineage(held.unionByName(equal))


def containment_report(
    queries: DataFrame,
    corpus: DataFrame,
    query_id: str,
    query_text: str,
    case_id: str,
    case_text: str,
    words: int = WORDS,
) -> DataFrame:
    """(query_id, copies, first_case): queries that occur in the corpus, in how many of its rows, and
    the smallest id among them."""
    asked = _cleaned(queries.select(F.col(query_id), F.col(query_text).alias("__raw")), "__raw").filter("__key IS NOT NULL")
    held = _cleaned(corpus.select(F.col(case_id), F.col(case_text).alias("__raw")), "__raw").filter("__key IS NOT NULL")
    held = cut_lineage(held.drop("__raw"))  # read several times, cleaned once
    pairs = _occurrences(asked, held, words)
    rows = held.groupBy("__key").agg(F.count(F.lit(1)).alias("copies"), F.min(case_id).alias("first_case"))
    counted = (
        pairs.join(rows, "__key")
        .groupBy(F.col("q_key").alias("__key"))
        .agg(F.sum("copies").alias("copies"), F.min("first_case").alias("first_case"))
    )
    return lookup_join(asked.select(query_id, "__key"), counted, "__key", spread_by=[query_id]).drop("__key")


def without_contained(
    corpus: DataFrame, queries: DataFrame, case_text: str, query_text: str, words: int = WORDS
) -> DataFrame:
    """The corpus rows that leak none of the queries: the guard for an index that is going to be
    evaluated with them. Rows without any kept character leak nothing and stay."""
    asked = _cleaned(queries.select(F.col(query_text).alias("__raw")), "__raw").filter("__key IS NOT NULL")
    held = cut_lineage(_cleaned(corpus, case_text))  # read several times, cleaned once
    leaking = _occurrences(asked, held.filter("__key IS NOT NULL").select("__key", "__text"), words).select("__key").distinct()
    return held.join(leaking, "__key", "left_anti").drop("__key", "__text")
